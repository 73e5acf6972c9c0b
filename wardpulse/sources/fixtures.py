"""Fixture views: vital-sign readings and a registry changelog derived from the
given tables (``events``; ``orders`` joined to ``customer``).

The derivation is pure integer arithmetic in column expressions, so it is
deterministic, runs inside the parquet scan's codegen stage, and scales with
the input.  The same formulas are written as SQL in ``plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardpulse.sources.tables import inline_table, read_table

EPOCH_2024_US = 1704067200000000   # 2024-01-01T00:00:00Z in microseconds
EPOCH_2024_MS = EPOCH_2024_US // 1000
TIME_COMPRESSION = 300000           # µs of source time per ms of reading time
WILD_EVERY = 53                     # every 53rd event is outside its envelope

# The six simulator states with their vital-sign envelopes
# (value = low + 0..n-1; temperature in tenths of a degree) and the percentage
# of readings on supplemental oxygen.
# sid, state, rr0, rrn, sp0, spn, o2_pct, t0, tn, bp0, bpn, hr0, hrn
ENVELOPE = [
    (0, "STABLE", 12, 9, 95, 5, 0, 361, 12, 110, 21, 60, 21),
    (1, "DETERIORATING_SEPSIS", 20, 11, 93, 5, 20, 385, 16, 85, 21, 100, 41),
    (2, "DETERIORATING_RESPIRATORY", 25, 11, 88, 6, 100, 365, 11, 105, 21, 90, 31),
    (3, "DETERIORATING_CARDIAC", 18, 9, 92, 5, 40, 360, 11, 80, 21, 100, 51),
    (4, "POST_OP_RECOVERING", 14, 9, 93, 5, 30, 368, 11, 100, 21, 75, 21),
    (5, "SEPTIC_SHOCK", 25, 14, 85, 7, 100, 385, 26, 60, 26, 120, 41),
]
STATES = [row[1] for row in ENVELOPE]

# Declared Markov transition probabilities, from-state rows in
# the order of STATES, to-state columns in the same order.
TRANSITIONS = [
    [0.93, 0.02, 0.02, 0.01, 0.01, 0.01],
    [0.08, 0.80, 0.03, 0.02, 0.02, 0.05],
    [0.08, 0.03, 0.82, 0.04, 0.02, 0.01],
    [0.08, 0.02, 0.04, 0.82, 0.02, 0.02],
    [0.20, 0.04, 0.04, 0.04, 0.67, 0.01],
    [0.02, 0.15, 0.05, 0.05, 0.03, 0.70],
]

# The typical NEWS2 interval for each state (inclusive; None =
# open-ended).
TYPICAL_SCORE = {
    "STABLE": (0, 2),
    "DETERIORATING_SEPSIS": (4, 7),
    "DETERIORATING_RESPIRATORY": (5, 8),
    "DETERIORATING_CARDIAC": (4, 7),
    "POST_OP_RECOVERING": (1, 4),
    "SEPTIC_SHOCK": (7, None),
}

# Order status -> registry event type.
ADMIN_EVENT = {"O": "ADMIT", "P": "TRANSFER", "F": "DISCHARGE"}
UNREGISTERED_MOD, UNREGISTERED_REM = 17, 3   # registry holes of the J4 fixture
# Share of each consciousness level declared for a state, in the
# order ALERT, NEW_CONFUSION, VOICE, PAIN, UNRESPONSIVE.
CONSCIOUSNESS_MIX = {
    "STABLE": (1.0, 0.0, 0.0, 0.0, 0.0),
    "DETERIORATING_SEPSIS": (0.60, 0.25, 0.15, 0.0, 0.0),
    "DETERIORATING_RESPIRATORY": (0.70, 0.20, 0.10, 0.0, 0.0),
    "DETERIORATING_CARDIAC": (0.70, 0.20, 0.10, 0.0, 0.0),
    "POST_OP_RECOVERING": (1.0, 0.0, 0.0, 0.0, 0.0),
    "SEPTIC_SHOCK": (0.0, 0.0, 0.33, 0.33, 0.34),
}
# Rules of the missing-vitals fixture: heart rate absent, temperature not a
# number, and temperatures off the 0.1 degree grid.
NO_HR_MOD, NAN_TEMP_MOD, FINE_MOD, FINE_STEP = 7, 11, 1000, 0.00049
WARDS = 5


def epoch_us(df: DataFrame, name: str) -> Column:
    """Epoch microseconds of a timestamp column, independent of the session zone.

    TIMESTAMP_NTZ values are wall-clock UTC; they are measured against the NTZ
    epoch rather than cast through the session time zone.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(
            f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`)")
    return F.unix_micros(F.col(name))


def _consciousness(sid: Column, k: Column) -> Column:
    # Cut points of the per-state consciousness mix on a 0..99 draw.
    return (
        F.when(sid.isin(0, 4), F.lit("ALERT"))
        .when(sid == 1, F.when(k < 60, "ALERT").when(k < 85, "NEW_CONFUSION")
              .otherwise("VOICE"))
        .when(sid.isin(2, 3), F.when(k < 70, "ALERT").when(k < 90, "NEW_CONFUSION")
              .otherwise("VOICE"))
        .otherwise(F.when(k < 33, "VOICE").when(k < 66, "PAIN")
                   .otherwise("UNRESPONSIVE"))
    )


def raw_readings(spark: SparkSession, sf_dir: str, compression: int = TIME_COMPRESSION
                 ) -> DataFrame:
    """RAW readings (+ ``seq``, ``ts_ms``) derived row-by-row from ``events``;
    ``compression`` is µs of source time per ms of reading time."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "props"])
    us = epoch_us(ev, "ts")
    e = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("long")
    base = ev.select(
        e.alias("seq"),
        F.col("user_id"),
        (F.lit(EPOCH_2024_MS) + F.floor((us - F.lit(EPOCH_2024_US)) / compression)
         ).cast("long").alias("ts_ms"),
        F.dayofmonth(F.date_from_unix_date(F.floor(us / 86400000000).cast("int"))
                     ).cast("long").alias("dom"),
        k.alias("k"),
    )
    u, dom = F.col("user_id"), F.col("dom")
    m = (u * 7 + dom * (u + dom)) % 12
    sid = (F.when(m <= 5, 0).when(m == 6, 1).when(m == 7, 2).when(m == 8, 3)
           .when(m <= 10, 4).otherwise(5))
    staged = base.withColumns({"sid": sid, "wild": (F.col("seq") % WILD_EVERY) == 0})
    # Envelope parameters come from the 6-row state dimension (fixed size, so
    # the broadcast is bounded).  Joining instead of inlining CASE chains keeps
    # the scored expressions small when the optimizer pushes filters down.
    env = F.broadcast(envelope_dim(base.sparkSession))
    staged = staged.join(env, "sid", "left")
    s, w, kk = F.col("sid"), F.col("wild"), F.col("k")
    seq = F.col("seq")

    def vital(mult, wild_lo, wild_n, lo, n):
        drawn = seq * mult + kk
        return F.when(w, F.lit(wild_lo) + drawn % wild_n).otherwise(
            F.col(lo) + drawn % F.col(n))

    return staged.select(
        "seq",
        F.col("user_id").cast("string").alias("patient_id"),
        "ts_ms",
        F.timestamp_millis("ts_ms").alias("timestamp"),
        "simulator_state",
        vital(3, 4, 36, "rr0", "rrn").cast("int").alias("respiration_rate"),
        vital(5, 80, 21, "sp0", "spn").cast("int").alias("oxygen_saturation"),
        (((seq * 13 + kk) % 100) < F.col("o2_pct")).alias("supplemental_o2"),
        (vital(7, 340, 80, "t0", "tn").cast("double") / F.lit(10.0)).alias("temperature"),
        vital(11, 50, 200, "bp0", "bpn").cast("int").alias("systolic_bp"),
        vital(17, 30, 150, "hr0", "hrn").cast("int").alias("heart_rate"),
        _consciousness(s, kk).alias("consciousness_level"),
    )


REAL_TIME = 1000   # compression of the day fixture: the source's own 30 days


def with_hot_patient(raw: DataFrame, share: int = 3) -> DataFrame:
    """Skew fixture: one patient has a ``share``-th of all readings."""
    return raw.withColumn("patient_id", F.when(F.col("seq") % share == 0, F.lit("hot"))
                          .otherwise(F.col("patient_id")))


def with_missing_vitals(raw: DataFrame) -> DataFrame:
    """Readings with NULL heart rates, NaN temperatures and temperatures of
    full double precision."""
    seq = F.col("seq")
    return raw.withColumns({
        "heart_rate": F.when(seq % NO_HR_MOD != 0, F.col("heart_rate")),
        "temperature": F.when(seq % NAN_TEMP_MOD == 3, F.lit(float("nan"))).otherwise(
            F.col("temperature") + (seq % FINE_MOD).cast("double") * F.lit(FINE_STEP))})


def with_registry_holes(admin: DataFrame) -> DataFrame:
    """J4 fixture: a registry that lacks every 17th patient."""
    return admin.filter(F.col("patient_id").cast("long") % UNREGISTERED_MOD != UNREGISTERED_REM)


def admin_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ADMIN registry changelog derived from ``orders`` ⋈ ``customer``.

    The join is left to Catalyst/AQE: ``customer`` is a dimension whose runtime
    size decides broadcast vs shuffle, no hint is forced.
    """
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    ok = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    etype = F.when(status == "O", "ADMIT").when(status == "P", "TRANSFER").when(
        status == "F", "DISCHARGE")
    return (
        o.join(c, F.col("o_custkey") == F.col("c_custkey"), "inner")
        .select(
            ok.alias("seq"),
            F.col("o_custkey").cast("string").alias("patient_id"),
            (F.lit(EPOCH_2024_MS) + (ok * 7919) % 8640000).cast("long").alias("event_ms"),
            etype.alias("event_type"),
            F.concat(F.lit("W"), (ok % WARDS).cast("string")).alias("ward"),
            F.lit(None).cast("string").alias("initial_state"),
            ((ok % 4) == 0).alias("suspected_infection"),
            F.col("c_mktsegment").alias("unit"),
        )
    )


def envelope_dim(spark: SparkSession) -> DataFrame:
    """Six-row state-envelope dimension (fixed size: safe to broadcast)."""
    cols = [("sid", "int"), ("simulator_state", "string")] + [
        (c, "bigint") for c in ["rr0", "rrn", "sp0", "spn", "o2_pct", "t0", "tn", "bp0",
                                "bpn", "hr0", "hrn"]]
    return inline_table(spark, ENVELOPE, cols)


def transition_dim(spark: SparkSession) -> DataFrame:
    """36-row declared transition matrix (fixed size: safe to broadcast)."""
    rows = [(STATES[i], STATES[j], float(TRANSITIONS[i][j]))
            for i in range(6) for j in range(6)]
    return inline_table(spark, rows, [("from_state", "string"), ("to_state", "string"),
                                      ("declared_p", "double")])


def consciousness_dim(spark: SparkSession) -> DataFrame:
    """Six-row declared consciousness mix (fixed size: safe to broadcast)."""
    rows = [(s, *map(float, mix)) for s, mix in CONSCIOUSNESS_MIX.items()]
    return inline_table(spark, rows, [("simulator_state", "string")] + [
        (f"declared_{c}", "double")
        for c in ("alert", "new_confusion", "voice", "pain", "unresponsive")])


def typical_score_dim(spark: SparkSession) -> DataFrame:
    rows = [(s, lo, hi) for s, (lo, hi) in TYPICAL_SCORE.items()]
    return inline_table(spark, rows, [("simulator_state", "string"), ("lo", "int"),
                                      ("hi", "int")])
