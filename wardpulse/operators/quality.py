"""Data-quality and process-mining jobs re-aimed from the simulator.

The simulator's constant tables (state envelopes, transition matrix, typical
scores) become tiny broadcast dimensions; the per-patient sequence jobs
(transitions, episodes, gaps, sessions) use the chunked ordered helpers, so
a patient with a third of all readings is still spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardpulse.operators.ordered import SEQ_CHUNK, TIME_CHUNK_MS, runs, with_neighbour
from wardpulse.sources.fixtures import (
    STATES, consciousness_dim, envelope_dim, transition_dim, typical_score_dim)

CONSCIOUSNESS_LEVELS = ["ALERT", "NEW_CONFUSION", "VOICE", "PAIN", "UNRESPONSIVE"]
SILENCE_MS = 300_000          # R4/R5 threshold (parameter)

# parameter -> (low column, count column, scale) over the envelope dimension
_ENVELOPE_CHECKS = {
    "respiration_rate": ("rr0", "rrn", 1.0),
    "oxygen_saturation": ("sp0", "spn", 1.0),
    "temperature": ("t0", "tn", 10.0),
    "systolic_bp": ("bp0", "bpn", 1.0),
    "heart_rate": ("hr0", "hrn", 1.0),
}


def envelope_violations(readings: DataFrame) -> DataFrame:
    """Readings outside their state's declared range, per parameter."""
    spark = readings.sparkSession
    env = F.broadcast(envelope_dim(spark).drop("sid"))
    j = readings.join(env, "simulator_state", "left")
    flags = []
    for name, (lo, n, scale) in _ENVELOPE_CHECKS.items():
        v = F.col(name)
        low = F.col(lo) / F.lit(scale) if scale != 1.0 else F.col(lo)
        high = (F.col(lo) + F.col(n) - 1) / F.lit(scale) if scale != 1.0 else F.col(lo) + F.col(n) - 1
        flags.append(F.struct(F.lit(name).alias("parameter"),
                              (~v.between(low, high)).alias("violated")))
    long = j.select("simulator_state", F.explode(F.array(*flags)).alias("f"))
    return long.groupBy("simulator_state", F.col("f.parameter").alias("parameter")).agg(
        F.count(F.lit(1)).alias("readings"),
        F.count_if(F.col("f.violated")).alias("violations"))


def state_transitions(readings: DataFrame, chunk_width: int = SEQ_CHUNK) -> DataFrame:
    """R2: empirical P(next state | state) between consecutive readings of a
    patient, against the declared 36-cell matrix."""
    # States travel as their place in the declared list: fixed-width edges.
    states = F.array(*map(F.lit, STATES))
    coded = readings.select("patient_id", "seq",
                            F.array_position(states, F.col("simulator_state")).alias("state"))
    nb = with_neighbour(coded, "patient_id", ["seq"], ["state"], chunk_width=chunk_width)
    observed = (nb.filter(F.col("prev_state").isNotNull())
                .groupBy("prev_state", "state").agg(F.count(F.lit(1)).alias("transitions"))
                .filter((F.col("prev_state") > 0) & (F.col("state") > 0))
                .select(F.element_at(states, F.col("prev_state").cast("int")).alias("from_state"),
                        F.element_at(states, F.col("state").cast("int")).alias("to_state"),
                        "transitions"))
    dim = F.broadcast(transition_dim(readings.sparkSession))
    cells = dim.join(observed, ["from_state", "to_state"], "left").withColumn(
        "transitions", F.coalesce("transitions", F.lit(0)).cast("long"))
    # 36 rows: the per-from-state total is a window over at most 6 rows each
    total = F.sum("transitions").over(Window.partitionBy("from_state"))
    emp = F.when(total > 0, F.col("transitions").cast("double") / total.cast("double"))
    return cells.select("from_state", "to_state", "transitions",
                        emp.alias("empirical_p"), "declared_p").withColumn(
        "abs_diff", F.abs(F.col("empirical_p") - F.col("declared_p")))


def episodes(readings: DataFrame, state_col: str,
             chunk_width: int = SEQ_CHUNK) -> DataFrame:
    """Gaps-and-islands runs of the same ``state_col`` per patient; NULL is
    a state of its own (a rejected reading ends a run)."""
    base = readings.select("patient_id", "seq", "ts_ms", F.col(state_col).alias("state"))
    found = runs(base, "patient_id", ["seq"], ["state"],
                 lambda before, row: before["state"].eqNullSafe(row["state"]), "seq", "ts_ms",
                 chunk_width=chunk_width)
    return found.select("patient_id", F.col("run_start").alias("start_seq"),
                        F.col("first")["state"].alias("state"), "start_ms", "end_ms",
                        F.col("rows").alias("readings"))


def cadence_gaps(readings: DataFrame, threshold_ms: int = SILENCE_MS,
                 chunk_width: int = TIME_CHUNK_MS) -> DataFrame:
    """Silences longer than ``threshold_ms`` between a patient's readings."""
    nb = with_neighbour(readings.select("patient_id", "seq", "ts_ms"), "patient_id",
                        ["ts_ms", "seq"], ["ts_ms"], chunk_width=chunk_width)
    gap = F.col("ts_ms") - F.col("prev_ts_ms")
    return (nb.withColumn("gap_ms", gap).filter(F.col("gap_ms") > threshold_ms)
            .select("patient_id", "seq", "prev_ts_ms", "ts_ms", "gap_ms"))


def monitoring_sessions(readings: DataFrame, gap_ms: int = SILENCE_MS,
                        chunk_width: int = TIME_CHUNK_MS) -> DataFrame:
    """Contiguous monitoring periods; an inactivity of ``gap_ms`` or more
    starts a new session (same split rule as ``session_window``)."""
    found = runs(readings.select("patient_id", "seq", "ts_ms"), "patient_id", ["ts_ms", "seq"],
                 ["ts_ms"], lambda before, row: row["ts_ms"] - before["ts_ms"] < gap_ms,
                 "ts_ms", "ts_ms", chunk_width=chunk_width)
    return found.select("patient_id", F.col("run_start").alias("session_start_ms"),
                        F.col("end_ms").alias("session_end_ms"),
                        F.col("rows").alias("readings"))


def sessions_native(readings: DataFrame, gap: str = "5 minutes") -> DataFrame:
    """R5 with Spark's ``session_window`` (the streaming form)."""
    s = readings.groupBy("patient_id", F.session_window("timestamp", gap).alias("s")).agg(
        F.min("ts_ms").alias("session_start_ms"), F.max("ts_ms").alias("session_end_ms"),
        F.count(F.lit(1)).alias("readings"))
    return s.select("patient_id", "session_start_ms", "session_end_ms", "readings")


def state_profile(readings: DataFrame) -> DataFrame:
    """Observed physiology per state vs the declared O2 rate, and the
    observed and declared consciousness mix over the five ACVPU levels; one
    scan and one aggregate."""
    stats = readings.groupBy("simulator_state").agg(
        F.count(F.lit(1)).alias("readings"),
        F.min("heart_rate").alias("hr_min"), F.max("heart_rate").alias("hr_max"),
        F.avg("heart_rate").alias("hr_avg"), F.avg("respiration_rate").alias("rr_avg"),
        F.avg("systolic_bp").alias("bp_avg"), F.avg("oxygen_saturation").alias("spo2_avg"),
        F.min("temperature").alias("temp_min"), F.max("temperature").alias("temp_max"),
        (F.count_if("supplemental_o2").cast("double") / F.count(F.lit(1))).alias("o2_rate"),
        *[F.count_if(F.col("consciousness_level") == lv).alias("n_" + lv.lower())
          for lv in CONSCIOUSNESS_LEVELS])
    declared = F.broadcast(envelope_dim(readings.sparkSession).select(
        "simulator_state", (F.col("o2_pct") / 100.0).alias("declared_o2_rate")))
    mix = F.broadcast(consciousness_dim(readings.sparkSession))
    return (stats.join(declared, "simulator_state", "left")
            .join(mix, "simulator_state", "left"))


def state_score_fit(scored: DataFrame) -> DataFrame:
    """Share of readings whose score lies in the state's typical interval."""
    dim = F.broadcast(typical_score_dim(scored.sparkSession))
    j = scored.select("simulator_state", "news2_score").join(dim, "simulator_state", "left")
    inside = (F.col("news2_score") >= F.col("lo")) & (
        F.col("hi").isNull() | (F.col("news2_score") <= F.col("hi")))
    return j.groupBy("simulator_state").agg(
        F.count(F.lit(1)).alias("readings"),
        F.count_if(inside).alias("in_typical"),
        (F.count_if(inside).cast("double") / F.count(F.lit(1))).alias("share_typical"))
