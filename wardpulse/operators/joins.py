"""Registry and cross-stream joins.

Join strategy is left to Catalyst/AQE except for fixed-size dimensions: the
registry grows with the patient population, so it is never force-broadcast;
AQE switches to a broadcast join at runtime only when the measured size is
under ``spark.sql.autoBroadcastJoinThreshold``.  Range joins are rewritten
as equi-joins on ``(patient_id, time bucket)`` so a heavy patient is spread
over many join keys instead of one nested-loop group; the pre-alert window
is a trailing frame rather than a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardpulse.functions.news2 import tier_rank
from wardpulse.operators.ordered import TIME_CHUNK_MS, with_ffill, with_previous_non_null
from wardpulse.operators.sliding import mean_of, moments, with_sliding

REGISTRY_COLUMNS = ["event_ms", "event_type", "ward", "unit", "suspected_infection",
                    "initial_state", "seq"]


def registry_latest(admin: DataFrame) -> DataFrame:
    """Latest changelog row per patient (order: event time, then seq).

    ``max_by`` over a struct is partially aggregated map-side, so a patient
    with a long history reaches the shuffle as one row per map task.
    """
    latest = admin.groupBy("patient_id").agg(
        F.max_by(F.struct(*REGISTRY_COLUMNS), F.struct("event_ms", "seq")).alias("r"))
    return latest.select(
        "patient_id",
        *[F.col("r")[c].alias("admin_seq" if c == "seq" else c) for c in REGISTRY_COLUMNS],
        (F.col("r.event_type") != "DISCHARGE").alias("admitted"))


def readings_with_ward(readings: DataFrame, admin: DataFrame) -> DataFrame:
    """Attach the patient's current registry row; ``unknown`` when absent."""
    reg = registry_latest(admin).select("patient_id", "ward", "unit", "admitted")
    return (readings.join(reg, "patient_id", "left")
            .withColumn("ward", F.coalesce("ward", F.lit("unknown"))))


ASOF_FIELDS = ["event_ms", "admin_seq", "event_type", "ward", "unit", "suspected_infection"]


def asof_registry(readings: DataFrame, admin: DataFrame,
                  chunk_width: int = TIME_CHUNK_MS, keep_unmatched: bool = False
                  ) -> DataFrame:
    """Registry row in force at each reading's time (as-of join).

    Readings and registry events are unioned per patient and ordered by
    ``(time, kind, seq)`` with events first at equal times; the last event
    seen is forward-filled onto each reading.  Ordered scans run per
    ``(patient, day)`` chunk with a carried state, so no patient is one task
    and no reading is compared with more than its own predecessor.  All
    reading columns ride along, so no join back to the readings is needed.
    Readings before the patient's first event are dropped unless
    ``keep_unmatched`` (then their registry fields are NULL).
    """
    cols = readings.columns
    ev_struct = F.struct(F.col("event_ms"), F.col("seq").alias("admin_seq"), "event_type",
                         "ward", "unit", "suspected_infection")
    ev = admin.select(
        F.col("patient_id").alias("_pid"), F.col("event_ms").alias("_t"),
        F.lit(0).alias("_kind"), F.col("seq").alias("_s"), ev_struct.alias("_ev"),
        *[F.lit(None).cast(readings.schema[c].dataType).alias(c) for c in cols])
    rd = readings.select(
        F.col("patient_id").alias("_pid"), F.col("ts_ms").alias("_t"), F.lit(1).alias("_kind"),
        F.col("seq").alias("_s"), F.lit(None).cast(ev.schema["_ev"].dataType).alias("_ev"),
        *cols)
    filled = with_ffill(ev.unionByName(rd), "_pid", ["_t", "_kind", "_s"], "_ev",
                        "_in_force", chunk_width=chunk_width)
    keep = F.col("_kind") == 1
    if not keep_unmatched:
        keep = keep & F.col("_in_force").isNotNull()
    return filled.filter(keep).select(*cols, *[F.col("_in_force")[c].alias(c)
                                               for c in ASOF_FIELDS])


def unregistered_patients(readings: DataFrame, admin: DataFrame) -> DataFrame:
    """Readings without any registry row, and registry patients without
    any reading (two anti joins on per-patient pre-aggregates)."""
    rp = readings.groupBy("patient_id").agg(F.count(F.lit(1)).alias("rows"))
    ap = admin.groupBy("patient_id").agg(F.count(F.lit(1)).alias("rows"))
    a = rp.join(ap, "patient_id", "left_anti").withColumn(
        "finding", F.lit("reading_without_registry"))
    b = ap.join(rp, "patient_id", "left_anti").withColumn(
        "finding", F.lit("registry_without_reading"))
    return a.unionByName(b)


def alerts_with_vitals(alerts: DataFrame, scored: DataFrame) -> DataFrame:
    """Each alert with the reading that raised it (equi-join on the
    reading's identity ``(patient_id, seq)``; no hot key possible)."""
    vit = scored.select("patient_id", "seq", "respiration_rate", "oxygen_saturation",
                        "supplemental_o2", "temperature", "systolic_bp", "heart_rate",
                        "consciousness_level")
    return alerts.join(vit, ["patient_id", "seq"], "inner")


def pre_alert_window(scored: DataFrame, window_ms: int = 600_000,
                     splits: int = 1) -> DataFrame:
    """Vitals in the ``window_ms`` up to and including each alert.

    Computed without a join: the tier-change flag comes from the chunked
    ``lag`` pass, the window statistics from a trailing RANGE frame, and only
    alert rows are kept.  Linear in the readings — no (alert, reading) pairs
    are formed, however many alerts a patient has or readings a frame holds.
    Readings at the alert's own millisecond are in the frame (RANGE peers).
    """
    base = scored.select("patient_id", "seq", "ts_ms", "news2_tier", "heart_rate",
                         "respiration_rate", "news2_score")
    ranked = base.withColumn("_rank", tier_rank("news2_tier"))
    # NULL-vital rejects are skipped by the lag, so they never hide a change
    flagged = with_previous_non_null(ranked, "patient_id", "seq", "_rank",
                                     "_prev_rank").withColumn(
        "_alert", F.col("_rank").isNotNull() & F.col("_prev_rank").isNotNull()
        & (F.col("_prev_rank") != F.col("_rank")))
    rr = F.col("respiration_rate").cast("long")
    parts = {"readings": ("sum", F.lit(1).cast("long")), "hr_min": ("min", F.col("heart_rate")),
             "hr_max": ("max", F.col("heart_rate")), **moments("rr", rr),
             "score_max": ("max", F.col("news2_score"))}
    framed = with_sliding(flagged, "patient_id", "ts_ms", -window_ms, 0, parts, splits=splits)
    return framed.filter("_alert").select(
        "patient_id", F.col("seq").alias("alert_seq"), F.col("ts_ms").alias("alert_ms"),
        F.col("news2_tier").alias("new_tier"), "readings", "hr_min", "hr_max",
        mean_of("rr").alias("rr_avg"), "score_max")
