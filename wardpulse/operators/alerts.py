"""Per-patient tier state and tier-change alerts (batch forms).

The reference keeps ``patient_id -> last_tier`` and, on every reading in
arrival order, emits an alert when a previous tier exists and differs from the
new one (both directions).  In batch this is a ``lag`` over arrival order
(``seq``) per patient, done by the skew-safe chunked helper; the stream form
(``streaming.scoring``) must give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardpulse.functions.news2 import rank_label, tier_rank
from wardpulse.operators.ordered import SEQ_CHUNK, with_previous_non_null

ALERT_COLUMNS = ["patient_id", "seq", "ts_ms", "previous_tier", "new_tier",
                 "news2_score"]


def last_tier(scored: DataFrame) -> DataFrame:
    """State after the whole input — tier of each patient's last reading.

    ``max_by`` is a declarative aggregate: map-side partial aggregation keeps a
    hot patient from reaching the shuffle as more than one row per task.
    The tier travels as its rank: with fixed-width buffers Spark hash-aggregates.
    """
    last = scored.withColumn("_rank", tier_rank("news2_tier")).groupBy("patient_id").agg(
        F.max_by("_rank", "seq").alias("_rank"),
        F.max("seq").alias("last_seq"),
        F.count(F.lit(1)).alias("readings"),
    )
    return last.select("patient_id", rank_label(F.col("_rank")).alias("last_tier"), "last_seq",
                       "readings")


def tier_change_alerts(scored: DataFrame, chunk_width: int = SEQ_CHUNK) -> DataFrame:
    """One row per tier change, ``previous_tier IS NOT NULL AND <> new``.

    Readings with a NULL tier (a NULL vital) are rejects and do not step the
    state, exactly as in the stream form, so they cannot hide a change; they
    are skipped inside the window rather than filtered out before it."""
    ranked = scored.select("patient_id", "seq", "ts_ms", "news2_tier", "news2_score",
                           tier_rank("news2_tier").alias("_rank"))
    with_prev = with_previous_non_null(ranked, "patient_id", "seq", "_rank", "_prev_rank",
                                       chunk_width=chunk_width)
    return (with_prev
            .filter(F.col("_rank").isNotNull() & F.col("_prev_rank").isNotNull()
                    & (F.col("_prev_rank") != F.col("_rank")))
            .select("patient_id", "seq", "ts_ms",
                    rank_label(F.col("_prev_rank")).alias("previous_tier"),
                    F.col("news2_tier").alias("new_tier"),
                    "news2_score"))


def label_direction(alerts: DataFrame) -> DataFrame:
    """T4: ``worsening`` when the new tier ranks above the previous one."""
    return alerts.withColumn(
        "direction",
        F.when(tier_rank("new_tier") > tier_rank("previous_tier"), "worsening")
        .otherwise("improving"))


def deterioration_alerts(alerts: DataFrame) -> DataFrame:
    """T4: keep only changes to a worse tier."""
    return label_direction(alerts).filter(F.col("direction") == "worsening")


def dedup_alerts(alerts: DataFrame) -> DataFrame:
    """T5 (batch): drop re-delivered alerts; key = (patient, arrival, new tier).

    Stream form: ``withWatermark(...).dropDuplicatesWithinWatermark`` on the
    same key (see ``streaming.scoring``).
    """
    return alerts.dropDuplicates(["patient_id", "seq", "new_tier"])


def redeliver(df: DataFrame, every: int, key: str = "seq") -> DataFrame:
    """Fixture for T5/T6: rows with ``key % every == 0`` delivered twice.

    One pass (``explode`` of a one- or two-element array) instead of a union
    with a filtered copy, which would compute ``df`` twice."""
    copies = F.when(F.col(key) % every == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))
    return df.select("*", F.explode(copies).alias("_copy")).drop("_copy")


def dedup_readings(readings: DataFrame) -> DataFrame:
    """T6 (batch): one row per arrival position ``seq`` after a replay.

    The shuffle is on ``seq`` — unique per reading, so no group is larger than
    the number of redeliveries of one message.
    """
    return readings.dropDuplicates(["seq"])


def with_emission(alerts: DataFrame, emitted_at: Column | None = None) -> DataFrame:
    """Processing time of each alert (now, unless given)."""
    return alerts.withColumn("emitted_at", F.current_timestamp() if emitted_at is None
                             else emitted_at)


def alert_latency(alerts: DataFrame, emitted_at: Column | None = None) -> DataFrame:
    """Lag of each alert's emission behind its reading's event time."""
    return with_emission(alerts, emitted_at).withColumn(
        "latency_ms", F.unix_millis(F.col("emitted_at")) - F.col("ts_ms"))


def latency_summary(latency: DataFrame) -> DataFrame:
    """Alerts, median, 95th percentile and largest lag by new tier."""
    q = F.expr("percentile(latency_ms, array(0.5D, 0.95D))")
    out = latency.groupBy("new_tier").agg(F.count(F.lit(1)).alias("alerts"), q.alias("_q"),
                                          F.max("latency_ms").alias("max_ms"))
    return out.select("new_tier", "alerts", F.round(F.col("_q")[0], 4).alias("p50_ms"),
                      F.round(F.col("_q")[1], 4).alias("p95_ms"), "max_ms")
