"""Ward KPIs, alert counts and the live patient board."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardpulse.functions.news2 import tier_rank
from wardpulse.operators.joins import asof_registry
from wardpulse.operators.ordered import SEQ_CHUNK, with_previous_non_null
from wardpulse.operators.windows import with_dwell

DAY_MS = 86_400_000
HOUR_MS = 3_600_000


def readings_in_ward(scored: DataFrame, admin: DataFrame) -> DataFrame:
    """Each reading with the ward in force at its time (J3), ``unknown`` when
    the patient had no registry event yet; plus alert flag and dwell time.
    Three ordered passes (as-of fill, previous tier, next reading time), each
    chunked per patient; no join back to the readings.  NULL-tier readings
    are rejects (null vital): they never raise or hide an alert."""
    base = scored.select("patient_id", "seq", "ts_ms", "news2_score", "news2_tier")
    placed = asof_registry(base, admin, keep_unmatched=True).select(*base.columns, "ward")
    prev = with_previous_non_null(placed.withColumn("_rank", tier_rank("news2_tier")),
                                  "patient_id", "seq", "_rank", "_prev_rank",
                                  chunk_width=SEQ_CHUNK)
    flagged = prev.withColumn(
        "is_alert", F.col("_rank").isNotNull() & F.col("_prev_rank").isNotNull()
        & (F.col("_prev_rank") != F.col("_rank")))
    return (with_dwell(flagged)
            .withColumn("ward", F.coalesce("ward", F.lit("unknown")))
            .withColumn("day_num", F.floor(F.col("ts_ms") / DAY_MS).cast("long")))


def _kpi_aggs():
    n = F.count(F.lit(1))
    return [
        F.countDistinct("patient_id").alias("patients"),
        n.alias("readings"),
        F.avg("news2_score").alias("mean_score"),
        F.round(F.percentile("news2_score", 0.95), 4).alias("p95_score"),
        (F.count_if(F.col("news2_tier") == "Low") * 100.0 / n).alias("pct_low"),
        (F.count_if(F.col("news2_tier") == "Medium") * 100.0 / n).alias("pct_medium"),
        (F.count_if(F.col("news2_tier") == "High") * 100.0 / n).alias("pct_high"),
        F.count_if("is_alert").alias("alerts"),
        F.coalesce(F.sum(F.when(F.col("news2_tier") == "High", F.col("dwell_ms"))),
                   F.lit(0)).cast("long").alias("high_ms"),
    ]


def ward_kpis(rw: DataFrame) -> DataFrame:
    """Per ward and day.  ``percentile`` on the integer score keeps a
    value->count map of at most 21 entries per group, so it stays small
    however many readings a ward has."""
    return rw.groupBy("ward", "day_num").agg(*_kpi_aggs())


def ward_kpis_rollup(rw: DataFrame) -> DataFrame:
    """Ward × day with ward subtotals and a grand total."""
    return rw.rollup("ward", "day_num").agg(
        F.count(F.lit(1)).alias("readings"),
        F.countDistinct("patient_id").alias("patients"),
        F.avg("news2_score").alias("mean_score"),
        F.count_if("is_alert").alias("alerts"))


def alert_counts(alerts: DataFrame, width_ms: int = HOUR_MS) -> DataFrame:
    """Alerts per tier pair per interval."""
    start = (F.floor(F.col("ts_ms") / F.lit(width_ms)) * F.lit(width_ms)).cast("long")
    return alerts.groupBy(start.alias("window_start_ms"), "previous_tier", "new_tier").agg(
        F.count(F.lit(1)).alias("alerts"))


def live_snapshot(scored: DataFrame) -> DataFrame:
    """K7: latest reading per patient (``max_by`` on arrival order)."""
    cols = ["seq", "ts_ms", "news2_score", "news2_tier", "respiration_rate",
            "oxygen_saturation", "temperature", "systolic_bp", "heart_rate",
            "consciousness_level"]
    last = scored.groupBy("patient_id").agg(
        F.max_by(F.struct(*cols), F.col("seq")).alias("r"))
    return last.select("patient_id", *[F.col("r")[c].alias(c) for c in cols])


def worst_patients(scored: DataFrame, k: int = 10) -> DataFrame:
    """The k sickest patients right now (top-k is the feature; Spark
    plans ``TakeOrderedAndProject``, a per-partition heap of k rows)."""
    return (live_snapshot(scored)
            .orderBy(F.col("news2_score").desc(), F.col("patient_id").asc())
            .limit(k)
            .select("patient_id", "seq", "ts_ms", "news2_score", "news2_tier"))
