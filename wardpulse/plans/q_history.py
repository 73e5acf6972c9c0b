"""Registered queries: table sinks and historical scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardpulse.operators.alerts import tier_change_alerts
from wardpulse.operators.joins import alerts_with_vitals
from wardpulse.plans.oracle import sql
from wardpulse.plans.registry import register, scored
from wardpulse.session import scratch_path
from wardpulse.sources import history as H

DAY0_MS = 1704067200000            # 2024-01-01T00:00Z: the fixture's first day
HISTORY_N = 20

_SCORED_OUT = ["seq", "ts_ms"] + H.SCORED_ROW[1:]


def _written_scored(spark, sf_dir):
    path = scratch_path(spark, "scored_readings")
    H.write_scored_readings(scored(spark, sf_dir), path)
    return H.read_history(spark, path)


@register("scored_readings", sql(f"SELECT {', '.join(_SCORED_OUT)} FROM scored"))
def scored_readings(spark, sf_dir):
    """K1: scored readings written as a date-partitioned table, read back."""
    return _written_scored(spark, sf_dir).select(*_SCORED_OUT)


@register("alerts", sql(
    "SELECT seq, ts_ms, patient_id, previous_tier, new_tier, news2_score FROM alerts"))
def alerts(spark, sf_dir):
    """K2: alerts table written date-partitioned, read back."""
    path = scratch_path(spark, "alerts")
    H.write_alerts(tier_change_alerts(scored(spark, sf_dir)), path)
    return H.read_history(spark, path).select(
        "seq", "ts_ms", "patient_id", "previous_tier", "new_tier", "news2_score")


@register("scored_scan", sql(f"""
SELECT news2_tier, count(*) AS readings, count(DISTINCT patient_id) AS patients,
       CAST(sum(news2_score) AS BIGINT) AS score_sum
FROM scored WHERE ts_ms >= {DAY0_MS} AND ts_ms < {DAY0_MS + H.DAY_MS}
GROUP BY news2_tier"""))
def scored_scan(spark, sf_dir):
    """Historical scan of one day of the scored table — the ``date``
    predicate prunes partitions, the ``ts_ms`` predicate reaches the parquet
    reader as a pushed filter."""
    day = H.time_range(_written_scored(spark, sf_dir), DAY0_MS, DAY0_MS + H.DAY_MS)
    return day.groupBy("news2_tier").agg(
        F.count(F.lit(1)).alias("readings"),
        F.countDistinct("patient_id").alias("patients"),
        F.sum("news2_score").cast("long").alias("score_sum"))


@register("patient_history", sql(f"""
SELECT seq, ts_ms, patient_id, news2_score, news2_tier,
       CAST(row_number() OVER (PARTITION BY patient_id ORDER BY ts_ms DESC, seq DESC)
            AS INTEGER) AS recency
FROM scored WHERE ts_ms >= {DAY0_MS} AND ts_ms < {DAY0_MS + H.DAY_MS}
QUALIFY recency <= {HISTORY_N}"""))
def patient_history(spark, sf_dir):
    """Newest-first history per patient over a time range (the newest
    20 readings of every patient; ``sources.history.patient_history`` is the
    single-patient access path)."""
    h = H.newest_per_patient(_written_scored(spark, sf_dir), DAY0_MS, DAY0_MS + H.DAY_MS,
                             HISTORY_N)
    return h.select("seq", "ts_ms", "patient_id", "news2_score", "news2_tier", "recency")


BUCKETS = 8


def _by_patient(spark, sf_dir):
    path = scratch_path(spark, "by_patient")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    H.write_by_patient(scored(spark, sf_dir), table, path, BUCKETS)
    return spark.table(table)


@register("patient_history_layout", sql(f"""
SELECT seq, ts_ms, patient_id, news2_score, news2_tier,
       CAST(row_number() OVER (PARTITION BY patient_id ORDER BY ts_ms DESC, seq DESC)
            AS INTEGER) AS recency
FROM scored WHERE ts_ms >= {DAY0_MS} AND ts_ms < {DAY0_MS + H.DAY_MS}
QUALIFY recency <= {HISTORY_N}"""))
def patient_history_layout(spark, sf_dir):
    """Newest readings of every patient from the table bucketed by patient, without a
    shuffle (one patient reads one bucket of each date: ``patient_history``)."""
    h = H.newest_per_patient(_by_patient(spark, sf_dir), DAY0_MS, DAY0_MS + H.DAY_MS, HISTORY_N)
    return h.select("seq", "ts_ms", "patient_id", "news2_score", "news2_tier", "recency")


@register("alerts_with_vitals_layout", sql("""
SELECT a.*, s.respiration_rate, s.oxygen_saturation, s.supplemental_o2, s.temperature,
       s.systolic_bp, s.heart_rate, s.consciousness_level
FROM alerts a JOIN scored s ON a.patient_id = s.patient_id AND a.seq = s.seq"""))
def alerts_with_vitals_layout(spark, sf_dir):
    """J1 on tables bucketed by patient: neither side is shuffled."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    table = _by_patient(spark, sf_dir)
    path = scratch_path(spark, "alerts_by_patient")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    (tier_change_alerts(scored(spark, sf_dir)).repartition(BUCKETS, "patient_id")
     .write.bucketBy(BUCKETS, "patient_id").sortBy("patient_id", "ts_ms").option("path", path)
     .format("parquet").saveAsTable(name))
    return alerts_with_vitals(spark.table(name), table)
