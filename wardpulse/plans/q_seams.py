"""Registered queries over tables that cross the operators' seams: one patient
with a third of all readings, chunks of a few rows or minutes, and a time axis
of thirty days (pruned scans)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardpulse.functions.news2 import with_news2
from wardpulse.operators import alerts as A
from wardpulse.operators import joins as J
from wardpulse.operators import kpis as K
from wardpulse.operators import quality as Q
from wardpulse.operators import sketches as SK
from wardpulse.operators import trajectory as M
from wardpulse.operators import windows as W
from wardpulse.plans.oracle import sql_days, sql_hot
from wardpulse.plans.q_quality import _episodes_sql
from wardpulse.plans.q_joins import _LATEST_SQL
from wardpulse.plans.q_trajectory import _features_sql
from wardpulse.plans.q_windows import _RW_SQL, ROLLING_SQL
from wardpulse.plans.registry import admin, raw_days, register, scored_hot
from wardpulse.session import scratch_path
from wardpulse.sources import history as H
from wardpulse.sources.fixtures import EPOCH_2024_MS

FEW_SEQ, FEW_MS = 50, 60_000   # chunk widths that cut every patient many times


@register("hot_tier_change_alerts", sql_hot("SELECT * FROM alerts"))
def hot_tier_change_alerts(spark, sf_dir):
    """T2 with a hot patient, in chunks of 50 arrivals."""
    return A.tier_change_alerts(scored_hot(spark, sf_dir), FEW_SEQ)


@register("hot_tier_episodes", sql_hot(_episodes_sql("scored", "news2_tier")))
def hot_tier_episodes(spark, sf_dir):
    """R3 with a hot patient, in chunks of 50 arrivals."""
    return Q.episodes(scored_hot(spark, sf_dir), "news2_tier", FEW_SEQ)


@register("hot_monitoring_sessions", sql_hot(f"""
, f AS (
  SELECT patient_id, seq, ts_ms,
    CASE WHEN lag(ts_ms) OVER w IS NULL OR ts_ms - lag(ts_ms) OVER w >= {Q.SILENCE_MS}
         THEN ts_ms END AS st
  FROM raw WINDOW w AS (PARTITION BY patient_id ORDER BY ts_ms, seq)),
g AS (
  SELECT *, max(st) OVER (PARTITION BY patient_id ORDER BY ts_ms, seq ROWS UNBOUNDED PRECEDING)
         AS session_start_ms
  FROM f)
SELECT patient_id, session_start_ms, max(ts_ms) AS session_end_ms, count(*) AS readings
FROM g GROUP BY ALL"""))
def hot_monitoring_sessions(spark, sf_dir):
    """R5 with a hot patient, in chunks of a minute."""
    return Q.monitoring_sessions(scored_hot(spark, sf_dir), chunk_width=FEW_MS)


@register("hot_cadence_gaps", sql_hot(f"""
SELECT patient_id, seq, prev_ts_ms, ts_ms, ts_ms - prev_ts_ms AS gap_ms FROM (
  SELECT patient_id, seq, ts_ms,
         lag(ts_ms) OVER (PARTITION BY patient_id ORDER BY ts_ms, seq) AS prev_ts_ms
  FROM raw)
WHERE ts_ms - prev_ts_ms > {Q.SILENCE_MS}"""))
def hot_cadence_gaps(spark, sf_dir):
    """R4 with a hot patient, in chunks of a minute."""
    return Q.cadence_gaps(scored_hot(spark, sf_dir), chunk_width=FEW_MS)


@register("hot_tier_occupancy", sql_hot("""
SELECT patient_id, news2_tier, count(*) AS readings,
       CAST(coalesce(sum(next_ts - ts_ms), 0) AS BIGINT) AS occupancy_ms
FROM (SELECT *, lead(ts_ms) OVER (PARTITION BY patient_id ORDER BY ts_ms, seq) AS next_ts
      FROM scored)
GROUP BY ALL"""))
def hot_tier_occupancy(spark, sf_dir):
    """A11 with a hot patient, in chunks of a minute."""
    return W.tier_occupancy(scored_hot(spark, sf_dir), FEW_MS)


@register("hot_readings_asof_ward", sql_hot("""
SELECT r.patient_id, r.seq, r.ts_ms, a.event_ms, a.seq AS admin_seq, a.event_type,
       a.ward, a.unit, a.suspected_infection
FROM raw r ASOF JOIN (SELECT * REPLACE (CASE WHEN seq % 3 = 0 THEN 'hot' ELSE patient_id END
  AS patient_id) FROM admin) a ON r.patient_id = a.patient_id AND r.ts_ms >= a.event_ms"""))
def hot_readings_asof_ward(spark, sf_dir):
    """J3 with a hot patient on both sides, in chunks of a minute."""
    from wardpulse.sources.fixtures import with_hot_patient
    r = scored_hot(spark, sf_dir).select("patient_id", "seq", "ts_ms")
    return J.asof_registry(r, with_hot_patient(admin(spark, sf_dir)), chunk_width=FEW_MS)


SPLITS = 60   # parts of a ten-minute block: ten seconds each


@register("hot_rolling_10min", sql_hot(ROLLING_SQL))
def hot_rolling_10min(spark, sf_dir):
    """A5 with a hot patient, blocks cut into ten seconds."""
    return W.rolling(scored_hot(spark, sf_dir), splits=SPLITS)


@register("hot_trajectory_features", sql_hot(_features_sql()))
def hot_trajectory_features(spark, sf_dir):
    """M1 with a hot patient, blocks cut into ten seconds."""
    return M.trajectory_features(scored_hot(spark, sf_dir), splits=SPLITS)


FIRST_DAY, DAYS = 10, 7
LO_MS, HI_MS = (EPOCH_2024_MS + d * H.DAY_MS for d in (FIRST_DAY, FIRST_DAY + DAYS))


@register("scored_scan_week", sql_days(f"""
SELECT ts_ms // {H.DAY_MS} AS day_num, news2_tier, count(*) AS readings,
       count(DISTINCT patient_id) AS patients
FROM scored WHERE ts_ms >= {LO_MS} AND ts_ms < {HI_MS} GROUP BY ALL"""))
def scored_scan_week(spark, sf_dir):
    """A week of a month's scored table; other dates are not read."""
    path = scratch_path(spark, "scored_days")
    H.write_scored_readings(with_news2(raw_days(spark, sf_dir)), path)
    week = H.time_range(H.read_history(spark, path), LO_MS, HI_MS)
    return week.groupBy(F.floor(F.col("ts_ms") / H.DAY_MS).cast("long").alias("day_num"),
                        "news2_tier").agg(
        F.count(F.lit(1)).alias("readings"), F.countDistinct("patient_id").alias("patients"))


@register("patient_history_week", sql_days(f"""
SELECT seq, ts_ms, patient_id, news2_score, news2_tier,
       CAST(row_number() OVER (PARTITION BY patient_id ORDER BY ts_ms DESC, seq DESC)
            AS INTEGER) AS recency
FROM scored WHERE ts_ms >= {LO_MS} AND ts_ms < {HI_MS} QUALIFY recency <= 5"""))
def patient_history_week(spark, sf_dir):
    """Each patient's newest five readings of a week of the month."""
    path = scratch_path(spark, "history_days")
    H.write_scored_readings(with_news2(raw_days(spark, sf_dir)), path)
    return H.newest_per_patient(H.read_history(spark, path), LO_MS, HI_MS, 5).select(
        "seq", "ts_ms", "patient_id", "news2_score", "news2_tier", "recency")


@register("ward_kpis_days", sql_days(_RW_SQL + """
SELECT ward, day_num, count(DISTINCT patient_id) AS patients, count(*) AS readings,
  avg(news2_score) AS mean_score,
  round(quantile_cont(news2_score, 0.95), 4) AS p95_score,
  count_if(news2_tier = 'Low') * 100.0::DOUBLE / count(*) AS pct_low,
  count_if(news2_tier = 'Medium') * 100.0::DOUBLE / count(*) AS pct_medium,
  count_if(news2_tier = 'High') * 100.0::DOUBLE / count(*) AS pct_high,
  CAST(count_if(is_alert) AS BIGINT) AS alerts,
  CAST(coalesce(sum(CASE WHEN news2_tier = 'High' THEN dwell_ms END), 0) AS BIGINT) AS high_ms
FROM rw GROUP BY ward, day_num"""))
def ward_kpis_days(spark, sf_dir):
    """A7 over thirty days: chunks of a day, carried across their edges."""
    return K.ward_kpis(K.readings_in_ward(with_news2(raw_days(spark, sf_dir)),
                                          admin(spark, sf_dir)))


@register("patients_by_ward_day", sql_days(_LATEST_SQL + f"""
, d AS (SELECT coalesce(l.ward, 'unknown') AS ward, r.ts_ms // {H.DAY_MS} * {H.DAY_MS} AS start_ms,
          r.patient_id, count(*) AS n
        FROM raw r LEFT JOIN latest l ON r.patient_id = l.patient_id GROUP BY ALL)
SELECT ward, start_ms, CAST(sum(n) AS BIGINT) AS readings, count(*) AS patients,
  CASE WHEN EXISTS (SELECT 1 FROM d y WHERE y.ward = d.ward AND y.start_ms = d.start_ms - {H.DAY_MS})
    THEN (SELECT count(*) FROM d y WHERE y.ward = d.ward AND y.start_ms = d.start_ms - {H.DAY_MS}
          AND NOT EXISTS (SELECT 1 FROM d z WHERE z.ward = d.ward AND z.start_ms = d.start_ms
                          AND z.patient_id = y.patient_id)) END AS gone
FROM d GROUP BY ward, start_ms"""))
def patients_by_ward_day(spark, sf_dir):
    """Distinct patients per ward and day, and those of the day before that are
    gone, from sketches per minute that are stored and merged."""
    placed = J.readings_with_ward(raw_days(spark, sf_dir), admin(spark, sf_dir))
    path = scratch_path(spark, "patient_sketches")
    SK.patient_sketches(placed, ["ward"]).write.parquet(path)
    days = SK.merge_patients(spark.read.parquet(path), ["ward"])
    return SK.patient_counts(days, ["ward"])
