"""Registered queries: windows, KPIs and the live board."""

from __future__ import annotations

from wardpulse.operators import kpis as K
from wardpulse.operators import windows as W
from wardpulse.operators.alerts import tier_change_alerts
from wardpulse.plans.oracle import SCORED_NULLS, sql
from wardpulse.plans.registry import admin, register, scored, scored_nulls

_SHORT = W.SHORT
_WORST = ("CASE max(CASE news2_tier WHEN 'High' THEN 2 WHEN 'Medium' THEN 1 "
          "WHEN 'Low' THEN 0 END) WHEN 2 THEN 'High' WHEN 1 THEN 'Medium' "
          "WHEN 0 THEN 'Low' END")


def _stats_sql(width_ms: int, src: str = "scored") -> str:
    cols = [f"(ts_ms // {width_ms}) * {width_ms} AS window_start_ms", "count(*) AS readings"]
    for v, s in _SHORT.items():
        x = f"CASE WHEN NOT isnan({v}) THEN {v} END" if v == "temperature" else v
        cols += [f"min({x}) AS {s}_min", f"max({x}) AS {s}_max",
                 f"round(avg({x}), {W.DOUBLE_PLACES}) AS {s}_avg" if v == "temperature"
                 else f"avg({x}) AS {s}_avg"]
    cols += ["CAST(count_if(supplemental_o2) AS BIGINT) AS o2_readings", "max(news2_score) AS max_score",
             "arg_max(news2_score, seq) AS last_score", f"{_WORST} AS worst_tier"]
    return ("SELECT patient_id, " + ",\n  ".join(cols)
            + f"\nFROM {src} GROUP BY patient_id, window_start_ms")


@register("agg_5min", sql(_stats_sql(300_000)))
def agg_5min(spark, sf_dir):
    """A1: per patient 5-minute tumbling-window vitals summary."""
    return W.agg_5min(scored(spark, sf_dir))


@register("agg_5min_nulls", sql(SCORED_NULLS + _stats_sql(300_000, "scored_nulls")))
def agg_5min_nulls(spark, sf_dir):
    """A1 over readings with missing heart rates, NaN and fine-grained temperatures."""
    return W.agg_5min(scored_nulls(spark, sf_dir))


@register("agg_1hour", sql(_stats_sql(3_600_000)))
def agg_1hour(spark, sf_dir):
    """A2: hourly summary, rolled up from the 5-minute partial aggregates."""
    return W.agg_1hour(scored(spark, sf_dir))


@register("agg_sliding_10min", sql("""
SELECT patient_id, (ts_ms // 60000 - k) * 60000 AS window_start_ms, count(*) AS readings,
       avg(heart_rate) AS hr_avg, max(news2_score) AS max_score
FROM (SELECT *, unnest(range(0, 10)) AS k FROM scored) GROUP BY ALL"""))
def agg_sliding_10min(spark, sf_dir):
    """A4: 10-minute windows sliding every minute."""
    return W.agg_sliding(scored(spark, sf_dir))


ROLLING_SQL = """
SELECT seq, patient_id, ts_ms, count(*) OVER w AS n, avg(heart_rate) OVER w AS hr_avg,
       min(heart_rate) OVER w AS hr_min, max(heart_rate) OVER w AS hr_max,
       round(stddev_samp(heart_rate) OVER w, 4) AS hr_std
FROM scored
WINDOW w AS (PARTITION BY patient_id ORDER BY ts_ms RANGE BETWEEN 600000 PRECEDING AND CURRENT ROW)"""


@register("rolling_10min", sql(ROLLING_SQL))
def rolling_10min(spark, sf_dir):
    """A5: per-reading trailing 10-minute RANGE frame (growing frames of blocks)."""
    return W.rolling(scored(spark, sf_dir))


@register("window_news2", sql(f"""
SELECT patient_id, (ts_ms // 300000) * 300000 AS window_start_ms,
       arg_max(news2_score, seq) AS last_score,
       CASE WHEN arg_max(news2_score, seq) >= 7 THEN 'High'
            WHEN arg_max(news2_score, seq) >= 5 THEN 'Medium' ELSE 'Low' END AS last_tier,
       max(news2_score) AS max_score, {_WORST} AS worst_tier
FROM scored GROUP BY ALL"""))
def window_news2(spark, sf_dir):
    """NEWS2 of each 5-minute window (last reading) and its worst tier."""
    return W.window_news2(scored(spark, sf_dir))


@register("throughput_per_min", sql("""
SELECT (ts_ms // 60000) * 60000 AS minute_ms, count(*) AS readings,
       count(DISTINCT patient_id) AS patients
FROM scored GROUP BY ALL"""))
def throughput_per_min(spark, sf_dir):
    """A10: readings and distinct patients per minute."""
    return W.throughput(scored(spark, sf_dir))


@register("throughput_per_patient", sql("""
SELECT patient_id, (ts_ms // 60000) * 60000 AS minute_ms, count(*) AS readings
FROM scored GROUP BY ALL"""))
def throughput_per_patient(spark, sf_dir):
    """A10: readings of each patient per minute."""
    return W.throughput_per_patient(scored(spark, sf_dir))


@register("tier_occupancy", sql("""
SELECT patient_id, news2_tier, count(*) AS readings,
       CAST(coalesce(sum(next_ts - ts_ms), 0) AS BIGINT) AS occupancy_ms
FROM (SELECT *, lead(ts_ms) OVER (PARTITION BY patient_id ORDER BY ts_ms, seq) AS next_ts
      FROM scored)
GROUP BY ALL"""))
def tier_occupancy(spark, sf_dir):
    """Milliseconds spent in each tier per patient."""
    return W.tier_occupancy(scored(spark, sf_dir))


_RW_SQL = """
, aw AS (
  SELECT r.patient_id, r.seq, a.ward
  FROM raw r ASOF JOIN admin a ON r.patient_id = a.patient_id AND r.ts_ms >= a.event_ms),
rw AS (
  SELECT s.patient_id, s.seq, s.ts_ms, s.news2_score, s.news2_tier,
    coalesce(aw.ward, 'unknown') AS ward, s.ts_ms // 86400000 AS day_num,
    coalesce(lag(s.news2_tier) OVER (PARTITION BY s.patient_id ORDER BY s.seq) <> s.news2_tier,
             false) AS is_alert,
    lead(s.ts_ms) OVER (PARTITION BY s.patient_id ORDER BY s.ts_ms, s.seq) - s.ts_ms AS dwell_ms
  FROM scored s LEFT JOIN aw ON s.patient_id = aw.patient_id AND s.seq = aw.seq)
"""


@register("ward_kpis", sql(_RW_SQL + """
SELECT ward, day_num, count(DISTINCT patient_id) AS patients, count(*) AS readings,
  avg(news2_score) AS mean_score,
  round(quantile_cont(news2_score, 0.95), 4) AS p95_score,
  count_if(news2_tier = 'Low') * 100.0::DOUBLE / count(*) AS pct_low,
  count_if(news2_tier = 'Medium') * 100.0::DOUBLE / count(*) AS pct_medium,
  count_if(news2_tier = 'High') * 100.0::DOUBLE / count(*) AS pct_high,
  CAST(count_if(is_alert) AS BIGINT) AS alerts,
  CAST(coalesce(sum(CASE WHEN news2_tier = 'High' THEN dwell_ms END), 0) AS BIGINT) AS high_ms
FROM rw GROUP BY ward, day_num"""))
def ward_kpis(spark, sf_dir):
    """Nightly ward KPIs (ward at reading time via the as-of join)."""
    return K.ward_kpis(K.readings_in_ward(scored(spark, sf_dir), admin(spark, sf_dir)))


@register("ward_kpis_rollup", sql(_RW_SQL + """
SELECT ward, day_num, count(*) AS readings, count(DISTINCT patient_id) AS patients,
  avg(news2_score) AS mean_score, CAST(count_if(is_alert) AS BIGINT) AS alerts
FROM rw GROUP BY ROLLUP (ward, day_num)"""))
def ward_kpis_rollup(spark, sf_dir):
    """KPI roll-up (ward × day, ward subtotals, grand total)."""
    return K.ward_kpis_rollup(K.readings_in_ward(scored(spark, sf_dir), admin(spark, sf_dir)))


@register("alert_counts", sql("""
SELECT (ts_ms // 3600000) * 3600000 AS window_start_ms, previous_tier, new_tier,
       count(*) AS alerts
FROM alerts GROUP BY ALL"""))
def alert_counts(spark, sf_dir):
    """Alerts per tier pair per hour."""
    return K.alert_counts(tier_change_alerts(scored(spark, sf_dir)))


_LIVE_COLS = ["seq", "ts_ms", "news2_score", "news2_tier", "respiration_rate",
              "oxygen_saturation", "temperature", "systolic_bp", "heart_rate",
              "consciousness_level"]
_LIVE_SQL = ("SELECT patient_id, " + ", ".join(
    f"arg_max({c}, seq) AS {c}" for c in _LIVE_COLS) + " FROM scored GROUP BY patient_id")


@register("live_snapshot", sql(_LIVE_SQL))
def live_snapshot(spark, sf_dir):
    """K7: current state of every patient for the dashboard."""
    return K.live_snapshot(scored(spark, sf_dir))


@register("worst_patients", sql(f"""
SELECT patient_id, seq, ts_ms, news2_score, news2_tier FROM ({_LIVE_SQL})
ORDER BY news2_score DESC, patient_id ASC LIMIT 10"""))
def worst_patients(spark, sf_dir):
    """Top-10 sickest patients on the live board."""
    return K.worst_patients(scored(spark, sf_dir), 10)
