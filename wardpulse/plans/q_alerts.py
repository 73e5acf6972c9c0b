"""Registered queries: patient state and tier-change alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardpulse.operators import alerts as A
from wardpulse.operators import sketches as SK
from wardpulse.plans.oracle import sql
from wardpulse.plans.registry import raw, register, scored
from wardpulse.session import scratch_path

ALERT_REPLAY_MOD = 5     # every 5th alert delivered twice (T5 fixture)
READING_REPLAY_MOD = 50  # every 50th reading delivered twice (T6 fixture)


def alerts_of(spark, sf_dir):
    return A.tier_change_alerts(scored(spark, sf_dir))


@register("last_tier", sql("""
SELECT patient_id, arg_max(news2_tier, seq) AS last_tier, max(seq) AS last_seq,
       count(*) AS readings
FROM scored GROUP BY patient_id"""))
def last_tier(spark, sf_dir):
    """The per-patient state after consuming every reading."""
    return A.last_tier(scored(spark, sf_dir))


@register("tier_change_alerts", sql("SELECT * FROM alerts"))
def tier_change_alerts(spark, sf_dir):
    """Alerts on every tier change, in arrival order per patient."""
    return alerts_of(spark, sf_dir)


@register("deterioration_alerts", sql("""
SELECT *, 'worsening' AS direction FROM alerts
WHERE (CASE new_tier WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 ELSE 2 END)
    > (CASE previous_tier WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 ELSE 2 END)"""))
def deterioration_alerts(spark, sf_dir):
    """T4: only changes to a worse tier."""
    return A.deterioration_alerts(alerts_of(spark, sf_dir))


@register("dedup_alerts", sql(f"""
SELECT DISTINCT * FROM (
  SELECT * FROM alerts UNION ALL
  SELECT * FROM alerts WHERE seq % {ALERT_REPLAY_MOD} = 0)"""))
def dedup_alerts(spark, sf_dir):
    """T5: alert stream with every 5th alert re-delivered, de-duplicated."""
    return A.dedup_alerts(A.redeliver(alerts_of(spark, sf_dir), ALERT_REPLAY_MOD))


@register("dedup_readings", sql(f"""
SELECT DISTINCT seq, patient_id, ts_ms, news2_score, news2_tier FROM (
  SELECT * FROM scored UNION ALL
  SELECT * FROM scored WHERE seq % {READING_REPLAY_MOD} = 0)"""))
def dedup_readings(spark, sf_dir):
    """Replayed readings (every 50th twice) reduced to one per ``seq``."""
    from wardpulse.functions.news2 import with_news2
    replayed = A.redeliver(raw(spark, sf_dir), READING_REPLAY_MOD)
    return with_news2(A.dedup_readings(replayed)).select(
        "seq", "patient_id", "ts_ms", "news2_score", "news2_tier")


#: Emission time of the latency fixture: a fixed delay that varies by arrival.
EMIT_DELAY_SQL = "ts_ms + 40 + seq % 997"


def _emitted():
    return F.timestamp_millis(F.expr(EMIT_DELAY_SQL))


@register("alert_latency", sql(f"""
SELECT patient_id, seq, ts_ms, new_tier, {EMIT_DELAY_SQL} - ts_ms AS latency_ms FROM alerts"""))
def alert_latency(spark, sf_dir):
    """Latency of each alert for a given emission time."""
    return A.alert_latency(alerts_of(spark, sf_dir), _emitted()).select(
        "patient_id", "seq", "ts_ms", "new_tier", "latency_ms")


@register("alert_latency_summary", sql(f"""
SELECT new_tier, count(*) AS alerts, round(quantile_cont(l, 0.5), 4) AS p50_ms,
       round(quantile_cont(l, 0.95), 4) AS p95_ms, max(l) AS max_ms
FROM (SELECT *, {EMIT_DELAY_SQL} - ts_ms AS l FROM alerts) GROUP BY new_tier"""))
def alert_latency_summary(spark, sf_dir):
    """Latency percentiles by new tier."""
    return A.latency_summary(A.alert_latency(alerts_of(spark, sf_dir), _emitted()))


def _stored_sketches(spark, sf_dir):
    """Hourly latency sketches, written and read back, and the latencies."""
    latency = A.alert_latency(alerts_of(spark, sf_dir), _emitted())
    path = scratch_path(spark, "latency_sketches")
    SK.latency_sketches(latency).write.parquet(path)
    return spark.read.parquet(path), latency


@register("alert_latency_hours", sql(f"""
SELECT new_tier, ts_ms // {SK.HOUR_MS} * {SK.HOUR_MS} AS start_ms, count(*) AS alerts, max(l) AS max_ms,
       CASE WHEN count(*) <= {SK.LATENCY_K} THEN quantile_disc(l, 0.5) END AS p50_ms,
       CASE WHEN count(*) <= {SK.LATENCY_K} THEN quantile_disc(l, 0.95) END AS p95_ms
FROM (SELECT *, {EMIT_DELAY_SQL} - ts_ms AS l FROM alerts) GROUP BY ALL"""))
def alert_latency_hours(spark, sf_dir):
    """Quantiles from stored sketches, exact for groups that a sketch keeps whole
    (larger groups: see ``alert_latency_days``)."""
    found = SK.with_latency_quantiles(_stored_sketches(spark, sf_dir)[0])
    small = F.col("alerts") <= SK.LATENCY_K
    return found.select("new_tier", "start_ms", "alerts", "max_ms",
                        *[F.when(small, F.col(c)).alias(c) for c in ("p50_ms", "p95_ms")])


@register("alert_latency_days", sql(f"""
SELECT new_tier, ts_ms // {SK.DAY_MS} * {SK.DAY_MS} AS start_ms, count(*) AS alerts, max(l) AS max_ms,
       true AS p50_within, true AS p95_within
FROM (SELECT *, {EMIT_DELAY_SQL} - ts_ms AS l FROM alerts) GROUP BY ALL"""))
def alert_latency_days(spark, sf_dir):
    """Daily quantiles merged from hourly sketches; the true rank of each answer,
    counted over the latencies, is within the stated error."""
    hours, latency = _stored_sketches(spark, sf_dir)
    day = SK.start_of("start_ms", SK.DAY_MS).alias("start_ms")
    days = SK.with_latency_quantiles(SK.merge_latency(hours, ["new_tier", day])).drop("sketch")
    day = SK.start_of("ts_ms", SK.DAY_MS).alias("start_ms")
    each = latency.select("new_tier", day, "latency_ms").join(days, ["new_tier", "start_ms"])
    n = F.count(F.lit(1))

    def within(q: float, answer: str):
        return ((F.count_if(F.col("latency_ms") < F.col(answer)) / n <= q + SK.RANK_ERROR)
                & (F.count_if(F.col("latency_ms") <= F.col(answer)) / n >= q - SK.RANK_ERROR))

    return each.groupBy("new_tier", "start_ms", "alerts", "max_ms").agg(
        within(0.5, "p50_ms").alias("p50_within"), within(0.95, "p95_ms").alias("p95_within"))
