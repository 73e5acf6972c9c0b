"""Registered queries: registry and joins (S7, J1–J6, A12-adjacent)."""

from __future__ import annotations


from wardpulse.operators import joins as J
from wardpulse.operators.alerts import tier_change_alerts
from wardpulse.plans.oracle import sql
from wardpulse.plans.registry import admin, raw, register, scored
from wardpulse.sources.fixtures import with_registry_holes

_LATEST_SQL = """
, latest AS (
  SELECT patient_id,
    arg_max(event_ms, (event_ms, seq)) AS event_ms,
    arg_max(event_type, (event_ms, seq)) AS event_type,
    arg_max(ward, (event_ms, seq)) AS ward,
    arg_max(unit, (event_ms, seq)) AS unit,
    arg_max(suspected_infection, (event_ms, seq)) AS suspected_infection,
    arg_max(seq, (event_ms, seq)) AS admin_seq
  FROM admin GROUP BY patient_id)
"""


@register("registry_latest", sql(_LATEST_SQL + """
SELECT patient_id, event_ms, event_type, ward, unit, suspected_infection, admin_seq,
       event_type <> 'DISCHARGE' AS admitted
FROM latest"""))
def registry_latest(spark, sf_dir):
    """Current registry row per patient from the changelog."""
    return J.registry_latest(admin(spark, sf_dir)).select(
        "patient_id", "event_ms", "event_type", "ward", "unit", "suspected_infection",
        "admin_seq", "admitted")


@register("readings_with_ward", sql(_LATEST_SQL + """
SELECT r.seq, r.patient_id, coalesce(l.ward, 'unknown') AS ward, l.unit,
       l.event_type <> 'DISCHARGE' AS admitted
FROM raw r LEFT JOIN latest l ON r.patient_id = l.patient_id"""))
def readings_with_ward(spark, sf_dir):
    """Readings with the patient's current ward (stream-static capable)."""
    return J.readings_with_ward(raw(spark, sf_dir), admin(spark, sf_dir)).select(
        "seq", "patient_id", "ward", "unit", "admitted")


@register("readings_asof_ward", sql("""
SELECT r.patient_id, r.seq, r.ts_ms, a.event_ms, a.seq AS admin_seq, a.event_type,
       a.ward, a.unit, a.suspected_infection
FROM raw r ASOF JOIN admin a ON r.patient_id = a.patient_id AND r.ts_ms >= a.event_ms"""))
def readings_asof_ward(spark, sf_dir):
    """Registry row in force at each reading's event time."""
    r = raw(spark, sf_dir).select("patient_id", "seq", "ts_ms")
    return J.asof_registry(r, admin(spark, sf_dir))


@register("unregistered_patients", sql("""
, rp AS (SELECT patient_id, count(*) AS rows FROM raw GROUP BY patient_id),
ap AS (SELECT patient_id, count(*) AS rows FROM admin
       WHERE CAST(patient_id AS BIGINT) % 17 <> 3 GROUP BY patient_id)
SELECT patient_id, rows, 'reading_without_registry' AS finding FROM rp
WHERE patient_id NOT IN (SELECT patient_id FROM ap)
UNION ALL
SELECT patient_id, rows, 'registry_without_reading' AS finding FROM ap
WHERE patient_id NOT IN (SELECT patient_id FROM rp)"""))
def unregistered_patients(spark, sf_dir):
    """Anti joins both ways between readings and a registry with holes."""
    return J.unregistered_patients(raw(spark, sf_dir),
                                   with_registry_holes(admin(spark, sf_dir)))


@register("alerts_with_vitals", sql("""
SELECT a.*, s.respiration_rate, s.oxygen_saturation, s.supplemental_o2, s.temperature,
       s.systolic_bp, s.heart_rate, s.consciousness_level
FROM alerts a JOIN scored s ON a.patient_id = s.patient_id AND a.seq = s.seq"""))
def alerts_with_vitals(spark, sf_dir):
    """Alert joined to the reading that raised it."""
    s = scored(spark, sf_dir)
    return J.alerts_with_vitals(tier_change_alerts(s), s)


@register("pre_alert_window", sql("""
SELECT a.patient_id, a.seq AS alert_seq, a.ts_ms AS alert_ms, a.new_tier,
       count(*) AS readings, min(s.heart_rate) AS hr_min, max(s.heart_rate) AS hr_max,
       avg(s.respiration_rate) AS rr_avg, max(s.news2_score) AS score_max
FROM alerts a JOIN scored s ON a.patient_id = s.patient_id
 AND s.ts_ms BETWEEN a.ts_ms - 600000 AND a.ts_ms
GROUP BY ALL"""))
def pre_alert_window(spark, sf_dir):
    """Vitals in the 10 minutes up to each alert (trailing frame)."""
    return J.pre_alert_window(scored(spark, sf_dir))
