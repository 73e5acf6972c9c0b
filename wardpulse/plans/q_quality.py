"""Registered queries: data quality and process mining."""

from __future__ import annotations

from wardpulse.operators import quality as Q
from wardpulse.plans.oracle import SCORED_NULLS, sql
from wardpulse.plans.registry import raw, register, scored, scored_nulls

_CHECKS = [("respiration_rate", "rr0", "rrn", False), ("oxygen_saturation", "sp0", "spn", False),
           ("temperature", "t0", "tn", True), ("systolic_bp", "bp0", "bpn", False),
           ("heart_rate", "hr0", "hrn", False)]


def _violation_sql() -> str:
    parts = []
    for name, lo, n, tenths in _CHECKS:
        low = f"{lo} / 10.0::DOUBLE" if tenths else lo
        high = f"({lo} + {n} - 1) / 10.0::DOUBLE" if tenths else f"{lo} + {n} - 1"
        parts.append(f"SELECT r.simulator_state, '{name}' AS parameter, "
                     f"NOT ({name} BETWEEN {low} AND {high}) AS violated "
                     f"FROM raw r LEFT JOIN env e ON r.simulator_state = e.simulator_state")
    return ("SELECT simulator_state, parameter, count(*) AS readings, "
            "CAST(count_if(violated) AS BIGINT) AS violations FROM ("
            + " UNION ALL ".join(parts) + ") GROUP BY ALL")


@register("envelope_violations", sql(_violation_sql()))
def envelope_violations(spark, sf_dir):
    """Out-of-envelope readings per state and parameter."""
    return Q.envelope_violations(raw(spark, sf_dir))


@register("state_transitions", sql("""
, obs AS (
  SELECT from_state, to_state, count(*) AS transitions FROM (
    SELECT lag(simulator_state) OVER (PARTITION BY patient_id ORDER BY seq) AS from_state,
           simulator_state AS to_state FROM raw)
  WHERE from_state IS NOT NULL GROUP BY ALL),
cells AS (
  SELECT d.from_state, d.to_state, CAST(coalesce(o.transitions, 0) AS BIGINT) AS transitions,
         d.declared_p
  FROM transition_dim d LEFT JOIN obs o ON d.from_state = o.from_state AND d.to_state = o.to_state),
tot AS (SELECT *, sum(transitions) OVER (PARTITION BY from_state) AS total FROM cells)
SELECT from_state, to_state, transitions,
       CASE WHEN total > 0 THEN CAST(transitions AS DOUBLE) / CAST(total AS DOUBLE) END AS empirical_p,
       declared_p,
       abs(CASE WHEN total > 0 THEN CAST(transitions AS DOUBLE) / CAST(total AS DOUBLE) END
           - declared_p) AS abs_diff
FROM tot"""))
def state_transitions(spark, sf_dir):
    """R2: empirical vs declared Markov transition matrix."""
    return Q.state_transitions(raw(spark, sf_dir))


def _episodes_sql(src: str, col: str) -> str:
    return f"""
, f AS (
  SELECT patient_id, seq, ts_ms, {col} AS state,
    CASE WHEN lag(seq) OVER (PARTITION BY patient_id ORDER BY seq) IS NULL
           OR lag({col}) OVER (PARTITION BY patient_id ORDER BY seq) IS DISTINCT FROM {col}
         THEN seq END AS st
  FROM {src}),
g AS (
  SELECT *, max(st) OVER (PARTITION BY patient_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS start_seq
  FROM f)
SELECT patient_id, start_seq, state, min(ts_ms) AS start_ms, max(ts_ms) AS end_ms,
       count(*) AS readings
FROM g GROUP BY ALL"""


@register("state_episodes", sql(_episodes_sql("raw", "simulator_state")))
def state_episodes(spark, sf_dir):
    """Runs of the same simulator state per patient."""
    return Q.episodes(raw(spark, sf_dir), "simulator_state")


@register("tier_episodes", sql(_episodes_sql("scored", "news2_tier")))
def tier_episodes(spark, sf_dir):
    """Runs of the same NEWS2 tier per patient."""
    return Q.episodes(scored(spark, sf_dir), "news2_tier")


@register("tier_episodes_nulls", sql(SCORED_NULLS + _episodes_sql("scored_nulls", "news2_tier")))
def tier_episodes_nulls(spark, sf_dir):
    """R3 with rejected readings (NULL tiers) between the runs."""
    return Q.episodes(scored_nulls(spark, sf_dir), "news2_tier")


@register("cadence_gaps", sql(f"""
SELECT patient_id, seq, prev_ts_ms, ts_ms, ts_ms - prev_ts_ms AS gap_ms FROM (
  SELECT patient_id, seq, ts_ms,
         lag(ts_ms) OVER (PARTITION BY patient_id ORDER BY ts_ms, seq) AS prev_ts_ms
  FROM raw)
WHERE ts_ms - prev_ts_ms > {Q.SILENCE_MS}"""))
def cadence_gaps(spark, sf_dir):
    """Silences longer than 5 minutes."""
    return Q.cadence_gaps(raw(spark, sf_dir))


@register("monitoring_sessions", sql(f"""
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
def monitoring_sessions(spark, sf_dir):
    """Monitoring sessions split by 5-minute inactivity."""
    return Q.monitoring_sessions(raw(spark, sf_dir))


_LEVELS = ", ".join(
    f"CAST(count_if(consciousness_level = '{lv}') AS BIGINT) AS n_{lv.lower()}"
    for lv in Q.CONSCIOUSNESS_LEVELS)


@register("state_profile", sql(f"""
SELECT r.simulator_state, count(*) AS readings, min(heart_rate) AS hr_min,
  max(heart_rate) AS hr_max, avg(heart_rate) AS hr_avg, avg(respiration_rate) AS rr_avg,
  avg(systolic_bp) AS bp_avg, avg(oxygen_saturation) AS spo2_avg,
  min(temperature) AS temp_min, max(temperature) AS temp_max,
  CAST(count_if(supplemental_o2) AS DOUBLE) / count(*) AS o2_rate, {_LEVELS},
  any_value(e.o2_pct) / 100.0::DOUBLE AS declared_o2_rate,
  any_value(m.a) AS declared_alert, any_value(m.c) AS declared_new_confusion,
  any_value(m.v) AS declared_voice, any_value(m.p) AS declared_pain,
  any_value(m.u) AS declared_unresponsive
FROM raw r LEFT JOIN env e ON r.simulator_state = e.simulator_state
LEFT JOIN (SELECT s, a::DOUBLE a, c::DOUBLE c, v::DOUBLE v, p::DOUBLE p, u::DOUBLE u FROM (VALUES
  ('STABLE', 1.0, 0, 0, 0, 0), ('DETERIORATING_SEPSIS', 0.60, 0.25, 0.15, 0, 0),
  ('DETERIORATING_RESPIRATORY', 0.70, 0.20, 0.10, 0, 0),
  ('DETERIORATING_CARDIAC', 0.70, 0.20, 0.10, 0, 0), ('POST_OP_RECOVERING', 1.0, 0, 0, 0, 0),
  ('SEPTIC_SHOCK', 0, 0, 0.33, 0.33, 0.34)) t(s, a, c, v, p, u)) m ON r.simulator_state = m.s
GROUP BY r.simulator_state"""))
def state_profile(spark, sf_dir):
    """Per-state physiology and consciousness mix (pivot)."""
    return Q.state_profile(raw(spark, sf_dir))


@register("state_score_fit", sql("""
SELECT s.simulator_state, count(*) AS readings,
  CAST(count_if(news2_score >= lo AND (hi IS NULL OR news2_score <= hi)) AS BIGINT) AS in_typical,
  CAST(count_if(news2_score >= lo AND (hi IS NULL OR news2_score <= hi)) AS DOUBLE) / count(*)
    AS share_typical
FROM scored s LEFT JOIN typical_dim t ON s.simulator_state = t.simulator_state
GROUP BY s.simulator_state"""))
def state_score_fit(spark, sf_dir):
    """Share of readings in each state's typical NEWS2 interval."""
    return Q.state_score_fit(scored(spark, sf_dir))
