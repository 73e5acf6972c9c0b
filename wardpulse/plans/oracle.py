"""DuckDB forms of the fixture views, used as the prefix of every oracle query.

The CTEs mirror ``sources.fixtures`` formula by formula (integer arithmetic
only) so both engines derive identical readings, registry events and
dimensions from the same parquet tables.
"""

from __future__ import annotations

from wardpulse.sources.fixtures import ENVELOPE, STATES, TRANSITIONS, TYPICAL_SCORE


def _values(rows) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(v)
    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


_ENV = _values(ENVELOPE)
_TRANS = _values([(STATES[i], STATES[j], TRANSITIONS[i][j])
                  for i in range(6) for j in range(6)])
_TYPICAL = _values([(s, lo, hi) for s, (lo, hi) in TYPICAL_SCORE.items()])


def _band(col: str, bands, top) -> str:
    parts = [f"WHEN {col} IS NULL THEN NULL"]
    parts += [f"WHEN {col} <= {edge} THEN {score}" for edge, score in bands]
    return "CASE " + " ".join(parts) + f" ELSE {top} END"


def _scores_sql(p: str = "") -> dict[str, str]:
    from wardpulse.functions import news2 as N
    return {
        "rr_score": _band(p + "respiration_rate", N.RR_BANDS, N.RR_TOP),
        "spo2_score": _band(p + "oxygen_saturation", N.SPO2_BANDS, N.SPO2_TOP),
        "o2_score": f"CASE WHEN {p}supplemental_o2 IS NULL THEN NULL "
                    f"WHEN {p}supplemental_o2 THEN 2 ELSE 0 END",
        "temp_score": _band(p + "temperature", N.TEMP_BANDS, N.TEMP_TOP),
        "bp_score": _band(p + "systolic_bp", N.BP_BANDS, N.BP_TOP),
        "hr_score": _band(p + "heart_rate", N.HR_BANDS, N.HR_TOP),
        "consciousness_score": f"CASE WHEN {p}consciousness_level IS NULL THEN NULL "
                               f"WHEN {p}consciousness_level = 'ALERT' THEN 0 ELSE 3 END",
    }


SCORES = _scores_sql()
_SUBS = ",\n    ".join(f"CAST({expr} AS INTEGER) AS {name}" for name, expr in SCORES.items())
_TOTAL = " + ".join(SCORES)

PREFIX = f"""
WITH env(sid, simulator_state, rr0, rrn, sp0, spn, o2_pct, t0, tn, bp0, bpn, hr0, hrn) AS (
  VALUES {_ENV}
),
transition_dim AS (
  SELECT from_state, to_state, CAST(p AS DOUBLE) AS declared_p
  FROM (VALUES {_TRANS}) t(from_state, to_state, p)
),
typical_dim(simulator_state, lo, hi) AS (VALUES {_TYPICAL}),
ev AS (
  SELECT event_id AS seq, user_id,
         1704067200000 + (epoch_us(ts) - 1704067200000000) // 300000 AS ts_ms,
         CAST(day(ts) AS BIGINT) AS dom,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events
),
ev2 AS (
  SELECT *, (user_id * 7 + dom * (user_id + dom)) % 12 AS m,
         seq % 53 = 0 AS wild
  FROM ev
),
ev3 AS (
  SELECT *, CASE WHEN m <= 5 THEN 0 WHEN m = 6 THEN 1 WHEN m = 7 THEN 2
                 WHEN m = 8 THEN 3 WHEN m <= 10 THEN 4 ELSE 5 END AS sid
  FROM ev2
),
raw AS (
  SELECT seq, CAST(user_id AS VARCHAR) AS patient_id, ts_ms,
    env.simulator_state,
    CAST(CASE WHEN wild THEN 4 + (seq*3 + k) % 36 ELSE rr0 + (seq*3 + k) % rrn END AS INTEGER) AS respiration_rate,
    CAST(CASE WHEN wild THEN 80 + (seq*5 + k) % 21 ELSE sp0 + (seq*5 + k) % spn END AS INTEGER) AS oxygen_saturation,
    (seq*13 + k) % 100 < o2_pct AS supplemental_o2,
    CAST(CASE WHEN wild THEN 340 + (seq*7 + k) % 80 ELSE t0 + (seq*7 + k) % tn END AS DOUBLE) / 10.0 AS temperature,
    CAST(CASE WHEN wild THEN 50 + (seq*11 + k) % 200 ELSE bp0 + (seq*11 + k) % bpn END AS INTEGER) AS systolic_bp,
    CAST(CASE WHEN wild THEN 30 + (seq*17 + k) % 150 ELSE hr0 + (seq*17 + k) % hrn END AS INTEGER) AS heart_rate,
    CASE WHEN ev3.sid IN (0, 4) THEN 'ALERT'
         WHEN ev3.sid = 1 THEN CASE WHEN k < 60 THEN 'ALERT' WHEN k < 85 THEN 'NEW_CONFUSION' ELSE 'VOICE' END
         WHEN ev3.sid IN (2, 3) THEN CASE WHEN k < 70 THEN 'ALERT' WHEN k < 90 THEN 'NEW_CONFUSION' ELSE 'VOICE' END
         ELSE CASE WHEN k < 33 THEN 'VOICE' WHEN k < 66 THEN 'PAIN' ELSE 'UNRESPONSIVE' END
    END AS consciousness_level
  FROM ev3 JOIN env ON ev3.sid = env.sid
),
sub AS (
  SELECT *,
    {_SUBS}
  FROM raw
),
scored AS (
  SELECT *, {_TOTAL} AS news2_score,
    CASE WHEN {_TOTAL} IS NULL THEN NULL
         ELSE greatest({", ".join(SCORES)}) >= 3 END AS any_extreme,
    CASE WHEN {_TOTAL} IS NULL THEN NULL WHEN {_TOTAL} >= 7 THEN 'High'
         WHEN {_TOTAL} >= 5 THEN 'Medium' ELSE 'Low' END AS news2_tier
  FROM sub
),
prev_tier AS (
  SELECT *, lag(news2_tier) OVER (PARTITION BY patient_id ORDER BY seq) AS previous_tier
  FROM scored WHERE news2_tier IS NOT NULL
),
alerts AS (
  SELECT patient_id, seq, ts_ms, previous_tier, news2_tier AS new_tier, news2_score
  FROM prev_tier
  WHERE previous_tier IS NOT NULL AND previous_tier <> news2_tier
),
admin AS (
  SELECT o_orderkey AS seq, CAST(o_custkey AS VARCHAR) AS patient_id,
    1704067200000 + ((o_orderkey * 7919) % 8640000) AS event_ms,
    CASE o_orderstatus WHEN 'O' THEN 'ADMIT' WHEN 'P' THEN 'TRANSFER'
                       WHEN 'F' THEN 'DISCHARGE' END AS event_type,
    'W' || CAST(o_orderkey % 5 AS VARCHAR) AS ward,
    CAST(NULL AS VARCHAR) AS initial_state,
    o_orderkey % 4 = 0 AS suspected_infection,
    c_mktsegment AS unit
  FROM orders JOIN customer ON o_custkey = c_custkey
)
"""

#: Continues the CTEs: readings with missing vitals, scored.
SCORED_NULLS = f"""
, raw_nulls AS (
  SELECT * REPLACE (CASE WHEN seq % 7 <> 0 THEN heart_rate END AS heart_rate,
    CASE WHEN seq % 11 = 3 THEN 'NaN'::DOUBLE
         ELSE temperature + CAST(seq % 1000 AS DOUBLE) * 0.00049::DOUBLE END AS temperature)
  FROM raw),
sub_nulls AS (SELECT *, {_SUBS} FROM raw_nulls),
scored_nulls AS (
  SELECT *, {_TOTAL} AS news2_score,
    CASE WHEN {_TOTAL} IS NULL THEN NULL WHEN {_TOTAL} >= 7 THEN 'High'
         WHEN {_TOTAL} >= 5 THEN 'Medium' ELSE 'Low' END AS news2_tier
  FROM sub_nulls)
"""


def sql_days(body: str) -> str:
    """The same over the uncompressed time axis of 30 days."""
    return PREFIX.replace("// 300000 AS ts_ms", "// 1000 AS ts_ms") + body


def sql_hot(body: str) -> str:
    """The same with a third of the readings given to one patient."""
    return PREFIX.replace("SELECT seq, CAST(user_id AS VARCHAR) AS patient_id, ts_ms,",
                          "SELECT seq, CASE WHEN seq % 3 = 0 THEN 'hot' ELSE "
                          "CAST(user_id AS VARCHAR) END AS patient_id, ts_ms,") + body


def sql(body: str) -> str:
    """Oracle query: the fixture CTEs followed by ``body`` (a SELECT)."""
    return PREFIX + body
