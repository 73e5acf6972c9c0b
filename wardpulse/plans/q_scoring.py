"""Registered queries: NEWS2 scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardpulse.functions import clinical as C
from wardpulse.functions.news2 import SUBSCORE_COLUMNS
from wardpulse.operators.joins import registry_latest
from wardpulse.plans.oracle import sql
from wardpulse.plans.registry import admin, register, scored

# Spark's TIMESTAMP range (0001-01-01 .. 9999-12-31 23:59:59.999 UTC) in ms.
MIN_TS_MS, MAX_TS_MS = -62135596800000, 253402300799999
I64_MAX = 9223372036854775807
BAD_TS_MOD, BAD_TS_REM = 113, 19   # fault rule shared with the frame fixture

_BAND_QUERIES = [
    ("score_rr", "respiration_rate", "rr_score"),
    ("score_spo2", "oxygen_saturation", "spo2_score"),
    ("score_o2", "supplemental_o2", "o2_score"),
    ("score_temp", "temperature", "temp_score"),
    ("score_bp", "systolic_bp", "bp_score"),
    ("score_hr", "heart_rate", "hr_score"),
    ("score_consciousness", "consciousness_level", "consciousness_score"),
]


def _band_query(name, value_col, score_col):
    def q(spark, sf_dir):
        return (scored(spark, sf_dir).groupBy(value_col, score_col)
                .agg(F.count(F.lit(1)).alias("readings")))
    q.__name__ = name
    q.__doc__ = f"F: {score_col} for every reading, as a value -> subscore histogram."
    register(name, sql(f"SELECT {value_col}, {score_col}, count(*) AS readings "
                       f"FROM scored GROUP BY {value_col}, {score_col}"))(q)


for _n, _v, _s in _BAND_QUERIES:
    _band_query(_n, _v, _s)


@register("news2_score", sql("SELECT seq, patient_id, news2_score FROM scored"))
def news2_score(spark, sf_dir):
    """F8: total of the seven subscores per reading."""
    return scored(spark, sf_dir).select("seq", "patient_id", "news2_score")


@register("any_extreme", sql(
    "SELECT news2_tier, any_extreme, count(*) AS readings, "
    "CAST(sum(news2_score) AS BIGINT) AS score_sum FROM scored GROUP BY ALL"))
def any_extreme(spark, sf_dir):
    """any single parameter at 3 (never changes the tier)."""
    return scored(spark, sf_dir).groupBy("news2_tier", "any_extreme").agg(
        F.count(F.lit(1)).alias("readings"),
        F.sum("news2_score").cast("long").alias("score_sum"))


@register("news2_tier", sql(
    "SELECT news2_tier, count(*) AS readings, min(news2_score) AS min_score, "
    "max(news2_score) AS max_score FROM scored GROUP BY news2_tier"))
def news2_tier(spark, sf_dir):
    """tier labels with the score range that produced each."""
    return scored(spark, sf_dir).groupBy("news2_tier").agg(
        F.count(F.lit(1)).alias("readings"),
        F.min("news2_score").alias("min_score"),
        F.max("news2_score").alias("max_score"))


_FLAGSHIP_COLS = (["seq", "patient_id", "ts_ms", "simulator_state",
                   "respiration_rate", "oxygen_saturation", "supplemental_o2",
                   "temperature", "systolic_bp", "heart_rate", "consciousness_level"]
                  + SUBSCORE_COLUMNS + ["news2_score", "any_extreme", "news2_tier"])


@register("news2_scored", sql(f"SELECT {', '.join(_FLAGSHIP_COLS)} FROM scored"))
def news2_scored(spark, sf_dir):
    """F11 (flagship): every reading with its subscores, total and tier."""
    return scored(spark, sf_dir).select(*_FLAGSHIP_COLS)


@register("epoch_ms_convert", sql(f"""
SELECT seq, ms, ms BETWEEN {MIN_TS_MS} AND {MAX_TS_MS} AS ts_valid,
       CASE WHEN ms BETWEEN {MIN_TS_MS} AND {MAX_TS_MS}
            THEN epoch_ms(epoch_ms(ms)) END AS ms_back
FROM (SELECT seq, CASE WHEN seq % {BAD_TS_MOD} = {BAD_TS_REM} THEN {I64_MAX}
                       ELSE ts_ms END AS ms FROM raw)"""))
def epoch_ms_convert(spark, sf_dir):
    """epoch-ms -> timestamp, range-checked *before* conversion (ANSI
    mode would otherwise abort the job on i64::MAX)."""
    from wardpulse.plans.registry import raw
    r = raw(spark, sf_dir).select(
        "seq", F.when(F.col("seq") % BAD_TS_MOD == BAD_TS_REM, F.lit(I64_MAX))
        .otherwise(F.col("ts_ms")).alias("ms"))
    valid = F.col("ms").between(MIN_TS_MS, MAX_TS_MS)
    ts = F.timestamp_millis(F.when(valid, F.col("ms")))
    return r.select("seq", "ms", valid.alias("ts_valid"),
                    F.unix_millis(ts).alias("ms_back"))


_ESC_VALUES = ", ".join(
    "('" + b + "', '" + r + "', '" + t.replace("'", "''") + "')" for b, r, t in C.ESCALATION)


@register("escalation_band", sql(f"""
, dim(escalation_band, risk, required_response) AS (VALUES {_ESC_VALUES}),
banded AS (
  SELECT CASE WHEN news2_score IS NULL THEN NULL WHEN news2_score >= 7 THEN 'HIGH'
              WHEN news2_score >= 5 THEN 'MEDIUM' WHEN any_extreme THEN 'LOW_MEDIUM'
              WHEN news2_score >= 1 THEN 'LOW' ELSE 'LOW_ROUTINE' END AS escalation_band
  FROM scored)
SELECT b.escalation_band, d.risk, d.required_response, count(*) AS readings
FROM banded b JOIN dim d ON b.escalation_band = d.escalation_band
GROUP BY ALL""".replace("\n, dim", "dim", 0)))
def escalation_band(spark, sf_dir):
    """five-way escalation band plus the required response (5-row
    broadcast dimension)."""
    s = scored(spark, sf_dir).select(C.escalation_band().alias("escalation_band"))
    # left join: an inner join on a computed key makes the optimizer push an
    # inferred IS NOT NULL filter (with the whole score expression) to the scan
    return (s.join(F.broadcast(C.escalation_dim(spark)), "escalation_band", "left")
            .groupBy("escalation_band", "risk", "required_response")
            .agg(F.count(F.lit(1)).alias("readings")))


@register("sepsis_bundle", sql("""
, latest AS (
  SELECT patient_id, arg_max(suspected_infection, (event_ms, seq)) AS suspected_infection,
         arg_max(ward, (event_ms, seq)) AS ward
  FROM admin GROUP BY patient_id)
SELECT s.seq, s.patient_id, s.news2_score, l.ward
FROM scored s JOIN latest l ON s.patient_id = l.patient_id
WHERE s.news2_score >= 5 AND l.suspected_infection"""))
def sepsis_bundle(spark, sf_dir):
    """score >= 5 in a patient with suspected infection (registry)."""
    reg = registry_latest(admin(spark, sf_dir)).select(
        "patient_id", "suspected_infection", "ward")
    return (scored(spark, sf_dir).join(reg, "patient_id")
            .filter(C.sepsis_bundle())
            .select("seq", "patient_id", "news2_score", "ward"))


@register("sepsis_criteria", sql("""
SELECT simulator_state,
       CAST((respiration_rate >= 22) AS INTEGER) + CAST((systolic_bp <= 100) AS INTEGER)
         + CAST((consciousness_level <> 'ALERT') AS INTEGER) AS sepsis_criteria,
       sepsis_criteria >= 2 AS sepsis_screen, count(*) AS readings
FROM scored GROUP BY ALL"""))
def sepsis_criteria(spark, sf_dir):
    """F16: number of sepsis screening criteria met (>= 2 screens positive)."""
    return (scored(spark, sf_dir)
            .groupBy("simulator_state", C.sepsis_criteria_count().alias("sepsis_criteria"),
                     C.sepsis_screen().alias("sepsis_screen"))
            .agg(F.count(F.lit(1)).alias("readings")))


_CLIN_SQL = f"""
CASE WHEN temperature >= {C.SHOCK_T} AND systolic_bp <= {C.SHOCK_SBP} AND heart_rate >= {C.SHOCK_HR}
          AND consciousness_level IN ('VOICE', 'PAIN', 'UNRESPONSIVE') THEN 'SEPTIC_SHOCK'
     WHEN temperature >= {C.SEPSIS_T} AND systolic_bp <= {C.SEPSIS_SBP} AND heart_rate >= {C.SEPSIS_HR}
          THEN 'DETERIORATING_SEPSIS'
     WHEN oxygen_saturation <= {C.RESP_SPO2} AND respiration_rate >= {C.RESP_RR} AND supplemental_o2
          THEN 'DETERIORATING_RESPIRATORY'
     WHEN temperature < {C.CARDIAC_T} AND systolic_bp <= {C.CARDIAC_SBP} AND heart_rate >= {C.CARDIAC_HR}
          THEN 'DETERIORATING_CARDIAC'
     WHEN heart_rate > {C.POSTOP_HR} OR systolic_bp < {C.POSTOP_SBP} OR respiration_rate > {C.POSTOP_RR}
          OR oxygen_saturation < {C.POSTOP_SPO2} OR supplemental_o2 OR temperature > {C.POSTOP_T}
          THEN 'POST_OP_RECOVERING'
     ELSE 'STABLE' END"""


@register("clinical_state", sql(
    f"SELECT seq, patient_id, {_CLIN_SQL} AS clinical_state FROM raw"))
def clinical_state(spark, sf_dir):
    """rule-based snapshot classifier per reading."""
    from wardpulse.plans.registry import raw
    return raw(spark, sf_dir).select("seq", "patient_id",
                                     C.clinical_state().alias("clinical_state"))


_PARAM_CASE = "CASE score_column " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in C.PARAMETER_NAMES.items()) + " END"


@register("score_drivers", sql(f"""
, long AS (
  UNPIVOT (SELECT seq, news2_tier, {', '.join(SUBSCORE_COLUMNS)} FROM scored)
  ON {', '.join(SUBSCORE_COLUMNS)} INTO NAME score_column VALUE subscore)
SELECT {_PARAM_CASE} AS parameter, news2_tier, count(*) AS readings,
       CAST(sum(subscore) AS BIGINT) AS points,
       CAST(sum(CASE WHEN subscore = 3 THEN 1 ELSE 0 END) AS BIGINT) AS extreme
FROM long WHERE subscore > 0 GROUP BY ALL"""))
def score_drivers(spark, sf_dir):
    """which parameters drive the score, per tier (unpivot + group)."""
    return C.score_drivers(scored(spark, sf_dir))
