"""Clinical rules on top of NEWS2: escalation band, sepsis triggers, the
rule-based clinical-state classifier and score-driver attribution.

All are native column expressions (CASE chains, casted predicate sums); the
driver attribution is a ``stack`` unpivot followed by a grouped count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardpulse.functions.news2 import SUBSCORE_COLUMNS

# Escalation bands and their required clinical response.
ESCALATION = [
    ("LOW_ROUTINE", "Low", "Routine monitoring, minimum 12-hourly obs"),
    ("LOW", "Low", "Minimum 12-hourly; nurse decides whether to escalate"),
    ("LOW_MEDIUM", "Low-Medium", "Urgent assessment by a competent registered nurse"),
    ("MEDIUM", "Medium", "Urgent clinician review; minimum hourly obs"),
    ("HIGH", "High", "Emergency response team; consider HDU/ICU transfer; "
                     "continuous monitoring"),
]
SEPSIS_BUNDLE_MIN_SCORE = 5
# Sepsis screening criteria (at least two of three).
SEPSIS_RR_MIN, SEPSIS_SBP_MAX, SEPSIS_MIN_CRITERIA = 22, 100, 2
ALTERED = ["VOICE", "PAIN", "UNRESPONSIVE"]

# Fixed values (our definition from the simulator's state envelopes): the
# classifier thresholds, first matching rule wins.
SHOCK_T, SHOCK_SBP, SHOCK_HR = 38.5, 85, 120
SEPSIS_T, SEPSIS_SBP, SEPSIS_HR = 38.5, 105, 100
RESP_SPO2, RESP_RR = 93, 25
CARDIAC_T, CARDIAC_SBP, CARDIAC_HR = 38.0, 100, 100
POSTOP_HR, POSTOP_SBP, POSTOP_RR, POSTOP_SPO2, POSTOP_T = 80, 110, 20, 95, 37.2

PARAMETER_NAMES = {
    "rr_score": "respiration_rate", "spo2_score": "oxygen_saturation",
    "o2_score": "supplemental_o2", "temp_score": "temperature",
    "bp_score": "systolic_bp", "hr_score": "heart_rate",
    "consciousness_score": "consciousness_level",
}


def escalation_band(total: str = "news2_score", extreme: str = "any_extreme") -> Column:
    t, x = F.col(total), F.col(extreme)
    return (F.when(t.isNull(), F.lit(None).cast("string"))
            .when(t >= 7, "HIGH").when(t >= 5, "MEDIUM")
            .when(x, "LOW_MEDIUM").when(t >= 1, "LOW").otherwise("LOW_ROUTINE"))


def escalation_dim(spark: SparkSession) -> DataFrame:
    """Five-row band -> risk/response dimension (fixed size: broadcastable)."""
    from wardpulse.sources.tables import inline_table
    return inline_table(spark, ESCALATION, [("escalation_band", "string"), ("risk", "string"),
                                            ("required_response", "string")])


def sepsis_criteria_count() -> Column:
    return ((F.col("respiration_rate") >= SEPSIS_RR_MIN).cast("int")
            + (F.col("systolic_bp") <= SEPSIS_SBP_MAX).cast("int")
            + (F.col("consciousness_level") != F.lit("ALERT")).cast("int"))


def sepsis_screen() -> Column:
    """Positive with at least two of the three criteria."""
    return sepsis_criteria_count() >= SEPSIS_MIN_CRITERIA


def sepsis_bundle(score: str = "news2_score",
                  infection: str = "suspected_infection") -> Column:
    return (F.col(score) >= SEPSIS_BUNDLE_MIN_SCORE) & F.coalesce(F.col(infection),
                                                                  F.lit(False))


def clinical_state() -> Column:
    """Snapshot classifier; ``simulator_state`` is never an input."""
    t, sbp, hr = F.col("temperature"), F.col("systolic_bp"), F.col("heart_rate")
    rr, spo2, o2 = F.col("respiration_rate"), F.col("oxygen_saturation"), F.col("supplemental_o2")
    c = F.col("consciousness_level")
    return (
        F.when((t >= SHOCK_T) & (sbp <= SHOCK_SBP) & (hr >= SHOCK_HR) & c.isin(*ALTERED),
               "SEPTIC_SHOCK")
        .when((t >= SEPSIS_T) & (sbp <= SEPSIS_SBP) & (hr >= SEPSIS_HR),
              "DETERIORATING_SEPSIS")
        .when((spo2 <= RESP_SPO2) & (rr >= RESP_RR) & o2, "DETERIORATING_RESPIRATORY")
        .when((t < CARDIAC_T) & (sbp <= CARDIAC_SBP) & (hr >= CARDIAC_HR),
              "DETERIORATING_CARDIAC")
        .when((hr > POSTOP_HR) | (sbp < POSTOP_SBP) | (rr > POSTOP_RR)
              | (spo2 < POSTOP_SPO2) | o2 | (t > POSTOP_T), "POST_OP_RECOVERING")
        .otherwise("STABLE")
    )


def unpivot_subscores(scored: DataFrame, ids: list[str]) -> DataFrame:
    """One row per (reading, parameter, subscore) — Spark's ``unpivot``."""
    return scored.unpivot(ids, SUBSCORE_COLUMNS, "score_column", "subscore").withColumn(
        "parameter", F.element_at(F.create_map(*[
            x for k, v in PARAMETER_NAMES.items() for x in (F.lit(k), F.lit(v))]),
            F.col("score_column")))


def score_drivers(scored: DataFrame) -> DataFrame:
    """Which parameters contribute (subscore > 0), by tier."""
    long = unpivot_subscores(scored, ["seq", "news2_tier"])
    return (long.filter(F.col("subscore") > 0)
            .groupBy("parameter", "news2_tier")
            .agg(F.count(F.lit(1)).alias("readings"),
                 F.sum("subscore").cast("long").alias("points"),
                 F.sum((F.col("subscore") == 3).cast("int")).cast("long").alias("extreme")))
