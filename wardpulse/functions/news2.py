"""NEWS2 scoring as native Catalyst expressions.

Every function takes and returns a ``Column``; the band chains compile to a
``CASE WHEN`` that runs inside whole-stage codegen, on batch and stream frames
alike.  A NULL input gives a NULL subscore (and so a NULL total and tier)
instead of falling through to the ``otherwise`` branch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# NEWS2 bands as (inclusive upper bound, subscore) pairs in
# ascending order, then the subscore above the last bound.
RR_BANDS = [(8, 3), (11, 1), (20, 0), (24, 2)]
RR_TOP = 3
SPO2_BANDS = [(91, 3), (93, 2), (95, 1)]  # SpO2 scale 1 only
SPO2_TOP = 0
TEMP_BANDS = [(35.0, 3), (36.0, 1), (38.0, 0), (39.0, 1)]
TEMP_TOP = 2
BP_BANDS = [(90, 3), (100, 2), (110, 1), (219, 0)]
BP_TOP = 3
HR_BANDS = [(40, 3), (50, 1), (90, 0), (110, 1), (130, 2)]
HR_TOP = 3
O2_ON_SCORE = 2
ALERT_LEVEL = "ALERT"          # the only consciousness level scoring 0
CONSCIOUSNESS_OTHER_SCORE = 3
MEDIUM_MIN, HIGH_MIN = 5, 7    # tier cut points on the total
EXTREME_SUBSCORE = 3

SUBSCORE_COLUMNS = [
    "rr_score", "spo2_score", "o2_score", "temp_score", "bp_score",
    "hr_score", "consciousness_score",
]


def _null_int() -> Column:
    return F.lit(None).cast("int")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _banded(c, bands, top) -> Column:
    c = _col(c)
    expr = F.when(c.isNull(), _null_int())
    for edge, score in bands:
        expr = expr.when(c <= F.lit(edge), F.lit(score))
    return expr.otherwise(F.lit(top))


def score_rr(c) -> Column:
    return _banded(c, RR_BANDS, RR_TOP)


def score_spo2(c) -> Column:
    return _banded(c, SPO2_BANDS, SPO2_TOP)


def score_o2(c) -> Column:
    c = _col(c)
    return F.when(c.isNull(), _null_int()).when(c, F.lit(O2_ON_SCORE)).otherwise(F.lit(0))


def score_temp(c) -> Column:
    """NaN compares greater than every number in Spark, so it lands in the top band."""
    return _banded(c, TEMP_BANDS, TEMP_TOP)


def score_bp(c) -> Column:
    return _banded(c, BP_BANDS, BP_TOP)


def score_hr(c) -> Column:
    return _banded(c, HR_BANDS, HR_TOP)


def score_consciousness(c) -> Column:
    """Exactly ``ALERT`` scores 0; any other string (case-sensitive) scores 3."""
    c = _col(c)
    return (F.when(c.isNull(), _null_int())
            .when(c == F.lit(ALERT_LEVEL), F.lit(0))
            .otherwise(F.lit(CONSCIOUSNESS_OTHER_SCORE)))


def tier(total) -> Column:
    total = _col(total)
    return (F.when(total.isNull(), F.lit(None).cast("string"))
            .when(total >= HIGH_MIN, F.lit("High"))
            .when(total >= MEDIUM_MIN, F.lit("Medium"))
            .otherwise(F.lit("Low")))


def tier_rank(t) -> Column:
    """Low=0, Medium=1, High=2 (for worsening/improving comparisons)."""
    t = _col(t)
    return (F.when(t == "Low", 0).when(t == "Medium", 1)
            .when(t == "High", 2).otherwise(F.lit(None).cast("int")))


def rank_label(rank) -> Column:
    """Inverse of ``tier_rank``."""
    r = _col(rank)
    return (F.when(r == 0, "Low").when(r == 1, "Medium").when(r == 2, "High")
            .otherwise(F.lit(None).cast("string")))


def subscores(prefix: str = "") -> dict[str, Column]:
    p = prefix
    return {
        "rr_score": score_rr(p + "respiration_rate"),
        "spo2_score": score_spo2(p + "oxygen_saturation"),
        "o2_score": score_o2(p + "supplemental_o2"),
        "temp_score": score_temp(p + "temperature"),
        "bp_score": score_bp(p + "systolic_bp"),
        "hr_score": score_hr(p + "heart_rate"),
        "consciousness_score": score_consciousness(p + "consciousness_level"),
    }


def with_subscores(df: DataFrame) -> DataFrame:
    return df.withColumns(subscores())


def with_news2(df: DataFrame, keep_subscores: bool = True) -> DataFrame:
    """RAW -> RAW + 7 subscores + news2_score + any_extreme + news2_tier.

    One projection: the subscores are computed once and reused by the total,
    the extreme flag and the tier (Catalyst collapses the two selects).
    """
    scored = with_subscores(df)
    parts = [F.col(c) for c in SUBSCORE_COLUMNS]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    # Three stacked projections, each referring to the previous one's columns:
    # Catalyst keeps them apart rather than inlining the seven CASE chains
    # into every later reference (which bloats generated code).
    scored = scored.withColumn("news2_score", total)
    scored = scored.withColumns({
        # any parameter at 3; it never changes the tier (a 1-4 total with an
        # extreme parameter stays Low), it is reported for the response band.
        "any_extreme": F.when(F.col("news2_score").isNotNull(),
                              F.greatest(*parts) >= F.lit(EXTREME_SUBSCORE)),
        "news2_tier": tier("news2_score"),
    })
    if not keep_subscores:
        scored = scored.drop(*SUBSCORE_COLUMNS, "any_extreme")
    return scored
