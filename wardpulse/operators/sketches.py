"""Mergeable summaries for dashboards over long ranges.

Stored per hour or minute, merged to any coarser range without the readings:

* latency quantiles as KLL sketches of LATENCY_K values.  A group of at most as many
  values is kept whole, so its quantiles are exact; beyond that the rank of an answer is
  within RANK_ERROR of the one asked for, more than twice the width of the sketch's
  99 % interval (2.296 / k**0.9021);
* distinct patients as theta sketches of 2**PATIENTS_LG entries.  Up to that many
  patients counts, unions and differences are exact; beyond, the relative standard error
  is 2**(-PATIENTS_LG / 2), 1.6 %.

Both are built map-side, so a group of any size moves one sketch per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LATENCY_K, RANK_ERROR = 1000, 0.01
PATIENTS_LG = 12
HOUR_MS, DAY_MS = 3_600_000, 86_400_000


def start_of(ms: str, width_ms: int) -> Column:
    return (F.floor(F.col(ms) / F.lit(width_ms)) * F.lit(width_ms)).cast("long")


def latency_sketches(latency: DataFrame, width_ms: int = HOUR_MS) -> DataFrame:
    """By new tier and ``width_ms`` of event time: alerts, largest lag, sketch."""
    return latency.groupBy("new_tier", start_of("ts_ms", width_ms).alias("start_ms")).agg(
        F.count(F.lit(1)).alias("alerts"), F.max("latency_ms").alias("max_ms"),
        F.kll_sketch_agg_bigint("latency_ms", LATENCY_K).alias("sketch"))


def merge_latency(sketches: DataFrame, by: Sequence[Column | str]) -> DataFrame:
    """Sketches of coarser groups from those of finer ones."""
    return sketches.groupBy(*by).agg(
        F.sum("alerts").alias("alerts"), F.max("max_ms").alias("max_ms"),
        F.kll_merge_agg_bigint("sketch").alias("sketch"))


def with_latency_quantiles(sketches: DataFrame) -> DataFrame:
    """p50 and p95 of each sketch (values that occur, not interpolated)."""
    return sketches.withColumns({
        f"p{int(q * 100)}_ms": F.kll_sketch_get_quantile_bigint("sketch", F.lit(q))
        for q in (0.5, 0.95)})


def patient_sketches(readings: DataFrame, by: Sequence[str] = (), width_ms: int = 60_000
                     ) -> DataFrame:
    """By ``by`` and ``width_ms`` of event time: readings, sketch of patients."""
    return readings.groupBy(*by, start_of("ts_ms", width_ms).alias("start_ms")).agg(
        F.count(F.lit(1)).alias("readings"),
        F.theta_sketch_agg("patient_id", PATIENTS_LG).alias("sketch"))


def merge_patients(sketches: DataFrame, by: Sequence[str] = (), width_ms: int = DAY_MS) -> DataFrame:
    return sketches.groupBy(*by, start_of("start_ms", width_ms).alias("start_ms")).agg(
        F.sum("readings").alias("readings"),
        F.theta_union_agg("sketch", PATIENTS_LG).alias("sketch"))


def patient_counts(sketches: DataFrame, by: Sequence[str] = (), width_ms: int = DAY_MS) -> DataFrame:
    """``patients`` of each range, and ``gone``: seen in the range just before, not in
    this one (NULL where that range has no readings)."""
    w = Window.partitionBy(*by).orderBy("start_ms")
    before = F.when(F.lag("start_ms").over(w) == F.col("start_ms") - F.lit(width_ms),
                    F.lag("sketch").over(w))
    return (sketches.withColumn("_before", before)
            .withColumn("patients", F.theta_sketch_estimate("sketch"))
            .withColumn("gone", F.theta_sketch_estimate(F.theta_difference("_before", "sketch")))
            .drop("_before", "sketch"))
