"""Time-window aggregates.

Tumbling and sliding windows use Spark's ``window()`` so the same function
runs on batch and streaming frames.  Aggregates are algebraic (count, sum,
min, max, ``max_by``) so partial aggregation happens map-side; coarser windows
are rolled up from finer ones instead of rescanning readings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardpulse.functions.news2 import tier
from wardpulse.operators.ordered import TIME_CHUNK_MS, with_neighbour
from wardpulse.operators.sliding import mean_of, moments, std_of, with_sliding
from wardpulse.schemas import NUMERIC_VITALS

SHORT = {"respiration_rate": "rr", "oxygen_saturation": "spo2", "temperature": "temp",
         "systolic_bp": "bp", "heart_rate": "hr"}


def _rank(c: str) -> Column:
    return (F.when(F.col(c) == "High", 2).when(F.col(c) == "Medium", 1)
            .when(F.col(c) == "Low", 0))


def _rank_label(c: Column) -> Column:
    return F.when(c == 2, "High").when(c == 1, "Medium").when(c == 0, "Low")


#: Averages of doubles depend in their last bits on the order of partial sums;
#: they are published to this many places.
DOUBLE_PLACES = 9


def vital(v: str) -> Column:
    """A vital sign as window statistics see it: NaN is no measurement, like
    NULL (it counts in ``readings``, not in a minimum, maximum or average)."""
    return F.when(~F.isnan(v), F.col(v)) if v == "temperature" else F.col(v)


def window_stats(scored: DataFrame, duration: str, slide: str | None = None,
                 watermark: str | None = None) -> DataFrame:
    """Per patient and window: count, sum/min/max of each vital, O2 count,
    max score, last score (by arrival) and worst tier.  Sums are kept so the
    result can be rolled up to coarser windows exactly.
    """
    df = scored
    if watermark:
        df = df.withWatermark("timestamp", watermark)
    win = F.window("timestamp", duration, slide) if slide else F.window("timestamp", duration)
    # A reading without a score (a missing vital) is never the last one.
    scored_seq = F.when(F.col("news2_score").isNotNull(), F.col("seq"))
    aggs = [F.count(F.lit(1)).alias("readings")]
    for v in NUMERIC_VITALS:
        s, x = SHORT[v], vital(v)
        aggs += [F.sum(x).alias(f"{s}_sum"), F.count(x).alias(f"{s}_n"),
                 F.min(x).alias(f"{s}_min"), F.max(x).alias(f"{s}_max")]
    aggs += [
        F.count_if(F.col("supplemental_o2")).alias("o2_readings"),
        F.max("news2_score").alias("max_score"),
        F.max_by("news2_score", scored_seq).alias("last_score"),
        F.max(scored_seq).alias("last_seq"),
        F.max(_rank("news2_tier")).alias("worst_rank"),
    ]
    out = df.groupBy("patient_id", win.alias("window")).agg(*aggs)
    return out.withColumn("window_start_ms", F.unix_millis(F.col("window.start")))


def rollup_aggs() -> list[Column]:
    """Aggregates that turn stats of fine windows into stats of coarse ones."""
    aggs = [F.sum("readings").alias("readings")]
    for s in SHORT.values():
        aggs += [F.sum(f"{s}_sum").alias(f"{s}_sum"), F.sum(f"{s}_n").alias(f"{s}_n"),
                 F.min(f"{s}_min").alias(f"{s}_min"),
                 F.max(f"{s}_max").alias(f"{s}_max")]
    return aggs + [
        F.sum("o2_readings").alias("o2_readings"),
        F.max("max_score").alias("max_score"),
        F.max_by("last_score", "last_seq").alias("last_score"),
        F.max("last_seq").alias("last_seq"),
        F.max("worst_rank").alias("worst_rank"),
    ]


def rollup_stats(stats: DataFrame, width_ms: int) -> DataFrame:
    """Roll fine window stats up to tumbling windows of ``width_ms``."""
    start = (F.floor(F.col("window_start_ms") / F.lit(width_ms)) * F.lit(width_ms)).cast("long")
    return stats.groupBy("patient_id", start.alias("window_start_ms")).agg(*rollup_aggs())


def finish_stats(stats: DataFrame) -> DataFrame:
    """Public columns: averages over the non-null values, tier label from rank."""
    cols = [F.col("patient_id"), F.col("window_start_ms"), F.col("readings").cast("long")]
    for v, s in SHORT.items():
        avg = F.try_divide(F.col(f"{s}_sum").cast("double"), F.col(f"{s}_n").cast("double"))
        if v == "temperature":
            avg = F.round(avg, DOUBLE_PLACES)
        cols += [F.col(f"{s}_min"), F.col(f"{s}_max"), avg.alias(f"{s}_avg")]
    cols += [F.col("o2_readings").cast("long").alias("o2_readings"), F.col("max_score"),
             F.col("last_score"), _rank_label(F.col("worst_rank")).alias("worst_tier")]
    return stats.select(*cols)


def agg_5min(scored: DataFrame, watermark: str | None = None) -> DataFrame:
    return finish_stats(window_stats(scored, "5 minutes", watermark=watermark))


def agg_1hour(scored: DataFrame) -> DataFrame:
    """A2 as the exact roll-up of A1: 12× fewer rows reach the second shuffle."""
    return finish_stats(rollup_stats(window_stats(scored, "5 minutes"), 3_600_000))


def agg_sliding(scored: DataFrame, duration: str = "10 minutes",
                slide: str = "1 minute") -> DataFrame:
    """A4: sliding windows; each reading lands in duration/slide windows."""
    out = scored.groupBy("patient_id", F.window("timestamp", duration, slide).alias("w")).agg(
        F.count(F.lit(1)).alias("readings"),
        F.avg("heart_rate").alias("hr_avg"),
        F.max("news2_score").alias("max_score"))
    return out.select("patient_id", F.unix_millis("w.start").alias("window_start_ms"),
                      "readings", "hr_avg", "max_score")


def rolling(scored: DataFrame, width_ms: int = 600_000, column: str = "heart_rate",
            splits: int = 1) -> DataFrame:
    """A5: per reading, trailing ``width_ms`` RANGE frame per patient, in time linear
    in the readings; ``splits`` cuts the blocks of a patient too hot for one task."""
    s, x = SHORT[column], F.col(column).cast("long")
    parts = {"n": ("sum", F.lit(1).cast("long")), f"{s}_min": ("min", F.col(column)),
             f"{s}_max": ("max", F.col(column)), **moments("m", x)}
    out = with_sliding(scored.select("seq", "patient_id", "ts_ms", column), "patient_id",
                       "ts_ms", -width_ms, 0, parts, splits=splits)
    return out.select("seq", "patient_id", "ts_ms", "n", mean_of("m").alias(f"{s}_avg"),
                      f"{s}_min", f"{s}_max", F.round(std_of("m"), 4).alias(f"{s}_std"))


def window_news2(scored: DataFrame) -> DataFrame:
    """Per 5-minute window, the last reading's score/tier and the worst."""
    st = window_stats(scored, "5 minutes")
    return st.select("patient_id", "window_start_ms", "last_score",
                     tier(F.col("last_score")).alias("last_tier"), "max_score",
                     _rank_label(F.col("worst_rank")).alias("worst_tier"))


def throughput(scored: DataFrame, duration: str = "1 minute") -> DataFrame:
    """A10: readings and distinct patients per minute (global time series)."""
    out = scored.groupBy(F.window("timestamp", duration).alias("w")).agg(
        F.count(F.lit(1)).alias("readings"),
        F.countDistinct("patient_id").alias("patients"))
    return out.select(F.unix_millis("w.start").alias("minute_ms"), "readings", "patients")


def throughput_per_patient(scored: DataFrame, duration: str = "1 minute") -> DataFrame:
    """A10: readings of each patient per minute."""
    out = scored.groupBy("patient_id", F.window("timestamp", duration).alias("w")).agg(
        F.count(F.lit(1)).alias("readings"))
    return out.select("patient_id", F.unix_millis("w.start").alias("minute_ms"), "readings")


def with_dwell(scored: DataFrame, chunk_width: int = TIME_CHUNK_MS) -> DataFrame:
    """Time until the patient's next reading (null for the last one)."""
    nb = with_neighbour(scored, "patient_id", ["ts_ms", "seq"], ["ts_ms"],
                        direction="next", chunk_width=chunk_width)
    return nb.withColumn("dwell_ms", F.col("next_ts_ms") - F.col("ts_ms"))


def tier_occupancy(scored: DataFrame, chunk_width: int = TIME_CHUNK_MS) -> DataFrame:
    """Time spent in each tier per patient (sum of dwell times)."""
    d = with_dwell(scored.select("patient_id", "seq", "ts_ms", "news2_tier"), chunk_width)
    return d.groupBy("patient_id", "news2_tier").agg(
        F.count(F.lit(1)).alias("readings"),
        F.coalesce(F.sum("dwell_ms"), F.lit(0)).cast("long").alias("occupancy_ms"))
