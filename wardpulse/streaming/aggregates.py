"""Streaming window aggregates (A3), sessions (R5) and silences.

Event-time windows with a watermark, append mode: a window or session is written
once, when the watermark passes its end; later rows for it are dropped from the
aggregate (they are still scored and stored by the scoring stream).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardpulse.functions.news2 import with_news2
from wardpulse.operators.quality import SILENCE_MS, sessions_native
from wardpulse.operators.windows import rollup_aggs, window_stats
from wardpulse.session import prepare_streaming
from wardpulse.streaming.state import silence_stream

WATERMARK = "10 minutes"


def write_stream(rows: DataFrame, out_dir: str, name: str, available_now: bool = True) -> str:
    """Append the rows of a stream to ``out_dir/name``; returns the folder."""
    path = f"{out_dir}/{name}"
    w = (rows.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", f"{out_dir}/_ck_{name}"))
    q = (w.trigger(availableNow=True) if available_now else w).start(path)
    if available_now:
        q.awaitTermination()
    return path


def run_aggregates(spark: SparkSession, readings: DataFrame, out_dir: str,
                   duration: str = "5 minutes", watermark: str = WATERMARK,
                   available_now: bool = True) -> str:
    """Write closed ``duration`` windows per patient to ``out_dir/windows``."""
    stats = window_stats(with_news2(readings), duration, watermark=watermark).drop("window")
    return write_stream(stats, out_dir, "windows", available_now)


def hourly_stream(readings: DataFrame, fine: str = "5 minutes", coarse: str = "1 hour",
                  watermark: str = WATERMARK) -> DataFrame:
    """A2 on the stream: the coarse windows as an aggregate of the closed fine ones, in
    one query and one pass over the readings.  State holds sums by patient and
    window; the coarse level sees one row per patient and fine window."""
    stats = window_stats(with_news2(readings), fine, watermark=watermark).drop("window_start_ms")
    hours = stats.withColumn("at", F.window_time("window")).groupBy(
        "patient_id", F.window("at", coarse).alias("hour")).agg(*rollup_aggs())
    return hours.withColumn("window_start_ms", F.unix_millis("hour.start")).drop("hour")


def run_hourly(spark: SparkSession, readings: DataFrame, out_dir: str,
               watermark: str = WATERMARK, available_now: bool = True) -> str:
    """A3: write closed hours per patient, chained on 5-minute windows."""
    prepare_streaming(spark)
    return write_stream(hourly_stream(readings, watermark=watermark), out_dir, "hours",
                        available_now)


def run_sessions(spark: SparkSession, readings: DataFrame, out_dir: str,
                 watermark: str = WATERMARK, available_now: bool = True) -> str:
    """Write closed monitoring sessions.  A reading that comes late, but before the
    watermark, extends a session or joins the two that it bridges."""
    prepare_streaming(spark)
    sessions = sessions_native(readings.withWatermark("timestamp", watermark))
    return write_stream(sessions, out_dir, "sessions", available_now)


def run_silences(spark: SparkSession, readings: DataFrame, out_dir: str,
                 gap_ms: int = SILENCE_MS, watermark: str = WATERMARK,
                 available_now: bool = True) -> str:
    """Write one row per silence, as soon as the watermark proves it."""
    prepare_streaming(spark)
    return write_stream(silence_stream(readings, gap_ms, watermark), out_dir, "silences",
                        available_now)
