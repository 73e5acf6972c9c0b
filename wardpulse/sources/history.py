"""Table sinks and historical scans.

Tables are parquet partitioned by ``date`` (the time-range partitioning of the
reference's hypertables) and sorted within files by ``(patient_id, ts_ms)`` so
row-group min/max statistics stand in for the ``(patient_id, time DESC)``
index.  Writes need no shuffle: each task sorts its own rows and writes at most
one file per date it holds.  All paths live under the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardpulse.sources.frames import ts_guard

DAY_MS = 86_400_000

SCORED_ROW = ["time", "patient_id", "simulator_state", "respiration_rate",
              "oxygen_saturation", "supplemental_o2", "temperature", "systolic_bp",
              "heart_rate", "consciousness_level", "news2_score", "news2_tier"]
ALERT_ROW = ["time", "patient_id", "previous_tier", "new_tier", "news2_score"]


def _valid_ms(ms: str = "ts_ms") -> Column:
    return F.when(ts_guard(ms), F.col(ms))


def date_of(ms: str = "ts_ms") -> Column:
    """Partition date from epoch ms, independent of the session time zone; NULL
    for a time no table can hold."""
    return F.date_from_unix_date(F.floor(_valid_ms(ms) / DAY_MS).cast("int"))


def to_scored_row(scored: DataFrame) -> DataFrame:
    """K1 projection: ``timestamp`` -> ``time``; plus ``seq``, ``ts_ms``, ``date``.

    A reading with an invalid time has no row (F12): it is a ``bad_timestamp``
    reject, and still steps the patient's state."""
    return scored.filter(ts_guard()).select(
        F.timestamp_millis(_valid_ms()).alias("time"),
        *[c for c in SCORED_ROW[1:]], "seq", "ts_ms", date_of().alias("date"))


def to_alert_row(alerts: DataFrame) -> DataFrame:
    """K2 projection; an alert with an invalid time has no row, as above."""
    emitted = ["emitted_at"] if "emitted_at" in alerts.columns else []
    return alerts.filter(ts_guard()).select(
        F.timestamp_millis(_valid_ms()).alias("time"),
        *ALERT_ROW[1:], "seq", "ts_ms", *emitted, date_of().alias("date"))


def write_table(rows: DataFrame, path: str, mode: str = "append") -> None:
    (rows.sortWithinPartitions("date", "patient_id", "ts_ms")
     .write.mode(mode).partitionBy("date").parquet(path))


def write_scored_readings(scored: DataFrame, path: str, mode: str = "append") -> None:
    """K1: scored readings table."""
    write_table(to_scored_row(scored), path, mode)


def write_alerts(alerts: DataFrame, path: str, mode: str = "append") -> None:
    """K2: alerts table."""
    write_table(to_alert_row(alerts), path, mode)


def write_by_patient(scored: DataFrame, table: str, path: str, buckets: int, spread: int = 1) -> None:
    """S8 layout: the scored table by ``date``, bucketed by patient and sorted by patient
    and time.  One patient's history reads one bucket of each date, and joins on the
    patient need no shuffle.  ``spread`` deals a bucket out to as many tasks and
    files, for patients too hot for one."""
    rows = to_scored_row(scored)
    bucket = F.pmod(F.hash("patient_id"), F.lit(buckets))
    salt = [F.pmod(F.xxhash64("seq"), F.lit(spread))] if spread > 1 else []
    (rows.repartition(buckets * spread, bucket, *salt)
     .write.mode("overwrite").partitionBy("date").bucketBy(buckets, "patient_id")
     .sortBy("patient_id", "ts_ms").option("path", path).format("parquet").saveAsTable(table))


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def time_range(df: DataFrame, lo_ms: int, hi_ms: int) -> DataFrame:
    """Filter on ``date`` (partition pruning) *and* ``ts_ms`` (row groups)."""
    lo_day, hi_day = lo_ms // DAY_MS, (hi_ms - 1) // DAY_MS
    return df.filter(
        F.col("date").between(F.date_from_unix_date(F.lit(lo_day)),
                              F.date_from_unix_date(F.lit(hi_day)))
        & (F.col("ts_ms") >= lo_ms) & (F.col("ts_ms") < hi_ms))


def patient_history(df: DataFrame, patient_id: str, lo_ms: int, hi_ms: int,
                    n: int) -> DataFrame:
    """Newest-first history of one patient; the limit is the feature and
    plans as ``TakeOrderedAndProject`` after pushed-down filters."""
    return (time_range(df, lo_ms, hi_ms).filter(F.col("patient_id") == patient_id)
            .orderBy(F.col("ts_ms").desc(), F.col("seq").desc()).limit(n))


def newest_per_patient(df: DataFrame, lo_ms: int, hi_ms: int, n: int) -> DataFrame:
    """S8 for every patient: the newest ``n`` rows of each in a time range.

    ``row_number() <= n`` lets Spark plan a partial ``WindowGroupLimit``
    below the shuffle, so each map task ships at most ``n`` rows per patient:
    a patient with a huge history costs ``n`` rows per task, not its history.
    """
    w = Window.partitionBy("patient_id").orderBy(F.col("ts_ms").desc(), F.col("seq").desc())
    return (time_range(df, lo_ms, hi_ms).withColumn("recency", F.row_number().over(w))
            .filter(F.col("recency") <= n))
