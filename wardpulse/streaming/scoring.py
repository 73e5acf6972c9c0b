"""Structured Streaming jobs: sources, the scoring stream and its sinks.

* ``kafka_frames``   — S1 on a live topic (needs the Kafka connector).
* ``file_readings``  — readings or frames from replayed parquet files.
* ``run_scoring``    — one query; each micro-batch is decoded and scored once
  and written to the lake (K6/K1), the alert table and topic (K2/K3), the scored
  topic (K4) and the rejects (S4).

Arrival order is truth, and nothing is dropped for being late.  The offsets seen
(T6) and the last tier of each patient (T1/T3) are keyed state in the state store
(``streaming.state``): a batch costs what it holds, whatever the population and
the lake.  Each folder is named by the batch id, which a replay overwrites; readers
that ask for ``finished`` rows see a batch in all tables or in none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from wardpulse.functions.news2 import rank_label, tier_rank, with_news2
from wardpulse.operators.alerts import with_emission
from wardpulse.schemas import ALERT_AVSC, RAW_AVSC, SCORED_AVSC, TOPIC_ALERTS, TOPIC_RAW, TOPIC_SCORED
from wardpulse.session import list_names, prepare_streaming, touch_path
from wardpulse.sources import frames as FR
from wardpulse.sources import history as H
from wardpulse.streaming.state import NOBODY, RETENTION_MS, stepped

REPLAY_PARTS, REPLAY_FILES = 4, 4
ROWS_PER_FILE = 250_000   # a file is one task of the stream
#: Offsets or files of one micro-batch unless the caller says otherwise; the
#: first batch of a backlog is then no larger than the others.
MAX_OFFSETS, MAX_FILES = 20_000_000, 1_000


def write_replay(rows: DataFrame, path: str, parts: int = REPLAY_PARTS,
                 files_per_part: int | None = None, order: tuple[int, ...] | None = None,
                 by: Column | None = None, even: bool = False) -> int:
    """Replay fixture: ``rows`` split into ``parts`` consecutive ranges of ``seq`` (or
    of ``by``), appended one after another (in ``order``), so each range's files are
    newer than those of the range before.  Each append writes ``files_per_part``
    files (from the number of rows unless given), so a stream that reads as
    many per trigger sees whole ranges.  Ranges are equally wide, or hold about as many
    rows when ``even``; then none is empty.  Returns the files per trigger."""
    by = F.col("seq") if by is None else by
    rows = rows.persist(StorageLevel.DISK_ONLY)   # derived once, not once for each range
    lo, hi, n = rows.agg(F.min(by), F.max(by), F.count(F.lit(1))).first()
    if not files_per_part:
        files_per_part = max(REPLAY_FILES, math.ceil(n / parts / ROWS_PER_FILE))
    step = math.ceil((hi - lo + 1) / parts)
    bounds = [lo + i * step for i in range(parts + 1)]
    if even:
        cuts = rows.agg(F.percentile_approx(by, [i / parts for i in range(1, parts)])).first()[0]
        bounds = [*sorted({lo, *cuts}), hi + 1]
    for i in order or range(len(bounds) - 1):
        a, b = bounds[i], bounds[i + 1]
        (rows.filter((by >= a) & (by < b))
         .repartition(files_per_part).write.mode("append").parquet(path))
    rows.unpersist()
    return files_per_part


def file_readings(spark: SparkSession, path: str, schema: T.StructType,
                  files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.parquet(path)


def kafka_frames(spark: SparkSession, brokers: str, topic: str = TOPIC_RAW,
                 starting: str = "earliest", max_offsets: int | None = None) -> DataFrame:
    """Subscribe to the raw topic (earliest when no committed offsets).

    ``seq`` is the (partition, offset) arrival order; per-patient order is the
    offset order because the topic is keyed by patient id."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", brokers)
            .option("subscribe", topic).option("startingOffsets", starting)
            .option("maxOffsetsPerTrigger", max_offsets or MAX_OFFSETS).load()
            .select((F.col("partition").cast("long") * F.lit(1 << 40) + F.col("offset"))
                    .alias("seq"), "value"))


def kafka_readings(spark: SparkSession, brokers: str, topic: str = TOPIC_RAW,
                   starting: str = "earliest", max_offsets: int | None = None,
                   avsc: str = RAW_AVSC) -> tuple[DataFrame, DataFrame]:
    """``(readings, rejects)`` streams of a framed topic."""
    src = kafka_frames(spark, brokers, topic, starting, max_offsets)
    return FR.route(FR.decode_frames(src, avsc, keep=["seq", "value"]))


def arriving(source: DataFrame, avsc: str | None) -> DataFrame:
    """Decoded rows of a stream of frames (``avsc`` given) or of readings.  Raw bytes
    stay with the rows that a table will refuse."""
    if not avsc:
        return source.drop("timestamp").withColumns({
            "status": F.lit("ok"), "decode_error": F.lit(None).cast("string"),
            "value": F.lit(None).cast("binary")})
    decoded = FR.decode_frames(source, avsc, keep=["seq", "value"])
    fine = (F.col("status") == "ok") & F.coalesce(FR.ts_guard(), F.lit(False))
    return decoded.withColumn("value", F.when(~fine, F.col("value")))


class ScoringSink:
    """``foreachBatch`` sink: all outputs of a micro-batch from one cached frame.
    Every folder is overwritten by batch id, so a replayed batch rewrites the same
    files; topics are at-least-once like any producer."""

    def __init__(self, out_dir: str, brokers: str | None = None,
                 time_mode: str = "event"):
        if time_mode not in ("event", "processing"):
            raise ValueError(time_mode)
        self.brokers, self.time_mode = brokers, time_mode
        self.paths = {k: f"{out_dir}/{k}" for k in
                      ("lake", "alerts", "alert_frames", "rejects", "commits")}

    def _to_topic(self, records: DataFrame, avsc: str, topic: str) -> None:
        (FR.encode_frames(records, avsc).select("key", "value").write.format("kafka")
         .option("kafka.bootstrap.servers", self.brokers).option("topic", topic).save())

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, at = batch.sparkSession, f"batch={batch_id}"
        rows = batch.persist()
        readings, rejects = FR.route(rows)
        scored = with_news2(readings.drop("status", "decode_error", "value", "split_status",
                                          "schema_id"))
        rank = tier_rank("news2_tier")
        alerts = with_emission(
            scored.filter((F.col("_prev") >= 0) & (F.col("_prev") != rank))
            .select("patient_id", "seq", "ts_ms", rank_label(F.col("_prev")).alias("previous_tier"),
                    F.col("news2_tier").alias("new_tier"), "news2_score")).persist()

        H.write_table(H.to_scored_row(scored), f"{self.paths['lake']}/{at}", "overwrite")
        H.write_table(H.to_alert_row(alerts), f"{self.paths['alerts']}/{at}", "overwrite")
        told = alerts if self.time_mode == "event" else alerts.withColumn(
            "ts_ms", F.unix_millis("emitted_at"))
        FR.encode_frames(told, ALERT_AVSC).write.mode("overwrite").parquet(
            f"{self.paths['alert_frames']}/{at}")
        rejects.write.mode("overwrite").parquet(f"{self.paths['rejects']}/{at}")
        touch_path(spark, f"{self.paths['commits']}/{batch_id}")
        if self.brokers:
            self._to_topic(told, ALERT_AVSC, TOPIC_ALERTS)
            self._to_topic(scored, SCORED_AVSC, TOPIC_SCORED)
        rows.unpersist()
        alerts.unpersist()


def finished(spark: SparkSession, paths: dict[str, str], table: str) -> DataFrame:
    """K6: rows of one output of ``run_scoring`` from batches that are written whole, to
    all outputs; batches run one after another, so the last one tells."""
    done = max(map(int, list_names(spark, paths["commits"])), default=-1)
    return spark.read.parquet(paths[table]).filter(F.col("batch") <= done)


def stored_tiers(spark: SparkSession, out_dir: str) -> DataFrame:
    """T1 (stream): each patient's last tier, read from the state store of a
    ``run_scoring`` job as of its last batch."""
    state = (spark.read.format("statestore").option("path", f"{out_dir}/_ck_scoring")
             .option("operatorId", 0).option("stateVarName", "last_tier").load())
    patient = F.col("user_map_key")["patient_id"]
    return state.select(F.when(patient != NOBODY, patient).alias("patient_id"),
                        rank_label(F.col("user_map_value")["rank"]).alias("last_tier"))


def dedup_alert_stream(alerts: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """T5 (stream): drop re-delivered alerts, key = (patient, arrival, new
    tier), e.g. when an alert topic is replayed into a downstream job."""
    return (alerts.withColumn("alert_time", F.timestamp_millis("ts_ms"))
            .withWatermark("alert_time", delay)
            .dropDuplicatesWithinWatermark(["patient_id", "seq", "new_tier"])
            .drop("alert_time"))


def run_scoring(spark: SparkSession, source: DataFrame, out_dir: str,
                available_now: bool = True, dedup: bool = False, avsc: str | None = None,
                brokers: str | None = None, time_mode: str = "event",
                retention_ms: int = RETENTION_MS) -> dict[str, str]:
    """Score a stream of readings, or of frames when ``avsc`` is given.

    ``dedup`` (T6) drops messages redelivered within ``retention_ms``; late ones are
    scored, stored and stepped like any other.  ``time_mode`` says which time alert
    records carry: the reading's, or the time of processing.  With ``available_now``
    the call returns when the backlog is done."""
    prepare_streaming(spark)
    rows = arriving(source, avsc)
    sink = ScoringSink(out_dir, brokers, time_mode)
    w = (stepped(rows, dedup, retention_ms).writeStream.foreachBatch(sink).outputMode("append")
         .option("checkpointLocation", f"{out_dir}/_ck_scoring"))
    # Offsets expire with the next batch; a batch without data has nothing to do.
    no_data = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(no_data)
    spark.conf.set(no_data, "false")
    try:
        q = (w.trigger(availableNow=True) if available_now else w).start()
    finally:
        spark.conf.set(no_data, before)
    if available_now:
        q.awaitTermination()
    return sink.paths


SNAPSHOT_COLUMNS = ["seq", "ts_ms", "news2_score", "news2_tier", "respiration_rate",
                    "oxygen_saturation", "temperature", "systolic_bp", "heart_rate",
                    "consciousness_level"]


def _snapshot_sink(path: str):
    def sink(batch: DataFrame, batch_id: int) -> None:
        # the updated patients of this batch; overwrite by batch id (idempotent)
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode(
            "overwrite").parquet(f"{path}/batch={batch_id}")
    return sink


def run_live_board(spark: SparkSession, readings: DataFrame, out_dir: str,
                   available_now: bool = True) -> str:
    """K7 (stream): latest reading per patient as a streaming ``max_by``
    aggregate in update mode; each batch's changed patients are appended to
    an upsert log that ``read_live_board`` compacts (latest batch wins)."""
    prepare_streaming(spark)
    latest = with_news2(readings).groupBy("patient_id").agg(
        F.max_by(F.struct(*SNAPSHOT_COLUMNS), F.col("seq")).alias("r"))
    rows = latest.select("patient_id", *[F.col("r")[c].alias(c) for c in SNAPSHOT_COLUMNS])
    path = f"{out_dir}/live_board"
    w = (rows.writeStream.outputMode("update").foreachBatch(_snapshot_sink(path))
         .option("checkpointLocation", f"{out_dir}/_ck_board"))
    if available_now:
        w = w.trigger(availableNow=True)
    q = w.start()
    if available_now:
        q.awaitTermination()
    return path


def read_live_board(spark: SparkSession, path: str) -> DataFrame:
    """Compact the upsert log: per patient, the row of the latest batch."""
    log = spark.read.parquet(path)
    best = log.groupBy("patient_id").agg(
        F.max_by(F.struct(*SNAPSHOT_COLUMNS), F.col("batch_id")).alias("r"))
    return best.select("patient_id", *[F.col("r")[c].alias(c) for c in SNAPSHOT_COLUMNS])


def alerts_with_vitals_stream(alerts: DataFrame, scored: DataFrame,
                              delay: str = "10 minutes", bound_ms: int = 60_000
                              ) -> DataFrame:
    """J1 (stream): alert stream ⋈ scored-reading stream on the reading's
    identity, with watermarks on both sides and an event-time bound so the
    join state is purged once the watermark passes ``bound_ms``."""
    a = (alerts.withColumn("a_time", F.timestamp_millis("ts_ms"))
         .withWatermark("a_time", delay).alias("a"))
    s = (scored.select("patient_id", "seq", "timestamp", "respiration_rate",
                       "oxygen_saturation", "supplemental_o2", "temperature",
                       "systolic_bp", "heart_rate", "consciousness_level")
         .withWatermark("timestamp", delay).alias("s"))
    cond = ((F.col("a.patient_id") == F.col("s.patient_id"))
            & (F.col("a.seq") == F.col("s.seq"))
            & F.col("s.timestamp").between(
                F.col("a.a_time") - F.expr(f"INTERVAL {bound_ms} MILLISECONDS"),
                F.col("a.a_time") + F.expr(f"INTERVAL {bound_ms} MILLISECONDS")))
    return a.join(s, cond, "inner").select(
        "a.patient_id", "a.seq", "a.ts_ms", "a.previous_tier", "a.new_tier",
        "a.news2_score", "s.respiration_rate", "s.oxygen_saturation", "s.supplemental_o2",
        "s.temperature", "s.systolic_bp", "s.heart_rate", "s.consciousness_level")


def run_scoring_kafka(spark: SparkSession, brokers: str, out_dir: str,
                      max_offsets: int | None = None, once: bool = False,
                      dedup: bool = False, time_mode: str = "event") -> dict[str, str]:
    """The deployed shape: raw topic -> lake, alert table, rejects, and the
    alert and scored topics (needs the Kafka connector)."""
    return run_scoring(spark, kafka_frames(spark, brokers, max_offsets=max_offsets), out_dir,
                       available_now=once, dedup=dedup, avsc=RAW_AVSC, brokers=brokers,
                       time_mode=time_mode)
