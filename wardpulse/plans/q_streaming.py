"""Registered queries: streaming jobs replayed from files derived from the
given tables (S1, T1, T3, T6, A3, J1, J2, K6, K7, M5, R4, R5).  Each run writes its replay files, outputs
and checkpoints under a fresh folder of the shared directory."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from wardpulse.operators.alerts import redeliver
from wardpulse.operators.windows import finish_stats
from wardpulse.plans.oracle import sql
from wardpulse.plans.q_frames import _FAULTS_CTE
from wardpulse.plans.q_windows import _stats_sql
from wardpulse.plans import q_joins
from wardpulse.plans.registry import ORACLE, admin, raw, register
from wardpulse.session import scratch_path
from wardpulse.sources import frames as FR
from wardpulse.sources import history as H
from wardpulse.operators import trajectory as M
from wardpulse.operators.joins import ASOF_FIELDS
from wardpulse.operators.quality import SILENCE_MS
from wardpulse.streaming.aggregates import run_aggregates, run_hourly, run_sessions, run_silences
from wardpulse.streaming.predict import probability_from, run_predictions
from wardpulse.streaming.registry import append_version, run_wards
from wardpulse.functions.news2 import with_news2
from wardpulse.schemas import ALERT, RAW_AVSC
from wardpulse.streaming.scoring import (
    alerts_with_vitals_stream, file_readings, finished, read_live_board, run_live_board,
    run_scoring, stored_tiers, write_replay)

REPLAY_DUP_MOD = 50   # every 50th reading redelivered in the lake replay


def _replayed(spark, sf_dir, name, duplicates: bool = False, frames: bool = False, order=None):
    base = scratch_path(spark, name)
    r = raw(spark, sf_dir)
    if frames:
        r = FR.fixture_frames(r, RAW_AVSC).select("seq", "value")
    if duplicates:
        r = redeliver(r, REPLAY_DUP_MOD)
    fpt = write_replay(r, f"{base}/replay", order=order)
    return file_readings(spark, f"{base}/replay", r.schema, fpt), base, fpt


@register("stream_raw_replay", sql("SELECT seq, patient_id, ts_ms FROM raw"))
def stream_raw_replay(spark, sf_dir):
    """The readings source as a stream (file replay; Kafka by option),
    written through a checkpointed parquet sink and read back."""
    stream, base, _ = _replayed(spark, sf_dir, "stream_raw")
    q = (stream.select("seq", "patient_id", "ts_ms").writeStream.format("parquet")
         .option("checkpointLocation", f"{base}/_ck").trigger(availableNow=True)
         .start(f"{base}/out"))
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


@register("stream_tier_change_alerts", sql("SELECT * FROM alerts"))
def stream_tier_change_alerts(spark, sf_dir):
    """T3 (+T6): stateful alert stream over several micro-batches, fed a
    replay with redelivered readings; equals T2."""
    stream, base, _ = _replayed(spark, sf_dir, "stream_alerts", duplicates=True)
    paths = run_scoring(spark, stream, f"{base}/out", dedup=True)
    return spark.read.parquet(paths["alerts"]).select(
        "patient_id", "seq", "ts_ms", "previous_tier", "new_tier", "news2_score")


@register("lake_write_readback", sql("""
SELECT seq, ts_ms, patient_id, simulator_state, respiration_rate, oxygen_saturation,
       supplemental_o2, temperature, systolic_bp, heart_rate, consciousness_level,
       news2_score, news2_tier FROM scored"""))
def lake_write_readback(spark, sf_dir):
    """K6 + T6 (stream): a replay with every 50th reading redelivered, scored
    once into the date-partitioned lake table, read back."""
    stream, base, _ = _replayed(spark, sf_dir, "stream_lake", duplicates=True)
    paths = run_scoring(spark, stream, f"{base}/out", dedup=True)
    return spark.read.parquet(paths["lake"]).select(
        "seq", "ts_ms", *H.SCORED_ROW[1:])


FAULTY_ORDER = (0, 2, 3, 1)   # replay order of the four ranges: one comes late


_ARRIVED = _FAULTS_CTE + """
, b AS (SELECT min(seq) AS lo, CAST(ceil((max(seq) - min(seq) + 1) / 4) AS BIGINT) AS step FROM raw),
arrived AS (
  SELECT s.*, f.fault, list_position([0, 2, 3, 1], (s.seq - lo) // step) AS batch
  FROM scored s JOIN faults f ON s.seq = f.seq CROSS JOIN b),
good AS (SELECT * FROM arrived WHERE fault IS NULL OR fault IN ('other_schema_id', 'bad_timestamp')),
steps AS (
  SELECT *, lag(news2_tier) OVER (PARTITION BY patient_id ORDER BY batch, seq) AS prev FROM good)
"""


@register("stream_faulty_replay", sql(_ARRIVED + """
SELECT 'lake' AS output, seq, news2_tier AS detail, CAST(NULL AS BIGINT) AS raw_bytes FROM good
WHERE fault IS NULL OR fault <> 'bad_timestamp'
UNION ALL
SELECT 'alert', seq, prev || '>' || news2_tier, NULL FROM steps
WHERE prev <> news2_tier AND (fault IS NULL OR fault <> 'bad_timestamp')
UNION ALL
SELECT 'reject', seq, CASE WHEN fault IN ('empty', 'short') THEN 'short_frame'
    WHEN fault = 'truncated' THEN 'decode_error' ELSE fault END,
  CASE fault WHEN 'empty' THEN 0 WHEN 'short' THEN 5 END
FROM arrived WHERE fault IS NOT NULL AND fault <> 'other_schema_id'"""))
def stream_faulty_replay(spark, sf_dir):
    """Frames with every kind of fault, one range of
    them late, every 50th redelivered; nothing else is lost, and rejects keep
    their bytes."""
    stream, base, _ = _replayed(spark, sf_dir, "stream_faulty", duplicates=True, frames=True,
                             order=FAULTY_ORDER)
    paths = run_scoring(spark, stream, f"{base}/out", dedup=True, avsc=RAW_AVSC)
    read = {k: spark.read.parquet(paths[k]) for k in ("lake", "alerts", "rejects")}
    none = F.lit(None).cast("long").alias("raw_bytes")
    short = F.when(F.col("reason") == "short_frame", F.length("value").cast("long"))
    return (read["lake"].select(F.lit("lake").alias("output"), "seq",
                                F.col("news2_tier").alias("detail"), none)
            .unionByName(read["alerts"].select(
                F.lit("alert").alias("output"), "seq",
                F.concat_ws(">", "previous_tier", "new_tier").alias("detail"), none))
            .unionByName(read["rejects"].select(
                F.lit("reject").alias("output"), "seq", F.col("reason").alias("detail"),
                short.alias("raw_bytes"))))


def _two_runs(spark, sf_dir, name):
    """Faulty, late and redelivered frames scored by a job that stops half-way and is
    started again from its checkpoint."""
    base = scratch_path(spark, name)
    frames = redeliver(FR.fixture_frames(raw(spark, sf_dir), RAW_AVSC).select("seq", "value"),
                       REPLAY_DUP_MOD)
    for ranges in (FAULTY_ORDER[:2], FAULTY_ORDER[2:]):
        fpt = write_replay(frames, f"{base}/replay", order=ranges)
        paths = run_scoring(spark, file_readings(spark, f"{base}/replay", frames.schema, fpt),
                            f"{base}/out", dedup=True, avsc=RAW_AVSC)
    return base, paths


@register("stream_state_alerts", sql(_ARRIVED + """
SELECT patient_id, seq, ts_ms, prev AS previous_tier, news2_tier AS new_tier, news2_score
FROM steps WHERE prev <> news2_tier AND (fault IS NULL OR fault <> 'bad_timestamp')"""))
def stream_state_alerts(spark, sf_dir):
    """Alerts from keyed state across a restart; equals T2 in arrival order."""
    _, paths = _two_runs(spark, sf_dir, "stream_state")
    return finished(spark, paths, "alerts").select(
        "patient_id", "seq", "ts_ms", "previous_tier", "new_tier", "news2_score")


@register("stream_last_tier", sql(_ARRIVED + """
SELECT patient_id, arg_max(news2_tier, (batch, seq)) AS last_tier FROM good GROUP BY patient_id"""))
def stream_last_tier(spark, sf_dir):
    """Each patient's last tier as the stream's state store holds it."""
    base, _ = _two_runs(spark, sf_dir, "stream_tiers")
    return stored_tiers(spark, f"{base}/out")


@register("stream_agg_5min", sql(_stats_sql(300_000).replace(
    "GROUP BY patient_id, window_start_ms",
    "GROUP BY patient_id, window_start_ms "
    "HAVING (ts_ms // 300000) * 300000 + 300000 <= (SELECT max(ts_ms) FROM raw) - 600000")))
def stream_agg_5min(spark, sf_dir):
    """A3: 5-minute windows on the stream with a 10-minute watermark; the
    closed windows equal A1's (open windows are not emitted in append mode)."""
    stream, base, _ = _replayed(spark, sf_dir, "stream_windows")
    path = run_aggregates(spark, stream, f"{base}/out")
    return finish_stats(spark.read.parquet(path))


@register("stream_agg_1hour", sql(_stats_sql(3_600_000).replace(
    "GROUP BY patient_id, window_start_ms",
    "GROUP BY patient_id, window_start_ms "
    "HAVING window_start_ms + 3600000 <= (SELECT max(ts_ms) FROM raw) - 600000")))
def stream_agg_1hour(spark, sf_dir):
    """A3: hours chained on 5-minute windows in one streaming query; closed hours equal A2."""
    stream, base, _ = _replayed(spark, sf_dir, "stream_hours")
    return finish_stats(spark.read.parquet(run_hourly(spark, stream, f"{base}/out")))


DISORDER_MS = 80_000   # readings come up to six times this late


def _disordered(spark, sf_dir, name):
    """Readings that come up to eight minutes after younger ones, within the watermark."""
    base, r = scratch_path(spark, name), raw(spark, sf_dir)
    fpt = write_replay(r, f"{base}/replay", by=F.col("ts_ms") + F.col("seq") % 7 * DISORDER_MS)
    return file_readings(spark, f"{base}/replay", r.schema, fpt), base


_LAST_SEEN_SQL = f"""
, n AS (SELECT patient_id, ts_ms,
          lead(ts_ms) OVER (PARTITION BY patient_id ORDER BY ts_ms, seq) AS next_ms FROM raw)
SELECT patient_id, ts_ms AS silent_since_ms FROM n
WHERE (next_ms IS NULL OR next_ms - ts_ms > {SILENCE_MS})
  AND ts_ms + {SILENCE_MS} < (SELECT max(ts_ms) FROM raw) - 600000"""


@register("stream_silences", sql(_LAST_SEEN_SQL))
def stream_silences(spark, sf_dir):
    """R4 live: one row per silence from event-time timers, of patients that send again
    and of those that never do; equals R4's gaps and the open ones."""
    stream, base = _disordered(spark, sf_dir, "stream_silences")
    return spark.read.parquet(run_silences(spark, stream, f"{base}/out")).select(
        "patient_id", "silent_since_ms")


@register("stream_sessions", sql(f"""
, f AS (
  SELECT patient_id, seq, ts_ms,
    CASE WHEN lag(ts_ms) OVER w IS NULL OR ts_ms - lag(ts_ms) OVER w >= {SILENCE_MS}
         THEN ts_ms END AS st
  FROM raw WINDOW w AS (PARTITION BY patient_id ORDER BY ts_ms, seq)),
g AS (
  SELECT *, max(st) OVER (PARTITION BY patient_id ORDER BY ts_ms, seq ROWS UNBOUNDED PRECEDING)
         AS session_start_ms
  FROM f)
SELECT patient_id, session_start_ms, max(ts_ms) AS session_end_ms, count(*) AS readings
FROM g GROUP BY ALL
HAVING max(ts_ms) + {SILENCE_MS} <= (SELECT max(ts_ms) FROM raw) - 600000"""))
def stream_sessions(spark, sf_dir):
    """R5 on the stream: closed sessions of an out-of-order replay, in which late
    readings bridge sessions, equal the batch form's."""
    stream, base = _disordered(spark, sf_dir, "stream_sessions")
    return spark.read.parquet(run_sessions(spark, stream, f"{base}/out"))


ASOF_PARTS = 4


@register("stream_readings_asof_ward", ORACLE[q_joins.readings_asof_ward.__name__])
def stream_readings_asof_ward(spark, sf_dir):
    """J2 on the stream: the registry grows between the micro-batches, each joins the
    version of its time; equals J3."""
    base, r = scratch_path(spark, "stream_wards"), raw(spark, sf_dir)
    events = admin(spark, sf_dir)
    lo, hi = r.agg(F.min("ts_ms"), F.max("ts_ms")).first()
    step = -(-(hi - lo + 1) // ASOF_PARTS)
    known = None
    for i in range(ASOF_PARTS):
        until = lo + (i + 1) * step
        change = F.col("event_ms") < until if i < ASOF_PARTS - 1 else F.lit(True)
        if known is not None:
            change = change & (F.col("event_ms") >= known)
        append_version(events.filter(change), f"{base}/registry", i)
        fpt = write_replay(r, f"{base}/replay", parts=ASOF_PARTS, order=(i,), by=F.col("ts_ms"))
        out = run_wards(file_readings(spark, f"{base}/replay", r.schema, fpt),
                        f"{base}/registry", f"{base}/out")
        known = until
    return spark.read.parquet(out).filter("event_ms IS NOT NULL").select(
        "patient_id", "seq", "ts_ms", *ASOF_FIELDS)


@register("stream_predictions", sql("""
SELECT seq, patient_id, true AS as_batch, true AS as_stored FROM scored
WHERE news2_tier <> 'High'"""))
def stream_predictions(spark, sf_dir):
    """M5 on the stream: the stored pipeline applied to features from a bounded tail.
    Each prediction equals the batch form's, and the one written out from the stored
    coefficients."""
    base, r = scratch_path(spark, "stream_predict"), raw(spark, sf_dir)
    frame = M.training_frame(with_news2(r)).checkpoint()
    M.fit_model(frame.filter("is_train")).write().save(f"{base}/model")
    fpt = write_replay(r, f"{base}/replay", by=F.col("ts_ms"))
    out = run_predictions(file_readings(spark, f"{base}/replay", r.schema, fpt),
                          f"{base}/model", f"{base}/out")
    model = PipelineModel.load(f"{base}/model")
    batch = M.predict(model, frame).select("seq", "patient_id",
                                           F.col("p_deteriorate").alias("p_batch"))
    near = lambda c: F.abs(F.col("p_deteriorate") - c) < 1e-9
    return (spark.read.parquet(out).join(batch, ["seq", "patient_id"])
            .select("seq", "patient_id", near(F.col("p_batch")).alias("as_batch"),
                    near(probability_from(model)).alias("as_stored")))


_LIVE_COLS = ["seq", "ts_ms", "news2_score", "news2_tier", "respiration_rate",
              "oxygen_saturation", "temperature", "systolic_bp", "heart_rate",
              "consciousness_level"]


@register("stream_live_snapshot", sql(
    "SELECT patient_id, " + ", ".join(f"arg_max({c}, seq) AS {c}" for c in _LIVE_COLS)
    + " FROM scored GROUP BY patient_id"))
def stream_live_snapshot(spark, sf_dir):
    """K7 (stream): live board kept by a streaming update-mode aggregate and
    an upsert log; after the replay it equals the batch snapshot."""
    stream, base, _ = _replayed(spark, sf_dir, "stream_board")
    return read_live_board(spark, run_live_board(spark, stream, f"{base}/out"))


@register("stream_alerts_with_vitals", sql("""
SELECT a.*, s.respiration_rate, s.oxygen_saturation, s.supplemental_o2, s.temperature,
       s.systolic_bp, s.heart_rate, s.consciousness_level
FROM alerts a JOIN scored s ON a.patient_id = s.patient_id AND a.seq = s.seq"""))
def stream_alerts_with_vitals(spark, sf_dir):
    """J1 (stream): the alert topic joined to the scored topic with
    watermarks and an event-time bound; equals the batch J1."""
    stream, base, _ = _replayed(spark, sf_dir, "stream_j1")
    paths = run_scoring(spark, stream, f"{base}/out")
    # Arrival order need not be that of time, but the join drops what comes behind its
    # watermark: its readings are replayed by event time.
    fpt = write_replay(spark.read.schema(stream.schema).parquet(f"{base}/replay"), f"{base}/by_time",
                       by=F.col("ts_ms"), even=True)
    readings = with_news2(file_readings(spark, f"{base}/by_time", stream.schema, fpt))
    alerts = spark.readStream.schema(ALERT).parquet(f"{paths['alerts']}/*/*")
    q = (alerts_with_vitals_stream(alerts, readings).writeStream.format("parquet")
         .option("checkpointLocation", f"{base}/_ck_j1").trigger(availableNow=True)
         .start(f"{base}/j1"))
    q.awaitTermination()
    return spark.read.parquet(f"{base}/j1")
