"""Stream = batch: the stateful alert stream over 1 and 4 micro-batches and
across a restart from the checkpoint equals the batch lag form (T2)."""

import tempfile

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from wardpulse.functions.news2 import with_news2
from wardpulse.operators.alerts import tier_change_alerts
from wardpulse.sources.fixtures import raw_readings
from wardpulse.streaming.scoring import file_readings, run_scoring, write_replay

COLS = ["patient_id", "seq", "ts_ms", "previous_tier", "new_tier", "news2_score"]


def _batch(spark):
    return tier_change_alerts(with_news2(raw_readings(spark, SF_SMALL))).select(*COLS)


def test_stream_equals_batch_one_and_four_batches(spark):
    raw = raw_readings(spark, SF_SMALL)
    expected = _batch(spark)
    for parts in (1, 4):
        base = tempfile.mkdtemp(prefix="wp-stream-")
        fpt = write_replay(raw, f"{base}/replay", parts=parts, files_per_part=2)
        paths = run_scoring(spark, file_readings(spark, f"{base}/replay", raw.schema, fpt),
                            f"{base}/out")
        got = spark.read.parquet(paths["alerts"]).select(*COLS)
        assert got.count() == 195
        assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
        lake = spark.read.parquet(paths["lake"])
        assert lake.count() == 1000


def test_state_survives_restart(spark):
    raw = raw_readings(spark, SF_SMALL)
    base = tempfile.mkdtemp(prefix="wp-restart-")
    replay = f"{base}/replay"
    first, second = raw.filter(F.col("seq") < 500), raw.filter(F.col("seq") >= 500)
    first.repartition(2).write.mode("append").parquet(replay)
    run_scoring(spark, file_readings(spark, replay, raw.schema, 2), f"{base}/out")
    second.repartition(2).write.mode("append").parquet(replay)
    paths = run_scoring(spark, file_readings(spark, replay, raw.schema, 2), f"{base}/out")
    got = spark.read.parquet(paths["alerts"]).select(*COLS)
    expected = _batch(spark)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_out_of_order_replay_keeps_windows_consistent(spark):
    """Replay ranges 2 and 3 swapped, so range 2 arrives behind the watermark.
    Append mode never emits a window twice and never with more readings than
    the batch aggregate has (late rows can only be missing), and every
    reading is still scored into the lake."""
    from wardpulse.operators.windows import agg_5min
    from wardpulse.streaming.aggregates import run_aggregates
    raw = raw_readings(spark, SF_SMALL)
    base = tempfile.mkdtemp(prefix="wp-late-")
    replay = f"{base}/replay"
    bounds = [0, 250, 500, 750, 1000]
    for i in (0, 2, 1, 3):
        (raw.filter((F.col("seq") >= bounds[i]) & (F.col("seq") < bounds[i + 1]))
         .repartition(2).write.mode("append").parquet(replay))
    stream = lambda: file_readings(spark, replay, raw.schema, 2)
    windows = spark.read.parquet(run_aggregates(spark, stream(), f"{base}/agg"))
    key = ["patient_id", "window_start_ms"]
    assert windows.count() == windows.select(*key).distinct().count()
    batch = agg_5min(with_news2(raw)).select(*key, F.col("readings").alias("all_rows"))
    joined = windows.join(batch, key, "left")
    assert joined.filter(F.col("all_rows").isNull()).count() == 0
    assert joined.filter(F.col("readings") > F.col("all_rows")).count() == 0
    paths = run_scoring(spark, stream(), f"{base}/out")
    assert spark.read.parquet(paths["lake"]).count() == 1000


def test_session_window_equals_gaps_and_islands(spark):
    from wardpulse.operators.quality import monitoring_sessions, sessions_native
    raw = raw_readings(spark, SF_SMALL)
    a, b = monitoring_sessions(raw), sessions_native(raw)
    assert a.count() == 105
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_alert_stream_dedup_matches_batch(spark):
    """T5: alerts replayed twice through a file stream, de-duplicated within
    the watermark, equal the batch alerts."""
    from wardpulse.schemas import ALERT
    from wardpulse.streaming.scoring import dedup_alert_stream
    alerts = _batch(spark)
    base = tempfile.mkdtemp(prefix="wp-t5-")
    for _ in range(2):
        alerts.repartition(2).write.mode("append").parquet(f"{base}/alerts")
    stream = spark.readStream.schema(ALERT).parquet(f"{base}/alerts")
    q = (dedup_alert_stream(stream).writeStream.format("parquet")
         .option("checkpointLocation", f"{base}/_ck").trigger(availableNow=True)
         .start(f"{base}/out"))
    q.awaitTermination()
    got = spark.read.parquet(f"{base}/out").select(*COLS)
    assert got.count() == 195
    assert got.exceptAll(alerts).count() == 0 and alerts.exceptAll(got).count() == 0


def test_late_range_and_redeliveries(spark):
    """A whole range that comes after later ones is scored, stored and stepped,
    with and without de-duplication; redelivered rows appear once with it."""
    from wardpulse.operators.alerts import redeliver
    raw = raw_readings(spark, SF_SMALL)
    base = tempfile.mkdtemp(prefix="wp-late2-")
    fpt = write_replay(redeliver(raw, 50), f"{base}/replay", files_per_part=2, order=(0, 2, 3, 1))
    for dedup, rows in ((False, 1020), (True, 1000)):
        out = f"{base}/out{dedup}"
        paths = run_scoring(spark, file_readings(spark, f"{base}/replay", raw.schema, fpt), out,
                            dedup=dedup)
        lake = spark.read.parquet(paths["lake"])
        assert lake.count() == rows and lake.select("seq").distinct().count() == 1000
        assert "date" in lake.columns


def test_redelivery_in_a_later_batch(spark):
    raw = raw_readings(spark, SF_SMALL)
    base = tempfile.mkdtemp(prefix="wp-redeliver-")
    for part in (raw.filter("seq < 500"), raw.filter("seq >= 300")):
        part.repartition(2).write.mode("append").parquet(f"{base}/replay")
    paths = run_scoring(spark, file_readings(spark, f"{base}/replay", raw.schema, 2),
                        f"{base}/out", dedup=True)
    got = spark.read.parquet(paths["alerts"]).select(*COLS)
    expected = _batch(spark)
    assert spark.read.parquet(paths["lake"]).count() == 1000
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_bad_timestamp_does_not_stop_the_stream(spark):
    """An i64 maximum time: no table row, a reject with its bytes, and the
    patient's state steps on."""
    from tests.conftest import reading, readings_df
    from wardpulse.schemas import RAW_AVSC
    from wardpulse.sources import frames as FR
    calm, ill = dict(rr=15, hr=75), dict(rr=26, hr=140, sbp=85, c="VOICE")
    rows = [reading(seq=0, **calm), reading(seq=1, **ill), reading(seq=2, **calm)]
    df = readings_df(spark, rows).withColumn(
        "ts_ms", F.when(F.col("seq") == 1, F.lit(FR.I64_MAX)).otherwise(F.col("seq") * 1000))
    frames = FR.encode_frames(df, RAW_AVSC).select("seq", "value")
    base = tempfile.mkdtemp(prefix="wp-badts-")
    frames.repartition(1).write.parquet(f"{base}/frames")
    paths = run_scoring(spark, file_readings(spark, f"{base}/frames", frames.schema, 1),
                        f"{base}/out", avsc=RAW_AVSC)
    assert [r.seq for r in spark.read.parquet(paths["lake"]).orderBy("seq").collect()] == [0, 2]
    rejects = spark.read.parquet(paths["rejects"]).collect()
    value = bytes(frames.filter("seq = 1").first().value)
    assert [(r.seq, r.reason, bytes(r.value)) for r in rejects] == [(1, "bad_timestamp", value)]
    alerts = spark.read.parquet(paths["alerts"]).collect()
    assert [(r.seq, r.previous_tier, r.new_tier) for r in alerts] == [(2, "High", "Low")]
    assert all(r.emitted_at is not None for r in alerts)
    assert spark.read.parquet(paths["alert_frames"]).count() == 2


def test_hourly_is_the_rollup_of_five_minutes(spark):
    from wardpulse.operators.windows import agg_1hour, finish_stats, window_stats
    from wardpulse.sources.fixtures import with_missing_vitals
    s = with_news2(with_missing_vitals(raw_readings(spark, SF_SMALL)))
    direct = finish_stats(window_stats(s, "1 hour").drop("window"))
    rolled = agg_1hour(s)
    assert rolled.exceptAll(direct).count() == 0 and direct.exceptAll(rolled).count() == 0


def test_heart_rate_drift_is_flagged_before_it_scores(spark):
    """75 -> 85 -> 95 -> 108 over three minutes: the slope flags the trend while
    each reading alone scores little."""
    from tests.conftest import reading, readings_df
    from wardpulse.operators.trajectory import TREND_SLOPE, lead_time, trajectory_features
    rows = [reading(seq=i, ts=60_000 * i, hr=hr) for i, hr in enumerate((75, 85, 95, 108))]
    rows.append(reading(seq=4, ts=300_000, hr=140, rr=26, sbp=85, c="VOICE"))
    features = trajectory_features(with_news2(readings_df(spark, rows)))
    by_seq = {r.seq: r for r in features.collect()}
    assert by_seq[3].hr_slope >= TREND_SLOPE and by_seq[3].news2_tier == "Low"
    assert by_seq[3].spo2_mean == 97.0
    lead = lead_time(features).collect()
    assert [(r.first_flag_ms, r.high_ms, r.lead_ms) for r in lead] == [(120_000, 300_000, 180_000)]


def test_runs_do_not_depend_on_chunks(spark):
    from wardpulse.operators.quality import episodes, monitoring_sessions
    raw = raw_readings(spark, SF_SMALL).withColumn("patient_id", F.col("seq").cast("int") % 2)
    whole, gaps = episodes(raw, "simulator_state"), monitoring_sessions(raw, 20_000)
    for width in (1, 2, 7, 100):
        small = episodes(raw, "simulator_state", width)
        assert small.exceptAll(whole).count() == 0 and whole.exceptAll(small).count() == 0
    for width in (1, 5_000, 60_000):
        small = monitoring_sessions(raw, 20_000, width)
        assert small.exceptAll(gaps).count() == 0 and gaps.exceptAll(small).count() == 0


def test_declared_tables():
    """The declared envelopes, transitions and consciousness mix, spelled out."""
    from wardpulse.sources import fixtures as X
    assert all(abs(sum(row) - 1) < 1e-9 for row in X.TRANSITIONS)
    assert all(abs(sum(mix) - 1) < 1e-9 for mix in X.CONSCIOUSNESS_MIX.values())
    assert X.TRANSITIONS[0] == [0.93, 0.02, 0.02, 0.01, 0.01, 0.01]
    assert X.TRANSITIONS[5] == [0.02, 0.15, 0.05, 0.05, 0.03, 0.70]
    high = {r[1]: (r[2] + r[3] - 1, r[11] + r[12] - 1) for r in X.ENVELOPE}
    assert high["STABLE"] == (20, 80) and high["SEPTIC_SHOCK"] == (38, 160)


def test_join_reads_whole_ranges_of_many_files(spark, monkeypatch):
    """Ranges of more files than the least number: the readings of a range still
    come in one micro-batch, so none is late for the join."""
    from wardpulse.plans.q_streaming import stream_alerts_with_vitals
    from wardpulse.streaming import scoring
    monkeypatch.setattr(scoring, "ROWS_PER_FILE", 20)
    got = stream_alerts_with_vitals(spark, SF_SMALL)
    scored = with_news2(raw_readings(spark, SF_SMALL))
    expected = tier_change_alerts(scored).select("patient_id", "seq")
    assert got.count() == 195
    assert expected.exceptAll(got.select("patient_id", "seq")).count() == 0


def test_join_of_readings_whose_times_go_back(spark):
    """Later arrivals of other patients begin again at the first time; the join still finds
    the reading of every alert."""
    from wardpulse.plans.q_streaming import stream_alerts_with_vitals
    base = tempfile.mkdtemp(prefix="wp-back-")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    copies = events.crossJoin(spark.range(3).withColumnRenamed("id", "i"))
    (copies.withColumns({"event_id": F.col("event_id") + 1000 * F.col("i"),
                         "user_id": F.col("user_id") + 10_000 * F.col("i")})
     .drop("i").write.parquet(f"{base}/events.parquet"))
    got = stream_alerts_with_vitals(spark, base).select("patient_id", "seq")
    expected = tier_change_alerts(with_news2(raw_readings(spark, base))).select("patient_id", "seq")
    assert got.count() == expected.count() > 3 * 150
    assert expected.exceptAll(got).count() == 0


def test_even_ranges_hold_as_many_rows(spark):
    """One time far from the others leaves no range without files, so that a trigger reads
    one range; the outlier is in the last."""
    base = tempfile.mkdtemp(prefix="wp-even-")
    rows = spark.range(400).select(F.col("id").alias("seq"), F.when(F.col("id") == 0, 10**9).otherwise(
        F.col("id")).alias("at"))
    assert write_replay(rows, f"{base}/replay", files_per_part=2, by=F.col("at"), even=True) == 2
    files = spark.read.parquet(f"{base}/replay").groupBy(F.input_file_name()).count().collect()
    assert len(files) == 8 and all(40 <= r["count"] <= 60 for r in files)


def test_replay_rows_are_derived_once(spark):
    """Four ranges and their bounds come from one derivation of the rows."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(1000).withColumnRenamed("id", "seq").mapInArrow(count, "seq long")
    base = tempfile.mkdtemp(prefix="wp-once-")
    write_replay(rows, f"{base}/replay", order=(2, 0, 3, 1))
    assert seen.value == 1000
    assert spark.read.parquet(f"{base}/replay").distinct().count() == 1000
