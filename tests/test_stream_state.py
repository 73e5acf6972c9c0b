"""Keyed state of the streams: offsets, tiers, silences, registry versions, sketches."""

import tempfile

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, reading, readings_df
from wardpulse.functions.news2 import with_news2
from wardpulse.operators import sketches as SK
from wardpulse.operators.alerts import redeliver, tier_change_alerts
from wardpulse.plans.q_history import DAY0_MS, alerts_with_vitals_layout
from wardpulse.schemas import ADMIN
from wardpulse.sources import history as H
from wardpulse.sources.fixtures import raw_readings
from wardpulse.streaming import state as S
from wardpulse.streaming.aggregates import run_silences
from wardpulse.streaming.registry import WardSink, append_version, newest_version
from wardpulse.streaming.scoring import file_readings, finished, run_scoring, stored_tiers, write_replay


def test_offsets_pack_to_ranges():
    rng = np.random.default_rng(1)
    for share in (0, 0.01, 0.5, 0.99, 1):
        seen = rng.random(S.BLOCK) < share
        assert (S.unpack_offsets(S.pack_offsets(seen)) == seen).all()
    whole = S.pack_offsets(np.ones(S.BLOCK, bool))
    assert len(whole) == 8 and S.pack_offsets(np.zeros(S.BLOCK, bool)) == b""


def test_steps_within_a_block():
    block = pd.DataFrame({"block": 0, "seq": [5, 1, 3, 2, 4, 6], "patient_id": ["a", "a", "b", "a", "a", None],
                          "rank": np.array([2, 0, 1, -1, 1, 0], np.int32), "prev": -1, "last": -1,
                          "edge": False, "payload": "x"})
    got = S.step_block(block).set_index("seq")
    assert got["prev"].tolist() == [-1, -1, -1, 0, 1, -1]       # seq 1..6
    assert got["edge"].tolist() == [True, False, True, False, False, True]
    assert got.loc[1, "last"] == 2 and got.loc[3, "last"] == 1


def _chunks(rows):
    return pd.concat([b.to_pandas() for b in S.pack_blocks(iter(rows.to_batches(max_chunksize=1000)))])


def test_chunks_keep_rows_whole():
    """Missing values beside NaN, longs beyond a double, several blocks in any order."""
    n = 5000
    seq = np.random.default_rng(2).permutation(n) * 10
    rows = pa.table({"seq": seq, "_block": seq // S.BLOCK, "big": pa.array([None, 2**63 - 1] * (n // 2)),
                     "t": pa.array([float("nan"), None, 1.5, -0.0] * (n // 4), from_pandas=False)})
    packed = _chunks(rows)
    assert sorted(packed["key"]) == sorted(set((seq // S.BLOCK).tolist()))
    back = S.from_chunks(packed["rows"]).sort_by("seq")
    assert str(back.to_pylist()) == str(rows.sort_by("seq").to_pylist())
    assert pa.Table.from_batches(S.unpack([pa.RecordBatch.from_pandas(packed[["rows"]])], ["t", "big"])).num_rows == n


def test_readings_reach_the_state_in_chunks():
    """A block of 16,384 readings, some twice, is a few rows to Python: one for each bucket of
    patients and one for the readings whose tier before is known."""
    class Held:
        value = None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    n, patients = S.BLOCK, 900
    seq = np.append(np.arange(n), np.arange(0, n, 50))
    rows = pa.table({"seq": seq, "patient_id": [f"p{i % patients}" for i in seq], "_block": np.zeros(len(seq), int),
                     "_bucket": pa.array(seq % patients % S.BUCKETS, pa.int32()),
                     "_rank": pa.array(seq // 1000 % 3, pa.int32())})
    packed = _chunks(rows)
    assert len(packed) == 1
    arrivals = S.Arrivals(True, 1000)
    arrivals.seen = Held()
    out = pd.concat(arrivals.handleInputRows((0,), iter([packed]), None))
    assert len(out) == S.BUCKETS + 1 and set(out["key"]) == {-1, *range(S.BUCKETS)}
    steps = S.from_chunks(out["rows"]).sort_by("seq")
    assert steps["seq"].to_pylist() == list(range(n))
    assert steps["_prev"].to_pylist() == [-1 if i < patients else (i - patients) // 1000 % 3 for i in range(n)]
    assert list(arrivals.handleInputRows((0,), iter([packed]), None)) == []   # all redelivered


@pytest.mark.parametrize("seed", range(5))
def test_runs_merge_in_any_order(seed):
    rng = np.random.default_rng(seed)
    t = np.sort(rng.integers(0, 5000, 120))
    whole = S.merge_runs(np.stack([t, t], axis=1), 60)
    cuts = np.flatnonzero(np.diff(t) > 60)
    assert whole[:, 1].tolist() == [*t[cuts].tolist(), t[-1]]
    parts, held = np.array_split(rng.permutation(t), 6), np.zeros((0, 2), np.int64)
    for p in parts:
        held = S.merge_runs(np.concatenate([held, S.merge_runs(np.stack([p, p], axis=1), 60)]), 60)
    assert (held == whole).all()


def test_state_costs_what_the_batch_holds(spark):
    """A later batch of one patient updates that patient's state alone, drops what came
    before without reading the lake, and a whole block is one range."""
    raw = raw_readings(spark, SF_SMALL)
    base = tempfile.mkdtemp(prefix="wp-state-")
    raw.repartition(2).write.parquet(f"{base}/replay")
    schema = raw.schema
    run_scoring(spark, file_readings(spark, f"{base}/replay", schema, 2), f"{base}/out", dedup=True)
    one = raw.filter("seq = 7").withColumn("seq", F.lit(5000).cast("long")).withColumn("heart_rate", F.lit(140))
    redeliver(one.unionByName(raw.filter("seq % 9 = 0")), 2).repartition(2).write.mode("append").parquet(
        f"{base}/replay")
    paths = run_scoring(spark, file_readings(spark, f"{base}/replay", schema, 2), f"{base}/out", dedup=True)
    lake = finished(spark, paths, "lake")
    assert lake.count() == 1001 and [r.seq for r in lake.filter("batch = 1").collect()] == [5000]
    patient = one.first().patient_id
    changed = finished(spark, paths, "alerts").filter("batch = 1").collect()
    assert [r.patient_id for r in changed] in ([], [patient])
    everything = raw.unionByName(one)
    tiers = {r.patient_id: r.last_tier for r in stored_tiers(spark, f"{base}/out").collect()}
    last = with_news2(everything).groupBy("patient_id").agg(F.max_by("news2_tier", "seq").alias("t"))
    assert tiers == {r.patient_id: r.t for r in last.collect()}
    expected = tier_change_alerts(with_news2(everything)).select("patient_id", "seq", "new_tier")
    got = finished(spark, paths, "alerts").select("patient_id", "seq", "new_tier")
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_unfinished_batches_are_not_read(spark):
    raw = raw_readings(spark, SF_SMALL)
    base = tempfile.mkdtemp(prefix="wp-finished-")
    raw.repartition(1).write.parquet(f"{base}/replay")
    paths = run_scoring(spark, file_readings(spark, f"{base}/replay", raw.schema, 1), f"{base}/out")
    lake = spark.read.parquet(f"{paths['lake']}/batch=0")
    lake.write.partitionBy("date").parquet(f"{paths['lake']}/batch=1")   # a batch that died half-way
    assert finished(spark, paths, "lake").count() == 1000
    assert spark.read.parquet(paths["lake"]).count() == 2000


def test_silences(spark):
    """A patient that never sends again, one that does, one whose gap a late reading fills."""
    minute, day = 60_000, 20_000 * 86_400_000
    first = [("gone", 0), ("back", 0), ("late", 0), ("late", 8 * minute), ("on", 0)]
    first += [("on", k * minute) for k in range(1, 12)]
    second = [("back", 13 * minute), ("late", 4 * minute)] + [("on", k * minute) for k in range(12, 60)]
    base = tempfile.mkdtemp(prefix="wp-silence-")
    for part in (first, second):
        readings_df(spark, [reading(pid=p, ts=day + t, seq=i) for i, (p, t) in enumerate(part)]).repartition(2).write.mode(
            "append").parquet(f"{base}/replay")
    schema = readings_df(spark, [reading()]).schema
    path = run_silences(spark, file_readings(spark, f"{base}/replay", schema, 2), f"{base}/out")
    got = {(r.patient_id, (r.silent_since_ms - day) // minute) for r in spark.read.parquet(path).collect()}
    assert got == {("gone", 0), ("back", 0), ("back", 13), ("late", 8)}


def test_silences_of_many_patients(spark):
    """Gaps of exactly the limit are none, patients without a name are one, times come
    out of order; readings meet in session windows, so no patient costs a Python call."""
    gap, day = 300_000, 20_000 * 86_400_000
    rng = np.random.default_rng(3)
    names = [None, *(f"p{i}" for i in range(40))]
    rows = [(names[int(p)], int(t) * 60_000) for p, t in
            zip(rng.integers(0, len(names), 600), rng.integers(0, 90, 600))]
    rows += [("equal", 0), ("equal", gap), ("over", 0), ("over", gap + 1), ("end", 130 * 60_000)]
    rows += [("just", 115 * 60_000 - 1), ("open", 115 * 60_000)]   # the watermark: 120 minutes
    rows = [(p, day + t) for p, t in rows]
    base = tempfile.mkdtemp(prefix="wp-silences-")
    readings = readings_df(spark, [reading(pid=p, ts=t, seq=i) for i, (p, t) in enumerate(rows)])
    readings.repartition(3).write.parquet(f"{base}/replay")
    stream = file_readings(spark, f"{base}/replay", readings.schema, 3)
    got = spark.read.parquet(run_silences(spark, stream, f"{base}/out")).collect()
    expected = set()
    for p in {p for p, _ in rows} - {"end", "open"}:
        t = np.array([t for q, t in rows if q == p])
        expected |= {(p, int(z)) for z in S.merge_runs(np.stack([t, t], axis=1), gap)[:, 1]}
    watermark = day + 120 * 60_000
    assert {(r.patient_id, r.silent_since_ms) for r in got} == expected
    assert len(got) == len(expected)
    assert {r.noticed_ms for r in got} == {watermark}
    plan = S.silence_stream(stream, gap, "10 minutes")._jdf.queryExecution().logical().toString()
    assert "session_window" in plan and "MapInArrow" not in plan


def test_replayed_batch_keeps_its_registry_version(spark):
    base = tempfile.mkdtemp(prefix="wp-registry-")

    def change(seq, ward, at):
        return spark.createDataFrame([(seq, "p1", at, "TRANSFER", ward, None, False, "u")], ADMIN)

    assert newest_version(spark, f"{base}/registry") == -1
    sink = WardSink(f"{base}/registry", f"{base}/out")
    rows = readings_df(spark, [reading(pid="p1", ts=100, seq=1)])
    sink(rows, 0)
    append_version(change(1, "W1", 50), f"{base}/registry", 0)
    sink(rows, 1)
    append_version(change(2, "W2", 60), f"{base}/registry", 1)
    sink(rows, 0)
    sink(rows, 1)
    sink(rows, 2)
    got = spark.read.parquet(sink.out).orderBy("batch").collect()
    assert [(r.ward, r.registry_version) for r in got] == [(None, -1), ("W1", 0), ("W2", 1)]


def test_latency_sketch_within_its_error(spark):
    """A group far beyond what a sketch keeps whole, merged from a hundred parts."""
    n = 200_000
    latency = spark.range(n).select(
        F.lit("High").alias("new_tier"), (F.col("id") % 100 * SK.HOUR_MS).alias("ts_ms"),
        (F.col("id") * 7919 % n).alias("latency_ms"))
    merged = SK.with_latency_quantiles(SK.merge_latency(SK.latency_sketches(latency), ["new_tier"])).first()
    assert merged.alerts == n and merged.max_ms == n - 1
    assert abs(merged.p50_ms - 0.5 * n) <= SK.RANK_ERROR * n
    assert abs(merged.p95_ms - 0.95 * n) <= SK.RANK_ERROR * n


def test_patient_sketch_estimates_and_differences(spark):
    n = 60_000
    seen = spark.range(2 * n).select(
        F.concat(F.lit("p"), (F.col("id") % n + F.floor(F.col("id") / n) * n / 4).cast("int")).alias("patient_id"),
        (F.floor(F.col("id") / n) * SK.DAY_MS + F.col("id") % 1440 * 60_000).alias("ts_ms"))
    days = SK.patient_counts(SK.merge_patients(SK.patient_sketches(seen))).orderBy("start_ms").collect()
    assert [r.readings for r in days] == [n, n] and days[0].gone is None
    error = 4 * 2 ** (-SK.PATIENTS_LG / 2)
    assert all(abs(r.patients - n) <= error * n for r in days)
    assert abs(days[1].gone - n / 4) <= 3 * error * n / 4


def test_layout_by_patient(spark):
    """One patient reads one bucket; a join on the patient shuffles neither side."""
    base = tempfile.mkdtemp(prefix="wp-layout-")
    scored = with_news2(raw_readings(spark, SF_SMALL))
    H.write_by_patient(scored, "wp_by_patient", f"{base}/t", 4, spread=2)
    table = spark.table("wp_by_patient")
    patient = scored.first().patient_id
    one = H.patient_history(table, patient, DAY0_MS, DAY0_MS + H.DAY_MS, 5)
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")   # show buckets
    try:
        plan = H.patient_history(table, patient, DAY0_MS, DAY0_MS + H.DAY_MS, 5)._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 4" in plan
    expected = scored.filter(F.col("patient_id") == patient).orderBy(
        F.desc("ts_ms"), F.desc("seq")).limit(5)
    assert [r.seq for r in one.collect()] == [r.seq for r in expected.collect()]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = alerts_with_vitals_layout(spark, SF_SMALL)
        physical = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
    assert "SortMergeJoin" in physical and "Exchange" not in physical
    assert joined.count() == 195
    spark.sql("DROP TABLE wp_by_patient")
