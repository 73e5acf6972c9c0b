"""Linear RANGE frames against pandas, whatever the blocks, splits and gaps."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import reading, readings_df
from wardpulse.functions.news2 import with_news2
from wardpulse.operators.sliding import mean_of, moments, slope_of, std_of, with_sliding
from wardpulse.operators.trajectory import deterioration_label, trajectory_features

SCHEMA = "seq long, patient_id string, ts_ms long, x long, y double"


def rows(n=600, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        patient = "hot" if i % 3 else rng.choice(["a", "b", None])
        out.append((i, patient, rng.choice([rng.randint(-3000, 9000), rng.randint(0, 40) * 100]),
                    None if rng.random() < 0.2 else rng.randint(0, 200),
                    None if rng.random() < 0.2 else 36 + rng.random() * 4))
    return out


def expected(data, lo, hi):
    out = {}
    for seq, p, t, _, _ in data:
        frame = [r for r in data if r[1] == p and t + lo <= r[2] <= t + hi]
        xs = [(r[2], r[3]) for r in frame if r[3] is not None]
        ys = [r[4] for r in frame if r[4] is not None]
        v = np.array([x for _, x in xs], float)
        ts = np.array([u for u, _ in xs], float)
        slope = None
        if len(v) > 1 and np.ptp(ts) > 0:
            slope = float(((ts - ts.mean()) * (v - v.mean())).sum() / ((ts - ts.mean()) ** 2).sum()) * 60_000
        first = min(frame, key=lambda r: (r[2], r[0]), default=None)
        out[seq] = (len(frame) or None, min((x for _, x in xs), default=None), max(ys, default=None),
                    first and first[0], v.mean() if len(v) else None,
                    v.std(ddof=1) if len(v) > 1 else None, slope)
    return out


@pytest.mark.parametrize("lo,hi,splits", [(-600, 0, 1), (-600, 0, 7), (-5000, 0, 3), (1, 500, 1),
                                          (1, 500, 4), (-200, 300, 2), (0, 0, 1), (-100, -50, 1)])
def test_frames(spark, lo, hi, splits):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA)
    parts = {"n": ("sum", F.lit(1).cast("long")), "x_low": ("min", F.col("x")),
             "y_high": ("max", F.col("y")), "first": ("min", F.struct("ts_ms", "seq")),
             **moments("m", F.col("x"), ts=True)}
    got = with_sliding(df, "patient_id", "ts_ms", lo, hi, parts, splits=splits).select(
        "seq", "n", "x_low", "y_high", F.col("first.seq").alias("first"), mean_of("m").alias("mean"),
        std_of("m").alias("std"), slope_of("m").alias("slope")).collect()
    ref = expected(data, lo, hi)
    assert len(got) == len(data)
    for r in got:
        for a, b in zip(r[1:], ref[r.seq]):
            assert (a is None and b is None) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-7), (r, ref[r.seq])


def test_dense_patient_is_linear(spark):
    """A patient-hour with all rows: frames of thousands of rows each."""
    n = 20_000
    df = spark.range(n).select(
        F.col("id").alias("seq"), F.lit("hot").alias("patient_id"),
        (F.col("id") * 25).alias("ts_ms"), (F.col("id") * 7919 % 200).alias("x"))
    parts = {"n": ("sum", F.lit(1).cast("long")), "high": ("max", F.col("x")), **moments("m", F.col("x"))}
    for splits in (1, 60):
        got = with_sliding(df, "patient_id", "ts_ms", -100_000, 0, parts, splits=splits).select(
            "seq", "n", "high", mean_of("m").alias("mean"), std_of("m").alias("std")).toPandas()
        got = got.set_index("seq").sort_index()
        x = pd.Series(np.arange(n) * 7919 % 200)
        w = x.rolling(4001, min_periods=1)
        assert (got["n"] == w.count()).all() and (got["high"] == w.max()).all()
        assert np.allclose(got["mean"], w.mean()) and np.allclose(got["std"][1:], w.std()[1:])


def test_missing_vitals(spark):
    """NULL and NaN are no measurements; a reading without them still counts."""
    data = [reading(seq=0, ts=0, hr=60, temp=37.0), reading(seq=1, ts=60_000, hr=None, temp=float("nan")),
            reading(seq=2, ts=120_000, hr=64, temp=38.0), reading(seq=3, ts=120_000, hr=64, temp=None)]
    f = {r.seq: r for r in trajectory_features(with_news2(readings_df(spark, data))).collect()}
    assert [f[i].n for i in range(4)] == [1, 2, 4, 4]
    assert (f[0].hr_std, f[0].hr_slope, f[1].hr_mean, f[1].temp_mean) == (None, None, 60.0, 37.0)
    assert f[2].temp_slope == 0.5 and f[2].temp_std == 0.7071 and f[2].hr_slope == 2.0
    labels = deterioration_label(with_news2(readings_df(spark, [
        reading(seq=0, ts=0), reading(seq=1, ts=0, hr=140, rr=30, sbp=80),
        reading(seq=2, ts=-600_000), reading(seq=3, ts=-600_001)]))).collect()
    assert {r.seq: r.label for r in labels} == {0: 0, 2: 1, 3: 0}
