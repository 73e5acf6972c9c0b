"""Band edges of every NEWS2 parameter, golden aggregate rows, NULL rule."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import readings_df, reading
from wardpulse.functions import news2 as N

GRIDS = {
    N.score_rr: ("int", [(0, 3), (8, 3), (9, 1), (11, 1), (12, 0), (20, 0), (21, 2), (24, 2),
                         (25, 3), (40, 3)]),
    N.score_spo2: ("int", [(80, 3), (91, 3), (92, 2), (93, 2), (94, 1), (95, 1), (96, 0),
                           (100, 0)]),
    N.score_o2: ("boolean", [(True, 2), (False, 0)]),
    N.score_temp: ("double", [(32.0, 3), (35.0, 3), (35.1, 1), (36.0, 1), (36.1, 0), (38.0, 0),
                              (38.1, 1), (39.0, 1), (39.1, 2), (41.0, 2), (35.05, 1),
                              (38.05, 1), (float("nan"), 2)]),
    N.score_bp: ("int", [(60, 3), (90, 3), (91, 2), (100, 2), (101, 1), (110, 1), (111, 0),
                         (219, 0), (220, 3), (260, 3)]),
    N.score_hr: ("int", [(20, 3), (40, 3), (41, 1), (50, 1), (51, 0), (90, 0), (91, 1),
                         (110, 1), (111, 2), (130, 2), (131, 3), (180, 3)]),
    N.score_consciousness: ("string", [("ALERT", 0), ("VOICE", 3), ("PAIN", 3),
                                       ("UNRESPONSIVE", 3), ("NEW_CONFUSION", 3),
                                       ("alert", 3), ("", 3), ("UNKNOWN", 3)]),
}


@pytest.mark.parametrize("fn", list(GRIDS), ids=lambda f: f.__name__)
def test_band_grid(spark, fn):
    dtype, grid = GRIDS[fn]
    df = spark.createDataFrame([(v,) for v, _ in grid] + [(None,)], f"v {dtype}")
    got = [r[0] for r in df.select(fn("v")).collect()]
    assert got == [s for _, s in grid] + [None]


GOLDEN = [  # rr, spo2, o2, temp, sbp, hr, consciousness, score, tier
    (15, 98, False, 37.0, 120, 70, "ALERT", 0, "Low"),
    (22, 98, False, 37.0, 95, 100, "ALERT", 5, "Medium"),
    (25, 91, True, 37.0, 120, 70, "ALERT", 8, "High"),
    (25, 98, False, 37.0, 120, 70, "ALERT", 3, "Low"),     # single 3 stays Low
    (22, 98, False, 37.0, 91, 111, "ALERT", 6, "Medium"),
    (15, 97, False, 37.0, 120, 75, "ALERT", 0, "Low"),
    (26, 90, True, 39.5, 85, 135, "VOICE", 19, "High"),
]


def test_golden_rows(spark):
    rows = [reading(seq=i, rr=g[0], spo2=g[1], o2=g[2], temp=g[3], sbp=g[4], hr=g[5], c=g[6])
            for i, g in enumerate(GOLDEN)]
    out = N.with_news2(readings_df(spark, rows)).orderBy("seq").collect()
    assert [(r.news2_score, r.news2_tier) for r in out] == [(g[7], g[8]) for g in GOLDEN]
    assert out[3].any_extreme is True and out[0].any_extreme is False


def test_null_vital_gives_null_score_and_tier(spark):
    df = readings_df(spark, [reading(hr=None), reading(c=None, seq=1)])
    out = N.with_news2(df).orderBy("seq").collect()
    assert all(r.news2_score is None and r.news2_tier is None and r.any_extreme is None
               for r in out)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(70, 100), st.booleans(),
                          st.floats(30, 43, allow_nan=False), st.integers(40, 260),
                          st.integers(20, 200),
                          st.sampled_from(["ALERT", "VOICE", "PAIN", "x"])),
                min_size=1, max_size=20))
def test_score_range_and_tier_monotone(spark, vals):
    rows = [reading(seq=i, rr=v[0], spo2=v[1], o2=v[2], temp=v[3], sbp=v[4], hr=v[5], c=v[6])
            for i, v in enumerate(vals)]
    out = N.with_news2(readings_df(spark, rows)).select("news2_score", "news2_tier").collect()
    rank = {"Low": 0, "Medium": 1, "High": 2}
    for r in out:
        assert 0 <= r.news2_score <= 20
    pairs = sorted((r.news2_score, rank[r.news2_tier]) for r in out)
    assert all(a[1] <= b[1] for a, b in zip(pairs, pairs[1:]))


def test_temp_nan_scores_two(spark):
    df = spark.createDataFrame([(math.nan,)], "t double")
    assert df.select(N.score_temp(F.col("t"))).first()[0] == 2
