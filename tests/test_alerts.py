"""Patient state and alert sequences, and the chunked ordered helpers."""

import pandas as pd
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, reading, readings_df
from wardpulse.functions.news2 import with_news2
from wardpulse.operators import alerts as A
from wardpulse.operators.ordered import with_ffill, with_frame, with_neighbour
from wardpulse.sources.fixtures import raw_readings

NORMAL = dict(rr=15, spo2=97, o2=False, temp=37.0, sbp=120, hr=75, c="ALERT")
CRITICAL = dict(rr=26, spo2=90, o2=True, temp=39.5, sbp=85, hr=135, c="VOICE")


def _alerts(spark, rows):
    return A.tier_change_alerts(with_news2(readings_df(spark, rows))).orderBy("seq").collect()


def test_first_reading_no_alert(spark):
    assert _alerts(spark, [reading(seq=0, **NORMAL)]) == []


def test_unchanged_tier_no_alert(spark):
    assert _alerts(spark, [reading(seq=0, **NORMAL), reading(seq=1, **NORMAL)]) == []


def test_change_alerts_with_previous_tier(spark):
    out = _alerts(spark, [reading(seq=0, **NORMAL), reading(seq=1, ts=5000, **CRITICAL)])
    assert [(r.previous_tier, r.new_tier, r.news2_score) for r in out] == [("Low", "High", 19)]


def test_keys_isolated(spark):
    rows = [reading(pid="p1", seq=0, **NORMAL), reading(pid="p2", seq=1, **CRITICAL)]
    assert _alerts(spark, rows) == []
    last = {r.patient_id: r.last_tier
            for r in A.last_tier(with_news2(readings_df(spark, rows))).collect()}
    assert last == {"p1": "Low", "p2": "High"}


def test_improvement_alerts_too(spark):
    rows = [reading(seq=0, **CRITICAL), reading(seq=1, **NORMAL)]
    assert [(r.previous_tier, r.new_tier) for r in _alerts(spark, rows)] == [("High", "Low")]


def test_alert_chain_property_on_fixture(spark):
    a = A.tier_change_alerts(with_news2(raw_readings(spark, SF_SMALL))).toPandas()
    assert len(a) == 195
    for _, g in a.sort_values("seq").groupby("patient_id"):
        assert (g.previous_tier.iloc[1:].values == g.new_tier.iloc[:-1].values).all()


def test_chunk_width_does_not_change_results(spark):
    s = with_news2(raw_readings(spark, SF_SMALL))
    base = A.tier_change_alerts(s)
    for width in (3, 50, 997):
        assert base.exceptAll(A.tier_change_alerts(s, chunk_width=width)).count() == 0
        assert A.tier_change_alerts(s, chunk_width=width).count() == 195


def _brute(pdf, key, order, fn):
    return pdf.sort_values([key] + order).groupby(key, group_keys=False).apply(fn)


def test_neighbour_and_ffill_match_pandas(spark):
    raw = raw_readings(spark, SF_SMALL).select("patient_id", "seq", "ts_ms", "heart_rate")
    pdf = raw.toPandas().sort_values(["patient_id", "seq"])
    exp_prev = pdf.groupby("patient_id")["heart_rate"].shift(1)
    exp_next = pdf.groupby("patient_id")["ts_ms"].shift(-1)
    marked = pdf.assign(v=pdf.seq.where(pdf.heart_rate > 100))
    exp_ff = marked.groupby("patient_id")["v"].ffill()
    for width in (7, 1 << 24):
        got = with_neighbour(raw, "patient_id", ["seq"], ["heart_rate"], chunk_width=width)
        g = got.toPandas().sort_values(["patient_id", "seq"])
        assert g.prev_heart_rate.fillna(-1).tolist() == exp_prev.fillna(-1).tolist()
        nxt = with_neighbour(raw, "patient_id", ["ts_ms", "seq"], ["ts_ms"],
                             direction="next", chunk_width=width * 1000)
        n = nxt.toPandas().sort_values(["patient_id", "seq"])
        assert n.next_ts_ms.fillna(-1).tolist() == exp_next.fillna(-1).tolist()
        ff = with_ffill(raw.withColumn("v", F.when(F.col("heart_rate") > 100, F.col("seq"))),
                        "patient_id", ["seq"], "v", "vf", chunk_width=width)
        f = ff.toPandas().sort_values(["patient_id", "seq"])
        assert f.vf.fillna(-1).tolist() == exp_ff.fillna(-1).tolist()
        mono = with_ffill(raw.withColumn("v", F.when(F.col("heart_rate") > 100, F.col("seq"))),
                          "patient_id", ["seq"], "v", "vf", chunk_width=width, monotone=True)
        m = mono.toPandas().sort_values(["patient_id", "seq"])
        assert m.vf.fillna(-1).tolist() == exp_ff.fillna(-1).tolist()


def test_frame_matches_pandas_rolling(spark):
    raw = raw_readings(spark, SF_SMALL).select("patient_id", "seq", "ts_ms", "heart_rate")
    pdf = raw.toPandas()
    got = with_frame(raw, "patient_id", "ts_ms", -600_000, 0,
                     {"n": lambda w: F.count(F.lit(1)).over(w),
                      "mx": lambda w: F.max("heart_rate").over(w)},
                     bucket_width=900_000).toPandas().set_index("seq").sort_index()
    rows = []
    for _, r in pdf.iterrows():
        win = pdf[(pdf.patient_id == r.patient_id) & (pdf.ts_ms >= r.ts_ms - 600_000)
                  & (pdf.ts_ms <= r.ts_ms)]
        rows.append((r.seq, len(win), win.heart_rate.max()))
    exp = pd.DataFrame(rows, columns=["seq", "n", "mx"]).set_index("seq").sort_index()
    assert got.n.tolist() == exp.n.tolist() and got.mx.tolist() == exp.mx.tolist()


def test_null_vital_reading_does_not_hide_a_change(spark):
    rows = [reading(seq=0, **NORMAL), reading(seq=1, **dict(NORMAL, hr=None)),
            reading(seq=2, **CRITICAL)]
    out = _alerts(spark, rows)
    assert [(r.seq, r.previous_tier, r.new_tier) for r in out] == [(2, "Low", "High")]


def test_null_vital_routed_to_rejects(spark):
    from wardpulse.sources.frames import route
    df = readings_df(spark, [reading(seq=0, **NORMAL), reading(seq=1, **dict(NORMAL, rr=None))])
    decoded = df.withColumn("status", F.lit("ok")).withColumn(
        "decode_error", F.lit(None).cast("string"))
    ok, rejects = route(decoded)
    assert ok.count() == 2
    assert [(r.seq, r.reason) for r in rejects.collect()] == [(1, "null_vital")]


def test_previous_non_null_matches_pandas(spark):
    from wardpulse.operators.ordered import with_previous_non_null
    raw = raw_readings(spark, SF_SMALL).select("patient_id", "seq", "heart_rate")
    holes = raw.withColumn("v", F.when(F.col("seq") % 3 != 0, F.col("heart_rate")))
    pdf = holes.toPandas().sort_values(["patient_id", "seq"])
    exp = pdf.groupby("patient_id")["v"].transform(lambda s: s.ffill().shift(1))
    for width in (2, 11, 1 << 24):
        got = with_previous_non_null(holes, "patient_id", "seq", "v", "pv", chunk_width=width)
        g = got.toPandas().sort_values(["patient_id", "seq"])
        assert g.pv.fillna(-1).tolist() == exp.fillna(-1).tolist()
