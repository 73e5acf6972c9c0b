"""Avro codec: round trip, golden bytes from the JVM Avro library, framing,
fault routing (short, empty, bad magic, truncated, other id, i64::MAX)."""

import json

from pyspark.sql import functions as F

from tests.avro_rows import AvroDecodeError, decode_body, encode_body, frame
from wardpulse.functions.avro import parse_schema
from wardpulse.schemas import ALERT_AVSC, RAW_AVSC
from wardpulse.sources import frames as FR

ALERT = ["p1", 1_000_000, "Low", "High", 9]
RAW = ["p2", 1_700_000_000_000, "STABLE", 15, 97, False, 37.25, 120, 75, "ALERT"]


def _jvm_bytes(spark, avsc, values):
    jvm = spark._jvm
    schema = jvm.org.apache.avro.Schema.Parser().parse(avsc)
    rec = jvm.org.apache.avro.generic.GenericData.Record(schema)
    for f, v in zip(json.loads(avsc)["fields"], values):
        t = f["type"]
        kind = t["type"] if isinstance(t, dict) else t
        rec.put(f["name"], jvm.java.lang.Long.valueOf(str(v)) if kind == "long" else v)
    out = jvm.java.io.ByteArrayOutputStream()
    enc = jvm.org.apache.avro.io.EncoderFactory.get().binaryEncoder(out, None)
    jvm.org.apache.avro.generic.GenericDatumWriter(schema).write(rec, enc)
    enc.flush()
    return bytes(out.toByteArray())


def test_golden_bytes_match_jvm_avro(spark):
    for avsc, vals in ((ALERT_AVSC, ALERT), (RAW_AVSC, RAW)):
        assert encode_body(parse_schema(avsc), vals) == _jvm_bytes(spark, avsc, vals)


def test_round_trip_and_header():
    fields = parse_schema(ALERT_AVSC)
    body = encode_body(fields, ALERT)
    framed = frame(1, body)
    assert framed[:5] == bytes([0, 0, 0, 0, 1])
    assert decode_body(fields, framed[5:]) == ALERT
    assert frame(0x01020304, b"")[1:5] == bytes([1, 2, 3, 4])   # big-endian id
    raw_fields = parse_schema(RAW_AVSC)
    extreme = RAW[:1] + [(1 << 63) - 1] + RAW[2:]
    assert decode_body(raw_fields, encode_body(raw_fields, extreme)) == extreme


def test_truncated_body_raises():
    fields = parse_schema(ALERT_AVSC)
    body = encode_body(fields, ALERT)
    for cut in range(len(body)):
        try:
            decode_body(fields, body[:cut])
        except AvroDecodeError:
            continue
        raise AssertionError(f"prefix of {cut} bytes decoded")


def test_fault_routing(spark):
    fields = parse_schema(RAW_AVSC)
    good = encode_body(fields, RAW)
    bad_ts = encode_body(fields, RAW[:1] + [(1 << 63) - 1] + RAW[2:])
    rows = [(0, frame(1, good)), (1, b""), (2, frame(1, good)[:5]),
            (3, b"\x01" + frame(1, good)[1:]), (4, frame(1, good)[:-3]),
            (5, frame(7, good)), (6, frame(1, bad_ts))]
    df = spark.createDataFrame(rows, "seq long, value binary")
    dec = FR.decode_frames(df, RAW_AVSC)
    status = {r.seq: (r.status, r.schema_id) for r in dec.collect()}
    assert status == {0: ("ok", 1), 1: ("short_frame", None), 2: ("short_frame", None),
                      3: ("bad_magic", None), 4: ("decode_error", 1), 5: ("ok", 7),
                      6: ("ok", 1)}
    ok, rejects = FR.route(dec)
    assert sorted(r.seq for r in ok.collect()) == [0, 5, 6]
    assert ok.filter(F.col("timestamp").isNull()).first().seq == 6
    reasons = {r.seq: r.reason for r in rejects.collect()}
    assert reasons == {1: "short_frame", 2: "short_frame", 3: "bad_magic",
                       4: "decode_error", 6: "bad_timestamp"}


def test_batch_codec_equals_row_codec():
    """The numpy batch codec gives the row codec's bytes and decisions on
    random records, truncations, garbage, extreme values and nulls."""
    import math
    import random

    import pyarrow as pa

    from wardpulse.functions.avro import _ARROW, decode_batch, encode_batch

    fields = parse_schema(RAW_AVSC)
    rng = random.Random(7)

    def rec():
        return [rng.choice(["p1", "", "pé", "x" * 200]),
                rng.choice([0, 1, -1, 1_700_000_000_000, (1 << 63) - 1, -(1 << 63)]),
                rng.choice(["STABLE", "é"]), rng.randint(-2**31, 2**31 - 1),
                rng.randint(0, 300), rng.random() < .5,
                rng.choice([37.25, -0.0, float("inf"), 1e300, float("nan")]),
                rng.randint(-5, 300), 70, "ALERT"]

    rows = [rec() for _ in range(2000)]
    rows[5][3] = None
    cols = [pa.array([r[i] for r in rows], type=_ARROW[k]) for i, (_, k) in enumerate(fields)]
    ref = [None if any(v is None for v in r) else frame(1, encode_body(fields, r)) for r in rows]
    assert encode_batch(fields, cols, 1).to_pylist() == ref
    bodies = []
    for f in ref:
        if f is None:
            bodies.append(None)
            continue
        b, c = f[5:], rng.random()
        if c < 0.2:
            b = b[:rng.randint(0, len(b))]
        elif c < 0.25:
            b = bytes(rng.getrandbits(8) for _ in range(rng.randint(0, 30)))
        bodies.append(b)
    arrs, errs = decode_batch(fields, pa.array(bodies, pa.binary()))
    for i, b in enumerate(bodies):
        got = [a[i].as_py() for a in arrs]
        if b is None:
            assert all(g is None for g in got) and errs[i].as_py() is None
            continue
        try:
            exp = decode_body(fields, b)
        except AvroDecodeError:
            assert errs[i].as_py() is not None and all(g is None for g in got)
            continue
        assert errs[i].as_py() is None
        for x, y in zip(got, exp):
            assert x == y or (isinstance(x, float) and math.isnan(x) and math.isnan(y))
