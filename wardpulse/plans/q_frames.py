"""Registered queries: framed-Avro codec, split, rejects, audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardpulse.operators.alerts import tier_change_alerts
from wardpulse.plans.oracle import sql
from wardpulse.plans.registry import raw, register, scored
from wardpulse.schemas import ALERT_AVSC, RAW_AVSC, SCORED_AVSC
from wardpulse.sources import frames as FR

_FAULT_CASE = "CASE " + " ".join(
    f"WHEN seq % {m} = {r} THEN '{n}'" for n, m, r in FR.FAULTS) + " END"
_FAULTS_CTE = f"\n, faults AS (SELECT *, {_FAULT_CASE} AS fault FROM raw)\n"

_RAW_OUT = ["seq", "schema_id", "patient_id", "ts_ms", "simulator_state",
            "respiration_rate", "oxygen_saturation", "supplemental_o2", "temperature",
            "systolic_bp", "heart_rate", "consciousness_level"]


def _decoded(spark, sf_dir):
    frames = FR.fixture_frames(raw(spark, sf_dir), RAW_AVSC)
    return FR.decode_frames(frames, RAW_AVSC)


@register("frame_split", sql(_FAULTS_CTE + """
SELECT CASE WHEN fault IN ('empty', 'short') THEN 'short_frame'
            WHEN fault = 'bad_magic' THEN 'bad_magic' ELSE 'ok' END AS split_status,
       CAST(CASE WHEN fault IN ('empty', 'short', 'bad_magic') THEN NULL
                 WHEN fault = 'other_schema_id' THEN 7 ELSE 1 END AS INTEGER) AS schema_id,
       count(*) AS frames
FROM faults GROUP BY ALL"""))
def frame_split(spark, sf_dir):
    """Frame guard (length > 5 and magic 0x00) and header id parse."""
    frames = FR.fixture_frames(raw(spark, sf_dir), RAW_AVSC)
    return FR.split_frames(frames).groupBy("split_status", "schema_id").agg(
        F.count(F.lit(1)).alias("frames"))


@register("decode_frames", sql(_FAULTS_CTE + f"""
SELECT seq, CAST(CASE WHEN fault = 'other_schema_id' THEN 7 ELSE 1 END AS INTEGER) AS schema_id,
  patient_id,
  CASE WHEN fault = 'bad_timestamp' THEN {FR.I64_MAX} ELSE ts_ms END AS ts_ms,
  simulator_state, respiration_rate, oxygen_saturation, supplemental_o2, temperature,
  systolic_bp, heart_rate, consciousness_level
FROM faults WHERE fault IS NULL OR fault IN ('other_schema_id', 'bad_timestamp')"""))
def decode_frames(spark, sf_dir):
    """S3: Avro bodies decoded with the one fixed reader schema (the header
    id is ignored, so id-7 frames decode too); encode->decode = RAW view."""
    d = _decoded(spark, sf_dir)
    return d.filter(F.col("status") == "ok").select(*_RAW_OUT)


@register("reject_counts", sql(_FAULTS_CTE + """
SELECT CASE fault WHEN 'empty' THEN 'short_frame' WHEN 'short' THEN 'short_frame'
                  WHEN 'bad_magic' THEN 'bad_magic' WHEN 'truncated' THEN 'decode_error'
                  WHEN 'bad_timestamp' THEN 'bad_timestamp' END AS reason,
       count(*) AS frames
FROM faults WHERE fault IS NOT NULL AND fault <> 'other_schema_id' GROUP BY ALL"""))
def reject_counts(spark, sf_dir):
    """Rejects routed by reason instead of silently dropped."""
    _, rejects = FR.route(_decoded(spark, sf_dir))
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("frames"))


@register("schema_id_audit", sql(_FAULTS_CTE + """
SELECT CAST(CASE WHEN fault = 'other_schema_id' THEN 7 ELSE 1 END AS INTEGER) AS schema_id,
       count(*) AS frames,
       (CASE WHEN fault = 'other_schema_id' THEN 7 ELSE 1 END) = 1 AS expected
FROM faults WHERE fault IS NULL OR fault NOT IN ('empty', 'short', 'bad_magic')
GROUP BY ALL"""))
def schema_id_audit(spark, sf_dir):
    """Header schema ids seen, flagged against the expected id."""
    return FR.schema_id_audit(
        FR.split_frames(FR.fixture_frames(raw(spark, sf_dir), RAW_AVSC)))


def _vlen(u: str) -> str:
    edges = [1 << (7 * i) for i in range(1, 9)]
    return "CASE " + " ".join(f"WHEN {u} < {e} THEN {i + 1}" for i, e in enumerate(edges)) \
        + " ELSE 9 END"


def _zz(n: str) -> str:
    return f"(CASE WHEN {n} >= 0 THEN 2 * ({n}) ELSE -2 * ({n}) - 1 END)"


def _str_len(s: str) -> str:
    return f"({_vlen('2 * strlen(' + s + ')')} + strlen({s}))"


_RAW_LEN = " + ".join([
    _str_len("patient_id"), _vlen(_zz("ts_ms")), _str_len("simulator_state"),
    _vlen(_zz("respiration_rate")), _vlen(_zz("oxygen_saturation")), "1", "8",
    _vlen(_zz("systolic_bp")), _vlen(_zz("heart_rate")), _str_len("consciousness_level")])


@register("encode_raw_frames", sql(f"""
SELECT seq, CAST(5 + {_RAW_LEN} AS BIGINT) AS frame_len, 0 AS magic, 1 AS schema_id
FROM raw"""))
def encode_raw_frames(spark, sf_dir):
    """K5: RAW -> framed Avro; frame length and header checked against the
    Avro size rules (bytes themselves are checked by unit tests)."""
    enc = FR.encode_frames(raw(spark, sf_dir), RAW_AVSC)
    return enc.select(
        "seq", F.length("value").cast("long").alias("frame_len"),
        F.conv(F.hex(F.substring("value", 1, 1)), 16, 10).cast("int").alias("magic"),
        F.conv(F.hex(F.substring("value", 2, 4)), 16, 10).cast("int").alias("schema_id"))


@register("encode_alert_frames", sql("""
SELECT seq, patient_id, ts_ms, previous_tier, new_tier, news2_score FROM alerts"""))
def encode_alert_frames(spark, sf_dir):
    """K3: alerts framed for the alert topic (key = patient id), shown as the
    round trip through the decoder."""
    alerts = tier_change_alerts(scored(spark, sf_dir))
    enc = FR.encode_frames(alerts, ALERT_AVSC)
    dec = FR.decode_frames(enc, ALERT_AVSC)
    return dec.filter(F.col("status") == "ok").select(
        "seq", "patient_id", "ts_ms", "previous_tier", "new_tier", "news2_score")


@register("encode_scored_frames", sql("""
SELECT seq, patient_id, ts_ms, simulator_state, respiration_rate, oxygen_saturation,
       supplemental_o2, temperature, systolic_bp, heart_rate, consciousness_level,
       news2_score, news2_tier FROM scored"""))
def encode_scored_frames(spark, sf_dir):
    """K4: SCORED records framed for the scored topic (round trip)."""
    s = scored(spark, sf_dir)
    dec = FR.decode_frames(FR.encode_frames(s, SCORED_AVSC), SCORED_AVSC)
    return dec.filter(F.col("status") == "ok").drop(
        "split_status", "schema_id", "decode_error", "status")
