"""Record types of the vital-signs pipeline.

RAW is one bedside reading, SCORED adds the NEWS2 total and tier, ALERT is a
tier change, ADMIN is one registry changelog event.  ``seq`` (arrival order;
Kafka partition/offset on a live stream, ``event_id`` in the fixtures) and
``ts_ms`` (event time as epoch milliseconds) ride along with every record.
"""

from __future__ import annotations

import json

from pyspark.sql import types as T

RAW_FIELDS = [
    ("patient_id", T.StringType()),
    ("timestamp", T.TimestampType()),
    ("simulator_state", T.StringType()),
    ("respiration_rate", T.IntegerType()),
    ("oxygen_saturation", T.IntegerType()),
    ("supplemental_o2", T.BooleanType()),
    ("temperature", T.DoubleType()),
    ("systolic_bp", T.IntegerType()),
    ("heart_rate", T.IntegerType()),
    ("consciousness_level", T.StringType()),
]

VITAL_COLUMNS = [
    "respiration_rate", "oxygen_saturation", "supplemental_o2", "temperature",
    "systolic_bp", "heart_rate", "consciousness_level",
]

NUMERIC_VITALS = [
    "respiration_rate", "oxygen_saturation", "temperature", "systolic_bp",
    "heart_rate",
]

RAW = T.StructType(
    [T.StructField("seq", T.LongType(), False),
     T.StructField("ts_ms", T.LongType(), True)]
    + [T.StructField(n, t, True) for n, t in RAW_FIELDS]
)

SCORED = T.StructType(
    RAW.fields
    + [T.StructField("news2_score", T.IntegerType(), True),
       T.StructField("news2_tier", T.StringType(), True)]
)

ALERT = T.StructType([
    T.StructField("patient_id", T.StringType(), False),
    T.StructField("seq", T.LongType(), False),
    T.StructField("ts_ms", T.LongType(), True),
    T.StructField("previous_tier", T.StringType(), False),
    T.StructField("new_tier", T.StringType(), False),
    T.StructField("news2_score", T.IntegerType(), False),
])

ADMIN = T.StructType([
    T.StructField("seq", T.LongType(), False),
    T.StructField("patient_id", T.StringType(), False),
    T.StructField("event_ms", T.LongType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("ward", T.StringType(), True),
    T.StructField("initial_state", T.StringType(), True),
    T.StructField("suspected_infection", T.BooleanType(), True),
    T.StructField("unit", T.StringType(), True),
])

# The three wire schemas (record name, namespace, field order
# and Avro types must match the registered schemas for byte compatibility).
_NS = "com.icu.vitals"
_TS = {"type": "long", "logicalType": "timestamp-millis"}
_RAW_AVRO_FIELDS = [
    {"name": "patient_id", "type": "string"},
    {"name": "timestamp", "type": _TS},
    {"name": "simulator_state", "type": "string"},
    {"name": "respiration_rate", "type": "int"},
    {"name": "oxygen_saturation", "type": "int"},
    {"name": "supplemental_o2", "type": "boolean"},
    {"name": "temperature", "type": "double"},
    {"name": "systolic_bp", "type": "int"},
    {"name": "heart_rate", "type": "int"},
    {"name": "consciousness_level", "type": "string"},
]
RAW_AVSC = json.dumps({"type": "record", "name": "VitalSigns", "namespace": _NS,
                       "fields": _RAW_AVRO_FIELDS})
SCORED_AVSC = json.dumps({
    "type": "record", "name": "ScoredReading", "namespace": _NS,
    "fields": _RAW_AVRO_FIELDS + [{"name": "news2_score", "type": "int"},
                                  {"name": "news2_tier", "type": "string"}]})
ALERT_AVSC = json.dumps({
    "type": "record", "name": "VitalAlert", "namespace": _NS,
    "fields": [{"name": "patient_id", "type": "string"},
               {"name": "timestamp", "type": _TS},
               {"name": "previous_tier", "type": "string"},
               {"name": "new_tier", "type": "string"},
               {"name": "news2_score", "type": "int"}]})

# Topic names.
TOPIC_RAW = "vitals.raw"
TOPIC_SCORED = "vitals.scored"
TOPIC_ALERTS = "vitals.alerts"

TIERS = ["Low", "Medium", "High"]
