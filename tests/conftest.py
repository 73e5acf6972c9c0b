import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from wardpulse.session import local_session
    s = local_session(cpus=4, shuffle_partitions=4, app="wardpulse-tests")
    yield s
    s.stop()


def reading(pid="p1", ts=0, seq=0, rr=15, spo2=97, o2=False, temp=37.0, sbp=120, hr=75,
            c="ALERT", state="STABLE"):
    return (seq, ts, pid, state, rr, spo2, o2, temp, sbp, hr, c)


READING_SCHEMA = ("seq long, ts_ms long, patient_id string, simulator_state string, "
                  "respiration_rate int, oxygen_saturation int, supplemental_o2 boolean, "
                  "temperature double, systolic_bp int, heart_rate int, "
                  "consciousness_level string")


def readings_df(spark, rows):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, READING_SCHEMA)
    return df.withColumn("timestamp", F.timestamp_millis("ts_ms"))
