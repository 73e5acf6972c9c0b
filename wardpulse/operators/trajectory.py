"""Trajectory features, deterioration labels and MLlib models (M1–M6).

Features end at the reading's time (trailing RANGE frame), labels start
strictly after it (leading frame), both in time linear in the readings, and
train/test are split by a hash of the patient id, so no patient contributes to
both sides.  ``simulator_state`` is
never a feature; it is ground truth for evaluation only.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardpulse.operators.ordered import SEQ_CHUNK, with_ffill, with_neighbour
from wardpulse.operators.sliding import mean_of, moments, slope_of, std_of, with_sliding
from wardpulse.operators.windows import DOUBLE_PLACES, vital

DAY0_MS = 1704067200000       # origin of the minute axis used for slopes
WINDOW_MS = 600_000           # 10-minute trailing feature window
HORIZON_MS = 600_000          # 10-minute label horizon
FEATURE_VITALS = {"heart_rate": "hr", "respiration_rate": "rr", "oxygen_saturation": "spo2",
                  "systolic_bp": "bp", "temperature": "temp"}
TREND_SLOPE = 2.0             # bpm per minute: heart-rate trend flag (M6)
TREND_MIN_READINGS = 3
TRAIN_BUCKETS = 8             # of 10 hash buckets of patient_id


#: Subtracted from temperatures before squares and products are summed.
TYPICAL_TEMPERATURE = 37.0


def _measured(v: str) -> F.Column:
    """A vital sign as its statistics see it; NaN is no measurement."""
    if v == "temperature":
        return vital(v) - F.lit(TYPICAL_TEMPERATURE)
    return F.col(v).cast("long")


def trajectory_features(scored: DataFrame, width_ms: int = WINDOW_MS, splits: int = 1) -> DataFrame:
    """M1: per reading, over the trailing ``width_ms``: slope (units/min),
    delta from the frame's first reading, mean and std of each vital."""
    cols = ["seq", "patient_id", "ts_ms", "news2_score", "news2_tier", *FEATURE_VITALS]
    parts = {"n": ("sum", F.lit(1).cast("long")),
             "_first": ("min", F.struct("ts_ms", "seq", *FEATURE_VITALS))}
    for v, s in FEATURE_VITALS.items():
        parts |= moments(s, _measured(v), ts=True)
    out = with_sliding(scored.select(*cols), "patient_id", "ts_ms", -width_ms, 0, parts,
                       splits=splits)
    features = []
    for v, s in FEATURE_VITALS.items():
        exact = v != "temperature"
        mean = mean_of(s) if exact else F.round(mean_of(s, TYPICAL_TEMPERATURE), DOUBLE_PLACES)
        features += [mean.alias(f"{s}_mean"), F.round(std_of(s), 4).alias(f"{s}_std"),
                     F.round(slope_of(s), 4).alias(f"{s}_slope")]
    deltas = [(F.col(v) - F.col("_first")[v]).alias(f"{s}_delta") for v, s in FEATURE_VITALS.items()]
    return out.select(*cols, "n", *features, *deltas)


def deterioration_label(scored: DataFrame, horizon_ms: int = HORIZON_MS,
                        splits: int = 1) -> DataFrame:
    """M2: 1 if the patient reaches High within (t, t + horizon], for readings
    not already High (those are left out: nothing left to predict)."""
    high = (F.col("news2_tier") == "High").cast("int")
    out = with_sliding(scored.select("seq", "patient_id", "ts_ms", "news2_tier"), "patient_id",
                       "ts_ms", 1, horizon_ms, {"_future_high": ("max", high)}, splits=splits)
    return (out.filter(F.col("news2_tier") != "High")
            .select("seq", "patient_id", "ts_ms",
                    F.coalesce(F.col("_future_high"), F.lit(0)).alias("label")))


FEATURE_COLUMNS = (["n", "news2_score"]
                   + [f"{s}_{k}" for s in FEATURE_VITALS.values()
                      for k in ("mean", "std", "slope", "delta")])


def patient_bucket(key: str = "patient_id") -> F.Column:
    """0..9 from the md5 of the patient id, the same in any engine."""
    return (F.conv(F.substring(F.md5(F.col(key).cast("binary")), 1, 6), 16, 10)
            .cast("long") % 10)


def without_gaps(features: DataFrame) -> DataFrame:
    """Features as the model takes them: no spread and no slope count as 0."""
    return features.fillna(0.0, subset=[c for c in FEATURE_COLUMNS if c.endswith(("_std", "_slope"))])


def training_frame(scored: DataFrame) -> DataFrame:
    feats = trajectory_features(scored)
    labels = deterioration_label(scored)
    j = feats.join(labels.select("patient_id", "seq", "label"), ["patient_id", "seq"])
    return (without_gaps(j)
            .withColumn("is_train",
                        patient_bucket() < TRAIN_BUCKETS)
            .withColumn("label", F.col("label").cast("double")))


def fit_model(train: DataFrame) -> PipelineModel:
    """M3: standardised logistic regression over the trajectory features."""
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="raw_features",
                        handleInvalid="keep"),
        StandardScaler(inputCol="raw_features", outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol="label", maxIter=50,
                           regParam=0.01),
    ])
    return pipe.fit(train)


def predict(model: PipelineModel, frame: DataFrame) -> DataFrame:
    """M5: batch (or stream) scoring with a fitted pipeline."""
    from pyspark.ml.functions import vector_to_array
    return model.transform(frame).withColumn(
        "p_deteriorate", vector_to_array("probability")[1])


def evaluate(pred: DataFrame) -> DataFrame:
    """M4: area under the full ROC curve (no binning) on the held-out patients
    (one-row DataFrame)."""
    auc = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction",
                                        metricName="areaUnderROC", numBins=0).evaluate(pred)
    stats = pred.agg(F.count(F.lit(1)).alias("test_rows"),
                     F.sum("label").cast("long").alias("test_positives"))
    return stats.withColumn("auc", F.lit(float(auc)))


def state_confusion_of(pred: DataFrame, states: DataFrame) -> DataFrame:
    """M4: predictions against the ground-truth state of each reading."""
    return (pred.join(states.select("patient_id", "seq", "simulator_state"), ["patient_id", "seq"])
            .groupBy("simulator_state", F.col("prediction").cast("int").alias("predicted"))
            .agg(F.count(F.lit(1)).alias("readings")))


def lead_time(features: DataFrame, chunk_width: int = SEQ_CHUNK) -> DataFrame:
    """M6: per High onset, time from the first heart-rate trend flag since the
    patient's previous High reading to the onset, in arrival order.

    ``after_seq`` names that previous High reading (-1: none); onsets without
    a flag before them have no lead time and no row."""
    high = F.col("news2_tier") == "High"
    base = features.select("patient_id", "seq", "ts_ms", "news2_tier", "hr_slope", "n").withColumn(
        "_high_seq", F.when(high, F.col("seq")))
    since = with_ffill(base, "patient_id", ["seq"], "_high_seq", "_after",
                       chunk_width=chunk_width, monotone=True)
    flags = (since.filter(~high & (F.col("hr_slope") >= TREND_SLOPE)
                          & (F.col("n") >= TREND_MIN_READINGS))
             .groupBy("patient_id", F.coalesce("_after", F.lit(-1)).alias("after_seq"))
             .agg(F.min("ts_ms").alias("first_flag_ms")))
    onsets = with_neighbour(base.filter(high).select("patient_id", "seq", "ts_ms"), "patient_id",
                            ["seq"], ["seq"], chunk_width=chunk_width).select(
        "patient_id", F.coalesce("prev_seq", F.lit(-1)).alias("after_seq"),
        F.col("ts_ms").alias("high_ms"))
    return flags.join(onsets, ["patient_id", "after_seq"]).withColumn(
        "lead_ms", F.col("high_ms") - F.col("first_flag_ms"))
