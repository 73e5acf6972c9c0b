"""Model scoring on the stream (M5).

Features look back over ten minutes, so a micro-batch needs the readings before it: a
bounded tail of WINDOW_MS, and of ``late_ms`` for readings that come out of order,
is handed from batch to batch in a folder named by the batch id.  Each batch computes
the features of tail and batch with the batch operator, keeps the batch's rows and
applies the stored pipeline.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardpulse.functions.news2 import with_news2
from wardpulse.operators import trajectory as M
from wardpulse.session import delete_path

TAIL = ["seq", "patient_id", "ts_ms", "news2_score", "news2_tier", *M.FEATURE_VITALS]


class PredictSink:
    """``foreachBatch`` sink; the model is read once, where the stream starts."""

    def __init__(self, model: PipelineModel, out_dir: str, late_ms: int):
        self.model, self.late_ms = model, late_ms
        self.out, self.tail = f"{out_dir}/predictions", f"{out_dir}/_tail"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = with_news2(batch).select(*TAIL, F.lit(True).alias("_new"))
        if batch_id:
            earlier = spark.read.schema(rows.drop("_new").schema).parquet(
                f"{self.tail}/batch={batch_id - 1}")
            rows = rows.unionByName(earlier.withColumn("_new", F.lit(False)))
        rows = rows.persist()
        new = rows.filter("_new").select("patient_id", "seq")
        features = M.trajectory_features(rows).join(new, ["patient_id", "seq"], "left_semi")
        scored = M.predict(self.model, M.without_gaps(features.filter("news2_tier != 'High'")))
        scored.select("seq", "patient_id", "ts_ms", *M.FEATURE_COLUMNS, "prediction",
                      "p_deteriorate").write.mode("overwrite").parquet(f"{self.out}/batch={batch_id}")
        newest = rows.agg(F.max("ts_ms")).first()[0]
        kept = rows.filter(F.col("ts_ms") >= (newest or 0) - M.WINDOW_MS - self.late_ms)
        kept.drop("_new").write.mode("overwrite").parquet(f"{self.tail}/batch={batch_id}")
        delete_path(spark, f"{self.tail}/batch={batch_id - 2}")
        rows.unpersist()


def run_predictions(readings: DataFrame, model_path: str, out_dir: str, late_ms: int = 600_000,
                    available_now: bool = True) -> str:
    """M5: predictions for each reading that is not High, with the stored pipeline;
    returns the folder."""
    sink = PredictSink(PipelineModel.load(model_path), out_dir, late_ms)
    w = (readings.writeStream.foreachBatch(sink)
         .option("checkpointLocation", f"{out_dir}/_ck_predictions"))
    q = (w.trigger(availableNow=True) if available_now else w).start()
    if available_now:
        q.awaitTermination()
    return sink.out


def probability_from(model: PipelineModel) -> Column:
    """The model written out as a column over the features: the logistic of the scaled
    sum, from the stored coefficients alone."""
    scaler, fitted = model.stages[1], model.stages[2]
    total = F.lit(float(fitted.intercept))
    for c, w, s in zip(M.FEATURE_COLUMNS, fitted.coefficients.toArray(), scaler.std.toArray()):
        if s:
            total = total + F.col(c).cast("double") * F.lit(float(w) / float(s))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))
