"""Stream-static join with a registry that changes while the stream runs.

The registry is an append-only changelog in folders ``version=N``.  A micro-batch
joins the newest version that is there when it first runs; the choice is kept in a
file named by the batch, so that a replayed batch joins the same version although
newer ones have come.  The join is the as-of join of the batch form: the registry
row in force at each reading's time, chunked by patient and day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardpulse.operators.joins import asof_registry
from wardpulse.schemas import ADMIN
from wardpulse.session import list_names, touch_path

_VERSION = "version="


def append_version(changes: DataFrame, path: str, version: int) -> None:
    """Add one version of changes; its folder appears when it is whole."""
    changes.select(*[f.name for f in ADMIN]).write.mode("overwrite").parquet(
        f"{path}/{_VERSION}{version}")


def newest_version(spark: SparkSession, path: str) -> int:
    """Newest version whose write has ended; -1: none."""
    found = [int(n[len(_VERSION):]) for n in list_names(spark, path) if n.startswith(_VERSION)]
    return max((v for v in found if "_SUCCESS" in list_names(spark, f"{path}/{_VERSION}{v}")),
               default=-1)


class WardSink:
    """``foreachBatch`` sink: readings with the registry row in force at their time."""

    def __init__(self, registry: str, out_dir: str):
        self.registry, self.out = registry, f"{out_dir}/placed"
        self.choices = f"{out_dir}/_versions"

    def version_of(self, spark: SparkSession, batch_id: int) -> int:
        made = [n for n in list_names(spark, self.choices) if n.startswith(f"{batch_id}-")]
        if made:
            return int(made[0].split("-", 1)[1])
        version = newest_version(spark, self.registry)
        touch_path(spark, f"{self.choices}/{batch_id}-{version}")
        return version

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version = self.version_of(spark, batch_id)
        if version < 0:
            changes = spark.createDataFrame([], ADMIN)
        else:
            changes = (spark.read.schema(ADMIN).option("basePath", self.registry)
                       .parquet(*[f"{self.registry}/{_VERSION}{v}" for v in range(version + 1)]))
        batch = batch.persist()
        # Only patients of the batch take part in the ordered pass.
        changes = changes.join(batch.select("patient_id").distinct(), "patient_id", "left_semi")
        placed = asof_registry(batch, changes, keep_unmatched=True)
        (placed.withColumn("registry_version", F.lit(version))
         .write.mode("overwrite").parquet(f"{self.out}/batch={batch_id}"))
        batch.unpersist()


def run_wards(readings: DataFrame, registry: str, out_dir: str, available_now: bool = True) -> str:
    """Write the stream's readings with their wards; returns the folder."""
    sink = WardSink(registry, out_dir)
    w = readings.writeStream.foreachBatch(sink).option("checkpointLocation", f"{out_dir}/_ck_wards")
    q = (w.trigger(availableNow=True) if available_now else w).start()
    if available_now:
        q.awaitTermination()
    return sink.out
