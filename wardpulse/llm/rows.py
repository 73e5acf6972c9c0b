"""Row plumbing shared by the operators: keys, joins back, shared tables.

Internal columns start with ``__`` so that a caller's extra columns, whatever
their names, neither clash nor get lost.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardpulse.session import scratch_path

#: Rows in one Arrow batch handed to Python; with texts of up to some hundred
#: kilobytes this keeps a batch far below a worker's memory.
ARROW_ROWS = 1000

KEY = "__key"


def once_per_process(name: str, build: Callable[[], object]) -> object:
    """An object that is costly to build, kept for all tasks of a Python worker.

    Package code is pickled by value, so its own globals last for one task; the
    object is kept on a module of its own."""
    kept = sys.modules.setdefault("_wardpulse_process", types.ModuleType("_wardpulse_process"))
    if not hasattr(kept, name):
        setattr(kept, name, build())
    return getattr(kept, name)


def text_or_empty(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def row_key(id_col: str, text_col: str) -> Column:
    """Hash that addresses a row by id and text (null id or text included), so
    rows that repeat an id with another text get their own decision."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def arrow_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later reads do
    not recompute it, and survive the loss of any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keep_rows(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``docs`` whose (id, key) is in ``keys`` (columns __id, KEY), all
    columns kept.  A semi join, so repeated keys multiply nothing."""
    left = docs.withColumn("__dk", row_key(id_col, text_col))
    cond = (F.col("__dk") == F.col(KEY)) & F.col(f"`{id_col}`").eqNullSafe(F.col("__id"))
    return left.join(keys.select("__id", KEY), cond, "left_semi").drop("__dk")
