"""Parquet table access with explicit column pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Read one given table; select only ``columns`` so the scan's ReadSchema
    is pruned even before Catalyst sees the downstream projection."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def inline_table(spark: SparkSession, rows, schema: list[tuple[str, str]]) -> DataFrame:
    """A small constant table as an inline ``VALUES`` relation.

    Unlike ``createDataFrame`` on a Python list (an RDD evaluated by Python
    workers on every use), this is a JVM ``LocalRelation``: no Python, no
    extra job, and Catalyst can fold or broadcast it directly.
    """
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    names = ", ".join(n for n, _ in schema)
    casts = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in schema)
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({names})")
