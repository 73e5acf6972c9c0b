"""Query registry: name -> (Spark callable, DuckDB oracle SQL or None).

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
given tables.  Every computed column is aliased identically in both forms.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from wardpulse.functions.news2 import with_news2
from wardpulse.session import prepare
from wardpulse.sources.fixtures import (
    REAL_TIME, admin_events, raw_readings, with_hot_patient, with_missing_vitals)

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        assert name not in QUERIES, name
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_readings(spark, sf_dir)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_news2(raw_readings(spark, sf_dir))


def scored_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_news2(with_missing_vitals(raw_readings(spark, sf_dir)))


def raw_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_readings(spark, sf_dir, REAL_TIME)


def scored_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_news2(with_hot_patient(raw_readings(spark, sf_dir)))


def admin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admin_events(spark, sf_dir)


@lru_cache(maxsize=1)
def load_all() -> tuple[dict[str, QueryFn], dict[str, str]]:
    """Import every query module so its ``@register`` calls run."""
    from wardpulse.plans import (  # noqa: F401
        q_scoring, q_alerts, q_windows, q_joins, q_quality, q_frames,
        q_history, q_trajectory, q_streaming, q_seams,
    )
    return QUERIES, ORACLE
