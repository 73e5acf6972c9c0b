"""Skew-safe per-key ordered operations.

A plain ``Window.partitionBy(patient_id)`` sends every row of a patient to one
task.  If one patient (or device replaying history) holds a third of all rows,
that task does a third of the job.  The helpers here split each key into
*chunks* of a monotone order column (``seq`` ranges or event-time ranges), run
the window per ``(key, chunk)``, and repair the chunk boundaries with a small
per-chunk summary table:

* ``with_neighbour`` — previous (``lag``) or next (``lead``) row's values;
* ``with_ffill``     — last non-null value at or before each row;
* ``with_frame``     — RANGE-frame aggregates over ``[t+lo, t+hi]`` via a halo:
  rows near a chunk edge are copied into the neighbouring chunk.

The summary table has one row per non-empty ``(key, chunk)``; its own window is
per key but only as long as the number of chunks of that key, which is bounded
by (order range / chunk width).  No key ever lands whole in one task, and the
big side is shuffled once on ``(key, chunk)`` — the boundary join reuses that
partitioning, so only the summary side moves again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ~16M consecutive seq values per chunk; a chunk of one key never exceeds it.
SEQ_CHUNK = 1 << 24
# 1 day of event time per chunk for time-ordered scans.
TIME_CHUNK_MS = 86_400_000

_CK = "_wp_chunk"


def _fixed_width(t: T.DataType) -> bool:
    return isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                          T.DoubleType, T.BooleanType, T.DateType, T.TimestampType))


def _chunk(col: str, width: int) -> Column:
    return F.floor(F.col(col) / F.lit(width)).cast("long")


def _order_cols(order: Sequence[str], descending: bool = False) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order]


def with_previous_non_null(df: DataFrame, key: str | Sequence[str], order: str, col: str,
                           out: str, *, chunk_width: int = SEQ_CHUNK) -> DataFrame:
    """``out`` = last non-null ``col`` strictly before each row of the key.

    Rows whose ``col`` is NULL stay in place but are skipped, so no filter
    has to be pushed under the shuffle (a pushed filter re-evaluates the
    whole derivation of ``col`` at the scan).  Single integral ``order`` and
    fixed-width ``col`` keep the edge table hash-aggregated."""
    keys = [key] if isinstance(key, str) else list(key)
    c = df.withColumn(_CK, _chunk(order, chunk_width))
    w = (Window.partitionBy(*keys, _CK).orderBy(F.col(order))
         .rowsBetween(Window.unboundedPreceding, -1))
    c2 = c.select("*", F.last(col, ignorenulls=True).over(w).alias("_wp_prev"))
    tails = c.groupBy(*keys, _CK).agg(
        F.max_by(col, F.when(F.col(col).isNotNull(), F.col(order))).alias("_wp_tail"))
    wk = (Window.partitionBy(*keys).orderBy(_CK)
          .rowsBetween(Window.unboundedPreceding, -1))
    carry = tails.select(*keys, _CK,
                         F.last("_wp_tail", ignorenulls=True).over(wk).alias("_wp_carry"))
    joined = c2.join(carry, [*keys, _CK], "left")
    return joined.select(*[F.col(x) for x in df.columns],
                         F.coalesce("_wp_prev", "_wp_carry").alias(out))


def with_neighbour(df: DataFrame, key: str | Sequence[str], order: Sequence[str],
                   cols: Sequence[str], *, direction: str = "prev",
                   chunk_width: int = SEQ_CHUNK, prefix: str | None = None
                   ) -> DataFrame:
    """Add ``<prefix><col>`` = value of ``col`` on the previous/next row of the
    same key, ordered by ``order`` (the first order column must be numeric and
    is the chunking column; ties must be broken by the later order columns).
    """
    keys = [key] if isinstance(key, str) else list(key)
    prefix = prefix if prefix is not None else ("prev_" if direction == "prev" else "next_")
    order = list(order)
    packed = F.struct(*[F.col(c).alias(c) for c in cols])
    order_key = F.struct(*[F.col(c) for c in order])
    c = df.withColumn(_CK, _chunk(order[0], chunk_width))
    w = Window.partitionBy(*keys, _CK).orderBy(*_order_cols(order))
    inner = (F.lag if direction == "prev" else F.lead)(packed).over(w)
    c2 = c.select("*", inner.alias("_wp_nb"))
    # Chunk edges by aggregation over the pre-shuffle rows: partial
    # aggregation ships one row per (key, chunk) and map task, not the rows.
    pick = F.max_by if direction == "prev" else F.min_by
    if all(x == order[0] for x in cols):
        # the carried value is the leading order column: the edge is its max/min
        edge_fn = F.max if direction == "prev" else F.min
        edges = c.groupBy(*keys, _CK).agg(*[edge_fn(x).alias(x) for x in cols]).select(
            *keys, _CK, F.struct(*[F.col(x) for x in cols]).alias("_wp_self"))
    elif len(order) == 1 and all(_fixed_width(df.schema[x].dataType) for x in [*cols, *order]):
        # fixed-width buffers: Spark hash-aggregates (no map-side sort)
        edges = c.groupBy(*keys, _CK).agg(
            *[pick(x, order[0]).alias(x) for x in cols]).select(
            *keys, _CK, F.struct(*[F.col(x) for x in cols]).alias("_wp_self"))
    else:
        edges = c.groupBy(*keys, _CK).agg(pick(packed, order_key).alias("_wp_self"))
    wk = Window.partitionBy(*keys).orderBy(_CK)
    carry_fn = F.lag if direction == "prev" else F.lead
    carry = edges.select(*keys, _CK, carry_fn("_wp_self").over(wk).alias("_wp_carry"))
    joined = c2.join(carry, [*keys, _CK], "left")
    nb = F.coalesce(F.col("_wp_nb"), F.col("_wp_carry"))
    return joined.select(
        *[F.col(x) for x in df.columns],
        *[nb[x].alias(prefix + x) for x in cols],
    )


def with_ffill(df: DataFrame, key: str | Sequence[str], order: Sequence[str],
               col: str, out: str, *, chunk_width: int = SEQ_CHUNK,
               monotone: bool = False) -> DataFrame:
    """``out`` = last non-null ``col`` at or before each row of the same key.

    ``monotone=True`` declares ``col`` non-decreasing along ``order`` (e.g.
    run-start markers); the chunk tails are then a plain ``max``, which Spark
    hash-aggregates."""
    keys = [key] if isinstance(key, str) else list(key)
    order = list(order)
    order_key = F.struct(*[F.col(c) for c in order])
    c = df.withColumn(_CK, _chunk(order[0], chunk_width))
    w = (Window.partitionBy(*keys, _CK).orderBy(*_order_cols(order))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    c2 = c.select("*", F.last(col, ignorenulls=True).over(w).alias("_wp_ff"))
    # last non-null value of each chunk (rows with a null value have a null
    # ordering key, which max_by skips); partial aggregation runs map-side, so
    # one row per (key, chunk) and map task crosses the shuffle
    if monotone:
        tails = c.groupBy(*keys, _CK).agg(F.max(col).alias("_wp_ff"))
    else:
        tails = c.groupBy(*keys, _CK).agg(
            F.max_by(col, F.when(F.col(col).isNotNull(), order_key)).alias("_wp_ff"))
    wk = (Window.partitionBy(*keys).orderBy(_CK)
          .rowsBetween(Window.unboundedPreceding, -1))
    carry = tails.select(*keys, _CK,
                         F.last("_wp_ff", ignorenulls=True).over(wk).alias("_wp_carry"))
    joined = c2.join(carry, [*keys, _CK], "left")
    return joined.select(*[F.col(x) for x in df.columns],
                         F.coalesce("_wp_ff", "_wp_carry").alias(out))


def runs(df: DataFrame, key: str, order: Sequence[str], state: Sequence[str],
         same: Callable[[Column, Column], Column], start: str, ts_col: str, *,
         chunk_width: int) -> DataFrame:
    """Gaps and islands in one pass: maximal runs of rows, in ``order``, in which
    each row continues the one before it by ``same(before, row)`` (both structs
    of ``state``).

    Output per run: key, ``run_start`` (``start`` of its first row), ``first``
    (the struct of its first row), first and last ``ts_col`` and the number of
    rows.  The rows are shuffled once, by (key, chunk), and aggregated there to
    partial runs; only those, and one edge row per chunk, move on.  A chunk's
    first run joins the last run before it by a scan of the chunks."""
    packed = F.struct(*[F.col(c) for c in state])
    w = Window.partitionBy(key, _CK).orderBy(*_order_cols(order))
    rows = (df.withColumn(_CK, _chunk(order[0], chunk_width)).withColumn("_wp_s", packed)
            .withColumn("_wp_b", F.lag("_wp_s").over(w)))
    new = F.col("_wp_b").isNull() | ~same(F.col("_wp_b"), F.col("_wp_s"))
    rows = rows.withColumn("_wp_n", F.sum(new.cast("long")).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    at = F.struct(*[F.col(c) for c in order])
    part = rows.groupBy(key, _CK, "_wp_n").agg(
        F.min_by(start, at).alias("_wp_start"), F.min_by("_wp_s", at).alias("first"),
        F.max_by("_wp_s", at).alias("_wp_last"), F.min(ts_col).alias("start_ms"),
        F.max(ts_col).alias("end_ms"), F.count(F.lit(1)).alias("rows"))

    edge = part.groupBy(key, _CK).agg(
        F.min_by("first", "_wp_n").alias("_wp_head"), F.max_by("_wp_last", "_wp_n").alias("_wp_tail"),
        F.max("_wp_n").alias("_wp_runs"), F.min_by("_wp_start", "_wp_n").alias("_wp_first_start"),
        F.max_by("_wp_start", "_wp_n").alias("_wp_last_start"))
    wk = Window.partitionBy(key).orderBy(_CK)
    before = F.lag("_wp_tail").over(wk)
    edge = edge.withColumn("_wp_joins", before.isNotNull() & same(before, F.col("_wp_head")))
    # Start of the run that is open at the end of each chunk, where known from
    # the chunk itself; a chunk that is one joined run passes on the one before.
    opens = F.when(F.col("_wp_runs") > 1, F.col("_wp_last_start")).when(
        ~F.col("_wp_joins"), F.col("_wp_first_start"))
    edge = edge.withColumn("_wp_opens", opens).withColumn(
        "_wp_carry", F.last("_wp_opens", ignorenulls=True).over(
            wk.rowsBetween(Window.unboundedPreceding, -1)))
    edge = edge.select(key, _CK, F.when(F.col("_wp_joins"), F.col("_wp_carry")).alias("_wp_carry"))
    head = F.when(F.col("_wp_n") == 1, F.col("_wp_carry"))
    return (part.join(edge, [key, _CK])
            .groupBy(key, F.coalesce(head, F.col("_wp_start")).alias("run_start")).agg(
                F.min_by("first", F.struct(_CK, "_wp_n")).alias("first"),
                F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"),
                F.sum("rows").alias("rows")))


def with_frame(df: DataFrame, key: str | Sequence[str], ts_col: str,
               lo: int, hi: int, aggs: dict[str, Callable[[Window], Column]],
               *, bucket_width: int = 3_600_000) -> DataFrame:
    """RANGE-frame window aggregates over ``ts_col`` in ``[t+lo, t+hi]`` per key.

    Rows are bucketed by ``floor(ts / bucket_width)``; a row whose frame may
    reach into a neighbouring bucket is also copied there as a halo row, so
    every frame is complete inside its own ``(key, bucket)`` partition.  Halo
    rows count in frames but are dropped from the output.  Needs
    ``-lo <= bucket_width`` and ``hi <= bucket_width``.  The copy factor is
    ``1 + (|lo| + |hi|) / bucket_width``.
    """
    assert -lo <= bucket_width and hi <= bucket_width and lo <= hi
    keys = [key] if isinstance(key, str) else list(key)
    t = F.col(ts_col)
    b = F.floor(t / F.lit(bucket_width)).cast("long")
    start = b * F.lit(bucket_width)
    # a row at t appears in frames of rows at u with u+lo <= t <= u+hi, i.e. u in [t-hi, t-lo]
    targets = F.array(b)
    targets = F.when(t - F.lit(lo) >= start + F.lit(bucket_width),
                     F.array_union(targets, F.array(b + 1))).otherwise(targets)
    targets = F.when(t - F.lit(hi) < start,
                     F.array_union(targets, F.array(b - 1))).otherwise(targets)
    c = df.select("*", b.alias("_wp_home"), F.explode(targets).alias(_CK))
    w = (Window.partitionBy(*keys, _CK).orderBy(t).rangeBetween(lo, hi))
    return (c.select("*", *[fn(w).alias(name) for name, fn in aggs.items()])
            .filter(F.col("_wp_home") == F.col(_CK))
            .drop("_wp_home", _CK))
