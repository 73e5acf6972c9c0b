"""RANGE frames in time linear in the rows, however many rows a frame holds.

Spark's sliding frame recomputes or rescans: its cost is rows × frame rows.  Here
the time axis is cut into blocks as wide as the frame, so that every frame is the
end of one block and the beginning of the next.  A row takes part twice: as itself
in its own block, and as a copy, moved on by the frame's width, in the next block.
A frame that ends at time p holds the rows of p's block up to p and the copies
there whose moved time is behind p.  Both are growing frames, one in ascending and
one in descending time, which Spark computes in one pass each; their partial results
are merged.  Nothing is ever subtracted, so sums of doubles lose nothing and
minima and maxima are as cheap as sums.

One shuffle by (key, block) moves two narrow rows per row (three where a frame does
not end at its own row).  A block of one key that is too large for one task is
cut further by ``splits``: each part then takes what lies before or behind it in the
block from a table of one row per part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BLOCK, _PART, _KIND, _AT = "_wp_block", "_wp_part", "_wp_kind", "_wp_at"
_ROW, _COPY, _READER = 0, 1, 2

_AGG = {"sum": F.sum, "min": F.min, "max": F.max}


def _merge(how: str, a: Column, b: Column) -> Column:
    if how == "sum":
        return F.coalesce(a + b, a, b)
    return (F.least if how == "min" else F.greatest)(a, b)


def with_sliding(df: DataFrame, key: str, ts_col: str, lo: int, hi: int,
                 parts: dict[str, tuple[str, Column]], *, splits: int = 1) -> DataFrame:
    """Add ``name`` = ``how`` (sum, min or max) of a column over the rows of the same
    key with ``ts_col`` in ``[t + lo, t + hi]``, for each ``name: (how, column)``.

    Frames without a non-null value give NULL.  The column may use
    ``time_in_block``: the row's time relative to the frame's block, the same for all
    rows of a frame, which keeps products with time small."""
    assert lo <= hi and splits >= 1
    width = hi - lo + 1
    t = F.col(ts_col).cast("long")

    def at(kind: int, time: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), time.alias("at"))

    events = [at(_ROW, t), at(_COPY, t + F.lit(width))]
    if hi:
        events.append(at(_READER, t + F.lit(hi)))
    step = -(-width // splits)
    rows = df.select("*", F.explode(F.array(*events)).alias("_wp_e")).select(
        *df.columns, F.col("_wp_e.kind").alias(_KIND), F.col("_wp_e.at").alias(_AT))
    start = F.floor(F.col(_AT) / F.lit(width)).cast("long")
    rows = rows.withColumn(_BLOCK, start).withColumn(
        _PART, F.floor((F.col(_AT) - F.col(_BLOCK) * width) / F.lit(step)).cast("int"))
    moved = F.when(F.col(_KIND) == _COPY, F.lit(width)).otherwise(F.lit(0))
    rows = rows.withColumn("time_in_block", F.col(_AT) - moved - F.col(_BLOCK) * width)

    def own(how: str, c: Column, kind: int) -> Column:
        return _AGG[how](F.when(F.col(_KIND) == kind, c))

    place = [key, _BLOCK, _PART] if splits > 1 else [key, _BLOCK]
    up = (Window.partitionBy(*place).orderBy(_AT)
          .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    # Copies at the same moved time have left the frame: they come behind it here.
    down_key = -2 * F.col(_AT) + (F.col(_KIND) == _COPY).cast("long")
    down = (Window.partitionBy(*place).orderBy(down_key)
            .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    out = rows.select(
        "*", *[own(how, c, _ROW).over(up).alias(f"_wp_u_{n}") for n, (how, c) in parts.items()],
        *[own(how, c, _COPY).over(down).alias(f"_wp_d_{n}") for n, (how, c) in parts.items()])
    sides = ["u", "d"]
    if splits > 1:
        edges = rows.groupBy(*place).agg(
            *[own(how, c, _ROW).alias(f"u_{n}") for n, (how, c) in parts.items()],
            *[own(how, c, _COPY).alias(f"d_{n}") for n, (how, c) in parts.items()])
        w = Window.partitionBy(key, _BLOCK)
        before = w.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
        behind = w.orderBy(F.desc(_PART)).rowsBetween(Window.unboundedPreceding, -1)
        carry = edges.select(
            *place, *[_AGG[how](f"u_{n}").over(before).alias(f"_wp_cu_{n}")
                      for n, (how, _) in parts.items()],
            *[_AGG[how](f"d_{n}").over(behind).alias(f"_wp_cd_{n}")
              for n, (how, _) in parts.items()])
        carry = carry.withColumnsRenamed({c: f"_wp_c{c}" for c in place})
        same = [F.col(c).eqNullSafe(F.col(f"_wp_c{c}")) for c in place]   # a NULL key is a key
        out, sides = out.join(carry, same), ["u", "d", "cu", "cd"]
    out = out.filter(F.col(_KIND) == (_READER if hi else _ROW))

    def merged(name: str, how: str) -> Column:
        value = F.col(f"_wp_u_{name}")
        for s in sides[1:]:
            value = _merge(how, value, F.col(f"_wp_{s}_{name}"))
        return value.alias(name)

    return out.select(*[F.col(c) for c in df.columns],
                      *[merged(n, how) for n, (how, _) in parts.items()])


MINUTE_MS = 60_000


def moments(name: str, x: Column, ts: bool = False) -> dict[str, tuple[str, Column]]:
    """Parts from which ``mean_of``, ``std_of`` and, with ``ts``, ``slope_of`` follow.

    Integers are summed as integers, squares of times as doubles, which are exact up to
    2**53 and cannot overflow.  Doubles should come near zero (subtract a typical
    value), so that their squares lose no digits."""
    out = {f"{name}_n": ("sum", x.isNotNull().cast("long")), f"{name}_x": ("sum", x),
           f"{name}_xx": ("sum", x * x)}
    if ts:
        t = F.when(x.isNotNull(), F.col("time_in_block"))
        out |= {f"{name}_t": ("sum", t), f"{name}_tt": ("sum", t.cast("double") * t),
                f"{name}_xt": ("sum", x * t)}
    return out


def _sums(name: str, *kinds: str) -> list[Column]:
    return [F.col(f"{name}_{k}").cast("double") for k in kinds]


def mean_of(name: str, base: float = 0) -> Column:
    x, n = _sums(name, "x", "n")
    mean = F.try_divide(x, n)
    return mean + F.lit(base) if base else mean


def std_of(name: str) -> Column:
    """Sample standard deviation; NULL under two values."""
    n, x, xx = _sums(name, "n", "x", "xx")
    return F.when(n > 1, F.sqrt(F.greatest(n * xx - x * x, F.lit(0.0)) / (n * (n - 1))))


def slope_of(name: str) -> Column:
    """Slope of the least-squares line, per minute; NULL without two times."""
    n, x, t, tt, xt = _sums(name, "n", "x", "t", "tt", "xt")
    spread = n * tt - t * t
    return F.when(spread > 0, (n * xt - x * t) / spread * F.lit(float(MINUTE_MS)))
