"""Exact dedup by progressive refinement: length, prefix hash, full hash.

Texts are equal when identical after every run of ASCII white space becomes
one space; null counts as empty.  One scan counts (length, prefix hash) pairs;
a pair seen once settles its row.  Only rows of the surviving pairs have their
full content hashed, and only those hashes are shuffled and grouped.

All of it is DataFrame functions.  The survivors reach the second scan as a
set of at most 2**SLOT_BITS slot numbers, which bounds the broadcast whatever
the input; two pairs in one slot only cause an unneeded full hash.

Defined cases: an empty table gives no rows; null ids take part, the group's
smallest non-null id stays (all null: null stays); rows that repeat an id and
its text are counted in ``group_size`` and share the decision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardpulse.llm.rows import KEY, keep_rows, row_key, shared_table, text_or_empty

SLOT_BITS = 20
PREFIX_CHARS = 256


def normalised(text_col: str) -> Column:
    return F.regexp_replace(text_or_empty(text_col), r"[\x20\x09-\x0D]+", " ")


def _slot() -> Column:
    return F.pmod(F.xxhash64("__len", "__pre"), F.lit(1 << SLOT_BITS))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = PREFIX_CHARS,
                carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept and ``carry``
    (further columns computed from ``docs`` in the same scan; ``__norm`` names
    the normalised text there)."""
    carry = carry or {}
    norm = docs.withColumn("__norm", normalised(text_col)).select(
        F.col(id_col).alias("__id"), "__norm",
        *[c.alias(n) for n, c in carry.items()])
    signed = norm.select(
        "*", F.length("__norm").alias("__len"),
        F.xxhash64(F.substring("__norm", 1, prefix_chars)).alias("__pre"))

    pairs = signed.groupBy("__len", "__pre").agg(F.count(F.lit(1)).alias("__n"))
    slots = pairs.filter("__n > 1").select(_slot().alias("__slot")).distinct()
    hashed = (signed.withColumn("__s", _slot())
              .join(F.broadcast(slots), F.col("__s") == F.col("__slot"), "left")
              .select("__id", "__len", *carry,
                      F.when(F.col("__slot").isNotNull(), F.sha2("__norm", 256))
                      .alias("__full")))
    rows = shared_table(hashed, "exact-dedup")

    alone = rows.filter("__full is null").select(
        F.col("__id").alias(id_col), F.col("__id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), *carry)
    full = rows.filter("__full is not null")
    groups = full.groupBy("__full", "__len").agg(
        F.min("__id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    grouped = full.join(groups, ["__full", "__len"]).select(
        F.col("__id").alias(id_col), "keep_id", "group_size",
        F.col("__id").eqNullSafe(F.col("keep_id")).alias("kept"), *carry)
    return alone.unionByName(grouped)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that stay, all columns; one of each group."""
    marks = exact_dedup(docs, id_col, text_col, carry={KEY: row_key(id_col, text_col)})
    keys = marks.filter("kept").select(F.col(id_col).alias("__id"), KEY)
    return keep_rows(docs, keys, id_col, text_col)
