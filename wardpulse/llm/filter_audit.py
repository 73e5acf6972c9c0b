"""Filter interaction audit: what five filters remove in every order.

The filters, by letter, fail a text (words are runs of other characters than
``[\\x20\\x09-\\x0D]``, case kept):

* A: fewer than MIN_WORDS words;
* B: distinct words are under DISTINCT_PERCENT of the words;
* C: ``A-Z`` are over UPPER_PERCENT of the code points;
* D: it holds one of SYMBOLS;
* E: a row with a smaller id has the identical text.

A subset of the filters is a number below 32, filter k being bit k.  A document
becomes a 32-bit word: bit S tells whether it survives the subset S.  Carry-save
adders count the words by bit, per part and label, inside tasks; a task passes on
32 counts for each part and label, and all orders, steps and shares follow from
the counts of subset survivors: after the filters of S, ``count[S]`` are left.

Texts are read once, to a narrow row (id, part, failures of A to D, SHA-256).
Only texts that stand in several rows are looked up for E.

Defined cases: null text is empty (fails A alone, unless it repeats); a null part
is the empty string; a row without an id neither fails E nor makes others fail,
and has no labels; rows that repeat an id with one text do not make each other
fail; of several labels of an id any 1 counts; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardpulse.llm.rows import arrow_batches, shared_table, text_or_empty

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT, SYMBOLS = 50, 65, 5, b"#$%&*|"
SUBSETS = 1 << len(FILTERS)
ORDERS = ["".join(p) for p in permutations(FILTERS)]

#: Words of one part and label that are counted at once, and parts with labels
#: that a task holds before it passes on their counts.
HELD_WORDS, HELD_CELLS = 1 << 16, 1 << 12

_UPPER = bytes(range(65, 91))
#: Survival word of each set of failed filters: bit S is set if S has none of them.
_WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not s & failed)
                   for failed in range(SUBSETS)], np.uint32)


def failures(text: str) -> int:
    """Set of the filters A to D that the text fails."""
    raw = text.encode()
    words = raw.split()
    upper = len(raw) - len(raw.translate(None, _UPPER))
    return ((len(words) < MIN_WORDS)
            | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
            | (100 * upper > UPPER_PERCENT * len(text)) << 2
            | (len(raw.translate(None, SYMBOLS)) < len(raw)) << 3)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("__text").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [b.column("__id"), b.column("part"), pa.array(map(failures, texts), pa.int32()),
             pa.array([hashlib.sha256(t.encode()).digest() for t in texts], pa.binary())],
            names=["__id", "part", "failed", "digest"])


def positional_counts(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit ``words`` have each bit set.

    Three words of one weight make one of the same weight (their sum, bit by
    bit, without carries) and one of twice the weight (the carries), until at
    most two of each weight are left to be counted bit by bit."""
    counts, weight = np.zeros(32, np.int64), 1
    while len(words):
        carries = [words[:0]]
        while len(words) > 2:
            third = len(words) // 3
            a, b, c = words[:third], words[third:2 * third], words[2 * third:3 * third]
            odd = a ^ b
            carries.append((a & b) | (odd & c))
            words = np.concatenate([odd ^ c, words[3 * third:]])
        counts += weight * ((words[:, None] >> np.arange(32, dtype=np.uint32)) & 1).sum(
            axis=0, dtype=np.int64)
        words, weight = np.concatenate(carries), 2 * weight
    return counts


def _survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, label, failed) -> (part, label, counts) of the task."""
    counts: dict[tuple[str, int], np.ndarray] = {}
    held: list[pa.RecordBatch] = []

    def count() -> None:
        if not held:
            return
        table = pa.Table.from_batches(held)
        coded = table["part"].combine_chunks().dictionary_encode()
        parts = coded.dictionary.to_pylist()
        cell = coded.indices.to_numpy().astype(np.int64) * 4 + table["label"].to_numpy()
        order = np.argsort(cell, kind="stable")
        words = _WORDS[table["failed"].to_numpy()[order]]
        cells, starts = np.unique(cell[order], return_index=True)
        for c, x in zip(cells.tolist(), np.split(words, starts[1:])):
            key = (parts[c // 4], c % 4)
            counts[key] = counts.get(key, 0) + positional_counts(x)
        held.clear()

    def passed_on() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in counts], pa.string()),
             pa.array([label for _, label in counts], pa.int32()),
             pa.array([x.tolist() for x in counts.values()], pa.list_(pa.int64()))],
            names=["part", "label", "counts"])
        counts.clear()
        return out

    rows = 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= HELD_WORDS:
            count()
            rows = 0
            if len(counts) > HELD_CELLS:
                yield passed_on()
    count()
    if counts:
        yield passed_on()


def survivors(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
              text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per part: ``kept``, ``good``, ``toxic``, each an array of 32 counts
    of the documents (all, of quality 1, toxic) that survive each subset."""
    arrow_batches(docs.sparkSession)
    slim = docs.select(
        F.col(id_col).cast("long").alias("__id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        text_or_empty(text_col).alias("__text"))
    rows = shared_table(slim.mapInArrow(_read, "__id long, part string, failed int, digest binary"),
                        "audit-rows")
    repeated = (rows.groupBy("digest").agg(F.min("__id").alias("first"),
                                           F.count(F.lit(1)).alias("n"))
                .filter("n > 1").select("digest", "first"))
    marks = (labels.select(F.col("doc_id").cast("long").alias("__id"),
                           (F.col("quality") == 1).cast("int").alias("good"),
                           (F.col("toxic") == 1).cast("int").alias("toxic"))
             .filter(F.col("__id").isNotNull())
             .groupBy("__id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
             .withColumn("salt", F.lit(0).cast("long")))
    # Rows without an id match no label; the salt deals them out.
    salt = F.when(F.col("__id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0))
    label = F.coalesce("good", F.lit(0)) + 2 * F.coalesce("toxic", F.lit(0))
    marked = (rows.join(repeated, "digest", "left").withColumn("salt", salt.cast("long"))
              .join(marks, ["__id", "salt"], "left")
              .select("part", label.alias("label"),
                      (F.col("failed") + F.when(F.col("first") < F.col("__id"), 16).otherwise(0))
                      .alias("failed")))
    counts = marked.mapInArrow(_survivors, "part string, label int, counts array<long>")

    def of(bit: int) -> F.Column:
        taken = F.lit(True) if not bit else F.col("label").bitwiseAND(F.lit(bit)) > 0
        return F.array(*[F.coalesce(F.sum(F.when(taken, F.col("counts")[s])), F.lit(0))
                         for s in range(SUBSETS)])

    return counts.groupBy("part").agg(of(0).alias("kept"), of(1).alias("good"),
                                      of(2).alias("toxic"))


def _shares(left: np.ndarray) -> list[int]:
    """Rows that each filter removes, summed over all orders."""
    n, out = len(FILTERS), []
    for k in range(n):
        before = [s for s in range(SUBSETS) if not s >> k & 1]
        out.append(sum(factorial(s.bit_count()) * factorial(n - 1 - s.bit_count())
                       * int(left[s] - left[s | 1 << k]) for s in before))
    return out


_COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
            "good_lost", "toxic_lost", "shapley"]


def part_audit(part: str, left: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> list[tuple]:
    """Rows of one part, for each order and step, from its counts of survivors."""
    shares, full, rows = _shares(left), SUBSETS - 1, []
    for order in ORDERS:
        before = 0
        for step, letter in enumerate(order, 1):
            k = FILTERS.index(letter)
            after = before | 1 << k
            removed = int(left[before] - left[after])
            rows.append((part, order, step, int(left[after]), removed,
                         int(left[0] - left[1 << k]) - removed,
                         int(left[full ^ (1 << k)] - left[full]),
                         int(good[before] - good[after]), int(toxic[before] - toxic[after]),
                         shares[k]))
            before = after
    return rows


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.string(), pa.int32()] + [pa.int64()] * 7
    for b in batches:
        for part, *counts in zip(*(b.column(c).to_pylist() for c in ("part", "kept", "good", "toxic"))):
            rows = part_audit(part, *(np.array(x, np.int64) for x in counts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_COLUMNS)


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per part, order of the filters and step; counts within the part:
    kept, removed, redundant (fail the step's filter, removed earlier),
    unique_fails (fail no other filter), good_lost, toxic_lost, shapley (removed
    by the step's filter, summed over all orders)."""
    schema = "part string, filter_order string, step int, " + ", ".join(
        f"{c} long" for c in _COLUMNS[3:])
    return survivors(docs, labels, id_col, text_col, part_col).mapInArrow(_audits, schema)
