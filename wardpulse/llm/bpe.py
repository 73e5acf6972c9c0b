"""Byte-level BPE encoding and decoding by rank files, with overlapping chunks.

Texts up to CHUNK characters are one piece.  Longer ones are cut into chunks
that reach OVERLAP characters into the next one.  Tasks pre-tokenise all chunks
side by side, each from its own start; a match depends on nothing before its
start, so from the first pre-token end that two neighbours share in their
overlap they agree for good, and the text is stitched there.  The pieces
between stitches are encoded in parallel and their ids joined in order.

A stitch stands between a character that is not white space and one that is, so
the pattern's look-ahead for white space never sees the end of a piece.  A text
with an overlap that shows no such end is encoded as one piece.

Decoding joins the raw bytes of the ids.

Defined cases: null text is empty and gives no ids; rows that repeat an id stay
rows of their own; null ids stay null; an empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F

from wardpulse.llm.rows import (KEY, arrow_batches, once_per_process, row_key,
                                shared_table, text_or_empty)

CHUNK = 32_768
OVERLAP = 1_024


def rank_encoding(path: str, pattern: str) -> tiktoken.Encoding:
    def build() -> tiktoken.Encoding:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks,
                                 special_tokens={})

    return once_per_process(f"ranks {path} {pattern}", build)


@lru_cache(maxsize=4)
def _matcher(pattern: str) -> regex.Pattern:
    """The pattern with Unicode's white space, as the rank encoders read it."""
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}")
                         .replace(r"\S", r"\P{White_Space}"))


def pre_token_ends(part: str, pattern: str, cut: bool) -> list[int]:
    """Ends of matches between a visible character and white space; without the
    last match of a text that was ``cut`` behind it."""
    ends = [m.end() for m in _matcher(pattern).finditer(part)]
    return [e for e in (ends[:-1] if cut else ends)
            if e < len(part) and part[e].isspace() and not part[e - 1].isspace()]


def _chunks(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, text in enumerate(b.column("__text").to_pylist()):
                starts = range(0, len(text), chunk)
                same = pa.array([i] * len(starts))
                yield pa.RecordBatch.from_arrays(
                    [b.column("__id").take(same), b.column(KEY).take(same),
                     b.column("row").take(same), pa.array(range(len(starts)), pa.int32()),
                     pa.array([len(text) > s + chunk for s in starts], pa.bool_()),
                     pa.array([text[s:s + chunk + overlap] for s in starts], pa.string())],
                    names=["__id", KEY, "row", "k", "more", "part"])
    return run


def _overlaps(chunk: int, overlap: int, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            heads, tails = [], []
            for part, more in zip(b.column("part").to_pylist(), b.column("more").to_pylist()):
                ends = pre_token_ends(part, pattern, more)
                heads.append([e for e in ends if e <= overlap])
                tails.append([e - chunk for e in ends if e > chunk])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(heads, pa.list_(pa.int32())),
                 pa.array(tails, pa.list_(pa.int32()))],
                names=[*b.schema.names, "head", "tail"])
    return run


def _encode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = rank_encoding(path, pattern)
        for b in batches:
            ids = [np.asarray(enc.encode_ordinary(t), "<u4").tobytes()
                   for t in b.column("__text").to_pylist()]
            cols = [c for c in b.schema.names if c != "__text"]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in cols), pa.array(ids, pa.binary())], names=[*cols, "ids"])
    return run


def _decode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = rank_encoding(path, pattern)
        for b in batches:
            raw = [enc.decode_bytes(np.frombuffer(x, "<u4").tolist())
                   for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(raw, pa.binary())],
                                             names=[*b.schema.names, "decoded"])
    return run


def _typed(df: DataFrame, drop: tuple[str, ...] = (), **more: str) -> str:
    kinds = [(f.name, f.dataType.simpleString()) for f in df.schema if f.name not in drop]
    return ", ".join(f"`{n}` {t}" for n, t in [*kinds, *more.items()])


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per row of ``docs``: id, KEY, n_tokens, ids (little-endian
    unsigned 32-bit integers, as bytes)."""
    arrow_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).alias("__id"), row_key(id_col, text_col).alias(KEY),
                       text_or_empty(text_col).alias("__text"))

    def encoded(df: DataFrame) -> DataFrame:
        return df.mapInArrow(_encode(path, pattern), _typed(df, ("__text",), ids="binary"))

    small = F.length("__text") <= chunk
    long = slim.filter(~small).withColumn("row", F.monotonically_increasing_id())
    kind = slim.schema["__id"].dataType.simpleString()
    cut = long.mapInArrow(_chunks(chunk, overlap),
                          f"__id {kind}, {KEY} long, row long, k int, more boolean, part string")
    cut = cut.repartition(F.col("row"), F.col("k"))
    cut = shared_table(cut.mapInArrow(_overlaps(chunk, overlap, pattern), _typed(
        cut, head="array<int>", tail="array<int>")), "bpe-chunks")

    near = Window.partitionBy("row").orderBy("k")
    first = F.array_min(F.array_intersect(F.lag("tail").over(near), "head"))
    last = F.array_min(F.array_intersect("tail", F.lead("head").over(near)))
    cuts = cut.select("row", "k", "more", "head", "tail").select(
        "row", "k", "more", F.when(F.col("k") > 0, first).otherwise(0).alias("first"),
        last.alias("last"))
    unstitched = cuts.filter("first is null or (more and last is null)").select("row").distinct()
    cuts = cuts.select("row", "k", "first", "last").join(unstitched, "row", "left_anti")
    parts = cut.select("__id", KEY, "row", "k", "part")
    pieces = parts.join(cuts, ["row", "k"]).select(
        "__id", KEY, "row", "k", F.when(F.col("last").isNull(), F.expr("substring(part, first + 1)"))
        .otherwise(F.expr(f"substring(part, first + 1, {chunk} + last - first)")).alias("__text"))
    stitched = encoded(pieces).groupBy("row", "__id", KEY).agg(
        F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("p")).select("__id", KEY, F.expr(
            "aggregate(p, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"))
    whole = encoded(parts.join(unstitched, "row", "left_semi").groupBy("row", "__id", KEY).agg(
        F.array_sort(F.collect_list(F.struct("k", F.substring("part", 1, chunk).alias("t"))))
        .alias("p")).select("__id", KEY, F.array_join(F.col("p.t"), "").alias("__text")))
    return encoded(slim.filter(small)).unionByName(stitched).unionByName(whole).select(
        F.col("__id").alias(id_col), KEY,
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """``tokens`` with a binary column ``ids`` -> the same and ``decoded`` bytes."""
    return tokens.mapInArrow(_decode(path, pattern), _typed(tokens, decoded="binary"))
