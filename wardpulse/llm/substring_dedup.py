"""Substring dedup: repeated 20-word windows, by FM-indexes of content shards.

A word goes when a window of WIDTH consecutive words that covers it also starts
earlier (smaller id, or same document and smaller start).

An index per slice of the corpus would have to be searched by every document.
Here windows are routed by content instead: a window belongs to the smallest
hash among its GRAM-word grams (its minimizer), so equal windows meet in one
shard, and consecutive windows with one minimizer travel as one segment.

1. One scan counts minimizers.  Those of two segments, or twice in one, may
   hold repeats; they set bits in a filter of 2**FILTER_BITS bits, which is all
   that is broadcast, whatever the input.  A full filter costs traffic only.
2. A second scan cuts the segments that pass.  Equal segments are aggregated
   before the shuffle to one class with its earliest place; all other places of
   a class are repeats as a whole.
3. Classes are dealt by minimizer.  A task takes them shard by shard, indexes a
   shard's words (FM-index over a wavelet matrix), and streams the segments
   through it by backward search; a window whose interval holds an earlier
   place is a repeat.  Minimizers with more than HOT_WORDS words of classes
   would make a shard too large; their classes are cut into single windows,
   aggregated by content, and need no index.
4. Repeats are gathered by document and applied to the words.

Defined cases: null text has no words; null ids come after all others; rows
that repeat an id go by a hash of the text, and rows that repeat id and text
are one place (neither repeats the other); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from wardpulse.llm.fm_index import FMIndex
from wardpulse.llm.rows import KEY, arrow_batches, row_key, shared_table
from wardpulse.llm.words import window_hashes, word_hashes

WIDTH = 20
GRAM = 4
FILTER_BITS = 27
SHARD_WORDS = 1 << 20
HOT_WORDS = 1 << 20
QUERY_WINDOWS = 64
SLOT_BITS = 20
_LAST = (1 << 63) - 1


class Segments:
    """Windows of a batch of texts, grouped into runs of one minimizer."""

    def __init__(self, texts: list[str | None]):
        words = [t.encode().split() if t else [] for t in texts]
        sizes = np.array([len(w) for w in words], np.int64)
        self.ends = np.cumsum(sizes)
        self.words = [w for ws in words for w in ws]
        h = word_hashes(self.words)
        per = WIDTH - GRAM + 1
        n = max(0, len(h) - WIDTH + 1)
        doc = np.repeat(np.arange(len(texts)), sizes)[:n]
        ok = np.arange(n) + WIDTH <= self.ends[doc] if n else np.zeros(0, bool)
        at = np.flatnonzero(ok)
        if not len(at):
            self.start = self.count = self.doc = at
            self.route, self.twice = np.zeros(0, np.uint64), np.zeros(0, bool)
            return
        g = window_hashes(h, GRAM)
        m, size = g, 1
        while size * 2 <= per:
            m = np.minimum(m[:-size], m[size:])
            size *= 2
        m = np.minimum(m[:n], m[per - size:per - size + n])
        hits = sum((g[o:o + n] == m).view(np.int8) for o in range(per))
        new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (m[at[1:]] != m[at[:-1]])])
        first = np.flatnonzero(new)
        self.start, self.route, self.doc = at[first], m[at[first]], doc[at[first]]
        self.count = np.diff(np.append(first, len(at)))
        self.twice = (np.maximum.reduceat(hits[at], first) > 1) | (self.count > per)

    def place(self) -> np.ndarray:
        """Start of each segment in its document."""
        return self.start - np.concatenate([[0], self.ends])[self.doc]


def _routes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        s = Segments(b.column("__text").to_pylist())
        route, inv = np.unique(s.route, return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(route.view(np.int64)),
             pa.array(np.bincount(inv, 1 + s.twice, len(route)).astype(np.int64))],
            names=["route", "n"])


def _cut(passing):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(passing.value, np.uint8)
        for b in batches:
            s = Segments(b.column("__text").to_pylist())
            slot = (s.route & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
            on = np.flatnonzero((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)
            text = [b" ".join(s.words[a:a + n + WIDTH - 1])
                    for a, n in zip(s.start[on].tolist(), s.count[on].tolist())]
            digest = np.fromiter(map(xxhash.xxh3_64_intdigest, text), np.uint64, len(text))
            rows = pa.array(s.doc[on])
            yield pa.RecordBatch.from_arrays(
                [pa.array(s.route[on].view(np.int64)), pa.array(digest.view(np.int64)),
                 b.column("d").take(rows), b.column(KEY).take(rows),
                 pa.array(s.place()[on].astype(np.int32)), pa.array(s.count[on].astype(np.int32)),
                 pa.array(text, pa.binary())],
                names=["route", "digest", "d", KEY, "at", "n", "seg"])
    return run


def repeats_in_shard(segs: list[bytes], d: np.ndarray, key: np.ndarray, at: np.ndarray
                     ) -> tuple[np.ndarray, np.ndarray]:
    """(segment, window) of each window that also starts at an earlier place."""
    ids: dict[bytes, int] = {}
    text, first, count = [], [], []
    for s in segs:
        w = [ids.setdefault(x, len(ids) + 1) for x in s.split()]
        first.append(len(text))
        count.append(len(w) - WIDTH + 1)
        text += w
        text.append(0)
    text = np.array(text, np.int64)
    first, count = np.array(first, np.int64), np.array(count, np.int64)
    index = FMIndex(text, WIDTH)

    docs = np.lexsort((key, d))
    new = np.concatenate([[False], (d[docs[1:]] != d[docs[:-1]]) | (key[docs[1:]] != key[docs[:-1]])])
    ordinal = np.empty(len(segs), np.int64)
    ordinal[docs] = np.cumsum(new)
    seg = np.repeat(np.arange(len(segs)), count + WIDTH)
    place = (ordinal[seg] << 32) + at[seg] + np.arange(len(text)) - first[seg]
    earliest = np.minimum.reduceat(place[index.sa], np.unique(index.full_lo))

    pieces = -(-count // QUERY_WINDOWS)
    owner = np.repeat(np.arange(len(segs)), pieces)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    q_first = first[owner] + k * QUERY_WINDOWS
    q_count = np.minimum(QUERY_WINDOWS, count[owner] - k * QUERY_WINDOWS)
    start, lowest = index.windows(text, q_first, q_count)
    late = start[earliest[index.full_group[lowest]] < place[start]]
    late.sort()
    return seg[late], late - first[seg[late]]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes sorted by route -> repeats (d, KEY, at, n), shard by shard."""
    segs, cols, words, last = [], [[], [], []], 0, None

    def shard() -> pa.RecordBatch:
        d, key, at = (np.array(c, np.int64) for c in cols)
        seg, win = repeats_in_shard(segs, d, key, at)
        new = np.concatenate([[True], (seg[1:] != seg[:-1]) | (win[1:] != win[:-1] + 1)]) \
            if len(seg) else np.zeros(0, bool)
        i = np.flatnonzero(new)
        return pa.RecordBatch.from_arrays(
            [pa.array(d[seg[i]]), pa.array(key[seg[i]]), pa.array((at[seg[i]] + win[i]).astype(np.int32)),
             pa.array(np.diff(np.append(i, len(seg))).astype(np.int32))], names=["d", KEY, "at", "n"])

    for b in batches:
        for route, d, key, at, n, s in zip(*(b.column(c).to_pylist()
                                             for c in ("route", "d", KEY, "at", "n", "seg"))):
            if words >= SHARD_WORDS and route != last:
                yield shard()
                segs, cols, words = [], [[], [], []], 0
            segs.append(s)
            for c, v in zip(cols, (d, key, at)):
                c.append(v)
            words, last = words + n + WIDTH, route
    if segs:
        yield shard()


def _single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for d, key, at, s in zip(*(b.column(c).to_pylist() for c in ("d", KEY, "at", "seg"))):
            w = s.split()
            n = len(w) - WIDTH + 1
            digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(b" ".join(w[i:i + WIDTH]))
                                            for i in range(n)), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.array([d] * n, pa.int64()),
                 pa.array([key] * n, pa.int64()), pa.array(range(at, at + n), pa.int32())],
                names=["s1", "s2", "d", KEY, "at"])


def _later(places: DataFrame, by: list[str]) -> DataFrame:
    """Places that are not the earliest of their content, as (d, KEY, at, n)."""
    here = F.struct("d", KEY, "at")
    first = places.groupBy(*by).agg(F.min(here).alias("first"), F.count(F.lit(1)).alias("m"))
    return (places.join(first.filter("m > 1").drop("m"), by).filter(here > F.col("first"))
            .select("d", KEY, "at", "n"))


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stretches of ``n`` windows from word ``at`` on that repeat earlier ones:
    (d, KEY, at, n), where ``d`` is the id (nulls last) and KEY the row key."""
    spark = docs.sparkSession
    arrow_batches(spark)
    slim = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("d"),
                       row_key(id_col, text_col).alias(KEY),
                       F.col(text_col).cast("string").alias("__text"))
    routes = (slim.select("__text").mapInArrow(_routes, "route long, n long")
              .groupBy("route").agg(F.sum("n").alias("n")).filter("n > 1"))
    slot = F.col("route").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    packed = (routes.select(F.shiftright(slot, 15).alias("block"), (slot % 32768).alias("bit"))
              .groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")))
    filled = bytearray(1 << (FILTER_BITS - 3))
    for block, bits in packed.collect():  # at most 2**FILTER_BITS bits in all
        filled[block * 4096:block * 4096 + len(bits)] = bits
    passing = spark.sparkContext.broadcast(bytes(filled))

    # Route and digest together name a segment's content.
    schema = f"route long, digest long, d long, {KEY} long, at int, n int, seg binary"
    segs = shared_table(slim.mapInArrow(_cut(passing), schema), "segments")
    here = F.struct("d", KEY, "at", "n", "seg")
    classes = shared_table(
        segs.groupBy("route", "digest").agg(F.min(here).alias("r"))
        .select("route", "r.*"), "segment-classes")
    copies = _later(segs.drop("seg"), ["route", "digest"])
    hot = (classes.groupBy("route").agg(F.sum(F.col("n") + WIDTH).alias("w"),
                                        F.count(F.lit(1)).alias("m"))
           .filter((F.col("w") > HOT_WORDS) & (F.col("m") > 1)).select("route"))
    hot = shared_table(hot, "hot-routes")
    out = copies
    if not hot.isEmpty():
        single = classes.join(hot, "route", "left_semi").select("d", KEY, "at", "seg").mapInArrow(
            _single_windows, f"s1 long, s2 long, d long, {KEY} long, at int")
        single = shared_table(single.withColumn("n", F.lit(1)), "single-windows")
        out = out.union(_later(single, ["s1", "s2"]))
        classes = classes.join(hot, "route", "left_anti")
    found = (classes.repartition("route").sortWithinPartitions("route")
             .select("route", "d", KEY, "at", "n", "seg")
             .mapInArrow(_search, f"d long, {KEY} long, at int, n int"))
    return out.union(found)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        total, gone, kept = [], [], []
        for text, cuts in zip(b.column("__text").to_pylist(), b.column("cuts").to_pylist()):
            words = text.encode().split() if text else []
            total.append(len(words))
            if cuts:
                d = np.zeros(len(words) + 1, np.int64)
                at = np.array([c["at"] for c in cuts])
                np.add.at(d, at, 1)
                np.add.at(d, at + np.array([c["n"] for c in cuts]) + WIDTH - 1, -1)
                stay = np.cumsum(d[:-1]) == 0
                words = [w for w, s in zip(words, stay.tolist()) if s]
            gone.append(total[-1] - len(words))
            kept.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays(
            [b.column("__id"), b.column(KEY), pa.array(total, pa.int64()),
             pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
            names=["__id", KEY, "n_words", "n_removed", "kept_text"])


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, KEY, n_words, n_removed, kept_text (the
    words that stay, joined by one space)."""
    cuts = shared_table(
        repeated_windows(docs, id_col, text_col).groupBy("d", KEY)
        .agg(F.collect_set(F.struct("at", "n")).alias("cuts"))
        .select("d", F.col(KEY).alias("__k"), "cuts"), "cuts")
    slim = docs.select(F.col(id_col).alias("__id"), row_key(id_col, text_col).alias(KEY),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("__d"),
                       F.col(text_col).cast("string").alias("__text"))
    # Rows that surely have no cuts need no shuffle; they are told by at most
    # 2**SLOT_BITS slots of the keys that have some.
    slots = cuts.select(F.pmod("__k", F.lit(1 << SLOT_BITS)).alias("__slot")).distinct()
    marked = slim.join(F.broadcast(slots), F.pmod(KEY, F.lit(1 << SLOT_BITS)) == F.col("__slot"),
                       "left")
    whole = marked.filter("__slot is null").withColumn(
        "cuts", F.lit(None).cast(cuts.schema["cuts"].dataType))
    both = marked.filter("__slot is not null").join(
        cuts, (F.col(KEY) == F.col("__k")) & (F.col("__d") == F.col("d")), "left")
    kind = slim.schema["__id"].dataType.simpleString()
    cols = ["__id", KEY, "__text", "cuts"]
    return whole.select(*cols).union(both.select(*cols)).mapInArrow(
        _apply, f"__id {kind}, {KEY} long, n_words long, n_removed long, kept_text string"
    ).withColumnRenamed("__id", id_col)
