"""Ranked lexical search by exact inner products over sparse ball trees.

A term is a run of characters other than ASCII signs, space and control codes;
only A-Z are lower-cased.  With N the documents that hold a term, L all their
terms with repeats, n one document's terms, df the documents that hold a term and
tf its repeats in a document, the parts of a score are integers:

* weight of a term: ``w = floor(1000 * ln((2N + 2) / (2df + 1)))``;
* length of a document: ``m = 25 + 75 * n * N div L``;
* entry of a document: ``x = 10**9 * tf div (1000 * tf + 8 * m)``.

A score is the inner product of an item's vector (``repeats * w``) and the
document's.  Items are searched in blocks of about BLOCK_TERMS pairs of item and
term, so that the block's terms and weights, which tasks get as a broadcast, have
a bound.  For each block the texts are read once, to sparse vectors over the
block's terms; rows without any of them cannot score.

A task cuts its rows into shards of at most SHARD_DOCS rows and SHARD_ENTRIES
entries and builds a ball tree of each: a node holds the centroid c of its
documents' vectors, their radius r and the radius on the axis of each term, r_t,
and splits by the nearer of two far apart ones.  No document of a node scores above
``<q, c> + min(|q| * r, sum of q_t * r_t)``, where q keeps the terms that the node
has.  All are doubles, so the radius and the bound are rounded up by more than the
error of their sums can be (SLACK, relative to the sums of the absolute terms).  An
item walks the nodes best first, scores leaves in 64-bit integers, and ends when no
bound reaches the last of its best documents; what a task found in its earlier
shards counts from the start.  Each task passes on at most ``k`` documents an item.

To make balls tight, entries are scaled by SCALE(w) and queries divided by it, which
leaves inner products as they are.

Equal scores rank by ascending id.  Defined cases: null or termless text is never
found and counts in neither N nor L; rows without an id come last among equals;
rows that repeat an id rank as documents of their own; items that repeat as a whole
(id and text) are one, items that share an id are ranked each by itself; an item
without terms, or an empty table, finds nothing.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from wardpulse.llm.rows import arrow_batches, shared_table, text_or_empty

TOP = 10
BLOCK_TERMS = 1 << 18
SHARD_DOCS, SHARD_ENTRIES = 1 << 13, 1 << 22
LEAF = 32
SLACK = 1e-9

#: Bytes of terms as they are (A-Z lower-cased), all others to a space.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else
                    c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: str) -> list[bytes]:
    return text.encode().translate(_TERM_BYTES).split()


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def length(n: int, docs: int, total: int) -> int:
    return 25 + 75 * n * docs // total


class Query(NamedTuple):
    terms: np.ndarray    # places of its terms in the block
    weights: np.ndarray  # repeats * w, 64-bit integers


class Vectors(NamedTuple):
    """Sparse rows: entries ``starts[i]:starts[i + 1]`` belong to row i."""
    starts: np.ndarray
    terms: np.ndarray
    values: np.ndarray

    def take(self, rows: np.ndarray) -> Vectors:
        sizes = np.diff(self.starts)[rows]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[rows] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))
        return Vectors(np.concatenate([[0], ends]), self.terms[at], self.values[at])

    def dot(self, dense: np.ndarray) -> np.ndarray:
        """Inner product of each row (none is empty) with a dense vector."""
        return np.add.reduceat(self.values * dense[self.terms], self.starts[:-1])


class Node(NamedTuple):
    first: int           # its rows, in the tree's order
    last: int
    low_id: int          # smallest id among its rows
    children: tuple[int, ...]


class BallTree:
    """Ball tree over the rows of ``vectors`` (64-bit integer entries) and their
    ids; ``scale`` is by term."""

    def __init__(self, vectors: Vectors, ids: np.ndarray, scale: np.ndarray, leaf: int = LEAF):
        self.leaf, self.width, self.scale, self.ids = leaf, len(scale), scale, ids
        scaled = Vectors(vectors.starts, vectors.terms, vectors.values * scale[vectors.terms])
        self.nodes: list[Node] = []
        self.centroids: list[tuple[np.ndarray, np.ndarray]] = []
        self.radii: list[float] = []
        order: list[np.ndarray] = []
        self._build(scaled, np.arange(len(vectors.starts) - 1), order, 0)
        rows = np.concatenate(order)
        self.exact, self.ids = vectors.take(rows), ids[rows]
        # Centroids by term, for the bounds of all nodes at once.
        sizes = np.array([len(t) for t, _, _ in self.centroids])
        by_term = np.concatenate([t for t, _, _ in self.centroids])
        turn = np.argsort(by_term, kind="stable")
        self.centre_node = np.repeat(np.arange(len(sizes)), sizes)[turn]
        self.centre_value = np.concatenate([v for _, v, _ in self.centroids])[turn]
        self.axis_radius = np.concatenate([r for _, _, r in self.centroids])[turn]
        self.centre_at = np.searchsorted(by_term[turn], np.arange(self.width + 1))
        self.radius = np.array(self.radii)
        del self.centroids, self.radii

    def _build(self, scaled: Vectors, rows: np.ndarray, order: list[np.ndarray], first: int) -> int:
        """Add the node of ``rows`` (``scaled`` holds them alone), return its place."""
        n = len(rows)
        total = np.bincount(scaled.terms, scaled.values, self.width)
        centre = total / n
        norms = np.add.reduceat(scaled.values ** 2, scaled.starts[:-1])
        centre_norm = float(centre @ centre)
        square = norms - 2 * scaled.dot(centre) + centre_norm
        # The errors of the three sums are below SLACK of their absolute values.
        radius = math.sqrt(max(0.0, float((square + SLACK * (norms + centre_norm)).max())))
        place = len(self.nodes)
        self.nodes.append(Node(first, first + n, int(self.ids[rows].min()), ()))
        used = np.flatnonzero(total)
        # Radius on the axis of each term: entries of rows without the term are 0.
        high, low = np.zeros(self.width), np.full(self.width, np.inf)
        np.maximum.at(high, scaled.terms, scaled.values)
        np.minimum.at(low, scaled.terms, scaled.values)
        low[np.bincount(scaled.terms, minlength=self.width) < n] = 0
        axis = np.maximum(high - centre, centre - low)
        self.centroids.append((used, centre[used], axis[used]))
        self.radii.append(radius * (1 + SLACK))
        near = self._nearer(scaled, square, norms) if n > self.leaf else None
        if near is None:
            order.append(rows)
            return place
        children, at = [], first
        for side in (near, ~near):
            part = np.flatnonzero(side)
            children.append(self._build(scaled.take(part), rows[part], order, at))
            at += len(part)
        self.nodes[place] = self.nodes[place]._replace(children=tuple(children))
        return place

    def _nearer(self, scaled: Vectors, square: np.ndarray, norms: np.ndarray) -> np.ndarray | None:
        """Rows nearer to the one farthest from the centre than to the one farthest
        from that; the nearer half where this cuts off less than an eighth.  None: all
        rows are alike."""
        def from_row(i: int) -> np.ndarray:
            dense = np.zeros(self.width)
            span = slice(scaled.starts[i], scaled.starts[i + 1])
            dense[scaled.terms[span]] = scaled.values[span]
            return norms - 2 * scaled.dot(dense) + norms[i]

        one = from_row(int(square.argmax()))
        far = int(one.argmax())
        if one[far] <= SLACK * norms.max():
            return None
        gap, n = one - from_row(far), len(norms)
        near = gap < 0
        if not n // 8 <= near.sum() <= n - n // 8:
            near = np.zeros(n, bool)
            near[np.argsort(gap, kind="stable")[:n // 2]] = True
        return near

    def bounds(self, query: Query) -> np.ndarray:
        """Upper bound of the scores of each node's rows."""
        q = query.weights / self.scale[query.terms]
        spans = [(self.centre_at[t], self.centre_at[t + 1]) for t in query.terms.tolist()]
        at = np.concatenate([np.arange(a, b) for a, b in spans])
        by = np.repeat(q, [b - a for a, b in spans])
        node, size = self.centre_node[at], len(self.nodes)
        inner = np.bincount(node, self.centre_value[at] * by, size)
        norm = np.sqrt(np.bincount(node, by * by, size))
        axes = np.bincount(node, self.axis_radius[at] * by, size)
        return (inner + np.minimum(norm * self.radius, axes)) * (1 + SLACK)

    def search(self, query: Query, best: list[tuple[int, int]], k: int) -> int:
        """Add to ``best``, a heap of (score, id negated), what ranks among the first
        ``k``; returns the number of rows that were scored."""
        bounds = self.bounds(query)
        dense = np.zeros(self.width, np.int64)
        dense[query.terms] = query.weights
        queue, scored = [(-bounds[0], 0)], 0
        while queue:
            bound, place = heapq.heappop(queue)
            node = self.nodes[place]
            if len(best) == k:
                if -bound < best[0][0]:
                    break
                if math.floor(-bound) == best[0][0] and -node.low_id < best[0][1]:
                    continue
            if node.children:
                for child in node.children:
                    heapq.heappush(queue, (-bounds[child], child))
                continue
            starts = self.exact.starts[node.first:node.last]
            span = slice(starts[0], self.exact.starts[node.last])
            found = np.add.reduceat(self.exact.values[span] * dense[self.exact.terms[span]],
                                    starts - starts[0])
            scored += node.last - node.first
            least = best[0][0] if len(best) == k else 1
            for i in np.flatnonzero(found >= max(least, 1)).tolist():
                entry = (int(found[i]), -int(self.ids[node.first + i]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return scored


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [Counter(terms(t)) for t in b.column("__text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("__item"), b.column("key"),
             pa.array([list(c) for c in found], pa.list_(pa.binary())),
             pa.array([list(c.values()) for c in found], pa.list_(pa.int64()))],
            names=["__item", "key", "terms", "repeats"])


def _vectors(shared):
    """(id, text) -> (id, n, places of the block's terms, tf) by document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value
        for b in batches:
            lengths, places, tfs, ends = [], [], [], [0]
            for text in b.column("__text").to_pylist():
                words = terms(text)
                lengths.append(len(words))
                for term, tf in Counter(words).items():
                    at = place.get(term)
                    if at is not None:
                        places.append(at)
                        tfs.append(tf)
                ends.append(len(places))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("__id"), pa.array(lengths, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(places, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32()))],
                names=["__id", "n", "places", "tfs"])
    return run


def _document_frequencies(width: int):
    """Documents of the task by term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(width, np.int64)
        for b in batches:
            df += np.bincount(b.column("places").flatten().to_numpy(), minlength=width)
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(df[used], pa.int64())],
                                         names=["place", "df"])
    return run


#: Stands for a missing id, behind all others.
NO_ID = (1 << 63) - 1


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in shards of at most SHARD_DOCS rows and about SHARD_ENTRIES entries."""
    held, rows, entries = [], 0, 0
    for b in batches:
        sizes = np.cumsum(np.diff(b.column("places").offsets.to_numpy()))
        done = 0
        while done < b.num_rows:
            before = int(sizes[done - 1]) if done else 0
            fits = int(np.searchsorted(sizes, before + SHARD_ENTRIES - entries, "right")) - done
            take = min(b.num_rows - done, SHARD_DOCS - rows, max(fits, 0 if rows else 1))
            if take:
                held.append(b.slice(done, take))
                rows, entries = rows + take, entries + int(sizes[done + take - 1]) - before
                done += take
            if rows and (take == 0 or rows == SHARD_DOCS or entries >= SHARD_ENTRIES):
                yield pa.Table.from_batches(held)
                held, rows, entries = [], 0, 0
    if rows:
        yield pa.Table.from_batches(held)


def _search(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, scale, docs, total = shared.value
        best: list[list[tuple[int, int]]] = [[] for _ in queries]
        for t in _shards(batches):
            places, tfs = (t[c].combine_chunks() for c in ("places", "tfs"))
            sizes = pc.list_value_length(places).to_numpy().astype(np.int64)
            m = np.array([length(n, docs, total) for n in t["n"].to_pylist()], np.int64)
            tf = tfs.flatten().to_numpy().astype(np.int64)
            vectors = Vectors(np.concatenate([[0], np.cumsum(sizes)]),
                              places.flatten().to_numpy().astype(np.int64),
                              1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, sizes)))
            ids = np.array([NO_ID if d is None else d for d in t["__id"].to_pylist()], np.int64)
            tree = BallTree(vectors, ids, scale)
            for query, found in zip(queries, best):
                if len(query.terms):
                    tree.search(query, found, k)
        rows = [(i, None if d == -NO_ID else -d, score)
                for i, found in enumerate(best) for score, d in found]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in
                 zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64()))],
                names=["query", "doc_id", "score"])
    return run


def _search_block(slim: DataFrame, rows: list, k: int) -> DataFrame:
    """The best documents of the items in ``rows`` (of one block): query (place of
    the item), doc_id, score, at most ``k`` by task and item."""
    spark = slim.sparkSession
    place = {t: i for i, t in enumerate(sorted({bytes(t) for r in rows for t in r.terms}))}
    vectors = shared_table(slim.mapInArrow(
        _vectors(spark.sparkContext.broadcast(place)),
        "__id long, n long, places array<int>, tfs array<int>"), "lexical-vectors")
    docs, total = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = {r.place: r.df for r in
          vectors.select("places").mapInArrow(_document_frequencies(len(place)), "place int, df long")
          .groupBy("place").agg(F.sum("df").alias("df")).collect()}
    w = np.array([weight(docs, df.get(i, 0)) for i in range(len(place))], np.int64)
    queries = []
    for r in rows:
        at = np.array([place[bytes(t)] for t in r.terms], np.int64)
        queries.append(Query(at, np.array(r.repeats, np.int64) * w[at]))
    shared = spark.sparkContext.broadcast((queries, scale_of(w), docs, total))
    return vectors.filter(F.size("places") > 0).mapInArrow(
        _search(shared, k), "query int, doc_id long, score long")


def scale_of(w: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(w, 1.0))


def search_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                     text_col: str = "text", item_col: str = "item_id",
                     item_text_col: str = "text", k: int = TOP,
                     block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``k`` best documents of each item with scores above 0: item id, rank, id
    of the document, score."""
    spark = docs.sparkSession
    arrow_batches(spark)
    slim = docs.select(F.col(id_col).cast("long").alias("__id"),
                       text_or_empty(text_col).alias("__text"))
    asked = items.select(F.col(item_col).alias("__item"), text_or_empty(item_text_col)
                         .alias("__text")).distinct().withColumn("key", F.xxhash64("__item", "__text"))
    schema = T.StructType([asked.schema["__item"], asked.schema["key"],
                           T.StructField("terms", T.ArrayType(T.BinaryType())),
                           T.StructField("repeats", T.ArrayType(T.LongType()))])
    asked = shared_table(asked.mapInArrow(_item_terms, schema), "lexical-items")
    pairs = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks, found = max(1, math.ceil(pairs / block_terms)), []
    for b in range(blocks):
        rows = asked.filter(F.pmod("key", F.lit(blocks)) == b).collect()
        ids = spark.createDataFrame([(i, r[0], r.key) for i, r in enumerate(rows)], T.StructType([
            T.StructField("query", T.IntegerType()), asked.schema["__item"], asked.schema["key"]]))
        best = _search_block(slim, rows, k)
        found.append(best.join(F.broadcast(ids), "query").drop("query"))
        if blocks > 1:
            found[-1] = shared_table(found[-1], "lexical-found")
    hits = found[0]
    for x in found[1:]:
        hits = hits.unionByName(x)
    order = Window.partitionBy("__item", "key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select(F.col("__item").alias(item_col), F.col("rank").cast("int").alias("rank"),
                    F.col("doc_id").alias(id_col), "score"))
