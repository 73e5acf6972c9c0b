"""Near-dedup by chosen-path set similarity join.

A text's set holds its distinct five-word shingles.  Texts with one set are a
class.  Classes are linked when ``100 * |A and B| >= percent * |A or B|``, on
full sets; a component is what links and classes connect.

The join walks random trees (Christiani & Pagh, *Set similarity search beyond
MinHash*; CPSJoin).  A class has COORDS minwise tokens.  A node picks BRANCH
of the coordinates by a hash of its path, and a class goes to the child named
by its token there; so a child holds classes that share the tokens chosen on
its path.  Nodes of one class end; nodes up to NODE_LIMIT classes are leaves;
larger ones branch again, down to DEPTH.  TREES trees are independent.  A pair
at similarity 0.85 survives one tree with probability ``s = 1 - (1 - .85 s)^2``
= 0.97, and is missed by four of them in about one case of a million; at 0.80
it is 0.94 and 15 cases of a million.

Only nodes of over TASK_NODE classes branch by a shuffle.  A smaller one goes whole to a
task, which walks what is below it by the last bytes of the tokens (``walk``): equal
tokens have equal bytes, so no pair is parted there that tokens would keep together.

A node of over CENTRED classes that keeps most of its parent's is not parted by such
coordinates: its classes share most tokens, as copies of one text do, but also
unlike pages of one template.  Its centre is the token that over half of SAMPLES
classes have at each coordinate.  What two classes have in common beyond the centre
tells copies from pages.  A class goes on to the children named by the RARE
lowest-hashed of its tokens beside the centre's, and by one of those that a quarter of
the node or more has, if it has any.  Two linked classes that share none of those are both
near the centre, ``beside(x) + beside(y)`` being no more than the tokens in which links
may differ; so only classes up to half of that (``low``) are compared with all up to the
whole, and a node of low ones alone, such as copies of one text, ends there.  Unlike pages
of a template drop out of both unless they are alike in two of three shingles anyway.

Leaves and centres are compared exhaustively, in steps that keep what is passed on
linear in a group of mutual copies: every class meets two pivots, then those outside the
largest component meet the others.  In a task this is done by the agreement of tokens, and
the task passes on the components of the pairs that come within four standard deviations
of ``percent`` (all trees share the tokens, so a link at exactly 0.85 is lost here in about
one case of 10,000, at 0.86 in one of 50,000).  In nodes too large for a task the
pivots' links are confirmed on full sets, and outsiders meet the others in blocks.

What these loose pairs connect is compared on full sets in the same way: a group in one
cell, or in several that all have the group's pivots; of a group in several cells, the
classes outside its largest component then meet the others in blocks.

Defined cases: null or wordless text has no set, n_shingles 0 and is its own
component; fewer than five words are one shingle; null ids take part, and a
component's id is its smallest non-null id (all null: null, all kept); rows
that repeat an id are compared like others; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from wardpulse.llm.components import connected
from wardpulse.llm.rows import KEY, arrow_batches, keep_rows, row_key, shared_table
from wardpulse.llm.words import mix, window_hashes, word_hashes

WIDTH = 5
PERCENT = 85
COORDS = 128
TREES = 4
BRANCH = 2
NODE_LIMIT = 64
DEPTH = 8
TIGHT = 0.5
#: A node of up to so many classes (2 MB of briefs) is walked in one task.
TASK_NODE = 1 << 14
BLOCK = 2048
SET_BLOCK = 4096
#: Members of a block of full sets weigh more where their sets are larger: a block
#: holds about this many shingles on each side.
SET_ENTRIES = 1 << 21
#: Pairs that a task passes on at once.
PAIRS = 10_000
SIGMAS = 4
SAMPLES, RARE = 64, 8
CENTRED = 4 * SAMPLES   # a centre is made of nodes with more classes only
SLOT_BITS = 20

_MULT = np.random.default_rng(11).integers(1, 1 << 63, COORDS, np.uint64) | np.uint64(1)
_CHILD = "node long, up long, c long"
_SCHEMA = "__id {id}, " + KEY + " long, n long, c long, tokens binary, brief binary"


def shingles(text: str, width: int = WIDTH) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    words = text.encode().lower().split()
    h = word_hashes(words)
    if 0 < len(h) < width:
        return mix(window_hashes(h, len(h)), np.uint64(len(h)))
    return np.unique(window_hashes(h, width))


def _tokens(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, COORDS) minwise tokens; every set must have a member."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), COORDS), np.uint32)
    tmp = np.empty_like(flat)
    for i, m in enumerate(_MULT):
        np.multiply(flat, m, out=tmp)
        np.right_shift(tmp, np.uint64(32), out=tmp)
        out[:, i] = np.minimum.reduceat(tmp, starts)
    return out


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = [shingles(t or "") for t in b.column("__text").to_pylist()]
        full = [s for s in sets if len(s)]
        tok = iter(_tokens(full) if full else ())
        rows = [next(tok) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [b.column("__id"), b.column(KEY), pa.array(list(map(len, sets)), pa.int64()),
             pa.array([xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) for s in sets], pa.int64()),
             pa.array([None if r is None else r.tobytes() for r in rows], pa.binary()),
             pa.array([None if r is None else r.astype(np.uint8).tobytes() for r in rows],
                      pa.binary())],
            names=["__id", KEY, "n", "c", "tokens", "brief"])


def _coordinate(node: np.ndarray, step: int) -> np.ndarray:
    pick = mix(node, np.uint64(7)) % np.uint64(COORDS)
    return (pick + np.uint64(step * 53)) % np.uint64(COORDS)


def _children(node: np.ndarray, tokens: np.ndarray, step: int) -> np.ndarray:
    """Child node of each row for the ``step``-th coordinate its node picks."""
    coord = _coordinate(node, step)
    value = tokens[np.arange(len(node)), coord.astype(np.int64)].astype(np.uint64)
    return mix(mix(node, coord), value)


def _branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, up, c, tokens) -> (node, up, c) of the children; a null node is
    above the roots of the trees, ``up`` is the size of the parent."""
    for b in batches:
        if not b.num_rows:
            continue
        tokens = np.frombuffer(b"".join(b.column("tokens").to_pylist()), np.uint32
                               ).reshape(-1, COORDS)
        if b.column("node").null_count:
            nodes = [mix(np.full(b.num_rows, t, np.uint64), np.uint64(99)) for t in range(TREES)]
        else:
            nodes = [b.column("node").to_numpy().view(np.uint64)]
        for node in nodes:
            for step in range(BRANCH):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_children(node, tokens, step).view(np.int64)), b.column("up"),
                     b.column("c")], names=["node", "up", "c"])


def centre(tokens: np.ndarray, none: int = 0) -> np.ndarray:
    """(COORDS, 4) of the tokens that a quarter of the rows have or more, first the one
    that over half have; ``none`` where there are fewer."""
    t = np.sort(tokens, axis=0)
    common = np.full((COORDS, 4), none, tokens.dtype)
    for i in range(COORDS):
        value, count = np.unique(t[:, i], return_counts=True)
        many = value[2 * count > len(t)]
        common[i, :len(many)] = many
        several = value[(4 * count >= len(t)) & (2 * count <= len(t))]
        common[i, 1:1 + len(several)] = several[:3]
    return common


def _centres(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, tokens of some classes) -> (node, common): ``centre`` of those."""
    for b in batches:
        out = [centre(np.frombuffer(b"".join(some), np.uint32).reshape(-1, COORDS)).tobytes()
               for some in b.column("some").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(out, pa.binary())],
                                         names=["node", "common"])


_NONE = np.uint64((1 << 64) - 1)


def beside_centre(node: np.ndarray, tokens: np.ndarray, common: np.ndarray
                  ) -> tuple[np.ndarray, np.ndarray]:
    """Children of each row by tokens beside the centre's (_NONE: no such child), and
    the number of those tokens."""
    beside = tokens != common[:, :, 0]
    rare = beside & (tokens[:, :, None] != common[:, :, 1:]).all(axis=2)
    place = mix(node[:, None], np.arange(COORDS, dtype=np.uint64)[None] + np.uint64(1000))
    named = mix(place, tokens.astype(np.uint64))
    child = np.concatenate([
        np.partition(np.where(rare, named, _NONE), RARE - 1, axis=1)[:, :RARE],
        np.where(beside & ~rare, named, _NONE).min(axis=1, keepdims=True)], axis=1)
    return child, beside.sum(axis=1)


def _beside(percent: int):
    """(node, up, c, tokens, common) -> children (child, up, c) by tokens beside the
    centre's, and (node, c, low) of the classes near the centre (child null)."""
    apart = COORDS * (1 - _least_agreement(percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            tokens = np.frombuffer(b"".join(b.column("tokens").to_pylist()), np.uint32).reshape(-1, COORDS)
            common = np.frombuffer(b"".join(b.column("common").to_pylist()), np.uint32).reshape(
                -1, COORDS, 4)
            child, size = beside_centre(b.column("node").to_numpy().view(np.uint64), tokens, common)
            row, col = np.nonzero(child != _NONE)
            near = np.flatnonzero(size <= apart)
            rows = pa.array(np.concatenate([row, near]))
            whole = b.select(["node", "up", "c"]).take(rows)
            names = np.concatenate([child[row, col].view(np.int64), np.zeros(len(near), np.int64)])
            core = np.arange(len(rows)) >= len(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64(), mask=core), whole.column("node"), whole.column("up"),
                 whole.column("c"), pa.array((2 * size <= apart)[rows.to_numpy()])],
                names=["child", "node", "up", "c", "low"])
    return run


class Forest:
    """Union-find over positions, joining by given groups first."""

    def __init__(self, groups: np.ndarray):
        first: dict[int, int] = {}
        self.up = [first.setdefault(g, i) for i, g in enumerate(groups.tolist())]

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[j] = i
        return i != j


def _least_agreement(percent: int) -> float:
    p = percent / 100
    return p - SIGMAS * (p * (1 - p) / COORDS) ** 0.5


def _sized(n: np.ndarray, i: int, j: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])


class Labels:
    """Components of the rows of a node or cell, as a label for each row."""

    def __init__(self, size: int):
        self.of = np.arange(size)

    def join(self, i: int, rows: np.ndarray) -> None:
        rows = rows[self.of[rows] != self.of[i]]
        if len(rows):
            found = np.zeros(len(self.of), bool)
            found[self.of[rows]] = True
            self.of[found[self.of]] = self.of[i]

    def meet(self, rows: np.ndarray, others: np.ndarray, alike) -> None:
        """Join each of ``rows`` with those of ``rows`` and ``others`` that ``alike(i, among)``
        finds, pairs of ``others`` left out: two pivots first, then what is outside the
        largest component."""
        everyone = np.concatenate([rows, others])

        def ask(i: int, among: np.ndarray) -> None:
            among = among[self.of[among] != self.of[i]]   # the others need no question
            if len(among):
                self.join(i, alike(i, among))

        for i in (rows[0], rows[-1]):
            ask(i, everyone)
        main = np.bincount(self.of[everyone]).argmax()
        for i in rows[self.of[rows] != main]:
            ask(i, everyone)
        main = np.bincount(self.of[everyone]).argmax()
        for i in others[self.of[others] != main]:
            ask(i, rows)

    def pairs(self, c: np.ndarray) -> list[tuple[int, int]]:
        """(smallest class, class) of each component."""
        order = np.lexsort([c, self.of])
        first = np.flatnonzero(np.diff(self.of[order], prepend=-1))
        size = np.diff(np.append(first, len(order)))
        low = np.repeat(c[order][first], size)
        more = np.ones(len(order), bool)
        more[first] = False
        return list(zip(low[more].tolist(), c[order][more].tolist()))


def _split(names: np.ndarray) -> Iterator[np.ndarray]:
    """Positions of each name that occurs more than once."""
    order = np.argsort(names, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], np.diff(names[order]) != 0]))
    for part in np.split(order, starts[1:]):
        if len(part) > 1:
            yield part


def walk(rows: dict, percent: int) -> list[tuple[int, int]]:
    """The trees below one node, by briefs -> components of the classes whose tokens agree."""
    brief = np.frombuffer(b"".join(rows["data"]), np.uint8).reshape(-1, COORDS)
    c, n = (np.asarray(rows[k], np.int64) for k in ("c", "n"))
    low = _least_agreement(percent)
    apart, labels = COORDS * (1 - low), Labels(len(c))

    def alike(i: int, among: np.ndarray) -> np.ndarray:
        among = among[_sized(n, i, among, percent)]
        return among[(brief[among] == brief[i]).sum(axis=1, dtype=np.uint8) >= low * COORDS]

    none = np.empty(0, np.int64)
    todo = [(np.arange(len(c)), np.uint64(rows["block"] % (1 << 64)), True, 0)]
    while todo:
        at, node, parts, depth = todo.pop()
        if len(at) <= NODE_LIMIT:
            b = brief[at]
            for i, hit in enumerate((b[:, None] == b).sum(axis=2, dtype=np.uint8) >= low * COORDS):
                hit = at[i + 1:][hit[i + 1:]]
                if len(hit):
                    labels.join(at[i], hit[_sized(n, at[i], hit, percent)])
            continue
        if (not parts and len(at) <= CENTRED) or depth == DEPTH:
            labels.meet(at, none, alike)
            continue
        if parts:
            for step in range(BRANCH):
                coord = _coordinate(np.array([node]), step)
                values = brief[at, int(coord[0])]
                for part in _split(values):
                    child = mix(mix(np.array([node]), coord), values[part[:1]].astype(np.uint64))[0]
                    todo.append((at[part], child, len(part) <= TIGHT * len(at), depth + 1))
            continue
        some = at[np.argsort(mix(c[at].view(np.uint64), node), kind="stable")[:SAMPLES]]
        common = centre(brief[some].astype(np.int16), -1)[None]
        names, size = map(np.concatenate, zip(*(
            beside_centre(np.full(len(x), node), brief[x], common)
            for x in np.split(at, range(BLOCK, len(at), BLOCK)))))
        core = 2 * size <= apart
        if core.any():
            labels.meet(at[core], at[~core & (size <= apart)], alike)
        if not core.all():
            row, col = np.nonzero(names != _NONE)
            for part in _split(names[row, col]):
                todo.append((at[row[part]], names[row[part[0]], col[part[0]]],
                             len(part) <= TIGHT * len(at), depth + 1))
    return labels.pairs(c)


class SharedShingles:
    """Sets of some rows by shingle."""

    def __init__(self, sets: list[np.ndarray]):
        self.members, where = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        self.owner = owner[np.argsort(where, kind="stable")]
        self.ends = np.concatenate([[0], np.cumsum(np.bincount(where, minlength=len(self.members)))])
        self.size = len(sets)

    def counts(self, one: np.ndarray) -> np.ndarray:
        """Shingles that each set shares with ``one``."""
        at = np.searchsorted(self.members, one)
        fits = at < len(self.members)
        at = at[fits][self.members[at[fits]] == one[fits]]
        if not len(at):
            return np.zeros(self.size, np.int64)
        return np.bincount(np.concatenate([self.owner[self.ends[a]:self.ends[a + 1]] for a in at]),
                           minlength=self.size)


def exact_components(rows: dict, percent: int) -> list[tuple[int, int]]:
    """A cell's components by links on full sets."""
    c, n = (np.asarray(rows[k], np.int64) for k in ("c", "n"))
    if len(c) < 2:
        return []
    sets = [np.frombuffer(x, np.uint64) for x in rows["data"]]
    shared, labels = SharedShingles(sets), Labels(len(c))

    def alike(i: int, among: np.ndarray) -> np.ndarray:
        both = shared.counts(sets[i])[among]
        return among[100 * both >= percent * (n[i] + n[among] - both)]

    labels.meet(np.arange(len(c)), np.empty(0, np.int64), alike)
    return labels.pairs(c)


def loose_pairs(rows: dict, percent: int) -> list[tuple[int, int]]:
    """Spanning pairs of outsiders and others whose tokens agree."""
    brief = np.frombuffer(b"".join(rows["data"]), np.uint8).reshape(-1, COORDS)
    c, n, comp = (np.asarray(rows[k], np.int64) for k in ("c", "n", "comp"))
    out = np.asarray(rows["out"], bool)
    rest, low = np.flatnonzero(~out), _least_agreement(percent)
    # Pairs of one component need no edge; an outsider stands in both roles.
    forest, pairs = Forest(c), []
    for i in np.flatnonzero(out):
        j = rest[(comp[rest] != comp[i]) & _sized(n, i, rest, percent)]
        for k in j[(brief[j] == brief[i]).mean(axis=1) >= low].tolist():
            if forest.join(int(i), k):
                pairs.append((int(c[i]), int(c[k])))
    return pairs


def exact_pairs(rows: dict, percent: int) -> list[tuple[int, int]]:
    """Links on full sets that join components, outsiders against others."""
    c, n, comp = (np.asarray(rows[k], np.int64) for k in ("c", "n", "comp"))
    out = np.asarray(rows["out"], bool)
    sets = [np.frombuffer(x, np.uint64) for x in rows["data"]]
    rest = np.flatnonzero(~out)
    if not len(rest) or not out.any():
        return []
    shared = SharedShingles([sets[j] for j in rest])
    forest, links = Forest(comp), []
    for i in np.flatnonzero(out):
        both = shared.counts(sets[i])
        hit = 100 * both >= percent * (n[i] + n[rest] - both)
        for k in rest[hit].tolist():
            if forest.join(int(i), k):
                links.append((int(c[i]), int(c[k])))
    return links


def _in_blocks(compare, percent: int, names: tuple[str, ...]):
    """Run ``compare`` on the columns of each block; rows come sorted by block."""
    def pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([min(p) for p in found], pa.int64()),
             pa.array([max(p) for p in found], pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, found = None, {}, []
        for batch in batches:
            keys = batch.column("block").to_pylist()
            cols = {k: batch.column(k).to_pylist() for k in names}
            start = 0
            for end in range(1, len(keys) + 1):
                if end < len(keys) and keys[end] == keys[start]:
                    continue
                if keys[start] != key:
                    if held:
                        found += compare(held | {"block": key}, percent)
                        if len(found) >= PAIRS:
                            yield pairs(found)
                            found = []
                    key, held = keys[start], {k: [] for k in names}
                for k in names:
                    held[k] += cols[k][start:end]
                start = end
        if held:
            found += compare(held | {"block": key}, percent)
        yield pairs(found)

    return run


def _each_block(rows: DataFrame, compare, percent: int, *names: str) -> DataFrame:
    """Pairs (a, b) that ``compare`` finds in each ``block`` of ``rows``."""
    cells = rows.select("block", *names).repartition("block").sortWithinPartitions("block")
    return cells.mapInArrow(_in_blocks(compare, percent, names), "a long, b long")


def _outsiders_against_all(members: DataFrame, data: DataFrame, block: int, compare,
                           percent: int) -> DataFrame:
    """``members``: (grp, c, comp, weight, outer, inner); ``data``: (c, n, data).  Pairs
    (a, b) that ``compare`` finds in each group of more than one component, between
    ``outer`` classes outside the group's largest component and ``inner`` classes, in
    cells of at most a weight of ``block`` by ``block`` or so."""
    weigh = lambda c: F.sum(F.when(c, F.col("weight")).otherwise(0))
    parts = members.groupBy("grp", "comp").agg(weigh(F.col("inner")).alias("i"),
                                               weigh(F.col("outer")).alias("o"))
    groups = (parts.groupBy("grp").agg(
        F.sum("i").alias("inside"), F.sum("o").alias("outs"), F.count(F.lit(1)).alias("comps"),
        F.max_by(F.struct("comp", "o"), F.struct("i", "comp")).alias("main"))
        .withColumn("outs", F.col("outs") - F.col("main")["o"])
        .filter("comps > 1 AND inside > 0 AND outs > 0")
        .select("grp", F.col("main")["comp"].alias("main"), F.ceil(F.col("inside") / block).alias("nb"),
                F.ceil(F.col("outs") / block).alias("no")))
    apart = members.join(groups, "grp").join(data, "c")
    h, cols = F.xxhash64("c"), ["c", "n", "comp", "data"]
    everyone = (apart.filter("inner")
                .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("no") - 1))).select(
        F.xxhash64("grp", F.pmod(h, "nb"), "o").alias("block"), *cols, F.lit(False).alias("out")))
    outside = (apart.filter("outer AND comp != main")
               .withColumn("r", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).select(
        F.xxhash64("grp", "r", F.pmod(h, "no")).alias("block"), *cols, F.lit(True).alias("out")))
    return _each_block(everyone.union(outside), compare, percent, *cols, "out")


def _sets_of(need: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(c, data) of the classes in ``need``: full sets, as bytes.  The rows that
    stand for them are found by at most 2**SLOT_BITS slots of their keys."""
    need = classes.select("c", "rep").join(need.distinct(), "c", "left_semi")
    slots = need.select(F.pmod("rep", F.lit(1 << SLOT_BITS)).alias("__slot")).distinct()
    return (docs.join(F.broadcast(slots), F.pmod(KEY, F.lit(1 << SLOT_BITS)) == F.col("__slot"),
                      "left_semi")
            .mapInArrow(_sets, "c long, data binary")
            .join(need.select("c"), "c", "left_semi")
            .groupBy("c").agg(F.first("data").alias("data")))


def _around_centres(rows: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """``rows``: (node, up, c) of nodes that keep together; see ``_beside``."""
    first = Window.partitionBy("node").orderBy(F.xxhash64("c"))
    some = (rows.select("node", "c").withColumn("r", F.row_number().over(first))
            .filter(F.col("r") <= SAMPLES).join(tokens, "c")
            .groupBy("node").agg(F.collect_list("tokens").alias("some")))
    centres = some.mapInArrow(_centres, "node long, common binary")
    # Tokens first: the wider centres are not shuffled by class.
    return (rows.join(tokens, "c").join(centres, "node")
            .mapInArrow(_beside(percent), "child long, node long, up long, c long, low boolean"))


def _confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes that are links, on full sets."""
    lo, hi = F.least("na", "nb"), F.greatest("na", "nb")
    left = classes.select(F.col("c").alias("a"), F.col("n").alias("na"), F.col("brief").alias("ba"))
    right = classes.select(F.col("c").alias("b"), F.col("n").alias("nb"), F.col("brief").alias("bb"))
    pairs = (pairs.distinct().join(left, "a").join(right, "b").filter(100 * lo >= percent * hi)
             .mapInArrow(_token_filter(_least_agreement(percent)),
                         "a long, b long, na long, nb long"))
    pairs = shared_table(pairs, "near-pairs")
    sets = _sets_of(pairs.select(F.col("a").alias("c")).union(pairs.select("b")), classes, docs)
    return (pairs.join(sets.select(F.col("c").alias("a"), F.col("data").alias("sa")), "a")
            .join(sets.select(F.col("c").alias("b"), F.col("data").alias("sb")), "b")
            .mapInArrow(_linked(percent), "a long, b long"))


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = np.array([len(np.intersect1d(np.frombuffer(x, np.uint64),
                                                np.frombuffer(y, np.uint64), assume_unique=True))
                             for x, y in zip(b.column("sa").to_pylist(), b.column("sb").to_pylist())],
                            np.int64)
            n = b.column("na").to_numpy() + b.column("nb").to_numpy()
            yield b.select(["a", "b"]).filter(pa.array(100 * both >= percent * (n - both)))
    return run


def _token_filter(low: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint8).reshape(-1, COORDS)
                    for k in ("ba", "bb"))
            yield b.select(["a", "b", "na", "nb"]).filter(
                pa.array((x == y).mean(axis=1) >= low))
    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = [shingles(t or "") for t in b.column("__text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) for s in sets], pa.int64()),
             pa.array([s.tobytes() for s in sets], pa.binary())], names=["c", "data"])


def _walk_trees(classes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes, by the agreement of their tokens; what is linked is connected
    by them."""
    tokens = classes.select("c", "tokens")
    briefs = classes.select("c", "n", F.col("brief").alias("data"))
    level = classes.select(F.lit(None).cast("long").alias("node"), F.lit(1 << 62).alias("up"),
                           "c", "tokens").mapInArrow(_branch, _CHILD)
    yes = F.lit(True)
    stars, small, compared = [], [], []
    for depth in range(1, DEPTH + 2):
        level = shared_table(level, "near-level")
        sizes = (level.groupBy("node").agg(F.count(F.lit(1)).alias("size"),
                                           F.min("c").alias("p"), F.max("c").alias("q"))
                 .filter("size > 1"))
        level = shared_table(level.join(sizes, "node"), "near-nodes")
        large = F.col("size") > TASK_NODE
        small.append(level.filter(~large).select("node", "c"))
        level = level.filter(large)
        if level.isEmpty():
            break
        parts = (F.col("size") <= TIGHT * F.col("up")) & F.lit(depth < DEPTH)
        whole = level if depth > DEPTH else level.filter(~parts)
        stars += [whole.select(F.least(p, "c").alias("a"), F.greatest(p, "c").alias("b"))
                  .filter("a != b") for p in ("p", "q")]
        if depth > DEPTH:
            compared.append(level.select(F.col("node").alias("grp"), "c", yes.alias("outer"),
                                         yes.alias("inner")))
            break
        level = level.select("node", F.col("size").alias("up"), "c", parts.alias("parts"))
        near = shared_table(_around_centres(level.filter(~F.col("parts")).drop("parts"), tokens,
                                            percent), "near-centres")
        # Where all classes are low, they all meet near the centre.
        mixed = near.filter("NOT low").select("node").distinct()
        cores = near.filter("child IS NULL")
        # Near a centre, low ones against all, then the others against low ones.
        compared.append(cores.select(F.col("node").alias("grp"), "c", F.col("low").alias("outer"),
                                     yes.alias("inner")))
        compared.append(cores.join(mixed, "node", "left_semi").select(
            F.xxhash64("node", F.lit(1)).alias("grp"), "c", (~F.col("low")).alias("outer"),
            F.col("low").alias("inner")))
        level = (level.filter("parts").drop("parts").join(tokens, "c").select("node", "up", "c", "tokens")
                 .mapInArrow(_branch, _CHILD)
                 .unionByName(near.filter("child IS NOT NULL").join(mixed, "node", "left_semi").select(
                     F.col("child").alias("node"), "up", "c")))

    pairs = _each_block(_all(small).withColumnRenamed("node", "block").join(briefs, "c"),
                        walk, percent, "c", "n", "data")
    if stars:
        # Groups within components are enough here: a pivot and its classes are joined
        # after one round.
        links = shared_table(_confirm(_all(stars), classes, docs, percent), "near-pivots")
        members = _with_comp(_all(compared), connected(links, 1, partial=True))
        pairs = pairs.union(links).union(_outsiders_against_all(
            members.withColumn("weight", F.lit(1.0)), briefs, BLOCK, loose_pairs, percent))
    return pairs


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for x in frames[1:]:
        out = out.unionByName(x)
    return out


def _with_comp(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots, F.col("c") == F.col("u"), "left").select(
        *members.columns, F.coalesce("root", "c").alias("comp"))


def _components(classes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """(u, root) of the classes' components, by links on full sets."""
    loose = connected(_walk_trees(classes, docs, percent))
    members = loose.select(F.col("root").alias("grp"), F.col("u").alias("c")).union(
        loose.select("root", F.col("root").alias("c")).distinct())
    weight = F.greatest(F.lit(1.0), F.col("n") * F.lit(SET_BLOCK / SET_ENTRIES))
    members = members.join(classes.select("c", "n"), "c").withColumn("weight", weight)
    groups = members.groupBy("grp").agg(F.ceil(F.sum("weight") / SET_BLOCK).alias("cells"),
                                        F.min("c").alias("p"), F.max("c").alias("q"))
    members = shared_table(members.join(groups, "grp"), "near-loose")
    pivot = F.col("c").isin(F.col("p"), F.col("q"))
    cell = F.explode(F.when(pivot, F.sequence(F.lit(0), F.col("cells") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("c"), "cells"))))
    placed = members.select("c", "n", "grp", cell.alias("r")).select(
        F.xxhash64("grp", "r").alias("block"), "c", "n")
    roots = connected(_each_block(
        placed.join(_sets_of(members.select("c"), classes, docs), "c"),
        exact_components, percent, "c", "n", "data"))
    # In one cell, all have met.
    wide = F.col("cells") > 1
    apart = _with_comp(members.select("grp", "c", "weight", wide.alias("outer"),
                                      F.lit(True).alias("inner")), roots)
    sets = _sets_of(members.filter(wide).select("c"), classes, docs).join(
        classes.select("c", "n"), "c")
    more = _outsiders_against_all(apart, sets, SET_BLOCK, exact_pairs, percent)
    if members.filter(wide).isEmpty():
        return roots
    return connected(roots.toDF("a", "b").union(more))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept, KEY."""
    arrow_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).alias("__id"), row_key(id_col, text_col).alias(KEY),
                       F.col(text_col).cast("string").alias("__text"))
    kind = slim.schema["__id"].dataType.simpleString()
    rows = shared_table(slim.mapInArrow(_classes, _SCHEMA.format(id=kind)), "near-rows")
    classes = shared_table(
        rows.filter("n > 0").groupBy("c").agg(
            F.max("n").alias("n"), F.min("__id").alias("first_id"), F.min(KEY).alias("rep"),
            F.first("tokens").alias("tokens"), F.first("brief").alias("brief")), "near-classes")

    roots = _components(classes, slim, percent)

    owner = classes.join(roots, F.col("c") == F.col("u"), "left").select(
        "c", F.coalesce("root", "c").alias("root"), "first_id")
    firsts = owner.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = owner.join(firsts, "root").select("c", "component_id")
    slim_rows = rows.select("__id", KEY, "n", "c")
    linked = slim_rows.filter("n > 0").join(named, "c")
    alone = slim_rows.filter("n = 0").withColumn("component_id", F.col("__id"))
    return linked.unionByName(alone).select(
        F.col("__id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
        F.col("__id").eqNullSafe(F.col("component_id")).alias("kept"), KEY)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     percent: int = PERCENT) -> DataFrame:
    """Rows of ``docs`` that stay, all columns; one document of each component."""
    keys = (near_dedup(docs, id_col, text_col, percent).filter("kept")
            .select(F.col(id_col).alias("__id"), KEY))
    return keep_rows(docs, keys, id_col, text_col)
