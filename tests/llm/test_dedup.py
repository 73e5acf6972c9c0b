"""Exact, near and substring dedup against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from wardpulse.llm import near_dedup as ND, substring_dedup as SD
from wardpulse.llm.components import connected
from wardpulse.llm.exact_dedup import drop_copies, exact_dedup
from wardpulse.llm.near_dedup import drop_near_copies, near_dedup
from wardpulse.llm.substring_dedup import substring_dedup


def norm(t):
    return re.sub("[\x20\x09-\x0d]+", " ", t or "")


def words(t):
    return (t or "").encode().split()


def low_id(ids):
    given = [i for i in ids if i is not None]
    return min(given) if given else None


def exact_reference(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[norm(t)].append(i)
    return Counter((i, low_id(groups[norm(t)]), len(groups[norm(t)]), i == low_id(groups[norm(t)]))
                   for i, t, *_ in rows)


def shingle_set(t):
    w = [x.lower() for x in words(t)]
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def components_reference(rows, percent=85):
    sets = [shingle_set(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    inverted = defaultdict(list)
    for j, s in enumerate(sets):
        for i in {i for x in s for i in inverted[x]}:
            both = len(s & sets[i])
            if 100 * both >= percent * (len(s) + len(sets[i]) - both):
                root[find(j)] = find(i)
        for x in s:
            inverted[x].append(j)
    members = defaultdict(list)
    for j in range(len(rows)):
        members[find(j)].append(rows[j][0])
    return Counter((rows[j][0], len(sets[j]), low_id(members[find(j)]) if sets[j] else rows[j][0])
                   for j in range(len(rows)))


def substring_reference(rows):
    """Rows that repeat id and text are one place."""
    order = sorted({(i is None, i or 0, t or "") for i, t, *_ in rows})
    first, out = {}, {}
    for null, i, t in order:
        w = words(t)
        stay = [True] * len(w)
        for a in range(len(w) - 19):
            key = tuple(w[a:a + 20])
            if first.setdefault(key, (null, i, t, a)) != (null, i, t, a):
                stay[a:a + 20] = [False] * 20
        kept = [x for x, s in zip(w, stay) if s]
        out[null, i, t] = (len(w), len(w) - len(kept), b" ".join(kept).decode())
    return Counter((i, *out[i is None, i or 0, t or ""]) for i, t, *_ in rows)


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_exact_edge(edge):
    got = Counter(tuple(r) for r in exact_dedup(edge).collect())
    assert got == exact_reference(rows_of(edge))


def test_exact_prefix_clash(spark):
    """Same length and prefix, different tails."""
    rows = [(i, "p" * 300 + str(i % 7)) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in exact_dedup(df).collect()) == exact_reference(rows)


def test_exact_stage_keeps_columns(edge):
    kept = drop_copies(edge)
    assert kept.columns == edge.columns
    texts = Counter(norm(r.text) for r in kept.collect())
    assert set(texts) == {norm(r.text) for r in edge.collect()}
    # The row given twice shares one decision; all else stays once.
    assert {t for t, n in texts.items() if n > 1} <= {norm(edge.filter("doc_id = 7").first().text)}


@pytest.mark.parametrize("limit", [64, 1])
def test_near_edge(edge, monkeypatch, limit):
    monkeypatch.setattr(ND, "NODE_LIMIT", limit)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup(edge).collect())
    assert got == components_reference(rows_of(edge))


def test_near_small(small, small_rows):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup(small).collect())
    assert got == components_reference(small_rows)


def test_near_copies_of_one_text(spark, monkeypatch):
    """A large family of variants, and pairs close to the limit, by small nodes
    and blocks."""
    import random
    rng = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(300):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(ND, "NODE_LIMIT", 16)
    monkeypatch.setattr(ND, "BLOCK", 32)
    monkeypatch.setattr(ND, "SET_BLOCK", 20)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup(df).collect())
    assert got == components_reference(rows)


def template_rows(n, shared, own, seed=6):
    """Unlike pages of one template, and near copies of every tenth of them."""
    import random
    rng = random.Random(seed)
    frame = [f"menu{k}" for k in range(shared)]
    rows = []
    for i in range(n):
        page = frame + [f"own{i}x{k}" for k in range(own)]
        rows.append((3 * i, " ".join(page)))
        if i % 10 == 0:
            near = list(page)
            near[rng.randrange(len(page))] = f"changed{i}"
            rows.append((3 * i + 1, " ".join(near)))
        if i % 30 == 0:
            rows.append((3 * i + 2, " ".join(page[:-2])))
    return rows


@pytest.mark.parametrize("n,shared,own", [(800, 104, 40), (400, 120, 28), (400, 140, 12)])
def test_pages_of_a_template(spark, n, shared, own, monkeypatch):
    """Pages that share most of their shingles are linked to their copies alone.  Where
    they are half alike, no node of theirs is compared whole."""
    largest = []
    plain = ND._outsiders_against_all

    def counted(members, *rest):
        groups = members.groupBy("grp").agg(
            (F.count_if("outer") * F.count_if("inner")).alias("pairs"))
        largest.append(groups.agg(F.max("pairs")).first()[0])
        return plain(members, *rest)

    monkeypatch.setattr(ND, "_outsiders_against_all", counted)
    rows = template_rows(n, shared, own)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup(df).collect())
    assert got == components_reference(rows)
    assert own != 40 or largest[0] <= ND.CENTRED ** 2


def family_rows(n, seed=9):
    """Variants of one text."""
    import random
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    return rows


def test_small_nodes_are_walked_in_tasks(spark, monkeypatch):
    """A family that keeps together is shuffled by node once, not once for each level."""
    nodes = []
    plain = ND.shared_table

    def counted(df, name):
        out = plain(df, name)
        if name == "near-nodes":
            nodes.append(out.count())
        return out

    monkeypatch.setattr(ND, "shared_table", counted)
    rows = family_rows(400)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup(df).collect())
    assert got == components_reference(rows)
    assert len(nodes) == 1 and nodes[0] <= ND.TREES * ND.BRANCH * len(rows)


@pytest.mark.parametrize("rows", [family_rows(200), template_rows(200, 104, 40)])
def test_nodes_too_large_for_a_task(spark, monkeypatch, rows):
    """Branching by shuffles, pivots and blocks finds what the walk in tasks does."""
    for name, value in (("TASK_NODE", 40), ("CENTRED", 60), ("BLOCK", 32), ("SET_BLOCK", 20)):
        monkeypatch.setattr(ND, name, value)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup(df).collect())
    assert got == components_reference(rows)


@pytest.mark.parametrize("rows", [family_rows(600), template_rows(600, 104, 40)])
def test_walk_finds_linked_pairs(rows):
    """Classes that are linked are connected by the walk of their node, whatever its paths."""
    import numpy as np
    sets = [ND.shingles(t) for _, t in rows]
    brief = ND._tokens(sets).astype(np.uint8)
    node = {"c": [i for i, _ in rows], "n": list(map(len, sets)),
            "data": [x.tobytes() for x in brief]}
    want = components_reference(rows)
    found = [Counter(ND.walk(node | {"block": k}, 85)) for k in (-3, 0, 12345)]
    for pairs in found:
        root = {b: a for a, b in pairs}
        assert len(root) == len(pairs)
        groups = defaultdict(set)
        for i, _, c in want:
            groups[c].add(root.get(i, i))
        # One tree, so a pair may be lost; the copies of a text agree in nearly all tokens.
        assert sum(len(g) > 1 for g in groups.values()) <= len(groups) // 50


def test_near_stage(edge):
    kept = drop_near_copies(edge)
    assert kept.columns == edge.columns
    ref = components_reference(rows_of(edge))
    assert {r.doc_id for r in kept.collect()} == {i for i, _, c in ref if i == c}


def test_components_of_paths(spark):
    """Long paths settle on their smallest node."""
    edges = [(i, i + 1) for i in range(0, 200)] + [(i, i + 1) for i in range(1000, 1050)] + [(7, 7)]
    got = {r.u: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {i: 1000 for i in range(1001, 1051)}


def substring_rows(df):
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text)
                   for r in substring_dedup(df).collect())


@pytest.mark.parametrize("hot,shard", [(1 << 20, 1 << 20), (60, 500)])
def test_substring(edge, small, small_rows, monkeypatch, hot, shard):
    """Also with shards and hot minimizers of a few words."""
    monkeypatch.setattr(SD, "HOT_WORDS", hot)
    monkeypatch.setattr(SD, "SHARD_WORDS", shard)
    assert substring_rows(edge) == substring_reference(rows_of(edge))
    assert substring_rows(small) == substring_reference(small_rows)


def test_fm_index_finds_all_occurrences():
    import numpy as np
    from wardpulse.llm.fm_index import FMIndex
    rng = np.random.default_rng(1)
    text = np.append(rng.integers(1, 5, 600), 0)
    index = FMIndex(text, 6)
    for a in range(0, 590, 7):
        lo, hi = np.zeros(1, np.int64), np.full(1, len(text))
        for k in range(5, -1, -1):
            lo, hi = index.extend(text[a + k:a + k + 1], lo, hi)
        found = sorted(index.sa[lo[0]:hi[0]].tolist())
        assert found == [i for i in range(len(text) - 5) if (text[i:i + 6] == text[a:a + 6]).all()]


@pytest.mark.parametrize("op", [exact_dedup, near_dedup, substring_dedup, drop_copies,
                                drop_near_copies])
def test_empty(empty, op):
    assert op(empty).collect() == []


def test_digest_of_normalised_text(spark):
    import __spark_entry__ as E
    from tests.conftest import SF_SMALL
    for r in E.queries()["op3_exact_dedup"](spark, SF_SMALL).limit(20).collect():
        t = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter(f"doc_id = {r.doc_id}").first().text
        assert r.text_sha256 == hashlib.sha256(norm(t).encode()).hexdigest()
