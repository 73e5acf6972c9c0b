"""Lexical search, URL filters and filter audit against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from wardpulse.llm import filter_audit as FA, lexical_search as LS, url_filters as UF
from wardpulse.llm.queries import URL_RULES
from wardpulse.llm.url_filters import HostRule, PatternRule

SIGNS = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def found_terms(text):
    upper = "".join(map(chr, range(65, 91)))
    return SIGNS.findall((text or "").translate(str.maketrans(upper, upper.lower())))


def search_reference(docs, items, k):
    """``docs`` (id, text), ``items`` (id, text); rows (item, rank, doc, score)."""
    counts = [Counter(found_terms(t)) for _, t in docs]
    sizes = [sum(c.values()) for c in counts]
    n, total = sum(map(bool, sizes)), sum(sizes)
    df = Counter(t for c in counts for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        asked, scores = Counter(found_terms(text)), []
        for (doc, _), c, size in zip(docs, counts, sizes):
            score = 0
            for t, repeats in asked.items():
                if c[t]:
                    m = 100 - 75 + 75 * size * n // total
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += repeats * w * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1)]
    return Counter(out)


ITEMS = [(0, "One two WORDS, token=abc; same"), (0, "漢字 bc"), (1, None), (2, ""), (2, "  .,"),
         (3, "nowhere-at-all"), (4, "one one two"), (4, "one one two"), (None, "password")]


@pytest.fixture
def small_shards(monkeypatch):
    monkeypatch.setattr(LS, "SHARD_DOCS", 37)
    monkeypatch.setattr(LS, "SHARD_ENTRIES", 900)


@pytest.mark.parametrize("block_terms", [LS.BLOCK_TERMS, 4])
def test_search(spark, edge, small, small_shards, block_terms):
    items = [*ITEMS]
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    items += [(10 + i, t) for i, (_, t) in enumerate(rows) if t and len(t) < 3000]
    asked = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, score string")
    got = LS.search_documents(edge, asked, k=4, block_terms=block_terms * 40)
    assert Counter(tuple(r) for r in got.collect()) == search_reference(rows, items, 4)


def test_search_small(spark, small, small_rows, small_shards):
    items = [(i, t) for i, t, _ in small_rows if i % 20 == 0]
    got = LS.search_documents(small, spark.createDataFrame(items, "item_id long, text string"))
    assert Counter(tuple(r) for r in got.collect()) == search_reference(
        [r[:2] for r in small_rows], items, 10)


def test_search_of_nothing(spark, edge, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert LS.search_documents(empty, items).collect() == []
    assert LS.search_documents(edge, items.limit(0)).collect() == []


def vectors_of(rows):
    sizes = [len(r) for r in rows]
    return LS.Vectors(np.concatenate([[0], np.cumsum(sizes)]),
                      np.array([t for r in rows for t in r], np.int64),
                      np.array([x for r in rows for x in r.values()], np.int64))


def test_bounds_hold_and_prune():
    """No bound lies under the best score of its node; most rows go unscored."""
    rng = random.Random(3)
    topics = [rng.sample(range(300), 25) for _ in range(12)]
    rows = [{t: rng.randint(1, 10**6) for t in rng.sample(rng.choice(topics), 12)} for _ in range(600)]
    scale = np.sqrt(np.arange(1.0, 301.0))
    tree = LS.BallTree(vectors_of(rows), np.arange(600), scale, leaf=8)
    scored = 0
    for topic in topics:
        terms = np.array(sorted(rng.sample(topic, 8)), np.int64)
        query = LS.Query(terms, np.array([rng.randint(1, 10**4) for _ in terms], np.int64))
        score = [sum(r.get(t, 0) * w for t, w in zip(terms.tolist(), query.weights.tolist())) for r in rows]
        for node, bound in zip(tree.nodes, tree.bounds(query)):
            assert bound >= max(score[i] for i in tree.ids[node.first:node.last])
        best: list = []
        scored += tree.search(query, best, 5)
        assert sorted(best, reverse=True) == sorted(((s, -i) for i, s in enumerate(score)), reverse=True)[:5]
    assert scored < 0.3 * len(rows) * len(topics)


def test_equal_scores_rank_by_id_across_shards(spark, small_shards):
    docs = spark.createDataFrame([(i, "alpha beta") for i in random.Random(1).sample(range(500), 500)]
                                 + [(None, "alpha beta"), (7, "alpha beta")], "doc_id long, text string")
    docs = docs.union(spark.createDataFrame([(1000 + i, "other") for i in range(600)], docs.schema))
    items = spark.createDataFrame([(1, "beta")], "item_id long, text string")
    got = LS.search_documents(docs.repartition(3), items, k=6).orderBy("rank").collect()
    assert [r.doc_id for r in got] == [0, 1, 2, 3, 4, 5]
    got = LS.search_documents(docs.repartition(3), items, k=502).orderBy("rank").collect()
    assert [r.doc_id for r in got][6:9] == [6, 7, 7] and got[-1].doc_id is None


URLS = [
    None, "", "no scheme", "http://", "https://Example.NET/en/1", "https://example.net/en", "http://net/",
    "http://a.b.example.net/EN/x", "http://notexample.net/de/", "http://example.com/de/?q=/en/",
    "http://x.example.com/de", "http://example.com:80/de/", "http://u@example.org/fr/#/de/", "org/fr/",
    "http://org/fr/a", "http://casino-win.com/a", "http://x.com/casino", "http://x.com/casinos",
    "http://x.com/CASINO?responsible=gambling", "http://x.com/responsible-gambling/casino",
    "http://x.edu/poker", "ftp://free-bets.example.de", "http://x.com/search?q=1", "x://y://z/p?q",
    "http://x.com/wp-login.php", "http://x.com/pills-to-buy", "http://x.com/buy-pills", "http://\n/a\nb",
    "http://ünï.de/pörn/porn", "http://x.com/" + "a/" * 20_000 + "warez", "http://x.com/free/a/spins",
]


def url_reference(url, rules):
    url = url or ""
    upper = "".join(map(chr, range(65, 91)))
    low = url.translate(str.maketrans(upper, upper.lower()))
    rest = url.partition("://")[2]
    host = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(host):])[0]
    host = host.translate(str.maketrans(upper, upper.lower()))
    fits = [r for r in rules if isinstance(r, HostRule) and "://" in url and path.startswith(r.path)
            and (host == r.host or host.endswith("." + r.host))]
    if fits:
        won = max(fits, key=lambda r: len(r.host + r.path))
        return host, path, won.host + won.path, None, won.action
    hits = [r for r in rules if isinstance(r, PatternRule) and re.search(r.regex(), low, re.S)]
    hits = [r for r in hits if r.action == "allow"] or hits
    return host, path, None, hits[0].pattern if hits else None, hits[0].action if hits else "allow"


EXTRA = [HostRule("net", "/en"), HostRule("b.example.net", "/"), PatternRule("asino"), PatternRule("|http://org^", "allow"),
         PatternRule("y|"), PatternRule("*"), PatternRule("||net/en/")]


@pytest.mark.parametrize("rules_at_once", [UF.RULES_AT_ONCE, 7])
@pytest.mark.parametrize("rules", [URL_RULES, URL_RULES + EXTRA[:5], EXTRA, []])
def test_url_filters(spark, rules, rules_at_once):
    given = [*URLS, *(r.url for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect())]
    rows = [(i if i != 3 else None, u, "h", "r", 1) for i, u in enumerate(given)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string, verdict int")
    got = UF.judge_urls(pages, rules, rules_at_once=rules_at_once)
    assert got.columns == ["page_id", "host", "path", "rule", "pattern", "verdict"]
    assert Counter(tuple(r) for r in got.collect()) == Counter(
        (r[0], *url_reference(r[1], rules)) for r in rows)


def test_url_filters_of_nothing(spark):
    assert UF.judge_urls(spark.createDataFrame([], "page_id long, url string"), URL_RULES).collect() == []


def test_pattern_syntax_and_tokens():
    def fits(pattern, url):
        return re.search(PatternRule(pattern).regex(), url, re.S) is not None
    assert fits("||ads.", "http://x.ads.com/") and not fits("||ads.", "http://xads.com/")
    assert not fits("||ads.", "http://x.com/y.ads.com") and fits("^ad^", "http://x/ad")
    assert fits("|http:", "http://x") and not fits("|http:", "xhttp:") and fits("a*z|", "a/bz")
    assert PatternRule("ads^*big-ads*x.y|").tokens() == ["y"]
    assert PatternRule("||Ads.com^").tokens() == ["ads", "com"]
    assert HostRule("a.net", "/en").tokens() == ["a", "net"]
    assert HostRule("a.net", "/en/").tokens() == ["a", "net", "en"]


def test_only_candidates_run():
    """A URL tries rules filed under its tokens; each rule is under its rarest."""
    counts = {b"net": 50, b"example": 90, b"en": 70, b"casino": 2}
    index = UF.RuleIndex(list(enumerate(URL_RULES)), counts)
    assert not index.everywhere
    assert [r.name for _, r in index.filed[b"net"] if isinstance(r, HostRule)] == ["net/", "example.net/en/"]
    assert len(index.candidates("http://a.b/none/of/these")) == 0
    names = [r.pattern for _, r in index.candidates("http://a.b/casino") if isinstance(r, PatternRule)]
    assert "^casino^" in names and len(names) < 4


def audit_reference(rows, marks):
    """``rows`` (id, text, part), ``marks`` {id: (good, toxic)}; simulated row by row."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))

    def fails(i, t):
        t = t or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        return {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w),
                "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search("[#$%&*|]", t)),
                "E": i is not None and first[t] < i}

    failed = [(p or "", fails(i, t), *marks.get(i, (0, 0))) for i, t, p in rows]
    out = {}
    for order in FA.ORDERS:
        left = failed
        for step, f in enumerate(order, 1):
            gone = [r for r in left if r[1][f]]
            left = [r for r in left if not r[1][f]]
            for part in {r[0] for r in failed}:
                mine = [r for r in failed if r[0] == part]
                cut = [r for r in gone if r[0] == part]
                out[part, order, step] = (
                    sum(r[0] == part for r in left), len(cut), sum(r[1][f] for r in mine) - len(cut),
                    sum(r[1][f] and sum(r[1].values()) == 1 for r in mine),
                    sum(r[2] for r in cut), sum(r[3] for r in cut))
    shares = defaultdict(int)
    for (part, order, step), v in out.items():
        shares[part, order[step - 1]] += v[1]
    return {(*k, *v, shares[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_filter_audit(spark, edge):
    rows = [(r.doc_id, r.text, r.source) for r in edge.collect()]
    rng = random.Random(8)
    labels = [(i, rng.randint(0, 1), rng.randint(0, 1)) for i in range(0, 30, 2)]
    labels += [(4, 1, 0), (None, 1, 1), (8, None, 1), (9, None, None)]
    marks = defaultdict(lambda: (0, 0))
    for i, q, t in labels:
        if i is not None:
            marks[i] = (int(marks[i][0] or q == 1), int(marks[i][1] or t == 1))
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = FA.filter_audit(edge.withColumn("part", edge.c), table)
    assert {tuple(r) for r in got.collect()} == audit_reference(rows, marks)
    assert got.count() == 600 * len({r[2] or "" for r in rows})


def test_filter_audit_of_nothing(spark, edge, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert FA.filter_audit(empty, labels).collect() == []
    assert FA.filter_audit(edge, labels).filter("good_lost + toxic_lost > 0").count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 7, 100, 9999])
def test_positional_counts(n):
    words = np.random.default_rng(n).integers(0, 1 << 32, n, np.uint32)
    expected = [int((words >> np.uint32(b) & np.uint32(1)).sum()) for b in range(32)]
    assert FA.positional_counts(words).tolist() == expected
