"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardpulse.llm.bpe import decode, encode
from wardpulse.llm.exact_dedup import exact_dedup
from wardpulse.llm.filter_audit import filter_audit
from wardpulse.llm.lexical_search import search_documents
from wardpulse.llm.mixing import mix_sources
from wardpulse.llm.near_dedup import near_dedup
from wardpulse.llm.quality_rules import VERDICT, clean_texts
from wardpulse.llm import secrets
from wardpulse.llm.substring_dedup import substring_dedup
from wardpulse.llm.token_store import read_tokens, write_tokens
from wardpulse.llm.toxicity import score_toxicity
from wardpulse.llm.url_filters import HostRule, PatternRule, judge_urls
from wardpulse.llm.weak_quality import score_quality
from wardpulse.sources.tables import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn: QueryFn) -> QueryFn:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn
    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


@query()
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of whole documents at 0.85."""
    return near_dedup(documents(spark, sf_dir)).drop("__key")


@query(r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
           FROM documents),
     g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t""")
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup of whole documents."""
    return exact_dedup(documents(spark, sf_dir),
                       carry={"text_sha256": F.sha2(F.col("__norm"), 256)})


@query()
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-text counts, line frequency by host, verdict, cleaned text."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    return clean_texts(docs, verdict=VERDICT).select(
        "doc_id", *VERDICT, F.sha2("text", 256).alias("clean_sha256"))


#: Target weights of the registered mix; values not named weigh 1.
MIX_WEIGHTS = {"domain": {"d0": 1, "d1": 4, "d2": 2, "d3": 2},
               "lang": {"en": 4, "de": 3, "fr": 2, "es": 3}}
MIX_PERMILLE, MIX_EPOCHS, MIX_SEED = 900, 2, 7


def _fill_sql(level: str, parent: str, name: str) -> str:
    by = f"PARTITION BY {parent}" if parent else "PARTITION BY 0"
    keys = ", ".join([parent, name] if parent else [name])
    return f"""
{level}_a AS (SELECT *,
    coalesce(sum(cap) OVER (l ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS bef,
    (sum(w) OVER (l ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::HUGEINT AS wgt
  FROM {level}_n WINDOW l AS ({by} ORDER BY cap::DOUBLE / w::DOUBLE, {name})),
{level}_b AS (SELECT *, cap::HUGEINT * wgt <= (budget::HUGEINT - bef) * w AS sat FROM {level}_a),
{level}_c AS (SELECT *, sum(CASE WHEN sat THEN cap ELSE 0 END) OVER ({by}) AS taken,
    sum(CASE WHEN sat THEN 0 ELSE w END) OVER ({by}) AS open FROM {level}_b),
{level}_g AS (SELECT {keys}, tokens, CASE WHEN sat THEN cap::HUGEINT
    ELSE ((budget::HUGEINT - taken::HUGEINT) * w::HUGEINT) // open::HUGEINT END::BIGINT AS given
  FROM {level}_c)"""


def _weight_sql(level: str) -> str:
    return ("CASE " + level + " " + " ".join(
        f"WHEN '{v}' THEN {w}" for v, w in MIX_WEIGHTS[level].items()) + " ELSE 1 END")


MIX_SQL = rf"""
WITH num AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) AS k,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n FROM documents),
d AS (SELECT doc_id, lang, source, n,
    CASE WHEN k = '' THEN '' ELSE 'd' || (k::BIGINT % 4)::VARCHAR END AS domain FROM num),
leaf AS (SELECT domain, lang, source, sum(n)::BIGINT AS tokens,
    sum(n)::BIGINT * {MIX_EPOCHS} AS cap FROM d GROUP BY ALL),
x_n AS (SELECT domain, sum(cap)::BIGINT AS cap, sum(tokens)::BIGINT AS tokens,
    {_weight_sql("domain")} AS w,
    (SELECT (sum(tokens)::HUGEINT * {MIX_PERMILLE}) // 1000 FROM leaf)::BIGINT AS budget
  FROM leaf GROUP BY domain),{_fill_sql("x", "", "domain")},
y_n AS (SELECT l.domain, l.lang, sum(l.cap)::BIGINT AS cap, sum(l.tokens)::BIGINT AS tokens,
    {_weight_sql("lang").replace("CASE lang", "CASE l.lang")} AS w, any_value(g.given) AS budget
  FROM leaf l JOIN x_g g ON g.domain = l.domain GROUP BY l.domain, l.lang),{_fill_sql("y", "domain", "lang")},
z_n AS (SELECT l.domain, l.lang, l.source, l.cap, l.tokens, 1 AS w, g.given AS budget
  FROM leaf l JOIN y_g g ON g.domain = l.domain AND g.lang = l.lang),{_fill_sql("z", "domain, lang", "source")},
e AS (SELECT d.*, g.given, g.given // g.tokens AS whole, g.given % g.tokens AS rest,
    unnest(range({MIX_EPOCHS + 1})) AS epoch
  FROM d JOIN (SELECT * FROM z_g WHERE tokens > 0) g
    ON g.domain = d.domain AND g.lang = d.lang AND g.source = d.source),
r AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY domain, lang, source, epoch
    ORDER BY md5('{MIX_SEED}:' || epoch || ':' || doc_id), doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bef FROM e)
SELECT doc_id, domain, lang, source, epoch::INTEGER AS epoch, n::BIGINT AS n_tokens,
    given AS leaf_budget
FROM r WHERE epoch < whole OR (epoch = whole AND bef < rest)"""


@query(MIX_SQL)
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn to target weights over the domain-language-source tree."""
    return mix_sources(documents(spark, sf_dir), MIX_WEIGHTS, MIX_PERMILLE, MIX_EPOCHS,
                       MIX_SEED).drop("__key")


BPE_FILE = "byte_bpe_multi_50k.tiktoken"


@query()
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents encoded by byte-level BPE ranks, and decoded again."""
    path, pattern = public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN
    tokens = encode(documents(spark, sf_dir), path, pattern)
    return decode(tokens, path, pattern).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def _secrets_sql() -> str:
    q = {k: p.replace("'", "''") for k, p in secrets.PATTERNS.items()}
    parts = "\n  UNION ALL ".join(
        f"SELECT doc_id, {i} AS k, regexp_extract_all(t, '{p}') AS hits, "
        f"string_split_regex(t, '{p}') AS gaps FROM d" for i, p in enumerate(q.values()))
    limit = " ".join(
        "WHEN " + " AND ".join(f"regexp_matches(h, '{p}')" for p in ([w] if w else []) + list(ps))
        + f" THEN {secrets.most_sum(bits)}" for w, ps, bits in secrets.CLASSES.values())
    allow = " OR ".join(f"regexp_matches(h, '{p}')" for p in secrets.ALLOW)
    head = secrets.ASSIGN_HEAD.replace("'", "''")
    w = secrets.WINDOW
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
p AS ({parts}),
i AS (SELECT doc_id, k, hits, gaps, unnest(range(1, len(hits) + 1)) AS i FROM p),
s AS (SELECT doc_id, k, hits[i] AS h, (list_sum(list_transform(gaps[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(hits[1:i-1], lambda x: length(x))), 0))::BIGINT AS a FROM i),
c AS (SELECT *, CASE WHEN k = 3 AND regexp_matches(h, '{secrets.BESIDE}') AND NOT ({allow})
    THEN CASE {limit} END END AS most FROM s),
e AS (SELECT *, CASE WHEN most IS NOT NULL THEN list_min(list_transform(range(1, length(h) - {w - 2}),
    lambda j: list_sum(list_transform(map_values(list_aggregate(string_split(h, '')[j:j + {w - 1}], 'histogram')),
      lambda n: ({secrets.C_LOG_C})[n::BIGINT + 1])))) END AS least FROM c),
g AS (SELECT doc_id, k, a, a + length(h) AS b FROM e WHERE CASE k
    WHEN 0 THEN length(regexp_replace(h, '^{head}', '')) >= {secrets.MIN_VALUE}
    WHEN 1 THEN length(h) >= {secrets.MIN_ACCESS} WHEN 2 THEN true
    ELSE most IS NOT NULL AND least <= most END),
l AS (SELECT doc_id, k, a, b, ['assign', 'access', 'hex', 'entropy'][k + 1] || ':' || a || ':' || b AS n FROM g),
o AS (SELECT doc_id, count(*) FILTER (k = 0) AS n0, count(*) FILTER (k = 1) AS n1,
    count(*) FILTER (k = 2) AS n2, count(*) FILTER (k = 3) AS n3,
    string_agg(n, ',' ORDER BY a, k) FILTER (k < 3) AS base, string_agg(n, ',' ORDER BY a, k) AS spans
  FROM l GROUP BY doc_id)
SELECT d.doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
    coalesce(n3, 0) AS n_entropy, sha256(coalesce(base, '')) AS base_sha256,
    coalesce(spans, '') AS spans
FROM d LEFT JOIN o USING (doc_id)"""


@query(_secrets_sql())
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets by fixed patterns and sliding-window entropy."""
    found = secrets.scan_secrets(documents(spark, sf_dir))
    base = F.filter("found", lambda s: s["k"] < 3)
    return found.select(
        "doc_id", *[secrets.of_kind(F.col("found"), k).alias(f"n_{n}")
                    for k, n in enumerate(secrets.KINDS)],
        F.sha2(secrets.named(base), 256).alias("base_sha256"),
        secrets.named(F.col("found")).alias("spans"))


TOKENIZER_FILE = "byte_bpe_50k.json"


@query()
def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents written as token ids with Elias-Fano boundaries, read back."""
    store = write_tokens(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER_FILE))
    return read_tokens(spark, store)


@query()
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of repeated 20-word windows removed from whole documents."""
    return substring_dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query()
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of whole documents."""
    return score_toxicity(documents(spark, sf_dir),
                          read_table(spark, sf_dir, "labels")).drop("__key")


@query()
def op9_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of whole documents from weak labels."""
    return score_quality(documents(spark, sf_dir)).drop("__key")


@query(r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
q AS (SELECT item_id, text, unnest(regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
      FROM (SELECT DISTINCT item_id, text FROM benchmark)),
i AS (SELECT item_id, text, t, count(*) AS qf FROM q GROUP BY ALL),
g AS (SELECT count(*) FILTER (len(ts) > 0) AS docs, sum(len(ts))::BIGINT AS total FROM d),
x AS (SELECT row_number() OVER () AS r, doc_id, len(ts)::BIGINT AS n, ts FROM d),
p AS (SELECT r, doc_id, n, t, count(*) AS tf
      FROM (SELECT r, doc_id, n, unnest(ts) AS t FROM x) SEMI JOIN i USING (t) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
      FROM p, g GROUP BY t),
s AS (SELECT item_id, text, r, doc_id, sum(qf * w * ((1000000000 * tf) //
        (1000 * tf + 8 * (100 - 75 + ((75 * n * docs) // total)))))::BIGINT AS score
      FROM i JOIN p USING (t) JOIN w USING (t), g GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id, text
        ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 10""")
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return search_documents(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


#: Base rules of the registered URL filter, and pattern rules beyond them.
URL_RULES = [
    HostRule("net", "/"), HostRule("example.net", "/en/", "allow"),
    HostRule("example.com", "/de/"), HostRule("org", "/fr/", "allow"),
    *map(PatternRule, [
        "||casino-*.", "||cheap-pills.", "||free-bets.", "||adult-*.", "^casino^", "^poker^",
        "^slots^", "^jackpot^", "^viagra^", "^pills^*buy", "^porn^", "^xxx^", "^escort^",
        "^payday^loans^", "^torrent^*download", "^warez^", "^keygen^", "/wp-login.php", "/cgi-bin/*",
        "/cart/checkout^", "/search?q=", "?sessionid=*", "^replica^watches^", "^free^*^spins^"]),
    *(PatternRule(p, "allow") for p in [
        "^responsible^gambling^", "||*.edu/", "^addiction^help^"]),
]


def _urls_sql() -> str:
    def host(r: HostRule) -> str:
        return (f"CASE WHEN has AND (host = '{r.host}' OR ends_with(host, '.{r.host}')) "
                f"AND starts_with(path, '{r.path}') THEN '{r.name}' END")

    hosts = [r for r in URL_RULES if isinstance(r, HostRule)]
    patterns = [r for r in URL_RULES if isinstance(r, PatternRule)]
    # Allowing patterns first, each in the order given.
    patterns.sort(key=lambda r: r.action != "allow")
    found = " ".join(f"WHEN regexp_matches(u, '{r.regex().replace(chr(92) + 'Z', chr(92) + 'z')}', 's') "
                     f"THEN '{r.pattern}'" for r in patterns)
    allowed = ", ".join(f"'{r.pattern}'" for r in patterns if r.action == "allow")
    return rf"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, contains(coalesce(url, ''), '://') AS has,
    translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path,
    translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u
  FROM pages),
r AS (SELECT *, list_reduce(list_concat([NULL], list_filter([{", ".join(map(host, hosts))}],
      lambda x: x IS NOT NULL)), lambda a, b: CASE WHEN length(coalesce(a, '')) >= length(b) THEN a ELSE b END)
    AS rule, CASE {found} END AS pat FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IS NULL THEN pat END AS pattern,
  CASE WHEN rule IN ({", ".join(f"'{r.name}'" for r in hosts if r.action == "allow")}) THEN 'allow'
       WHEN rule IS NOT NULL THEN 'block' WHEN pat IS NULL OR pat IN ({allowed}) THEN 'allow'
       ELSE 'block' END AS verdict
FROM r"""


@query(_urls_sql())
def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by host rules and patterns."""
    return judge_urls(read_table(spark, sf_dir, "pages", ["page_id", "url"]), URL_RULES)


@query(r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS ws FROM documents),
y AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, (len(ws) < 50)::INT + 2 * (100 * len(list_distinct(ws)) < 65 * len(ws))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false)::INT AS f,
    coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM d LEFT JOIN y USING (doc_id)),
c AS (SELECT part, f, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x
    FROM m GROUP BY part, f),
l AS (SELECT unnest(range(5)) AS k),
o AS (SELECT [a.k, b.k, c.k, d.k, e.k] AS ks FROM l a, l b, l c, l d, l e
    WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (SELECT list_aggregate(list_transform(ks, lambda k: chr((65 + k)::INT)), 'string_agg', '') AS filter_order,
    step, ks[step] AS k,
    coalesce(list_sum(list_transform(ks[1:step - 1], lambda k: 1 << k)), 0)::INT AS bef
    FROM o, (SELECT unnest(range(1, 6)) AS step)),
a AS (SELECT part, filter_order, step::INT AS step,
    sum(n) FILTER (f & (bef | (1 << k)) = 0) AS kept,
    sum(n) FILTER (f & bef = 0 AND (f >> k) & 1 = 1) AS removed,
    sum(n) FILTER (f & bef != 0 AND (f >> k) & 1 = 1) AS redundant,
    sum(n) FILTER (f = 1 << k) AS unique_fails,
    sum(g) FILTER (f & bef = 0 AND (f >> k) & 1 = 1) AS good_lost,
    sum(x) FILTER (f & bef = 0 AND (f >> k) & 1 = 1) AS toxic_lost, any_value(k) AS k
    FROM c, s GROUP BY part, filter_order, step)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
    coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
    coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
    (sum(coalesce(removed, 0)) OVER (PARTITION BY part, k))::BIGINT AS shapley
FROM a""")
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all orders, by source."""
    return filter_audit(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))
