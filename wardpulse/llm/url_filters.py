"""URL filters: rules indexed by their rarest literal token.

Two kinds of rules, each with the action ``block`` or ``allow``:

* ``HostRule(host, path)`` fits the host and its subdomains when the URL's path
  starts with ``path`` (which starts with ``/``).  The longest that fits wins (of
  equally long ones the first given) and settles the URL;
* ``PatternRule(pattern)`` is text with ``*`` (any run), ``^`` (a separator or an
  end), ``||`` in front (start of the host or of a subdomain), ``|`` (start or
  end of the URL), matched against the URL with A-Z lower-cased.  Without a host
  rule an allowing pattern wins over blocking ones; with neither, the URL is
  allowed.

Either kind becomes a regular expression and a set of literal tokens: runs of
``[a-z0-9]`` that no letter or digit can lengthen where the rule fits, so that
each is a whole token of the URL.  A rule is filed under the one of its tokens that
stands in the fewest URLs, counted over the whole table; a URL looks up its own
tokens and runs the regular expressions of the rules filed there.  Rules without
such a token are tried on every URL.

The rules are the caller's list, so they fit the driver; tasks get at most
RULES_AT_ONCE of them as one broadcast index.  More rules are judged in
slices, the rows written between them.  Host rules of all slices are compared
by length, patterns by action and place in the list.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end,
A-Z lower-cased; the path follows, up to ``?``, ``#`` or the end.

Defined cases: a null URL or one without ``://`` has an empty host and path, and no
host rule fits it; patterns still see such a URL (null: empty text); rows that
repeat an id are judged row by row; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from wardpulse.llm.rows import shared_table

RULES_AT_ONCE = 50_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of tokens as they are (A-Z lower-cased), all others to a space.
_TOKEN_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 else 32
                     for c in range(256))
#: A token of a rule stands between characters that no ``*`` can lengthen.
_BOUNDED = re.compile(r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])")
_SEPARATOR = r"(?:[^a-z0-9_.%-]|\A|\Z)"


class HostRule(NamedTuple):
    host: str
    path: str = "/"
    action: str = "block"

    @property
    def name(self) -> str:
        return self.host + self.path

    def regex(self) -> str:
        """For the host and the path in one string."""
        return r"\A(?:[^/]*\.)?" + re.escape(self.name)

    def tokens(self) -> list[str]:
        return _BOUNDED.findall("." + _lower(self.name))


class PatternRule(NamedTuple):
    pattern: str
    action: str = "block"

    def regex(self) -> str:
        """For the whole URL, A-Z lower-cased."""
        head = body = _lower(self.pattern)
        out = ""
        if head.startswith("||"):
            out, body = r"\A[^/?#]*://(?:[^/?#]*\.)?", body[2:]
        elif head.startswith("|"):
            out, body = r"\A", body[1:]
        tail = r"\Z" if body.endswith("|") else ""
        body = body[:-1] if tail else body
        special = {"*": ".*", "^": _SEPARATOR}
        return out + "".join(special.get(c) or re.escape(c) for c in body) + tail

    def tokens(self) -> list[str]:
        return _BOUNDED.findall(_lower(self.pattern))


Rule = HostRule | PatternRule


def _lower(text: str) -> str:
    return text.translate(str.maketrans(_UPPER, _LOWER))


def url_tokens(url: str) -> set[bytes]:
    """Runs of ``[a-z0-9]``, A-Z lower-cased."""
    return set(url.encode().translate(_TOKEN_BYTES).split())


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")),
                       _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def token_counts(pages: DataFrame, url_col: str, wanted: set[bytes]) -> dict[bytes, int]:
    """URLs that hold each wanted token; counted in tasks, at most one row of each
    task and token moves on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for b in batches:
            for u in b.column("__url").to_pylist():
                seen.update(url_tokens(u) & wanted)
        yield pa.RecordBatch.from_arrays(
            [pa.array([t.decode() for t in seen], pa.string()), pa.array(seen.values(), pa.int64())],
            names=["token", "n"])

    urls = pages.select(F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("__url"))
    rows = (urls.mapInArrow(run, "token string, n long")
            .groupBy("token").agg(F.sum("n").alias("n")).collect())
    return {r.token.encode(): r.n for r in rows}


class RuleIndex:
    """Rules by their rarest token; regular expressions are compiled when first run.
    A rule is (rank, place, name, action), the smallest of a kind wins."""

    def __init__(self, rules: Sequence[tuple[int, Rule]], counts: dict[bytes, int]):
        self.filed: dict[bytes, list[tuple[int, Rule]]] = {}
        self.everywhere: list[tuple[int, Rule]] = []
        self.compiled: dict[int, re.Pattern] = {}
        for place, rule in rules:
            tokens = [t.encode() for t in rule.tokens()]
            if tokens:
                rarest = min(tokens, key=lambda t: (counts.get(t, 0), t))
                self.filed.setdefault(rarest, []).append((place, rule))
            else:
                self.everywhere.append((place, rule))

    def _fits(self, place: int, rule: Rule, target: str) -> bool:
        regex = self.compiled.get(place)
        if regex is None:
            regex = self.compiled[place] = re.compile(rule.regex(), re.S)
        return regex.search(target) is not None

    def candidates(self, url: str) -> list[tuple[int, Rule]]:
        """The rules that a URL must try, with their places."""
        found = [x for t in url_tokens(url) & self.filed.keys() for x in self.filed[t]]
        return found + self.everywhere

    def judge(self, url: str, host: str, path: str) -> tuple[tuple | None, tuple | None]:
        """The winning host rule and the winning pattern."""
        hosts, patterns = [], []
        for place, rule in self.candidates(url):
            if isinstance(rule, HostRule):
                if "://" in url and self._fits(place, rule, host + path):
                    hosts.append((-len(rule.name), place, rule.name, rule.action))
            elif self._fits(place, rule, _lower(url)):
                patterns.append((int(rule.action != "allow"), place, rule.pattern, rule.action))
        return min(hosts, default=None), min(patterns, default=None)


_FOUND = T.StructType([T.StructField("rank", T.IntegerType()), T.StructField("place", T.IntegerType()),
                       T.StructField("name", T.StringType()), T.StructField("action", T.StringType())])
_ARROW_FOUND = pa.struct([("rank", pa.int32()), ("place", pa.int32()), ("name", pa.string()),
                          ("action", pa.string())])


def _judge(shared):
    """Add what one slice of the rules finds, as columns __h1 and __p1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: RuleIndex = shared.value
        names = _ARROW_FOUND.names
        for b in batches:
            found = [index.judge(*x) for x in
                     zip(*(b.column(c).to_pylist() for c in ("__url", "host", "path")))]
            for k, column in enumerate(("__h1", "__p1")):
                b = b.append_column(column, pa.array(
                    [None if f[k] is None else dict(zip(names, f[k])) for f in found], _ARROW_FOUND))
            yield b
    return run


def judge_urls(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id",
               url_col: str = "url", rules_at_once: int = RULES_AT_ONCE) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule (``host + path`` of the host
    rule that won, else null), pattern (the pattern that won where no host rule
    did, else null), verdict."""
    spark, url = pages.sparkSession, F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("__id"), F.coalesce(url, F.lit("")).alias("__url"),
                        host_of(url).alias("host"), path_of(url).alias("path"),
                        F.lit(None).cast(_FOUND).alias("__h"), F.lit(None).cast(_FOUND).alias("__p"))
    counts = token_counts(pages, url_col, {t.encode() for r in rules for t in r.tokens()})
    placed = list(enumerate(rules))
    for start in range(0, len(placed), rules_at_once):
        if start:
            rows = shared_table(rows, "url-slice")
        shared = spark.sparkContext.broadcast(
            RuleIndex(placed[start:start + rules_at_once], counts))
        schema = T.StructType([*rows.schema, T.StructField("__h1", _FOUND),
                               T.StructField("__p1", _FOUND)])
        rows = (rows.mapInArrow(_judge(shared), schema)
                .withColumns({"__h": F.least("__h", "__h1"), "__p": F.least("__p", "__p1")})
                .drop("__h1", "__p1"))
    return rows.select(
        F.col("__id").alias(id_col), "host", "path", F.col("__h")["name"].alias("rule"),
        F.when(F.col("__h").isNull(), F.col("__p")["name"]).alias("pattern"),
        F.coalesce(F.col("__h")["action"], F.col("__p")["action"], F.lit("allow")).alias("verdict"))
