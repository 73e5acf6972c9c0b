"""Secret scan: fixed patterns, and sliding-window entropy of candidate strings.

All of it is DataFrame functions.  Kinds, in listed order:

* ``assign``, ``access``, ``hex``: the fixed patterns, leftmost matches that do
  not overlap, short ones dropped after matching;
* ``entropy``: runs of WINDOW or more base64/url characters.  A window slides
  over the run; counts of its characters are kept by adding the one that enters
  and taking off the one that leaves, and with them the sum of ``c * log2 c``,
  as an integer from a table, so the entropy needs no second pass.  A run is
  reported when its best window reaches the threshold of the run's character
  class, unless an allow-list pattern fits it.

Texts that hold no match take no further part; the others are split at their
matches, and running sums of the lengths give code-point positions.

Defined cases: null text is empty; rows that repeat an id stay rows of their
own; null ids stay null; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardpulse.llm.rows import text_or_empty

_NAMES = ("password", "passwd", "secret", "token")


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" for c in word)


#: Kind -> (pattern, pattern whose first match starts a value, least length).
ASSIGN_HEAD = ("(?:" + "|".join(map(_either_case, _NAMES))
               + f"|{_either_case('api')}_?{_either_case('key')})"
               + r"""["']?\x20*[:=]\x20*["']?""")
PATTERNS = {
    "assign": ASSIGN_HEAD + "[A-Za-z0-9+/_.=-]+",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]{24,}",
    "entropy": "[A-Za-z0-9+/_-]{20,}={0,2}",
}
KINDS = tuple(PATTERNS)
MIN_VALUE, MIN_ACCESS = 6, 20

WINDOW = 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
#: Class -> (pattern that all of the run fits, or None; patterns it must hold;
#: least bits per character).  The first class that fits counts.
CLASSES = {
    "hex": ("^[0-9a-fA-F]+$", ("[0-9]", "[a-fA-F]"), 3.0),
    "mixed": (None, ("[A-Z]", "[a-z]", "[0-9]"), 3.8),
    "upper": (None, ("[A-Z]", "[0-9]"), 3.5),
    "lower": (None, ("[a-z]", "[0-9]"), 3.5),
}
#: Runs that are no secrets: identifiers in UUID form, placeholders, counting
#: or alphabet sequences.
ALLOW = (
    "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    "EXAMPLE|[Ee]xample|[Pp]laceholder|[Xx]{6}|[0]{8}",
    "0123456789|123456789|abcdefghij|ABCDEFGHIJ",
)
#: Slugs, paths and dates: no digit stands beside a letter.
BESIDE = "[0-9][A-Za-z]|[A-Za-z][0-9]"

_ONE = 1 << 20
#: c * log2 c in units of 1 / _ONE, for counts up to that of a full window and
#: the character that enters before another leaves.
C_LOG_C = [0] + [round(c * math.log2(c) * _ONE) for c in range(1, WINDOW + 2)]


def most_sum(bits: float) -> int:
    """Largest sum of ``c * log2 c`` at which a window has ``bits`` of entropy."""
    return math.floor(WINDOW * (math.log2(WINDOW) - bits) * _ONE)


def _run_limit(run: Column) -> Column:
    """The class's limit on the sum; null when no class fits."""
    out = F.lit(None).cast("long")
    for whole, parts, bits in reversed(CLASSES.values()):
        fits = F.lit(True) if whole is None else run.rlike(whole)
        for p in parts:
            fits = fits & run.rlike(p)
        out = F.when(fits, F.lit(most_sum(bits)).cast("long")).otherwise(out)
    return out


def _least_sum(run: Column) -> Column:
    """Least sum of ``c * log2 c`` over the windows of a run."""
    table = F.array(*[F.lit(v).cast("long") for v in C_LOG_C])
    code = F.transform(F.split(run, ""), lambda ch: F.instr(F.lit(ALPHABET), ch))
    start = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("counts"),
        F.lit(0).cast("long").alias("sum"), F.lit(1 << 40).cast("long").alias("best"))

    def step(state: Column, x: Column) -> Column:
        i, ch, gone = x["i"], x["ch"], x["gone"]
        added = F.transform(state["counts"], lambda v, k: v + F.when(k == ch, 1).otherwise(0))
        n_in = F.element_at(added, ch + 1)
        total = state["sum"] + F.element_at(table, n_in + 1) - F.element_at(table, n_in)
        n_out = F.element_at(added, gone + 1)
        less = F.when(gone > 0, F.element_at(table, n_out + 1)
                      - F.element_at(table, F.greatest(n_out, F.lit(1)))).otherwise(0)
        total = (total - less).cast("long")
        counts = F.transform(added, lambda v, k: v - F.when((k == gone) & (gone > 0), 1).otherwise(0))
        best = F.when(i >= WINDOW - 1, F.least(state["best"], total)).otherwise(state["best"])
        return F.struct(counts.alias("counts"), total.alias("sum"), best.alias("best"))

    steps = F.transform(code, lambda ch, i: F.struct(
        i.alias("i"), ch.alias("ch"),
        F.when(i >= WINDOW, F.element_at(code, F.greatest(i - WINDOW + 1, F.lit(1))))
        .otherwise(0).alias("gone")))
    return F.aggregate(steps, start, step, lambda s: s["best"])


def high_entropy(run: Column) -> Column:
    allowed = F.lit(False)
    for p in ALLOW:
        allowed = allowed | run.rlike(p)
    limit = F.when(run.rlike(BESIDE) & ~allowed, _run_limit(run))
    return F.when(limit.isNotNull(), _least_sum(run) <= limit).otherwise(False)


def _parts(kind: str) -> Column:
    """Text before each match and the match, numbered; the last has no match."""
    pattern, k = PATTERNS[kind], KINDS.index(kind)
    zipped = F.arrays_zip(F.split("__text", pattern, -1).alias("gap"),
                          F.regexp_extract_all("__text", F.lit(pattern), F.lit(0)).alias("hit"))
    cut = F.transform(zipped, lambda x, i: F.struct(
        F.lit(k).alias("k"), i.alias("i"), F.length(x["gap"]).alias("gap"), x["hit"].alias("hit")))
    empty = F.slice(cut, 1, 0)
    return F.when(F.col("__text").rlike(pattern), cut).otherwise(empty)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id and ``found``, an array of (start, k, end)
    by start and kind; ``k`` is the place in KINDS, positions are code points,
    ends are exclusive."""
    slim = docs.select(F.col(id_col).alias("__id"), text_or_empty(text_col).alias("__text"))
    some = F.col("__text").rlike(PATTERNS["assign"]) | F.col("__text").rlike(PATTERNS["access"]) \
        | F.col("__text").rlike(PATTERNS["entropy"])
    slim = slim.withColumn("__some", some)
    none = slim.filter(~F.col("__some")).select(
        F.col("__id").alias(id_col),
        F.expr("cast(array() as array<struct<start:int,k:int,end:int>>)").alias("found"))

    hits = (slim.filter("__some").withColumn("__row", F.monotonically_increasing_id())
            .select("__row", "__id", F.explode(F.concat(*map(_parts, KINDS))).alias("p"))
            .select("__row", "__id", "p.*"))
    line = Window.partitionBy("__row", "k").orderBy("i")
    start = (F.sum("gap").over(line.rowsBetween(Window.unboundedPreceding, 0))
             + F.coalesce(F.sum(F.length("hit")).over(
                 line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    value = F.length(F.regexp_replace("hit", "^" + ASSIGN_HEAD, ""))
    good = (F.when(F.col("k") == 0, value >= MIN_VALUE)
            .when(F.col("k") == 1, F.length("hit") >= MIN_ACCESS)
            .when(F.col("k") == 2, F.lit(True))
            .otherwise(high_entropy(F.col("hit"))))
    spans = hits.withColumn("start", start.cast("int")).withColumn(
        "good", F.col("hit").isNotNull() & good)
    span = F.struct("start", "k", (F.col("start") + F.length("hit")).cast("int").alias("end"))
    found = spans.groupBy("__row", "__id").agg(
        F.array_sort(F.collect_list(F.when(F.col("good"), span))).alias("found"))
    return none.unionByName(found.select(F.col("__id").alias(id_col), "found"))


def named(found: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(
        ":", F.element_at(names, s["k"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def of_kind(found: Column, k: int) -> Column:
    return F.size(F.filter(found, lambda s: s["k"] == k)).cast("long")
