"""Quality rules: per-text counts and cross-document line frequency.

Base rules look at one text (see ``text_counts``).  The corpus rule hashes the
normalised lines of each text, counts for each host in how many distinct
texts a line stands, removes lines above the limit and rejects documents
that this depletes.

* normalised line: words lower-cased (A-Z), joined by one space;
* distinct text: the words of a document, lower-cased (A-Z).  Copies of one
  text, whatever their case and white space, add one to each line, so copies of
  a good document do not remove one another;
* the limit is a share of the host's distinct texts with a floor, so it acts
  alike at every size: ``max(MIN_DOCS, SHARE * distinct texts of the host)``;
* lines count whatever their length;
* depleted: fewer than MIN_WORDS words are left, and they are under half;
* the cleaned text is the text's other lines as they stand, joined by line feeds.

Pairs of line and text are made distinct first, dealt by both; their counts
are then partial-aggregated per task, so a line that stands in a third of all
documents sends one row per task.

Defined cases: null text is empty (base rules fail it); a null host is a host;
null ids and rows that repeat an id are judged row by row; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from wardpulse.llm.rows import KEY, arrow_batches, row_key, shared_table
from wardpulse.llm.words import covered, window_hashes, word_hashes

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\v\f\r"

MIN_DOCS = 10
SHARE = 0.005
SLOT_BITS = 20

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Columns of ``quality_rules`` beside id and KEY.
VERDICT = [*_COUNTS, "n_frequent_words", "base_failed", "kept"]


def text_counts(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    words = text.encode().split()
    n = len(words)
    chars = len(text) - sum(map(text.count, WHITE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    repeat = 0
    if n > REPEAT_WINDOW:
        w = window_hashes(word_hashes(words), REPEAT_WINDOW)
        s = np.sort(w)
        twice = s[1:][s[1:] == s[:-1]]
        if len(twice):
            repeat = int(covered(np.flatnonzero(np.isin(w, twice)), REPEAT_WINDOW, n).sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeat


def line_words(text: str) -> dict[int, int]:
    """Signed hash of each distinct normalised line -> words it covers."""
    out: dict[int, int] = {}
    for line in text.encode().lower().split(b"\n"):
        words = line.split()
        if words:
            h = xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63)
            out[h] = out.get(h, 0) + len(words)
    return out


def without_lines(text: str, frequent: list[int]) -> str:
    """The text without the lines that have one of these signed hashes."""
    gone = set(frequent)
    return "\n".join(x for x in text.split("\n") if not gone.intersection(line_words(x)))


def text_hash(text: str) -> int:
    """Signed hash of the normalised words of a text."""
    return xxhash.xxh3_64_intdigest(b" ".join(text.encode().lower().split())) - (1 << 63)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [t or "" for t in b.column("__text").to_pylist()]
        counts = list(zip(*map(text_counts, texts))) or [()] * len(_COUNTS)
        lines = [line_words(t) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [b.column("__id"), b.column(KEY), b.column("__host"),
             *[pa.array(c, pa.int64()) for c in counts],
             pa.array([text_hash(t) for t in texts], pa.int64()),
             pa.array([list(x) for x in lines], pa.list_(pa.int64())),
             pa.array([list(x.values()) for x in lines], pa.list_(pa.int32()))],
            names=["__id", KEY, "__host", *_COUNTS, "__content", "__lines", "__line_words"])


def _host(host_col: str) -> Column:
    return F.coalesce(F.col(host_col).cast("string"), F.lit("\0"))


def _slot() -> Column:
    return F.pmod(F.xxhash64("__host", "__line"), F.lit(1 << SLOT_BITS))


def _judged(docs: DataFrame, id_col: str, text_col: str, host_col: str, min_docs: int,
            share: float) -> DataFrame:
    """One row per row of ``docs``: __id, KEY, __host, the counts and verdicts of
    ``quality_rules``, and __frequent, the hashes of its lines above the limit
    (null: none)."""
    arrow_batches(docs.sparkSession)
    slim = docs.select(
        F.col(id_col).alias("__id"), row_key(id_col, text_col).alias(KEY),
        _host(host_col).alias("__host"),
        F.col(text_col).cast("string").alias("__text"))
    schema = T.StructType(
        [slim.schema["__id"], T.StructField(KEY, T.LongType()),
         T.StructField("__host", T.StringType())]
        + [T.StructField(c, T.LongType()) for c in _COUNTS]
        + [T.StructField("__content", T.LongType()),
           T.StructField("__lines", T.ArrayType(T.LongType())),
           T.StructField("__line_words", T.ArrayType(T.IntegerType()))])
    scanned = shared_table(
        slim.mapInArrow(_scan, schema).withColumn("__row", F.monotonically_increasing_id()),
        "quality-lines")

    lines = scanned.select("__row", "__host",
                           F.explode(F.arrays_zip("__lines", "__line_words")).alias("__l")
                           ).select("__row", "__host", F.col("__l.__lines").alias("__line"),
                                    F.col("__l.__line_words").alias("__w"))
    hosts = (scanned.select("__host", "__content").distinct()
             .groupBy("__host").agg(F.count(F.lit(1)).alias("__texts")))
    frequent = shared_table(
        scanned.select("__host", "__content", F.explode("__lines").alias("__line"))
        .distinct()
        .groupBy("__host", "__line").agg(F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") > min_docs)
        .join(hosts, "__host")
        .filter(F.col("__n") > F.col("__texts") * F.lit(share))
        .select("__host", "__line"), "quality-frequent")
    # Only lines in the slots of frequent ones are dealt out.
    slots = frequent.select(_slot().alias("__slot")).distinct()
    removed = (lines.join(F.broadcast(slots), _slot() == F.col("__slot"), "left_semi")
               .join(frequent, ["__host", "__line"])
               .groupBy("__row").agg(F.sum("__w").alias("__removed"),
                                     F.collect_list("__line").alias("__frequent")))
    left = F.col("n_words") - F.col("n_frequent_words")
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    depleted = (left < MIN_WORDS) & (2 * left < F.col("n_words"))
    return (scanned.drop("__lines", "__line_words", "__content")
            .join(removed, "__row", "left")
            .withColumn("n_frequent_words", F.coalesce("__removed", F.lit(0)).cast("long"))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & ~depleted))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  host_col: str = "source", min_docs: int = MIN_DOCS,
                  share: float = SHARE) -> DataFrame:
    """One row per row of ``docs``: id, the five counts, n_frequent_words (in
    lines above the limit), base_failed, kept, and KEY."""
    return _judged(docs, id_col, text_col, host_col, min_docs, share).select(
        F.col("__id").alias(id_col), *VERDICT, KEY)


def _cut(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, kind = b.schema.get_field_index(text_col), b.schema.field(text_col).type
            texts = [without_lines(t, f) if f else t for t, f in
                     zip(b.column(at).to_pylist(), b.column("__frequent").to_pylist())]
            yield b.set_column(at, text_col, pa.array(texts, kind)).drop_columns(["__frequent"])
    return run


def clean_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                host_col: str = "source", min_docs: int = MIN_DOCS, share: float = SHARE,
                verdict: Sequence[str] = (), only_kept: bool = False) -> DataFrame:
    """Rows of ``docs``, all columns, texts without their lines above the limit,
    and ``verdict`` (columns of ``quality_rules``; with ``verdict_`` in front where
    ``docs`` has a column of that name)."""
    marks = _judged(docs, id_col, text_col, host_col, min_docs, share)
    if only_kept:
        marks = marks.filter("kept")
    # Rows of one id, text and host are judged alike.
    marks = (marks.select("__id", KEY, "__host", *[F.col(c).alias(f"__v_{c}") for c in verdict],
                          "__frequent")
             .dropDuplicates(["__id", KEY, "__host"]))
    left = docs.withColumns({text_col: F.col(text_col).cast("string"),
                             "__dk": row_key(id_col, text_col), "__dh": _host(host_col)})
    cond = ((F.col("__dk") == F.col(KEY)) & (F.col("__dh") == F.col("__host"))
            & F.col(f"`{id_col}`").eqNullSafe(F.col("__id")))
    taken = {c.lower() for c in docs.columns}
    named = [F.col(f"__v_{c}").alias(f"verdict_{c}" if c in taken else c) for c in verdict]
    rows = left.join(marks, cond).select(*[f"`{c}`" for c in docs.columns], *named, "__frequent")
    return rows.mapInArrow(_cut(text_col), rows.drop("__frequent").schema)


def drop_rejected(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  host_col: str = "source") -> DataFrame:
    """Rows of ``docs`` that the rules keep, all columns, texts without their
    lines above the limit."""
    return clean_texts(docs, id_col, text_col, host_col, only_kept=True)
