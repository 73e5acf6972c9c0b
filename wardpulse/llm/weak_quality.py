"""Quality classifier by weak labels.

Overlapping heuristic labellers call a text good (+1), poor (-1) or abstain.
Expectation-maximisation over the label patterns of all documents estimates
how each answers on good and on poor texts (``label_model``); the posteriors of
a bounded sample (TRAIN rows of each side, by hash order) train a hashed linear
scorer, which scores every whole text.  No given label is used.

Defined cases: null and empty texts have no words, only the length labeller
speaks; null ids and rows that repeat an id are scored row by row; an empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from wardpulse.llm.label_model import LinearScorer, fit_label_model, train_scorer
from wardpulse.llm.quality_rules import text_counts
from wardpulse.llm.rows import KEY, arrow_batches, row_key, shared_table

TRAIN = 4000
KEEP = 0.5
HASHED = 1 << 14
PRIOR = 0.8

#: Labeller -> (poor at or beyond, good at or within) of its measure.
LIMITS = {
    "symbols": (0.1, 0.02),       # of [#*$%&|<>] per word
    "windows": (0.3, 0.05),       # share of words in repeated windows
    "stutter": (0.3, 0.05),       # share of words equal to the word before
    "capitals": (0.3, 0.12),      # share of letters
    "shouts": (0.3, 0.1),         # '!' per word
    "bars": (0.2, 0.02),          # '|' per word
    "digits": (0.3, 0.1),         # share of characters
    "same_lines": (0.3, 0.01),    # share of lines equal to an earlier one
    "long_words": (0.35, 0.15),   # share of words over 12 characters
    "open_lines": (0.8, 0.3),     # share of lines without an end mark
    "rare_joins": (0.95, 0.75),   # share of words that are not short and lower-case
    "short": (0.8, 0.5),          # 1 / (1 + words / 10)
}


def measures(text: str) -> list[float]:
    """Measures in the order of LIMITS; higher is poorer."""
    n, chars, symbols, dup, repeat = text_counts(text)
    words = text.split()
    w, c = max(1, n), max(1, len(text))
    letters = sum(map(str.isalpha, text))
    lines = [x.strip() for x in text.split("\n") if x.strip()]
    joins = sum(1 for x in words if len(x) <= 4 and x.islower())
    return [symbols / w, repeat / w,
            sum(a == b for a, b in zip(words, words[1:])) / w,
            sum(map(str.isupper, text)) / max(1, letters),
            text.count("!") / w, text.count("|") / w,
            sum(map(text.count, "0123456789")) / c, dup / max(1, len(lines)),
            sum(len(x) > 12 for x in words) / w,
            sum(x[-1] not in ".!?:;\"')" for x in lines) / max(1, len(lines)),
            1 - joins / w, 1 / (1 + n / 10)]


def labels_of(m: list[float]) -> np.ndarray:
    out = np.array([-1 if x >= poor else 1 if x <= good else 0
                    for x, (poor, good) in zip(m, LIMITS.values())], np.int8)
    if m[-1] == 1.0:  # no words: only the length says something
        out[:-1] = 0
    return out


def features(text: str, m: list[float] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed word shapes (unit length together) and binned measures."""
    m = measures(text) if m is None else m
    shapes = {(x[0].isupper(), x.isupper(), x[0].isalpha(), x[-1], min(len(x), 14))
              for x in text.split()}
    hashed = np.unique(np.fromiter((xxhash.xxh3_64_intdigest(repr(s).encode()) % HASHED
                                    for s in shapes), np.int64, len(shapes)))
    bins = [HASHED + 12 * i + min(11, int(12 * x)) for i, x in enumerate(m)]
    return (np.concatenate([hashed, bins]).astype(np.int64),
            np.concatenate([np.full(len(hashed), 1 / math.sqrt(max(1, len(hashed)))),
                            np.ones(len(bins))]))


DIMS = HASHED + 12 * len(LIMITS)


def start_answers() -> np.ndarray:
    out = np.empty((2, len(LIMITS), 3))
    out[0], out[1] = (0.4, 0.2, 0.4), (0.03, 0.12, 0.85)
    return out


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        v = [labels_of(measures(t or "")).tobytes() for t in b.column("__text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(KEY), pa.array(v, pa.binary())],
                                         names=[KEY, "pattern"])


def _score(scorer: LinearScorer, model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column("__text").to_pylist()]
            m = [measures(t) for t in texts]
            rows = [features(t, x) for t, x in zip(texts, m)]
            votes = np.stack([labels_of(x) for x in m]).astype(np.int64) if texts else None
            yield pa.RecordBatch.from_arrays(
                [b.column("__id"), b.column(KEY),
                 pa.array(model.posterior(votes) if texts else [], pa.float64()),
                 pa.array(scorer.score([r[0] for r in rows], [r[1] for r in rows]), pa.float64())],
                names=["__id", KEY, "weak_label", "score"])
    return run


def score_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, KEY, weak_label (the label model's
    posterior of a good text), score, kept (score of KEEP or more)."""
    arrow_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).alias("__id"), row_key(id_col, text_col).alias(KEY),
                       F.col(text_col).cast("string").alias("__text"))
    votes = shared_table(slim.mapInArrow(_votes, f"{KEY} long, pattern binary"), "quality-votes")
    patterns = shared_table(votes.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")),
                            "quality-patterns")
    model = fit_label_model(patterns, start_answers(), PRIOR)
    scorer = train_scorer(slim, votes, model, features, DIMS, TRAIN)
    kind = slim.schema["__id"].dataType.simpleString()
    return (slim.mapInArrow(_score(scorer, model),
                            f"__id {kind}, {KEY} long, weak_label double, score double")
            .select(F.col("__id").alias(id_col), KEY, "weak_label", "score",
                    (F.col("score") >= KEEP).alias("kept")))
