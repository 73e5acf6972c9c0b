"""Toxicity by weak supervision.

1. Stems (word starts of 4 to 6 letters, or whole words) that mark toxic rows
   are mined from a bounded sample of labelled training rows (SAMPLE of each
   label, by hash order); with fixed seed words and patterns over them they are
   the voters.
2. A generative label model is fitted to the vote patterns of all documents
   (``label_model``): prior, each voter's answers by class, correlations.
3. A linear classifier on hashed words and votes is trained on the posteriors
   of a bounded sample of documents, and scores every document.

Labels reach only step 1, from rows that are not held out: a row is held out
when crc32(id as text) mod 4 is HELD_OUT.  Score inputs come from the text.

Defined cases: null and empty texts have no votes and get the score of a text
without evidence; ids that repeat in the labels count once (highest label);
null ids are not held out; no usable labels leave the seed voters; an empty
table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from wardpulse.llm.label_model import LabelModel, LinearScorer, fit_label_model, train_scorer
from wardpulse.llm.rows import KEY, arrow_batches, row_key, shared_table

HELD_OUT, FOLDS = 2, 4
SAMPLE = 3000
TRAIN = 4000
THRESHOLD = 0.3
STEMS = 60
STEM_SIZES = (4, 5, 6)
MIN_RATIO, MIN_SHARE, MIN_TEXTS = 25.0, 0.008, 4
HASHED = 1 << 15

#: Fixed seed words.
SEED_WORDS = ("idiot", "moron", "stupid", "scum", "worthless", "pathetic", "loser",
              "disgusting", "trash", "clown")
#: Patterns over the lexicon: lexicon words in a text, share of its words.
MANY_HITS, DENSE = 3, 0.01

_WORD = re.compile(r"[^\W\d_]+")


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == HELD_OUT,
                      F.lit(False))


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def stems_of(words: set[str]) -> set[str]:
    """Whole words as ``word$`` and starts of longer words."""
    out = {w + "$" for w in words}
    for k in STEM_SIZES:
        out.update(w[:k] for w in words if len(w) > k)
    return out


class Voters:
    """Stem voters, then three patterns over their hits."""

    def __init__(self, stems: list[str]):
        self.place = {s: i for i, s in enumerate(stems)}
        self.n = len(stems) + 3

    def _hit(self, word: str) -> list[int]:
        get = self.place.get
        found = [get(word + "$")] + [get(word[:k]) for k in STEM_SIZES if len(word) > k]
        return [f for f in found if f is not None]

    def vote(self, words: list[str]) -> np.ndarray:
        out = np.zeros(self.n, np.int8)
        hits = 0
        distinct: dict[str, int] = {}
        for w in words:
            distinct[w] = distinct.get(w, 0) + 1
        for w, times in distinct.items():
            f = self._hit(w)
            if f:
                out[f] = 1
                hits += times
        out[-3:] = hits > 0, hits >= MANY_HITS, bool(words) and hits >= DENSE * len(words)
        return out


def _stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for toxic, text in zip(b.column("toxic").to_pylist(), b.column("__text").to_pylist()):
            words = set(words_of(text or ""))
            s = list(stems_of(words))
            # Copies mostly share their least word hash, and count once together.
            family = min((xxhash.xxh3_64_intdigest(w.encode()) for w in words), default=0) >> 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(s, pa.string()), pa.array([toxic] * len(s), pa.int32()),
                 pa.array([family] * len(s), pa.int64())], names=["stem", "toxic", "family"])


def mine_stems(docs: DataFrame, labels: DataFrame) -> list[str]:
    """Stems that mark toxic rows in a bounded sample of the training labels."""
    train = (labels.filter("toxic in (0, 1) and doc_id is not null").filter(~held_out("doc_id"))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    order = F.xxhash64("doc_id")
    picked = [train.filter(F.col("toxic") == y).orderBy(order, "doc_id").limit(SAMPLE)
              for y in (0, 1)]
    sample = F.broadcast(picked[0].union(picked[1]).withColumnRenamed("doc_id", "__sid"))
    found = (docs.join(sample, F.col("__id") == F.col("__sid")).select("toxic", "__text")
             .mapInArrow(_stems, "stem string, toxic int, family long").distinct()
             .groupBy("stem").agg(F.sum("toxic").alias("t"),
                                  F.sum(1 - F.col("toxic")).alias("c")))
    sizes = {y: n for y, n in picked[0].union(picked[1]).groupBy("toxic").count().collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    if not pos or not neg:
        return [w + "$" for w in SEED_WORDS]
    ratio = ((F.col("t") + 0.5) / (pos + 1)) / ((F.col("c") + 0.5) / (neg + 1))
    best = (found.filter(F.col("t") >= max(MIN_TEXTS, MIN_SHARE * pos)).filter(ratio >= MIN_RATIO)
            .select("stem", "t", "c", (F.col("t") * F.log(ratio)).alias("gain"))
            .orderBy(F.desc("gain"), "stem").limit(2000).collect())
    chosen: list[str] = []
    for stem, *_ in best:
        if len(chosen) < STEMS and not any(stem.startswith(s) or s.startswith(stem.rstrip("$"))
                                           for s in chosen):
            chosen.append(stem)
    return chosen + [w + "$" for w in SEED_WORDS
                     if not any((w + "$").startswith(s) or s.startswith(w) for s in chosen)]


def _votes(stems: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(stems)
        for b in batches:
            v = [voters.vote(words_of(t or "")).tobytes() for t in b.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("__id"), b.column(KEY), pa.array(v, pa.binary())],
                names=["__id", KEY, "pattern"])
    return run


def start_answers(voters: int) -> np.ndarray:
    """A voter is silent on clean rows and speaks on some toxic ones."""
    out = np.empty((2, voters, 3))
    out[0], out[1] = (0.001, 0.995, 0.004), (0.001, 0.849, 0.15)
    out[1, -3:] = (0.001, 0.199, 0.8)
    return out


def features(words: list[str], votes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed distinct words (unit length together), votes, and the number of
    lexicon stems hit."""
    distinct = sorted(set(words))
    hashed = np.unique(np.fromiter((xxhash.xxh3_64_intdigest(w[:6].encode()) % HASHED
                                    for w in distinct), np.int64, len(distinct)))
    spoken = np.flatnonzero(votes)
    many = math.log1p(int(votes[:-3].sum()))
    return (np.concatenate([hashed, HASHED + spoken, [HASHED + len(votes)]]).astype(np.int64),
            np.concatenate([np.full(len(hashed), 1 / math.sqrt(max(1, len(hashed)))),
                            np.ones(len(spoken)), [many]]))


def _score(stems: list[str], scorer: LinearScorer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(stems)
        for b in batches:
            rows = [features(w, voters.vote(w))
                    for w in (words_of(t or "") for t in b.column("__text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("__id"), b.column(KEY), b.column("held_out"),
                 pa.array(scorer.score([r[0] for r in rows], [r[1] for r in rows]), pa.float64())],
                names=["__id", KEY, "held_out", "score"])
    return run


def train_toxicity(docs: DataFrame, labels: DataFrame) -> tuple[list[str], LabelModel, LinearScorer]:
    """``docs``: (__id, KEY, __text).  The voters' stems, the label model of all
    documents, and the classifier."""
    stems = mine_stems(docs, labels)
    n = Voters(stems).n
    kind = docs.schema["__id"].dataType.simpleString()
    votes = shared_table(docs.mapInArrow(_votes(stems), f"__id {kind}, {KEY} long, pattern binary"),
                         "tox-votes")
    patterns = shared_table(votes.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")),
                            "tox-patterns")
    model = fit_label_model(patterns, start_answers(n), 0.1)

    voters = Voters(stems)

    def featurise(text: str) -> tuple[np.ndarray, np.ndarray]:
        words = words_of(text)
        return features(words, voters.vote(words))

    scorer = train_scorer(docs, votes.filter(~held_out("__id")), model, featurise,
                          HASHED + n + 1, TRAIN)
    return stems, model, scorer


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, KEY, held_out, score, predicted.
    ``labels``: (doc_id, toxic)."""
    arrow_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).alias("__id"), row_key(id_col, text_col).alias(KEY),
                       F.col(text_col).cast("string").alias("__text"))
    stems, _, scorer = train_toxicity(slim, labels.select("doc_id", "toxic"))
    kind = slim.schema["__id"].dataType.simpleString()
    return (slim.withColumn("held_out", held_out("__id"))
            .mapInArrow(_score(stems, scorer), f"__id {kind}, {KEY} long, held_out boolean, score double")
            .select(F.col("__id").alias(id_col), KEY, "held_out", "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))
