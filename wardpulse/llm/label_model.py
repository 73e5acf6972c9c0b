"""Weak supervision: a generative label model and a hashed linear scorer.

Voters give +1, -1 or 0 (abstain) on a document.  The model holds, for each
class, how often a voter gives each answer; expectation-maximisation fits it on
the counts of all vote patterns, one aggregation over the patterns a round, and
a last round measures how voters agree within a class, beyond chance.  A voter
that repeats others is discounted by that, so that a family of near-identical
voters does not count as many witnesses.

The scorer is a logistic regression on hashed features, fitted to posteriors of
a bounded sample.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardpulse.llm.rows import KEY

ROUNDS = 12
SMOOTH = 1.0


@dataclass
class LabelModel:
    prior: float
    answers: np.ndarray  # (2 classes, voters, 3 answers: -1, 0, 1)
    discount: np.ndarray  # (voters,)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(class 1) of rows of votes."""
        odds = np.log(self.answers[1] / self.answers[0]) * self.discount[:, None]
        z = np.log(self.prior / (1 - self.prior)) + sum(
            odds[j][votes[:, j] + 1] for j in range(votes.shape[1]))
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def unpack_votes(patterns: list[bytes], voters: int) -> np.ndarray:
    return np.frombuffer(b"".join(patterns), np.int8).reshape(-1, voters).astype(np.int64)


def _sums(patterns: DataFrame, voters: int,
          posterior: Callable[[np.ndarray], np.ndarray], pairs: bool) -> np.ndarray:
    """Posterior-weighted counts over all patterns: per class the size, then
    the answers of each voter, then (``pairs``) joint non-abstaining answers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if not b.num_rows:
                continue
            v = unpack_votes(b.column("pattern").to_pylist(), voters)
            n = b.column("n").to_numpy().astype(float)
            q = posterior(v)
            parts = []
            for w in (n * (1 - q), n * q):
                parts.append([w.sum()])
                parts.append(np.stack([((v == a) * w[:, None]).sum(0) for a in (-1, 0, 1)], 1).ravel())
                if pairs:
                    parts.append((v.T @ (v * w[:, None])).ravel())
            row = np.concatenate(parts)
            total = row if total is None else total + row
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["i", "x"])

    per = 1 + 3 * voters + (voters * voters if pairs else 0)
    out = np.zeros(2 * per)
    # One row for each parameter, whatever the input.
    for i, x in patterns.mapInArrow(run, "i int, x double").groupBy("i").agg(
            F.sum("x")).collect():
        out[i] = x
    return out.reshape(2, per)


def fit_label_model(patterns: DataFrame, start: np.ndarray, prior: float,
                    rounds: int = ROUNDS) -> LabelModel:
    """``patterns``: (pattern binary of int8 votes, n).  ``start``: (2, voters,
    3) answers to begin with; it also says which class is which, and serves as
    SMOOTH pseudo-counts."""
    voters = start.shape[1]
    model = LabelModel(prior, start, np.ones(voters))

    def refit(s: np.ndarray) -> LabelModel:
        sizes = s[:, 0]
        counts = s[:, 1:1 + 3 * voters].reshape(2, voters, 3) + SMOOTH * start
        p = (sizes[1] + SMOOTH * prior) / (sizes.sum() + SMOOTH)
        return LabelModel(float(np.clip(p, 1e-4, 1 - 1e-4)),
                          counts / counts.sum(2, keepdims=True), np.ones(voters))

    for _ in range(rounds):
        before = model
        model = refit(_sums(patterns, voters, model.posterior, False))
        if np.abs(model.answers - before.answers).max() < 1e-4:
            break
    s = _sums(patterns, voters, model.posterior, True)
    shared = np.zeros((voters, voters))
    for k in (0, 1):
        if s[k, 0] <= 0:
            continue
        mean = model.answers[k] @ np.array([-1.0, 0.0, 1.0])
        second = s[k, 1 + 3 * voters:].reshape(voters, voters) / s[k, 0]
        cov = second - np.outer(mean, mean)
        sd = np.sqrt(np.clip(np.diag(cov), 1e-9, None))
        shared = np.maximum(shared, np.clip(cov / np.outer(sd, sd), 0, 1))
    np.fill_diagonal(shared, 0)
    model.discount = 1 / (1 + (shared ** 2).sum(1))
    return model


@dataclass
class LinearScorer:
    bias: float
    weights: np.ndarray

    def score(self, slots: list[np.ndarray], values: list[np.ndarray]) -> np.ndarray:
        z = np.array([v @ self.weights[s] if len(s) else 0.0 for s, v in zip(slots, values)])
        return 1 / (1 + np.exp(-np.clip(z + self.bias, -35, 35)))


def fit_linear(slots: list[np.ndarray], values: list[np.ndarray], target: np.ndarray,
               weight: np.ndarray, dims: int, l2: float = 1e-4, steps: int = 300) -> LinearScorer:
    """Logistic regression on sparse rows and soft targets (Adam, full batch)."""
    if not len(target):
        return LinearScorer(-10.0, np.zeros(dims))
    row = np.repeat(np.arange(len(slots)), [len(s) for s in slots])
    col, val = np.concatenate(slots), np.concatenate(values)
    weight = weight / weight.sum()
    w, m, v = np.zeros(dims + 1), np.zeros(dims + 1), np.zeros(dims + 1)
    for t in range(1, steps + 1):
        z = np.bincount(row, val * w[col], len(slots)) + w[-1]
        err = (1 / (1 + np.exp(-np.clip(z, -35, 35))) - target) * weight
        g = np.append(np.bincount(col, val * err[row], dims), err.sum())
        g[:-1] += l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return LinearScorer(float(w[-1]), w[:-1])


def judged(votes: DataFrame, model: LabelModel) -> DataFrame:
    """``votes`` (with a column ``pattern``) and the posterior ``p``."""
    voters = model.answers.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = model.posterior(unpack_votes(b.column("pattern").to_pylist(), voters)) \
                if b.num_rows else []
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p, pa.float64())],
                                             names=[*b.schema.names, "p"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in votes.schema)
    return votes.mapInArrow(run, kinds + ", p double")


def train_scorer(docs: DataFrame, votes: DataFrame, model: LabelModel,
                 featurise: Callable[[str], tuple[np.ndarray, np.ndarray]], dims: int,
                 per_side: int) -> LinearScorer:
    """Linear scorer on posteriors of at most ``per_side`` rows of each side (by
    hash order), weighted back to the model's prior.  ``docs``: KEY, __text."""
    rows = judged(votes, model).select(KEY, "p")
    sides = [rows.filter(c).orderBy(F.xxhash64(KEY), KEY).limit(per_side)
             for c in ("p >= 0.5", "p < 0.5")]
    sample = F.broadcast(sides[0].union(sides[1]).select(F.col(KEY).alias("__sk"), "p"))
    rows = docs.join(sample, F.col(KEY) == F.col("__sk")).dropDuplicates([KEY]).select("p", "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            r = [featurise(t or "") for t in b.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("p"), pa.array([x[0] for x in r], pa.list_(pa.int32())),
                 pa.array([x[1] for x in r], pa.list_(pa.float32()))], names=["p", "slots", "values"])

    t = rows.mapInArrow(run, "p double, slots array<int>, values array<float>").toArrow()
    p = t.column("p").to_numpy()
    weight = np.where(p >= 0.5, model.prior / max(1, (p >= 0.5).sum()),
                      (1 - model.prior) / max(1, (p < 0.5).sum()))
    return fit_linear([np.array(x, np.int64) for x in t.column("slots").to_pylist()],
                      [np.array(x, float) for x in t.column("values").to_pylist()], p, weight, dims)
