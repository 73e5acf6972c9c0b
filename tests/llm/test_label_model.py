"""The label model against a plain loop version, on votes of known accuracy."""

import math
import random
from collections import Counter

import numpy as np
from wardpulse.llm.label_model import ROUNDS, SMOOTH, fit_label_model

ACCURACY = [0.9, 0.8, 0.7, 0.6, 0.85]
START = np.array([[[0.6, 0.2, 0.2]] * 7, [[0.2, 0.2, 0.6]] * 7])


def made_up(n=4000, seed=2):
    """Five voters that abstain now and then, and two that repeat the fourth."""
    rng = random.Random(seed)
    rows, truth = [], []
    for _ in range(n):
        y = rng.random() < 0.3
        votes = [0 if rng.random() < 0.2 else (1 if (rng.random() < a) == y else -1) for a in ACCURACY]
        rows.append((*votes, votes[3], votes[3] if rng.random() < 0.95 else 0))
        truth.append(y)
    return rows, truth


def loop_posterior(prior, answers, discount, row):
    z = math.log(prior / (1 - prior))
    for j, a in enumerate(row):
        z += discount[j] * math.log(answers[1][j][a + 1] / answers[0][j][a + 1])
    return 1 / (1 + math.exp(-z))


def loop_model(counts, prior):
    voters, first = len(next(iter(counts))), prior
    answers = START.tolist()
    for _ in range(ROUNDS):
        before = answers
        size = [0.0, 0.0]
        table = [[[SMOOTH * START[k][j][a] for a in range(3)] for j in range(voters)] for k in (0, 1)]
        for row, n in counts.items():
            q = loop_posterior(prior, answers, [1] * voters, row)
            for k, w in ((0, n * (1 - q)), (1, n * q)):
                size[k] += w
                for j, a in enumerate(row):
                    table[k][j][a + 1] += w
        answers = [[[x / sum(t) for x in t] for t in table[k]] for k in (0, 1)]
        prior = (size[1] + SMOOTH * first) / (sum(size) + SMOOTH)
        if max(abs(x - y) for k in (0, 1) for j in range(voters)
               for x, y in zip(answers[k][j], before[k][j])) < 1e-4:
            break
    shared = [[0.0] * voters for _ in range(voters)]
    for k in (0, 1):
        weight = {r: n * (q if k else 1 - q) for r, n in counts.items()
                  for q in [loop_posterior(prior, answers, [1] * voters, r)]}
        total = sum(weight.values())
        mean = [answers[k][j][2] - answers[k][j][0] for j in range(voters)]

        def cov(i, j):
            return sum(w * r[i] * r[j] for r, w in weight.items()) / total - mean[i] * mean[j]

        for i in range(voters):
            for j in range(voters):
                if i != j:
                    c = cov(i, j) / math.sqrt(max(cov(i, i), 1e-9) * max(cov(j, j), 1e-9))
                    shared[i][j] = max(shared[i][j], min(max(c, 0), 1))
    return prior, answers, [1 / (1 + sum(x * x for x in s)) for s in shared]


def fit(spark, rows):
    counts = Counter(rows)
    patterns = spark.createDataFrame(
        [(bytes(bytearray(np.array(r, np.int8).tobytes())), n) for r, n in counts.items()],
        "pattern binary, n long").repartition(3)
    return counts, fit_label_model(patterns, START[:, :len(rows[0])], 0.5)


def test_equals_loops(spark):
    counts, model = fit(spark, made_up()[0])
    prior, answers, discount = loop_model(counts, 0.5)
    assert math.isclose(model.prior, prior, rel_tol=1e-9)
    assert np.allclose(model.answers, answers, rtol=1e-9)
    assert np.allclose(model.discount, discount, rtol=1e-7)
    some = list(counts)[:50]
    assert np.allclose(model.posterior(np.array(some)),
                       [loop_posterior(prior, answers, discount, r) for r in some])


def test_repeats_are_discounted(spark):
    """Two voters that repeat a third share its weight; the others keep most of theirs."""
    _, model = fit(spark, made_up()[0])
    repeated, own = model.discount[[3, 5, 6]], model.discount[[0, 1, 2, 4]]
    assert repeated.max() < 0.45 and own.min() > 1.5 * repeated.max()


def test_finds_accuracies(spark):
    """Voters that err independently: accuracies, share of the class and truth."""
    rows, truth = made_up()
    rows = [r[:len(ACCURACY)] for r in rows]
    _, model = fit(spark, rows)
    for k, answer in ((1, 2), (0, 0)):
        given = model.answers[k, :, answer] / (model.answers[k, :, 0] + model.answers[k, :, 2])
        assert np.allclose(given, ACCURACY, atol=0.06)
    assert abs(model.prior - 0.3) < 0.05
    assert ((model.posterior(np.array(rows)) > 0.5) == np.array(truth)).mean() > 0.9
