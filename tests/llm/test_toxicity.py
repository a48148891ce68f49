"""Toxicity classifier: held-out accuracy, invariance to identity terms, edges."""

import numpy as np
import pytest

from conftest import SF01
from streamlens.llm import queries, toxicity


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in queries.op3_toxicity(spark, SF01).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    test = [(rows[i], y) for i, y in labels.items() if i in rows and rows[i].held_out]
    hit = sum(r.predicted == y for r, y in test) / len(test)
    assert len(rows) == 1000 and hit > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())


def biased(spark):
    """Toxic texts mention one group more often; the toxic word explains the label."""
    rng = np.random.default_rng(3)
    filler = ["alpha", "beta", "gamma", "delta", "river", "stone", "cloud", "table"]
    rows = []
    for i in range(600):
        toxic = i % 2
        words = list(rng.choice(filler, 6))
        if rng.random() < (0.8 if toxic else 0.1):
            words.append("muslims")
        elif rng.random() < 0.3:
            words.append("christians")
        if toxic and rng.random() < 0.8:
            words.append("scumbag")
        rows.append((i, " ".join(words), toxic))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_counterfactual_term_lowers_false_positives(spark):
    df = biased(spark)
    gap = {}
    for invariance in (0.0, 5.0):
        m = toxicity.fit(df, df, invariance=invariance)
        gap[invariance] = abs(m.score("river stone muslims") - m.score("river stone hindus"))
        assert m.score("you scumbag") > m.score("river stone cloud")
    assert gap[5.0] < 0.1 < gap[0.0]


def test_loss_gradient_matches_brute_force():
    x, y = [[0, 1], [1], [2], []], np.array([1.0, 0, 1, 0])
    pairs = [([0], [2])]
    w, b = toxicity.descend(x, y, pairs, 3, 0.5, 0.01, 3000)

    def loss(v):
        z = np.array([sum(v[i] for i in r) + v[3] for r in x])
        return np.mean(np.log1p(np.exp(z)) - y * z) + 0.5 * (v[0] - v[2]) ** 2 + 0.005 * (v[:3] ** 2).sum()
    best = np.append(w, b)
    assert all(loss(best) <= loss(best + d) + 1e-6 for d in np.random.default_rng(0).normal(0, 0.05, (200, 4)))


def test_edges(spark):
    df = spark.createDataFrame([(1, "bad word", 0.5), (1, "bad word", 0.5), (None, None, None), (2, "", 0.1), (3, "good " * 50000, 0.2)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (None, 1), (9, 1)], "doc_id long, toxic int")
    m = toxicity.fit(df, labels, steps=50)
    got = toxicity.score(df, m).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    none = toxicity.fit(df, labels.limit(0))
    assert none.score(None) == pytest.approx(0.5)
    assert toxicity.score(df.limit(0), none).collect() == []
    assert toxicity.fit(df, labels.where("toxic = 1 and doc_id = 1")).score("x") > 0.5


def test_swaps_stay_on_their_axis():
    assert toxicity.swapped({"the", "women"}) == {"the", "men"}
    assert toxicity.swapped({"the"}) is None
    assert all(a != b for a, b in toxicity.SWAP.items())
