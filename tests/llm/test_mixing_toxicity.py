"""Projected-gradient rates and the averaged bags against brute force; unseen misspellings."""

import numpy as np
import pytest

from tallyframe.llm import mixing, toxicity


def _brute_rates(p, t, wanted, rounds=20000):
    """Plain projected gradient of sum (expected - wanted)^2 / supply, fixed length 1: meets the
    same targets where they can be met."""
    unit, w = t @ p, np.ones(len(t))
    for _ in range(rounds):
        w = np.maximum(0, w - p @ (((w * t) @ p - wanted) / unit))
    return w


@pytest.mark.parametrize("budget", [None, 9000.0, 200000.0])
def test_rates_equal_plain_projected_gradient(spark, budget):
    rng = np.random.default_rng(11)
    p, t = rng.dirichlet([2.0, 1.0, 1.0], 300), rng.integers(0, 90, 300)
    rows = spark.createDataFrame([(i, int(n), x.tolist()) for i, (n, x) in enumerate(zip(t, p))],
                                 "doc_id long, mix_tokens long, mix_p array<double>")
    fitted, target, gap = mixing.fit_rates(rows, [0.2, 0.5, 0.3], budget)
    w = np.array([r.rate for r in fitted.orderBy("doc_id").collect()])
    want = _brute_rates(p, t.astype(float), np.array(target))
    assert w.min() >= 0 and (w * t) @ p == pytest.approx((want * t) @ p, rel=1e-5)
    assert gap == pytest.approx(max(abs((w * t) @ p - target) / target), abs=1e-6)


def test_rates_cut_at_zero(spark):
    """Targets out of reach: the unwanted domain goes to 0 and the wanted one is met."""
    rows = spark.createDataFrame([(0, 10, [1.0, 0.0]), (1, 10, [0.0, 1.0]), (2, 0, [0.5, 0.5])],
                                 "doc_id long, mix_tokens long, mix_p array<double>")
    fitted, target, gap = mixing.fit_rates(rows, [1.0, 0.0], 30.0)
    w = {r.doc_id: r.rate for r in fitted.collect()}
    assert target == [30.0, 0.0] and w[0] == pytest.approx(3) and w[1] == pytest.approx(0, abs=1e-8) and gap < 1e-8
    nothing = mixing.fit_rates(rows.limit(0), [1.0, 0.0], None)
    assert nothing[0].count() == 0 and nothing[2] == 0


def _texts(rng, n, bad):
    plain = ["".join(rng.choice(list("abcdeilmnorstu"), 6)) for _ in range(80)]
    rows = []
    for i in range(n):
        put = list(rng.choice(plain, 3 + i % 40))
        if i % 4 == 0:
            put[i % len(put)] = str(rng.choice(bad))
        rows.append((" ".join(put), int(i % 4 == 0)))
    return rows


def test_unseen_misspellings_share_vectors():
    rng = np.random.default_rng(3)
    rows = _texts(rng, 600, ["zzgrobnak", "vuxplunk", "quazzlix"])
    model = toxicity.fit([t.encode() for t, _ in rows], np.array([y for _, y in rows]), 0.25)
    plain = rows[1][0].split()[:3]
    seen, odd, clean = (toxicity._logits(model, [" ".join([*plain, w]).encode()])[0]
                        for w in ("zzgrobnak", "zzgrobnakk", "mirelsoda"))
    assert seen > odd > clean and odd - clean > 0.5 * (seen - clean) > 0


def test_text_is_the_weighted_average_of_its_spans():
    rng = np.random.default_rng(4)
    model = toxicity.Model(rng.normal(0, 1, toxicity.BUCKETS).astype(np.float32), -0.3)
    texts = ["", "one", "one two", "the quick brown fox jumps over it", " ".join(["word", "other"] * 400)]
    got = toxicity._logits(model, [t.encode() for t in texts])
    for text, z in zip(texts, got):
        words = text.split()
        if not words:
            assert z == model.bias
            continue
        bag = []
        for w in words:
            bucket, _ = toxicity._subwords([w.encode()])
            bag.append(model.weights[bucket].astype(float).mean())
        spans = np.array([np.mean(bag[i:i + toxicity.SPAN]) for i in range(max(1, len(bag) - toxicity.SPAN + 1))])
        weight = np.exp(toxicity.SHARP * (spans - spans.max()))
        assert z == pytest.approx(model.bias + (weight * spans).sum() / weight.sum(), rel=1e-4, abs=1e-4)
