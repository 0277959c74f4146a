"""Hard negatives against brute force, and the intervals against true scores."""

import numpy as np
import pytest

from tallyframe.llm import hard_negatives as hn


def _brute(rows):
    rows = [(i, l, np.array(v, np.int64)) for i, l, v in rows]
    out = set()
    anchors = {}
    for i, l, v in rows:
        if i % 100 == 0 and (i not in anchors or (l, v.tolist()) < (anchors[i][0], anchors[i][1].tolist())):
            anchors[i] = (l, v)
    for a, (la, va) in anchors.items():
        scored = [(-int(va @ v), i, l) for i, l, v in rows if i != a]
        pos = sorted((s, i) for s, i, l in scored if l == la)[:5]
        neg = sorted((s, i) for s, i, l in scored if l != la)
        for ps, p in pos:
            inside = [(s, i) for s, i in neg if 30 * -ps <= 100 * -s <= 90 * -ps][:10]
            out |= {(a, p, n + 1, i, -ps, -s) for n, (s, i) in enumerate(inside)}
    return out


def _run(spark, rows, parts=3):
    df = spark.createDataFrame([(i, l, v, i % 100 == 0) for i, l, v in rows],
                               "vec_id long, label long, v array<long>, anchor boolean").repartition(parts)
    got = [tuple(r) for r in hn.hard_negatives(df).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_intervals_hold_the_true_score():
    rng = np.random.default_rng(3)
    for dim in (64, 128):
        turn = hn.rotation(dim)
        v = rng.integers(-300, 300, (200, dim))
        v[:20] *= rng.integers(0, 2, (20, dim))
        v[20] = 0
        q = np.concatenate([rng.integers(-300, 300, (30, dim)), v[:5], np.zeros((1, dim), np.int64)])
        lo, hi = hn.intervals(*hn.encode(v.astype(float), turn), q @ turn.T)
        true = q @ v.T
        assert (lo <= true).all() and (true <= hi).all()
        loose = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(v, axis=1)
        assert np.median((hi - lo)[:30, 21:]) < 1.4 * np.median(loose[:30, 21:])     # against 2 without codes


@pytest.mark.parametrize("seed", [0, 1])
def test_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(hn, "ROWS", 64)
    monkeypatch.setattr(hn, "ANCHORS", 3)
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 60, (6, 20))
    rows = []
    for i in range(900):
        label = int(rng.integers(0, 6))
        rows.append((i, label, (centre[label if i % 9 else 0] + rng.normal(0, 60, 20)).astype(int).tolist()))
    assert _run(spark, rows) == _brute(rows)


def test_edges(spark):
    same = [3] * 8
    rows = [(100, 1, same), (200, 1, [0] * 8), (300, 2, [-1] * 8), (400, 9, same), (400, 8, same)]
    rows += [(i, 1 + i % 3, same) for i in range(1, 60)]            # ties only
    rows += [(100, 1, same), (7, 1, [3, 3]), (8, 2, []), (9, 2, [1, 1, 1, 1, 1, 1, 1, 1]), (9, 2, [1] * 8), (10, 3, [2] * 8)]
    assert _run(spark, rows) == _brute([(i, l, v + [0] * (8 - len(v))) for i, l, v in rows])
    assert _run(spark, []) == set()
    assert _run(spark, [(100, 1, same)]) == set()


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, [0.5, -0.001], "x"), (2, None, [1.0], "x"), (3, 1, None, "x"), (4, 1, [1.0, None], "x"), (5, 1, [nan], "x"),
            (6, 1, [-inf], "x"), (None, 1, [1.0], "x"), (100, 2, [], "x")]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>, v string")
    assert sorted((r.vec_id, r.v, r.anchor) for r in hn.integer_vectors(df).collect()) == [(1, [128, -1], False), (100, [], True)]
