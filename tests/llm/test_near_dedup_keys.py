"""Near duplicates: tiny slabs, ids that are null or name several texts, and the pipeline's stage."""

import itertools

import numpy as np
import pytest

import corpus_pipeline
from tallyframe.llm import near_dedup, words

BASE = [f"w{i}" for i in range(60)]


def _changed(*at, tail=0):
    return " ".join(f"x{i}" if i in at else w for i, w in enumerate(BASE)) + " more" * tail


@pytest.mark.parametrize("k", [2, 4, 5])
def test_slabs_of_few_words(monkeypatch, k):
    monkeypatch.setattr(words, "SLAB", 2)
    for sizes in itertools.product(range(6), repeat=3):
        texts = [" ".join(f"t{i}{j}" for j in range(n)).encode() for i, n in enumerate(sizes)]
        ids, counts, known = words.block_words(texts)
        found, n = words.shingles(ids, counts, words.hash_words(known), k)
        assert n.tolist() == [0 if s == 0 else max(1, s - k + 1) for s in sizes]
        assert len(found) == n.sum()


def test_short_texts_only(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "A  b"), (3, "c"), (4, "")], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect()}
    assert got == {1: (1, 1, True), 2: (1, 1, False), 3: (1, 3, True), 4: (0, 4, True)}


def test_a_text_without_an_id_links(spark):
    more = [f"y{i}" for i in range(8)]
    rows = [(1, _changed()), (None, " ".join(BASE + more)), (3, " ".join(BASE[8:] + more)),
            (None, "alone in this table it is"), (-4, "far " * 9)]
    s = [set(zip(*[t.split()[i:] for i in range(5)])) for _, t in rows[:3]]
    sim = [len(x & y) / len(x | y) for x, y in ((s[0], s[1]), (s[1], s[2]), (s[0], s[2]))]
    assert sim[0] >= 0.8 and sim[1] >= 0.8 and sim[2] < 0.8
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.component_id), r.kept, r.first) for r in near_dedup.near_duplicates(df).collect())
    assert got == [("-4", "-4", True, True), ("1", "1", True, True), ("3", "1", False, False),
                   ("None", "1", False, False), ("None", "None", False, True)]


def test_an_id_of_two_texts(spark):
    other = " ".join(f"v{i}" for i in range(50))
    rows = [(5, _changed()), (5, other), (8, other + " end"), (9, _changed(59)), (5, other)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect())
    assert got == [(5, 5, True), (5, 5, True), (5, 5, True), (8, 5, False), (9, 5, False)]
    kept = corpus_pipeline.drop_near_duplicates(spark, df.selectExpr("*", "'c' AS first", "1 AS component_id"), "")
    assert kept.columns == ["doc_id", "text", "first", "component_id"]
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(5, _changed()), (5, other)])


def test_families_of_many_near_copies(spark):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(BASE * 3 + [f"e{i}"])) for i in range(700)]
    rows += [(1000 + i, " ".join(rng.choice(BASE, 40))) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df).collect()}
    assert all(got[i] == (0 if i < 1000 else i) for i, _ in rows)
