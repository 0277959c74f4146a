"""Leaks against brute force over all items and places."""

import numpy as np

from tallyframe.llm import decontaminate as dc


def _distance(item, text):
    row = [0] * (len(text) + 1)
    for i, ch in enumerate(item):
        new = [i + 1]
        for j, x in enumerate(text):
            new.append(min(row[j] + (ch != x), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_short_items_between_word_borders(spark):
    bench = spark.createDataFrame([(1, "Paris  is it"), (2, "42"), (3, " \n"), (4, None), (5, "é")], "item_id long, text string")
    rows = [(1, "well PARIS is\tit, yes"), (2, "paris is item"), (3, "a42 142 42"), (4, "421 x42"), (5, "42"), (6, "caféé é"), (7, "")]
    got = {(r.doc_id, r.item_id): (r.distance, r.start, r.end)
           for r in dc.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert got == {(1, 1): (0, 5, 16), (3, 2): (0, 8, 10), (5, 2): (0, 0, 2), (6, 5): (0, 6, 7)}


def test_find_leaks_brute_force(spark, monkeypatch):
    monkeypatch.setattr(dc, "SLAB_CHARS", 200)
    rng = np.random.default_rng(4)
    letters = list("abcde ")
    items = ["".join(rng.choice(letters, int(rng.integers(20, 70)))) for _ in range(12)]
    rows = []
    for i in range(120):
        text = list(items[i % 12])
        for _ in range(int(rng.integers(0, 7))):
            at = int(rng.integers(0, len(text)))
            text[at:at + int(rng.integers(0, 2))] = rng.choice(letters, int(rng.integers(0, 2)))
        rows.append((i, "".join(rng.choice(letters, 30)) + "".join(text) + "".join(rng.choice(letters, 20))))
    bench = spark.createDataFrame([(n, t) for n, t in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.distance for r in
           dc.find_leaks(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), bench).collect()}
    want = {}
    for i, text in rows:
        for n, item in enumerate(items):
            a, b = dc.normalise(item.encode()), dc.normalise(text.encode())
            d = _distance(a, b)
            if d <= int(dc.RATE * len(a)) and len(a) >= dc.LEAST:
                want[i, n] = d
    short = {n for n, t in enumerate(items) if len(dc.normalise(t.encode())) < dc.LEAST}
    assert {k: v for k, v in got.items() if k[1] not in short} == want
    assert any(want.values()) and len(want) > 30
