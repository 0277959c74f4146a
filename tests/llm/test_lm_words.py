"""Words beyond the most frequent ones in the language model: learned in context, normalised."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallyframe.llm import lm_score, words


def test_rare_words_are_learned_in_their_context(spark):
    """Two words with one ending and one count, each after a word of its own."""
    lm = lm_score
    filler = " ".join(f"f{i}" for i in range(lm.TOP - 3)) + " aa bb"
    rows = [(i, filler) for i in range(3000)]
    rows += [(i, "aa first_zz") for i in range(3000, 5000)] + [(i, "bb other_zz") for i in range(5000, 7000)]
    tests = ["aa first_zz", "aa other_zz", "bb first_zz", "bb other_zz"]
    rows += [(-1 - i, t) for i, t in enumerate(tests)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.score for r in lm.score_texts(docs, F.col("doc_id") < 0).filter("doc_id < 0").collect()}
    a_first, a_other, b_first, b_other = (got[-1 - i] for i in range(4))
    assert a_first - a_other > 0.05 and b_other - b_first > 0.05


def test_word_probabilities_sum_to_one():
    """All words, and one unseen word an ending, after one context: units drawn without context,
    so that the end's probability is that of the empty text and falls out."""
    lm = lm_score
    rng = np.random.default_rng(5)
    vocab = [f"w{i}".encode() for i in range(600)]
    count = dict(zip(vocab, rng.integers(1, 50, len(vocab)).astype(float)))
    p = {k: rng.normal(0, 0.7, v) for k, v in lm.SHAPES.items()}
    p["target"][:] = 0
    flat = np.concatenate([p[k].reshape(-1) for k in lm.SHAPES]).astype(np.float32)
    hashed = dict(zip(vocab, words.hash_words(vocab).view(np.int64)))
    own = vocab[:lm.TOP - 1]
    end = np.uint64(lm.END).astype(np.int64)
    top = np.array(sorted([*(hashed[w] for w in own), end]), np.int64)
    a_unit = 16
    size, kinds = np.zeros(lm.ENDINGS), np.zeros(lm.ENDINGS)
    mass = np.zeros(lm.ENDINGS * a_unit)
    tail = {w: int(h) % lm.ENDINGS for w, h in zip(vocab, words.hash_words([w[-2:] for w in vocab], 1))}
    for w in vocab[len(own):]:
        size[tail[w]] += count[w]
        kinds[tail[w]] += 1
        mass[tail[w] * a_unit + (hashed[w] & (a_unit - 1))] += count[w] - lm.DISCOUNT
    rows = rng.normal(0, 0.7, (len(mass), lm.DIM)).astype(np.float32)
    norms = np.zeros(((lm.UNITS + 1) ** 2, lm.ENDINGS), np.float32)
    ones = pa.RecordBatch.from_arrays([pa.array(range(lm.UNITS + 1))], ["id"])
    for out in lm._norms(flat, rows, mass, lm.DISCOUNT * kinds)(iter([ones])):
        one = out.column("one")[0].as_py()
        norms[one * (lm.UNITS + 1):(one + 1) * (lm.UNITS + 1)] = np.frombuffer(out.column("norm")[0].as_py()).reshape(-1, lm.ENDINGS)
    unseen = {}
    for i in range(26 ** 2):
        w = f"unseen{chr(97 + i // 26)}{chr(97 + i % 26)}".encode()
        unseen.setdefault(int(words.hash_words([w[-2:]], 1)[0]) % lm.ENDINGS, w)
    prefix = b"w3 w500"
    texts = [prefix] + [prefix + b" " + w for w in vocab + list(unseen.values())]
    block = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([False] * len(texts)),
                                        pa.array([t.decode() for t in texts])], ["doc_id", "held", "text"])
    local, counts, known = words.block_words(texts)
    tails = dict(lm._tail_hashes(known))
    ids = np.concatenate([np.append(x, len(known)) for x in np.split(local, np.cumsum(counts)[:-1])]).astype(np.int32)
    row = pa.table({"doc_ids": [block.column("doc_id").to_pylist()], "held": [block.column("held").to_pylist()],
                    "counts": [(counts + 1).tolist()], "ids": [ids.tobytes()],
                    "hashes": [np.append(words.hash_words(known), np.uint64(lm.END)).tobytes()],
                    "endings": [np.append([tails[w[-2:]] % lm.ENDINGS for w in known], 0).astype(np.uint8).tobytes()]})
    seen = pa.table({"at": [i for i, w in enumerate(known) if w in count] + [len(known)],
                     "c": [count[w] for w in known if w in count] + [500.0]})
    got = lm._score(flat, rows, norms, top, size, kinds, 10_000, 601)(row, seen).column("score").to_numpy()
    after = 10 ** (got[1:] - got[0])
    bias = np.exp(p["bias"] - p["bias"].max())
    bias /= bias.sum()
    at_end = np.searchsorted(top, end)
    assert len(unseen) == lm.ENDINGS
    assert abs(after.sum() + bias[at_end] - 1) < 1e-4
