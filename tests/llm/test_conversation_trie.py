"""The conversation trie against a plain dictionary of prefixes."""

import hashlib
import re
import zlib
from collections import defaultdict

import pytest

from tallyframe.llm import conversation_trie as ct

SCHEMA = "conv_id long, turn long, role string, text string, node string, path string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _key(role, text):
    r, t = role or "", text or ""
    digest = hashlib.md5(f"{len(r.encode())}:{r}{t}".encode()).digest()
    return digest + len(re.findall(r"[^\x20\x09-\x0D]+", t)).to_bytes(4, "big")


def _brute(rows, group=20, heads=4):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), _key(role, text)))
    own = {c: [k for _, k in sorted(v)] for c, v in own.items()}
    nodes = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (abs(c) % group) * (1 if c >= 0 else -1)
        path = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            nodes[path[:d]].append((c, len(path) == d))
    children = defaultdict(int)
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(members) - 1) * int.from_bytes(p[-1][16:], "big") if p else 0
    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c, last in members if last))
        out.append((min(c for c, _ in members), len(p), min(c for c, _ in nodes[p[:-1]]) if p else None, len(members),
                    children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def _run(spark, rows, parts=4):
    df = spark.createDataFrame([tuple(r) + ("clash", "clash") for r in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r[c] for c in COLUMNS) for r in ct.conversation_trie(df).collect()), key=str)


@pytest.mark.parametrize("chunk", [8, 1 << 16])
def test_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(ct, "CHUNK", chunk)
    rows = []
    for c in range(-45, 260):                        # families of common beginnings, one copied often
        if c % 13 == 5:
            continue                                 # absent, some of them first of their group
        for t in range(c % 6 + (c % 5 == 0)):
            rows.append((c, t, ("system", "user", "assistant")[t % 3], f"turn {t} says {c % 3 if t > 1 else 0} words {'x ' * (c % 4)}"))
    for c in range(300, 340):                        # copies of a conversation
        rows += [(c, t, "user", f"copy {t}") for t in range(3)]
    for c in (400, 401, 419, 420):                   # long ones: exactly one block, a block and one, three blocks
        rows += [(c, t, "user", f"long {t}") for t in range({400: 16, 401: 17, 419: 40, 420: 32}[c])]
    assert _run(spark, rows) == _brute(rows)


def test_nulls_ties_repeats(spark):
    rows = [(0, None, None, None), (0, 1, "a", "b c"), (0, 1, "a", "b c"), (0, 1, "z", "b"), (1, 5, "ab", ""), (1, 6, "a", "b"),
            (2, None, "u", " \t "), (2, None, "v", "w" * 100_000), (None, 1, "a", "lost"), (20, 3, "a", None), (21, 1, "a", None),
            (7, 1, None, None), (7, 1, None, None)]
    assert _run(spark, rows) == _brute(rows)
    assert _run(spark, []) == []
    assert _run(spark, [(None, 1, "a", "b")]) == []


def test_turnless_conversation_is_a_member_of_the_root(spark):
    c = next(i for i in range(1, 20) if zlib.crc32(str(i).encode()) % 4 == 3)      # no first conversation: 2 turns fall away
    rows = [(c, 0, "u", "x"), (c, 1, "u", "y"), (c + 20, 0, "u", "z z")]
    got = _run(spark, rows)
    assert got == _brute(rows)
    assert any(r[1] == 0 and r[3] == 2 for r in got)


def test_rows_without_a_turn_are_left_out_before_the_shuffle(spark):
    """Prefixes that do not exist are filtered between ROLLUP's expansion and its first sums."""
    df = spark.createDataFrame([(1, 1, b"x", *[b"t"] * ct.WIDTH)], "conv_id long, n long, node binary, " +
                               ", ".join(f"t{i} binary" for i in range(1, ct.WIDTH + 1)))
    plan = ct._down(df, 0)._jdf.queryExecution().optimizedPlan().toString()
    aggregate, filtered, expand = (plan.index(x) for x in ("Aggregate", "Filter", "Expand"))
    assert aggregate < filtered < expand


def test_jobs_and_plans_do_not_follow_the_longest_conversation(spark, monkeypatch):
    """33 blocks: every node right, a few tables written, the last plan no longer than a short table's."""
    written = []
    scratch = ct.tables.scratch
    monkeypatch.setattr(ct.tables, "scratch", lambda df, name: written.append(name) or scratch(df, name))

    def run(rows):
        written.clear()
        df = ct.conversation_trie(spark.createDataFrame([tuple(r) + ("clash", "clash") for r in rows], SCHEMA).repartition(4))
        got = sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)
        assert got == _brute(rows)
        return len(written), df._jdf.queryExecution().optimizedPlan().toString().count("\n")

    short = [(c, t, "user", f"turn {t}") for c in range(3) for t in range(5)]
    long = short + [(c, t, "user", f"turn {t} {'x ' * (t % 3)}{c if t > last else 0}") for c, n, last in
                    ((20, 520, 600), (40, 520, 300), (60, 519, 100), (80, 256, 255), (100, 257, 90)) for t in range(n)]
    tables, plan = run(short)
    long_tables, long_plan = run(long)
    assert long_tables <= tables + 6 and long_plan == plan
