"""Secret scan over a trigram inverted index.

From the parse tree of every rule a Boolean trigram query is derived (an OR of ANDs that
any match must satisfy). Each block of texts is indexed on its own, as a segment: posting
lists of text numbers for the trigrams that occur in some query, over case-folded bytes.
Postings are intersected and united as the query says, and only the candidates are verified
with the rule itself. A rule without mandatory trigrams scans every text. A segment needs
nothing outside its block, so nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as op
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables, words


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0     # the group whose length counts
    least: int = 1     # matches with a shorter group are dropped


# The three base rules, then widely documented token formats.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)
EXTRA = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[0-9A-Za-z-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)

Query = list[frozenset[bytes]] | None   # OR of ANDs; None: no mandatory trigram
_STRINGS = 64                           # literal alternatives kept while walking a pattern


def _or(parts: list[Query]) -> Query:
    if any(p is None for p in parts):
        return None
    terms = {t for p in parts for t in p}
    return [t for t in terms if not any(o < t for o in terms)]


def _and(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return a if b is None else b
    return _or([[x | y] for x in a for y in b])


def _of(strings: set[str]) -> Query:
    """What a text must hold that contains one of ``strings``."""
    terms = []
    for s in strings:
        raw = s.encode().lower()
        if len(raw) < 3:
            return None
        terms.append(frozenset(raw[i:i + 3] for i in range(len(raw) - 2)))
    return _or([terms])


def _exact(kind, value) -> set[str] | None:
    """All strings a node can match, if they are few."""
    if kind is op.LITERAL:
        return {chr(value).lower()}
    if kind is op.SUBPATTERN:
        return _exact_all(value[-1])
    if kind is op.BRANCH:
        sets = [_exact_all(x) for x in value[1]]
        return None if any(s is None for s in sets) else set().union(*sets)
    if kind is op.IN and len(value) <= 8 and all(k is op.LITERAL for k, _ in value):
        return {chr(v).lower() for _, v in value}
    if kind is op.MAX_REPEAT and value[1] == 1:
        inner = _exact_all(value[2])
        return None if inner is None else inner | ({""} if value[0] == 0 else set())
    return None


def _exact_all(nodes) -> set[str] | None:
    run = {""}
    for kind, value in nodes:
        e = _exact(kind, value)
        if e is None or len(run) * len(e) > _STRINGS:
            return None
        run = {a + b for a in run for b in e}
    return run


def _walk(nodes) -> Query:
    query, run = None, {""}
    for kind, value in nodes:
        e = _exact(kind, value)
        if e is not None and len(run) * len(e) <= _STRINGS:
            run = {a + b for a in run for b in e}
            continue
        query, run = _and(query, _of(run)), {""}
        if e is not None:
            run = e
        elif kind is op.SUBPATTERN:
            query = _and(query, _walk(value[-1]))
        elif kind is op.BRANCH:
            query = _and(query, _or([_walk(x) for x in value[1]]))
        elif kind is op.MAX_REPEAT and value[0] > 0:
            query = _and(query, _walk(value[2]))
    return _and(query, _of(run))


def trigram_query(pattern: str) -> Query:
    """Trigrams (of ASCII-lower-cased UTF-8) every match of ``pattern`` must contain."""
    return _walk(_parser.parse(pattern))


class _Segment:
    """Inverted index of one block for the trigrams in ``vocab``."""

    def __init__(self, texts: list[bytes], vocab: list[bytes]):
        folded = np.frombuffer(b"\x00".join(texts).lower() + b"\x00\x00", np.uint8)
        self.all = np.arange(len(texts))
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        pairs = np.zeros(1 << 16, bool)
        pairs[[v[0] << 8 | v[1] for v in vocab]] = True
        two = (folded[:-2].astype(np.uint16) << 8) | folded[1:-1]
        at = np.flatnonzero(pairs[two])
        code = two[at].astype(np.uint32) << 8 | folded[at + 2]
        self.postings = {}
        wanted = np.array(sorted(int.from_bytes(v, "big") for v in vocab), np.uint32)
        near = np.minimum(np.searchsorted(wanted, code), len(wanted) - 1) if len(wanted) else code
        hit = wanted[near] == code if len(wanted) else np.zeros(0, bool)
        code, owner = code[hit], np.searchsorted(starts, at[hit], "right") - 1
        order = np.argsort(code, kind="stable")
        code, owner = code[order], owner[order]
        for v in vocab:
            a, b = np.searchsorted(code, [int.from_bytes(v, "big"), int.from_bytes(v, "big") + 1])
            self.postings[v] = np.unique(owner[a:b])

    def candidates(self, query: Query) -> np.ndarray:
        if query is None:
            return self.all
        found = [np.empty(0, np.int64)]
        for term in query:
            lists = sorted((self.postings[t] for t in term), key=len)
            kept = lists[0]
            for other in lists[1:]:
                if not len(kept):
                    break
                kept = np.intersect1d(kept, other, assume_unique=True)
            found.append(kept)
        return np.unique(np.concatenate(found))


def _verifier(rule: Rule):
    """Finds all spans of a rule in one text."""
    least, group = rule.least, rule.group
    if re.fullmatch(r"\[[^\]]+\]\+", rule.pattern) and least > 1:
        # maximal runs of one character set: only those long enough need a match object
        scan = re.compile(rule.pattern[:-1] + "{%d,}" % least, re.ASCII)
        return lambda text: [m.span() for m in scan.finditer(text)]
    scan = re.compile(rule.pattern, re.ASCII)
    return lambda text: [m.span() for m in scan.finditer(text)
                         if m.end(group) - m.start(group) >= least]


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE + EXTRA) -> DataFrame:
    """One row per row of ``docs``: doc_id and ``found``, an array of (kind, start, end) in
    order of start, then of ``rules``; code points, end exclusive. Spans are leftmost and do
    not overlap within a kind. Null and empty texts have none; null ids and repeated rows
    are kept; other columns are ignored; an empty table gives an empty result."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [trigram_query(r.pattern) for r in rules]
        vocab = sorted({t for q in queries if q for term in q for t in term})
        verify = [_verifier(r) for r in rules]
        for block in words.text_blocks(batches):
            texts = [t or "" for t in block.column("text").to_pylist()]
            segment = _Segment([t.encode() for t in texts], vocab)
            found: list[list] = [[] for _ in texts]
            for n, query in enumerate(queries):
                for i in segment.candidates(query).tolist():
                    for a, b in verify[n](texts[i]):
                        found[i].append((a, n, b))
            offsets, flat = [0], []
            for spans in found:
                flat += sorted(spans)
                offsets.append(len(flat))
            spans = pa.StructArray.from_arrays(
                [pa.array([rules[n].kind for _, n, _ in flat], pa.string()),
                 pa.array([a for a, _, _ in flat], pa.int64()), pa.array([b for _, _, b in flat], pa.int64())],
                ["kind", "start", "end"])
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").combine_chunks(), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)],
                ["doc_id", "found"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, found array<struct<kind:string,start:bigint,end:bigint>>")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(tables.read(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["kind"].isin(*(r.kind for r in BASE)))
    joined = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("found")).alias("spans"))
