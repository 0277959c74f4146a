"""Every registered query with an oracle SQL matches DuckDB on the small tables
(row count, column names, values); the rest run and keep a stable schema."""

import math
from collections import Counter

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows, cols = df.collect(), df.columns
    cur = duck.execute(ORACLE[name])
    orows, ocols = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    order = sorted(cols)
    a = Counter(tuple(_norm(r[cols.index(c)]) for c in order) for r in rows)
    b = Counter(tuple(_norm(r[ocols.index(c)]) for c in order) for r in orows)
    assert a == b, (list((a - b).elements())[:3], list((b - a).elements())[:3])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    schema = df.schema.simpleString()
    assert df.count() >= 0
    assert QUERIES[name](spark, SF_SMALL).schema.simpleString() == schema


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"entity_id", "score", "category"} <= set(df.columns)
