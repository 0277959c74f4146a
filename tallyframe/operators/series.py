"""Period series as rows of arrays, and stacks of them for numpy.

``packed`` turns ``(keys, t, values)`` rows into one row per series, its values as arrays in
``t`` order: one shuffle on the keys. A period series holds one value per day, week or month of
an entity, so an array is bounded by the calendar, not by the data. ``per_batch`` hands Arrow
batches of such rows to a numpy step in stacks of series of about the same length; there is no
Python call per series, and a task holds one batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

STACK = 1 << 17   # values of one stack, padding included (a longer series is a stack of its own)


def packed(df: DataFrame, keys: Sequence[str], t: str, cols: dict[str, str],
           extra: Sequence[Column] = ()) -> DataFrame:
    """One row per series: ``keys``, an array of doubles in ``t`` order for each of ``cols``
    (array name -> column), and the aggregates ``extra``. Periods with a null in ``t`` or any
    of the columns take no part in the arrays; equal ``t`` are ordered by value."""
    keys = list(keys)
    values = [F.col(c).cast("double") for c in cols.values()]
    whole = F.col(t).isNotNull()
    for v in values:
        whole &= v.isNotNull()
    row = F.struct(F.col(t).alias("t"), *[v.alias(f"v{i}") for i, v in enumerate(values)])
    rows = F.array_sort(F.collect_list(F.when(whole, row))).alias("_rows")
    if keys:   # as many tasks as the shuffle has parts: the arrays are small, the fits are not
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartition(parts, *keys)
    g = df.groupBy(*keys).agg(rows, F.count(F.lit(1)).alias("_all"), *extra).where("_all > 0")
    arrays = [F.col(f"_rows.v{i}").alias(name) for i, name in enumerate(cols)]
    return g.select("*", *arrays).drop("_rows", "_all")


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys``, null keys being equal; without keys ``right`` is one row."""
    if not keys:
        return left.crossJoin(F.broadcast(right))
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(r, on).drop(*[f"_r_{k}" for k in keys])


def doubles(lists: Sequence[np.ndarray]) -> pa.Array:
    """Arrow lists of doubles."""
    ends = np.concatenate([[0], np.cumsum([len(v) for v in lists])]).astype(np.int32)
    flat = np.concatenate([np.zeros(0), *lists])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.float64()))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values of all lists, length of each)."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False), size


class Lists:
    """A list column of a batch; ``stack`` pads the chosen rows to a rectangle."""

    def __init__(self, column: pa.Array):
        self.flat, self.size = _lists(column)
        self.start = np.cumsum(self.size) - self.size

    def stack(self, rows: np.ndarray, end: bool = False) -> np.ndarray:
        """(longest, rows): time runs down, zeros after a shorter series (before it with ``end``)."""
        n = self.size[rows]
        top = int(n.max(initial=0))
        at = np.arange(top)[:, None] - (top - n if end else 0)
        inside = (at >= 0) & (at < n)
        if not len(self.flat):
            return np.zeros(inside.shape)
        return np.where(inside, self.flat[np.where(inside, at + self.start[rows], 0)], 0.0)


def stacks(size: np.ndarray, order: Sequence[np.ndarray] = ()) -> Iterator[np.ndarray]:
    """Rows in stacks of similar length, equal in every array of ``order``."""
    rows = np.lexsort((size, *order)) if len(size) else np.zeros(0, np.int64)
    first = 0
    for i in range(1, len(rows) + 1):
        cut = i == len(rows) or any(o[rows[i]] != o[rows[first]] for o in order) \
            or (i + 1 - first) * max(1, size[rows[i]]) > STACK or size[rows[i]] > 2 * size[rows[first]] + 8
        if cut:
            yield rows[first:i]
            first = i


def per_batch(df: DataFrame, schema: StructType,
              step: Callable[[pa.RecordBatch], pa.Table]) -> DataFrame:
    """``step`` of every Arrow batch, cast to ``schema``."""
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from step(batch).select(names).to_batches()
    return df.mapInArrow(run, schema)


def schema_of(df: DataFrame, keys: Sequence[str], columns: str) -> StructType:
    """The key fields of ``df``, then ``columns`` (a DDL list)."""
    return StructType([df.schema[k] for k in keys] + StructType.fromDDL(columns).fields)


# ---- algebra of stacks ---------------------------------------------------------------

def solve_all(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x of every a x = b of a stack; the minimum-norm one where a matrix is singular."""
    if not a.shape[-1]:
        return np.zeros(b.shape)
    try:
        return np.linalg.solve(a, b[..., None])[..., 0]
    except np.linalg.LinAlgError:
        return np.einsum("sij,sj->si", np.linalg.pinv(a, hermitian=True), b)


def cross_products(x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """(series, k, k) sums of products of ``x`` (time, series, k) over the rows of ``mask``."""
    v = np.where(mask[..., None], x, 0.0).transpose(1, 2, 0)
    return v @ v.transpose(0, 2, 1)


def recur(x: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """x_t - sum_k theta_k out_{t-k} in place along the first axis; ``theta`` is (series, q) and
    ``x`` (time, series, ...)."""
    weights = [theta[:, k].reshape(-1, *[1] * (x.ndim - 2)) for k in range(theta.shape[1])]
    for j in range(1, len(x) if weights else 0):
        for k, w in enumerate(weights[:j], 1):
            x[j] -= w * x[j - k]
    return x


def largest_root(coef: np.ndarray) -> np.ndarray:
    """Largest modulus of the roots of z^p - c_1 z^{p-1} - ... - c_p for every row of ``coef``
    (0 without coefficients): below 1 for a stationary AR part, and for an invertible MA part
    with the signs of ``coef`` turned."""
    s, p = coef.shape
    if not p:
        return np.zeros(s)
    if p == 1:
        return np.abs(coef[:, 0])
    companion = np.zeros((s, p, p))
    companion[:, 0] = coef
    companion[:, np.arange(1, p), np.arange(p - 1)] = 1.0
    return np.abs(np.linalg.eigvals(companion)).max(1)
