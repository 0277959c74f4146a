"""Small learned models.

* ``mini_mlp_scores`` — one 3-6-1 network per entity, all entities of an Arrow batch
  trained together as stacked tensors (``mapInPandas``).
* ``perceptron`` — batch perceptron: one built-in aggregate over all rows per epoch.
* ``mlp_regressor`` — quasi-Newton steps from loss and gradient summed over all rows
  (parts per Arrow batch in ``mapInArrow``, added up by Spark).
* ``mlp_classifier`` — Spark ML ``MultilayerPerceptronClassifier``.
* ``confusion`` / ``classification_report`` — ``groupBy(label, pred)`` aggregates.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# ---- M13: per-entity mini network ----------------------------------------------------

# Shape, start and schedule of the per-entity network.
HIDDEN, START_SCALE, SEED = 6, 0.1, 42


def train_networks(x: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int, rate: float
                   ) -> tuple[np.ndarray, np.ndarray]:
    """Train one small network (ReLU layer, sigmoid output) for each of many entities at once.

    x (entity, row, feature), y and weight (entity, row); weights of an entity's rows sum to
    one and are 0 for padding. Biases are the weights of a constant last input. Returns the
    stacked layers (entity, feature + 1, hidden) and (entity, hidden + 1)."""
    many, _, width = x.shape
    rng = np.random.default_rng(SEED)
    layer = np.zeros((many, width + 1, HIDDEN))
    layer[:, :width] = rng.normal(scale=START_SCALE, size=(width, HIDDEN))
    head = np.zeros((many, HIDDEN + 1))
    head[:, :HIDDEN] = rng.normal(scale=START_SCALE, size=(HIDDEN, 1))[:, 0]
    inputs = _with_one(x)
    for _ in range(epochs):
        active = np.maximum(inputs @ layer, 0)
        miss = weight * (_output(active, head) - y)
        back = miss[..., None] * head[:, None, :HIDDEN] * (active > 0)
        head = head - rate * np.einsum("er,erh->eh", miss, _with_one(active))
        layer = layer - rate * np.einsum("erf,erh->efh", inputs, back)
    return layer, head


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.ones((*x.shape[:-1], 1))], -1)


def _output(active: np.ndarray, head: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.einsum("erh,eh->er", _with_one(active), head)))


def apply_networks(x: np.ndarray, layer: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Output (entity, row) of each entity's own network."""
    return _output(np.maximum(_with_one(x) @ layer, 0), head)


FEATURES = ["saving_ratio", "essential_ratio", "stability"]


def mini_mlp_scores(blocks: DataFrame, metrics: DataFrame, id_col: str = "entity_id",
                    epochs: int = 400, lr: float = 0.04) -> DataFrame:
    """Train one network per entity on its block features, score its current metrics.

    Output: ``(id, neural_score)`` in [0, 100]; NULL when a feature is undefined.
    """
    current = metrics.select(id_col, F.array(*[F.col(c).cast("double") for c in FEATURES]).alias("now"))
    # an entity has one row per half month: its list is bounded by the calendar
    row = F.struct("block", F.array(*[F.col(c).cast("double") for c in FEATURES]).alias("x"),
                   F.col("target").cast("double").alias("y"))
    entities = (blocks.groupBy(id_col).agg(F.sort_array(F.collect_list(row)).alias("rows")).join(current, id_col)
                .select(id_col, F.col("rows.x").alias("x"), F.col("rows.y").alias("y"), "now"))
    id_type = dict(blocks.dtypes)[id_col]

    def finite(values) -> bool:
        return bool(np.isfinite(np.array(values, dtype=float)).all())

    def fit_score(batches):
        for pdf in batches:
            scores = [None] * len(pdf)
            data = [([list(r) for r in x], list(y), list(now)) for x, y, now in zip(pdf["x"], pdf["y"], pdf["now"])]
            good = [i for i, parts in enumerate(data) if all(map(finite, parts))]
            if good:
                longest = max(len(data[i][1]) for i in good)
                x = np.zeros((len(good), longest, len(FEATURES)))
                y, weight = np.zeros((len(good), longest)), np.zeros((len(good), longest))
                for e, i in enumerate(good):
                    n = len(data[i][1])
                    x[e, :n], y[e, :n], weight[e, :n] = np.array(data[i][0], float) / 100, data[i][1], 1 / n
                nets = train_networks(x, y, weight, epochs, lr)
                now = np.array([data[i][2] for i in good], float)[:, None] / 100
                for i, p in zip(good, apply_networks(now, *nets)[:, 0]):
                    scores[i] = float(np.clip(p * 100, 0, 100))
            yield pd.DataFrame({id_col: pdf[id_col], "neural_score": pd.Series(scores, index=pdf.index, dtype=float)})

    return entities.mapInPandas(fit_score, f"{id_col} {id_type}, neural_score double").withColumn(
        "neural_score", F.when(~F.isnan("neural_score"), F.col("neural_score")))


# ---- M9: batch perceptron, one aggregate per epoch --------------------------------------

def perceptron(df: DataFrame, features: list[str], label: str, epochs: int = 100, eta: float = 0.01,
               patience: int = 20) -> DataFrame:
    """Binary perceptron (labels 0/1). Each epoch adds ``eta`` times the mean of y x over all
    wrongly classified rows (y = -1 or 1); that sum and the number of wrong rows are one
    aggregate with map-side partials, so a task holds one row of sums and the weights do not
    depend on how rows are dealt to partitions. The weights of the epoch with the fewest wrong
    rows are kept (the first of equals). Ends after ``epochs``, when no row is wrong, or when
    ``patience`` epochs brought no better weights. Rows with a null or NaN take no part; an
    empty table gives zero weights. Output: one row with coef (array), intercept, epochs
    (those that were run)."""
    columns = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]
    data = df.select(*columns, F.col(label).cast("double").alias("y")).na.drop() \
        .withColumn("y", F.when(F.col("y") > 0, 1.0).otherwise(-1.0)).persist()
    inputs = [F.col(f"x{i}") for i in range(len(features))] + [F.lit(1.0)]
    weights = np.zeros(len(inputs))
    best, fewest, since, done = weights, None, 0, 0
    try:
        while done < epochs:
            score = sum((x * float(w) for x, w in zip(inputs, weights)), F.lit(0.0))
            wrong = F.col("y") * score <= 0
            row = data.agg(F.count(F.lit(1)), F.count(F.when(wrong, 1)),
                           *[F.sum(F.when(wrong, F.col("y") * x)) for x in inputs]).first()
            if fewest is None or row[1] < fewest:
                best, fewest, since = weights, row[1], 0
            else:
                since += 1
            if not row[1] or since >= patience:
                break
            weights = weights + eta * np.array(row[2:], float) / row[0]
            done += 1
    finally:
        data.unpersist()
    return df.sparkSession.createDataFrame(
        [([float(v) for v in best[:-1]], float(best[-1]), done)],
        "coef array<double>, intercept double, epochs int")


def linear_predict(df: DataFrame, features: list[str], model: DataFrame, out: str = "prediction") -> DataFrame:
    """Class 1 when coef . x + intercept > 0 (model is one row: broadcast)."""
    j = df.crossJoin(F.broadcast(model))
    score = F.col("intercept")
    for i, c in enumerate(features):
        score = score + F.col("coef")[i] * F.col(c)
    return j.withColumn("score", score).withColumn(out, (F.col("score") > 0).cast("int")) \
        .drop(*model.columns)


def decision_grid(df: DataFrame, features: list[str], model: DataFrame, points: int = 100,
                  margin: float = 1.0) -> DataFrame:
    """points x points mesh over [min - margin, max + margin] of two features with the
    linear model's class at each node (grid size is fixed: points^2 rows)."""
    a, b = features
    r = df.agg(F.min(a).alias("_a0"), F.max(a).alias("_a1"), F.min(b).alias("_b0"), F.max(b).alias("_b1"))
    g = r.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i")) \
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("j"))
    ga = F.col("_a0") - margin + (F.col("_a1") - F.col("_a0") + 2 * margin) * F.col("i") / (points - 1)
    gb = F.col("_b0") - margin + (F.col("_b1") - F.col("_b0") + 2 * margin) * F.col("j") / (points - 1)
    g = g.select("i", "j", ga.alias(a), gb.alias(b))
    return linear_predict(g, features, model)


# ---- M10: confusion matrix and report ------------------------------------------------

def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("actual"), F.col(pred).alias("predicted")).agg(
        F.count(F.lit(1)).alias("count"))


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class: precision, recall, F1, support; plus accuracy and error rate (same on
    every row). One aggregate over (actual, predicted) counts."""
    c = confusion(df, label, pred)
    # each cell counts once for its actual and once for its predicted class
    n, zero = F.col("count"), F.lit(0).cast("long")
    hit = F.when(F.col("actual") == F.col("predicted"), n).otherwise(zero)
    sides = F.array(
        F.struct(F.col("actual").alias("cls"), hit.alias("tp"), zero.alias("pred_n"), n.alias("support")),
        F.struct(F.col("predicted").alias("cls"), zero.alias("tp"), n.alias("pred_n"), zero.alias("support")))
    per = c.select(F.inline(sides)).groupBy("cls").agg(*[F.sum(x).alias(x) for x in ("tp", "pred_n", "support")])
    tot = c.agg(F.sum("count").alias("_n"),
                F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("count")).otherwise(0)).alias("_ok"))
    per = per.crossJoin(F.broadcast(tot))
    prec = F.when(F.col("pred_n") > 0, F.col("tp") / F.col("pred_n")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    per = per.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return per.select("cls", "precision", "recall", f1.alias("f1"), "support",
                      (F.col("_ok") / F.col("_n")).alias("accuracy"),
                      (1 - F.col("_ok") / F.col("_n")).alias("error_rate"))


# ---- M11: MLP classifier (Spark ML) --------------------------------------------------

def mlp_classifier(train: DataFrame, test: DataFrame, features: list[str], label: str,
                   hidden: tuple = (10, 10), max_iter: int = 500, seed: int = 10) -> DataFrame:
    """Standardise (population std fitted on train), then Spark ML's multilayer
    perceptron (sigmoid hidden layers, softmax output). Labels are indexed 0..k-1 in
    sorted order. Returns test rows with ``prediction`` (original label values)."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.feature import VectorAssembler
    from .clean import standardize
    levels = sorted(r[0] for r in train.select(label).distinct().collect())
    idx = F.create_map(*[x for i, v in enumerate(levels) for x in (F.lit(v), F.lit(float(i)))])
    tr = standardize(train, features)
    te = standardize(train, features, test)
    va = VectorAssembler(inputCols=features, outputCol="_features")
    tr = va.transform(tr.withColumn("_label", idx[F.col(label)]))
    te = va.transform(te)
    mlp = MultilayerPerceptronClassifier(featuresCol="_features", labelCol="_label",
                                         layers=[len(features), *hidden, len(levels)], maxIter=max_iter,
                                         seed=seed)
    m = mlp.fit(tr)
    back = F.create_map(*[x for i, v in enumerate(levels) for x in (F.lit(float(i)), F.lit(v))])
    return m.transform(te).withColumn("prediction", back[F.col("prediction")]).drop(
        "_features", "rawPrediction", "probability")


# ---- M12: MLP regressor from gradients summed over all rows ------------------------------

LENGTHS = (1.0, 0.25, 0.0625)    # step lengths tried in one pass over the rows
MEMORY = 10                      # step and gradient pairs that shape the next direction


def _layers(theta: np.ndarray, inputs: int, hidden: int) -> tuple[np.ndarray, ...]:
    """w1 (inputs, hidden), b1, w2 (hidden, 1), b2 as views of the flat parameters."""
    cuts = np.cumsum([inputs * hidden, hidden, hidden])
    w1, b1, w2, b2 = np.split(theta, cuts)
    return w1.reshape(inputs, hidden), b1, w2[:, None], b2


def squared_loss(theta: np.ndarray, x: np.ndarray, y: np.ndarray, hidden: int) -> np.ndarray:
    """[half the sum of squared misses, its gradient in theta ...] over the rows of x."""
    w1, b1, w2, b2 = _layers(theta, x.shape[1], hidden)
    active = np.tanh(x @ w1 + b1)
    miss = (active @ w2 + b2)[:, 0] - y
    back = miss[:, None] * w2[:, 0] * (1 - active ** 2)
    return np.concatenate([[miss @ miss / 2], (x.T @ back).ravel(), back.sum(0), active.T @ miss, [miss.sum()]])


def _sum_over_rows(data: DataFrame, part: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``part`` (a vector of ``size`` numbers for a matrix of rows) over all rows: a
    task adds up its Arrow batches, Spark adds up the tasks; the driver sees one vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = part(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["at", "v"])

    sums = data.mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size)
    for r in sums:
        out[r["at"]] = r["v"]
    return out


def _direction(slope: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Quasi-Newton direction from the last (step, change of gradient) pairs."""
    q, kept = slope.copy(), []
    for step, change in reversed(pairs):
        share = step @ q / (step @ change)
        kept.append(share)
        q -= share * change
    if pairs:
        step, change = pairs[-1]
        q *= step @ change / (change @ change)
    else:
        q /= max(1.0, float(np.linalg.norm(q)))
    for (step, change), share in zip(pairs, reversed(kept)):
        q += (share - change @ q / (step @ change)) * step
    return -q


def mlp_regressor(df: DataFrame, features: list[str], target: str, hidden: int = 100, steps: int = 100,
                  l2: float = 1e-4, tol: float = 1e-5, seed: int = 10) -> dict:
    """One tanh hidden layer, linear output, mean squared loss plus ``l2`` / 2 times the squared
    weights, minimised by limited-memory quasi-Newton steps. Loss and gradient are sums over all
    rows: each Arrow batch gives its part (memory: one batch), tasks and then Spark add them up,
    and one job tries the three ``LENGTHS`` of a step at once, so the model does not depend on
    how rows are dealt to partitions (but for rounding). Ends after ``steps``, when a step
    lowers the loss by less than ``tol`` of itself, or when no length lowers it.

    Features are standardised with the training rows' mean / population std. Rows with a null
    or NaN take no part; without rows the starting weights are returned.
    Returns the model as plain arrays (w1, b1, w2, b2, mu, sd) and the last training ``loss``."""
    k = len(features)
    data = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)],
                     F.col(target).cast("double").alias("y")).na.drop().persist()
    rng = np.random.default_rng(seed)
    lim1, lim2 = math.sqrt(6 / (k + hidden)), math.sqrt(6 / (hidden + 1))
    theta = np.concatenate([rng.uniform(-lim1, lim1, k * hidden), np.zeros(hidden),
                            rng.uniform(-lim2, lim2, hidden), np.zeros(1)])
    size = len(theta)
    decay = l2 * np.concatenate([np.ones(k * hidden), np.zeros(hidden), np.ones(hidden), np.zeros(1)])
    try:
        stats = data.agg(F.count(F.lit(1)), *[f(f"x{i}") for f in (F.avg, F.stddev_pop) for i in range(k)]).first()
        n = stats[0]
        mu = np.array(stats[1:1 + k] if n else [0.0] * k, float)
        sd = np.array(stats[1 + k:] if n else [1.0] * k, float)
        sd[sd == 0] = 1.0

        def evaluate(points: list[np.ndarray]) -> list[tuple[float, np.ndarray]]:
            """(loss, gradient) at each point, from one pass over the rows."""
            def part(rows: np.ndarray) -> np.ndarray:
                x = (rows[:, :k] - mu) / sd
                return np.concatenate([squared_loss(p, x, rows[:, k], hidden) for p in points])

            sums = _sum_over_rows(data, part, len(points) * (1 + size)).reshape(len(points), 1 + size) / n
            return [(row[0] + decay @ p ** 2 / 2, row[1:] + decay * p) for p, row in zip(points, sums)]

        loss, slope = evaluate([theta])[0] if n else (0.0, np.zeros(size))
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        for _ in range(steps if n else 0):
            way, reach = _direction(slope, pairs), 1.0
            if way @ slope >= 0:
                way, pairs = _direction(slope, []), []
            chosen = None
            while chosen is None and reach > 1e-9:
                points = [theta + reach * length * way for length in LENGTHS]
                tried = [(f, g, p) for (f, g), p, length in zip(evaluate(points), points, LENGTHS)
                         if f < loss + 1e-4 * reach * length * (way @ slope)]
                chosen = min(tried, key=lambda t: t[0], default=None)
                reach *= LENGTHS[-1] / 4
            if chosen is None:
                break
            gain = loss - chosen[0]
            step, change = chosen[2] - theta, chosen[1] - slope
            if step @ change > 1e-12 * (change @ change):
                pairs = [*pairs, (step, change)][-MEMORY:]
            loss, slope, theta = chosen
            if gain <= tol * abs(loss):
                break
    finally:
        data.unpersist()
    w1, b1, w2, b2 = _layers(theta, k, hidden)
    return {"w1": w1, "b1": b1, "w2": w2, "b2": b2, "mu": mu, "sd": sd, "features": list(features),
            "loss": float(loss)}


def mlp_regressor_predict(df: DataFrame, model: dict, out: str = "prediction") -> DataFrame:
    """Apply the network with an Arrow-batched pandas UDF (weights in the closure)."""
    feats = model["features"]
    w1, b1, w2, b2, mu, sd = (model[k] for k in ("w1", "b1", "w2", "b2", "mu", "sd"))

    @F.pandas_udf("double")
    def predict(*cols: pd.Series) -> pd.Series:
        x = (np.column_stack([c.to_numpy(float) for c in cols]) - mu) / sd
        return pd.Series((np.tanh(x @ w1 + b1) @ w2 + b2)[:, 0])

    return df.withColumn(out, predict(*[F.col(c) for c in feats]))
