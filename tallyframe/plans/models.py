"""Regression, classification and forecasting queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expr import money
from ..operators import calendar, crosstab, forecast, learn, linear, refit
from . import tables
from .registry import finish, register
from .tables import DAILY_SQL
from .tabular import segment_monthly

R = 6
FEATURES = ["n_orders", "n_urgent", "tax_rate", "discount_rate", "pay_abono"]


def _rnd(df, digits=R):
    return finish(df, digits)


def _seg_total(spark, d):
    """Monthly order value per segment: reads orders and customer alone."""
    return segment_monthly(spark, d).select("segment", "month", F.col("total").cast("double").alias("total"))


_SEG_SQL = """seg AS (
  SELECT c_mktsegment AS segment, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


# ---- M1 / M7 / M8 (oracle-checked) ---------------------------------------------------

@register("ols_daily", f"""WITH {DAILY_SQL},
f AS (SELECT symbol, regr_slope(close, volume) AS slope, regr_intercept(close, volume) AS intercept,
             regr_r2(close, volume) AS r2, regr_count(close, volume) AS n FROM daily GROUP BY 1),
r AS (SELECT d.symbol, d.close - (f.intercept + f.slope * d.volume) AS res FROM daily d JOIN f ON d.symbol = f.symbol)
SELECT f.symbol, round(slope, 4) AS slope, round(intercept, 4) AS intercept, round(r2, {R}) AS r2, CAST(n AS BIGINT) AS n,
       round(avg(res), 4) + 0.0 AS resid_mean, round(stddev_samp(res), 4) AS resid_std,
       round(min(res), 4) AS resid_min, round(max(res), 4) AS resid_max
FROM f JOIN r ON f.symbol = r.symbol GROUP BY f.symbol, slope, intercept, r2, n""")
def q_ols_daily(spark, d):
    o = linear.ols_simple(tables.daily_prices(spark, d), "close", "volume", ["symbol"])
    return o.select("symbol", F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"),
                    F.round("r2", R).alias("r2"), "n", (F.round("resid_mean", 4) + 0.0).alias("resid_mean"),
                    *[F.round(c, 4).alias(c) for c in ("resid_std", "resid_min", "resid_max")])


@register("regression_metrics", f"""WITH {_SEG_SQL},
p AS (SELECT segment, total, lag(total) OVER (PARTITION BY segment ORDER BY month) AS pred FROM seg),
v AS (SELECT * FROM p WHERE total IS NOT NULL AND pred IS NOT NULL)
SELECT segment, CAST(count(*) AS BIGINT) AS n,
       round(1 - sum((total - pred) * (total - pred)) / (var_pop(total) * count(*)), {R}) AS r2,
       round(avg((total - pred) * (total - pred)), 0) AS mse, round(sqrt(avg((total - pred) * (total - pred))), 2) AS rmse,
       round(avg(abs(total - pred)), 2) AS mae, round(avg(abs((total - pred) / total)) * 100, 4) AS mape
FROM v GROUP BY 1""")
def q_regression_metrics(spark, d):
    from ..operators import windows
    s = windows.diff(_seg_total(spark, d), "total", "month", ["segment"], "_d")
    s = s.withColumn("pred", F.col("total") - F.col("_d"))
    m = linear.regression_metrics(s, "total", "pred", ["segment"])
    return m.select("segment", "n", F.round("r2", R).alias("r2"), F.round("mse", 0).alias("mse"),
                    F.round("rmse", 2).alias("rmse"), F.round("mae", 2).alias("mae"), F.round("mape", 4).alias("mape"))


@register("temporal_split", f"""WITH {_SEG_SQL},
p AS (SELECT segment, month, row_number() OVER (PARTITION BY segment ORDER BY month) AS pos,
             count(*) OVER (PARTITION BY segment) AS n FROM seg)
SELECT segment, month, n > 10 AND pos > n - greatest(1, floor(n * 0.2)) AS is_test FROM p""")
def q_temporal_split(spark, d):
    return linear.temporal_split(_seg_total(spark, d).drop("total"), "month", ["segment"])


_HASH = "CAST((CAST({k} AS DECIMAL(20,0)) * CAST(2654435761 AS DECIMAL(10,0))) % CAST(4294967296 AS DECIMAL(10,0)) AS DOUBLE) / 4294967296.0"


@register("random_split", f"""SELECT o_orderkey, {_HASH.format(k='o_orderkey')} < 0.2 AS is_test FROM orders""")
def q_random_split(spark, d):
    return linear.random_split(tables.read(spark, d, "orders").select("o_orderkey"), "o_orderkey")


@register("stratified_split", f"""WITH h AS (SELECT doc_id, quality, {_HASH.format(k='doc_id')} AS h FROM labels),
p AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY h) AS pos,
             count(*) OVER (PARTITION BY quality) AS n FROM h)
SELECT doc_id, quality, pos <= round(n * 0.2) AS is_test FROM p""")
def q_stratified_split(spark, d):
    lab = tables.read(spark, d, "labels").select("doc_id", "quality")
    return linear.stratified_split(lab, "doc_id", "quality")


# ---- M10 / U4 (oracle-checked rule classifier) ---------------------------------------

_RULE_SQL = """r AS (SELECT l.doc_id, l.quality AS actual, CAST(d.n_chars > 2000 AS INTEGER) AS predicted
      FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def _rule(spark, d):
    lab = tables.read(spark, d, "labels")
    doc = tables.read(spark, d, "documents").select("doc_id", "n_chars")
    return lab.join(doc, "doc_id").select("doc_id", F.col("quality").alias("actual"),
                                          (F.col("n_chars") > 2000).cast("int").alias("predicted"))


@register("classification_report", f"""WITH {_RULE_SQL},
c AS (SELECT actual, predicted, count(*) AS cnt FROM r GROUP BY 1, 2),
cls AS (SELECT actual AS cls FROM c UNION SELECT predicted FROM c),
t AS (SELECT sum(cnt) AS n, sum(CASE WHEN actual = predicted THEN cnt ELSE 0 END) AS ok FROM c),
per AS (SELECT cls, sum(CASE WHEN actual = cls AND predicted = cls THEN cnt ELSE 0 END) AS tp,
               sum(CASE WHEN predicted = cls THEN cnt ELSE 0 END) AS pred_n,
               sum(CASE WHEN actual = cls THEN cnt ELSE 0 END) AS support FROM cls, c GROUP BY cls),
pr AS (SELECT cls, CASE WHEN pred_n > 0 THEN tp / pred_n ELSE 0.0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, support FROM per)
SELECT cls, round(precision, {R}) AS precision, round(recall, {R}) AS recall,
       round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END, {R}) AS f1,
       CAST(support AS BIGINT) AS support, round(ok / n, {R}) AS accuracy, round(1 - ok / n, {R}) AS error_rate
FROM pr, t""")
def q_classification_report(spark, d):
    return _rnd(learn.classification_report(_rule(spark, d), "actual", "predicted"))


@register("confusion_matrix", f"""WITH {_RULE_SQL}
SELECT actual, predicted, CAST(count(*) AS BIGINT) AS count FROM r GROUP BY 1, 2""")
def q_confusion_matrix(spark, d):
    return learn.confusion(_rule(spark, d), "actual", "predicted")


@register("stacked_labels", f"""WITH {_RULE_SQL},
s AS (SELECT 'real' AS source, actual AS label FROM r UNION ALL SELECT 'pred', predicted FROM r)
SELECT source, CAST(count(CASE WHEN label = 0 THEN 1 END) AS BIGINT) AS "0",
       CAST(count(CASE WHEN label = 1 THEN 1 END) AS BIGINT) AS "1" FROM s GROUP BY source""")
def q_stacked_labels(spark, d):
    s = crosstab.stack_labels(_rule(spark, d), "actual", "predicted")
    return crosstab.crosstab(s, "source", "label", [0, 1])


# ---- M2-M6, M9, M11, M12, M14 (rows-only: fitted models) --------------------------------

@register("poly_trend")
def q_poly_trend(spark, d):
    """Cubic trend in the (centred, scaled) month index per segment."""
    return linear.poly_trend(_seg_total(spark, d), "total", "month", 3, ["segment"])


@register("ridge_fit")
def q_ridge_fit(spark, d):
    """Ridge (alpha 1) per segment; numerics standardised, the indicator not."""
    f = tables.segment_features(spark, d)
    return linear.ridge_fit(f, "total", FEATURES, ["segment"], alpha=1.0, standardize=FEATURES[:-1])


@register("ridge_cv")
def q_ridge_cv(spark, d):
    """Alpha over logspace(-3, 3, 50) by contiguous 5-fold CV, negative MSE."""
    f = tables.segment_features(spark, d)
    return linear.ridge_cv(f, "total", FEATURES[:-1], "month", ["segment"], scheme="kfold", folds=5)


@register("vif")
def q_vif(spark, d):
    return linear.vif(tables.segment_features(spark, d), FEATURES[:-1], ["segment"])


def _doc_features(spark, d):
    doc = tables.read(spark, d, "documents")
    lab = tables.read(spark, d, "labels")
    digits = (F.length("text") - F.length(F.regexp_replace("text", "[0-9]", ""))) / F.greatest(F.length("text"), F.lit(1))
    x = doc.join(lab, "doc_id").select("doc_id", F.log1p("n_chars").alias("x_len"),
                                       (digits * 100).alias("x_digits"), "quality")
    from ..operators.clean import standardize
    return standardize(x, ["x_len", "x_digits"])


@register("perceptron")
def q_perceptron(spark, d):
    """Perceptron on two standardised document features (up to 100 epochs, eta 0.01) and its
    train/test accuracy by hash split."""
    x = linear.stratified_split(_doc_features(spark, d), "doc_id", "quality")
    train = x.where(~F.col("is_test"))
    model = learn.perceptron(train, ["x_len", "x_digits"], "quality", epochs=100, eta=0.01)
    p = learn.linear_predict(x, ["x_len", "x_digits"], model)
    acc = p.groupBy("is_test").agg(F.avg((F.col("prediction") == F.col("quality")).cast("double")).alias("accuracy"),
                                   F.count(F.lit(1)).alias("rows"))
    return acc.crossJoin(model)


@register("decision_grid")
def q_decision_grid(spark, d):
    x = _doc_features(spark, d)
    model = learn.perceptron(x, ["x_len", "x_digits"], "quality", epochs=100, eta=0.01)
    return learn.decision_grid(x, ["x_len", "x_digits"], model, points=100)


DIMS = 64


def _embeddings(spark, d):
    e = tables.read(spark, d, "embeddings")
    return e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(DIMS)])


@register("mlp_classifier")
def q_mlp_classifier(spark, d):
    """All labels from all embedding dimensions: Spark ML perceptron network
    [64, 10, 10, labels], stratified 30 % test split; test accuracy."""
    x = linear.stratified_split(_embeddings(spark, d), "vec_id", "label", 0.3)
    feats = [f"e{i}" for i in range(DIMS)]
    pred = learn.mlp_classifier(x.where(~F.col("is_test")), x.where(F.col("is_test")), feats, "label")
    return pred.agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
                    F.count(F.lit(1)).alias("test_rows"))


@register("mlp_regressor")
def q_mlp_regressor(spark, d):
    """The last dimension regressed on all others (100 tanh units), 30 % hash test split;
    test MSE."""
    x = linear.random_split(_embeddings(spark, d), "vec_id", 0.3)
    feats, y = [f"e{i}" for i in range(DIMS - 1)], f"e{DIMS - 1}"
    model = learn.mlp_regressor(x.where(~F.col("is_test")), feats, y, hidden=100)
    p = learn.mlp_regressor_predict(x.where(F.col("is_test")), model)
    return p.agg(F.avg((F.col(y) - F.col("prediction")) ** 2).alias("mse"), F.count(F.lit(1)).alias("test_rows"))


# ---- Y (forecasting) -----------------------------------------------------------------

@register("dickey_fuller", f"""WITH {_SEG_SQL},
l AS (SELECT segment, total - lag(total) OVER (PARTITION BY segment ORDER BY month) AS dy,
             lag(total) OVER (PARTITION BY segment ORDER BY month) AS y1 FROM seg),
r AS (SELECT segment, regr_count(dy, y1) AS n, regr_slope(dy, y1) AS g, regr_sxx(dy, y1) AS sxx,
             regr_syy(dy, y1) AS syy, regr_sxy(dy, y1) AS sxy FROM l GROUP BY 1),
s AS (SELECT segment, count(total) AS n, avg(total) AS mean, stddev_samp(total) AS std FROM seg GROUP BY 1)
SELECT s.segment, CAST(s.n AS BIGINT) AS n, round(s.mean, 2) AS mean, round(s.std, 2) AS std,
       round(g / sqrt((syy - sxy * sxy / sxx) / (r.n - 2) / sxx), 4) AS adf_stat,
       round(CAST(-2.86154 - 2.8903 / r.n - 4.234 / (r.n * r.n) - 40.040 / (r.n * r.n * r.n) AS DOUBLE), 4) AS crit_5,
       g / sqrt((syy - sxy * sxy / sxx) / (r.n - 2) / sxx)
         < -2.86154 - 2.8903 / r.n - 4.234 / (r.n * r.n) - 40.040 / (r.n * r.n * r.n) AS stationary
FROM s JOIN r ON s.segment = r.segment""")
def q_dickey_fuller(spark, d):
    st = forecast.stationarity(_seg_total(spark, d), "total", "month", ["segment"], lags=0)
    return st.select("segment", "n", F.round("mean", 2).alias("mean"), F.round("std", 2).alias("std"),
                     F.round("adf_stat", 4).alias("adf_stat"), F.round("crit_5", 4).alias("crit_5"), "stationary")


@register("adf_test", f"""WITH {_SEG_SQL},
l1 AS (SELECT segment, month, total, total - lag(total) OVER (PARTITION BY segment ORDER BY month) AS dy,
              lag(total) OVER (PARTITION BY segment ORDER BY month) AS y1 FROM seg),
l2 AS (SELECT *, lag(dy) OVER (PARTITION BY segment ORDER BY month) AS dl1 FROM l1),
r AS (SELECT * FROM l2 WHERE dy IS NOT NULL AND y1 IS NOT NULL AND dl1 IS NOT NULL),
m AS (SELECT segment, count(*) AS k, regr_sxx(dy, y1) AS s11, regr_sxx(dy, dl1) AS s22,
             covar_pop(y1, dl1) * count(*) AS s12, regr_sxy(dy, y1) AS s1y, regr_sxy(dy, dl1) AS s2y,
             regr_syy(dy, y1) AS syy FROM r GROUP BY 1),
b AS (SELECT *, s11 * s22 - s12 * s12 AS det FROM m),
c AS (SELECT *, (s22 * s1y - s12 * s2y) / det AS b1, (s11 * s2y - s12 * s1y) / det AS b2 FROM b),
t AS (SELECT segment, k, b1 / sqrt((syy - b1 * s1y - b2 * s2y) / (k - 3) * s22 / det) AS adf_stat FROM c),
s AS (SELECT segment, count(total) AS n, avg(total) AS mean FROM seg GROUP BY 1)
SELECT s.segment, CAST(s.n AS BIGINT) AS n, round(s.mean, 2) AS mean, CAST(t.k AS BIGINT) AS df_n,
       round(adf_stat, 4) AS adf_stat,
       round(CAST(-2.86154 - 2.8903 / t.k - 4.234 / (t.k * t.k) - 40.040 / (t.k * t.k * t.k) AS DOUBLE), 4) AS crit_5,
       adf_stat < -2.86154 - 2.8903 / t.k - 4.234 / (t.k * t.k) - 40.040 / (t.k * t.k * t.k) AS stationary
FROM s JOIN t ON s.segment = t.segment""")
def q_adf_test(spark, d):
    """Augmented Dickey-Fuller (one lagged difference) on each segment's monthly totals."""
    st = forecast.stationarity(_seg_total(spark, d), "total", "month", ["segment"], lags=1)
    return st.select("segment", "n", F.round("mean", 2).alias("mean"), "df_n", F.round("adf_stat", 4).alias("adf_stat"),
                     F.round("crit_5", 4).alias("crit_5"), "stationary")


@register("adf_p_value", f"""WITH {_SEG_SQL},
l AS (SELECT segment, total - lag(total) OVER (PARTITION BY segment ORDER BY month) AS dy,
             lag(total) OVER (PARTITION BY segment ORDER BY month) AS y1 FROM seg),
r AS (SELECT segment, regr_count(dy, y1) AS n, regr_slope(dy, y1) AS g, regr_sxx(dy, y1) AS sxx,
             regr_syy(dy, y1) AS syy, regr_sxy(dy, y1) AS sxy FROM l GROUP BY 1),
t AS (SELECT segment, n, g / sqrt((syy - sxy * sxy / sxx) / (n - 2) / sxx) AS tau FROM r)
SELECT segment, CAST(n AS BIGINT) AS df_n, round(tau, 4) AS adf_stat,
       round(CAST({forecast.df_p_value_sql("tau")} AS DOUBLE), 5) AS p_value FROM t""")
def q_adf_p_value(spark, d):
    """Dickey-Fuller statistic of each segment's monthly totals and its p-value."""
    st = forecast.stationarity(_seg_total(spark, d), "total", "month", ["segment"], lags=0)
    return st.select("segment", "df_n", F.round("adf_stat", 4).alias("adf_stat"), F.round("p_value", 5).alias("p_value"))


@register("adf_auto_lag")
def q_adf_auto_lag(spark, d):
    """Augmented Dickey-Fuller test of each symbol's daily close, lagged differences by AIC."""
    st = forecast.stationarity(tables.daily_prices(spark, d), "close", "day", ["symbol"], lags=None)
    return st.select("symbol", "n", "df_n", "df_lags", "adf_stat", "crit_5", "p_value", "stationary")


@register("arima_order")
def q_arima_order(spark, d):
    """Lowest-AIC ARIMA among p <= 3, d <= 2, q <= 3 (47 orders) per segment."""
    return forecast.arima_select(_seg_total(spark, d), "total", "month", ["segment"], max_p=3, max_d=2, max_q=3,
                                 default=(1, 1, 1))


@register("arima_forecast")
def q_arima_forecast(spark, d):
    """Six months ahead with 95 % intervals and money text, per segment."""
    s = _seg_total(spark, d)
    m = forecast.arima_select(s, "total", "month", ["segment"], max_p=3, max_d=2, max_q=3, default=(1, 1, 1))
    f = forecast.arima_forecast(s, "total", "month", m, ["segment"], horizon=6)
    return f.withColumn("forecast_text", money("forecast")) \
        .withColumn("range_text", F.concat(money("lower"), F.lit(" - "), money("upper")))


@register("arimax_forecast")
def q_arimax_forecast(spark, d):
    """Regression with ARIMA errors: monthly totals on order count and urgent-order count
    per segment (order chosen by AIC, p <= 2, d <= 1, q <= 2), six months ahead with the
    regressors held at their last month."""
    f = tables.segment_orders(spark, d).select("segment", "month", "total", "n_orders", "n_urgent")
    ex = ["n_orders", "n_urgent"]
    m = forecast.arima_select(f, "total", "month", ["segment"], max_p=2, max_d=1, max_q=2, exog=ex)
    fc = forecast.arima_forecast(f, "total", "month", m, ["segment"], horizon=6, exog=ex)
    return fc.join(m.select("segment", "p", "d", "q", "beta"), "segment")


@register("hybrid_forecast")
def q_hybrid_forecast(spark, d):
    """Ridge on regressors + ARIMA on residuals, 3 months, with the scenario uplift."""
    f = tables.segment_features(spark, d)
    fc, _ = forecast.hybrid(f, "total", "month", FEATURES, ["segment"], horizon=3, standardize=FEATURES[:-1])
    return forecast.scenario(fc)


@register("fallback_forecast", f"""WITH {_SEG_SQL},
l AS (SELECT segment, arg_max(total, month) AS last_value, max(month) AS t FROM seg GROUP BY 1)
SELECT segment, CAST(i.range + 1 AS INTEGER) AS step,
       last_day(CAST(t + to_months(CAST(i.range + 1 AS INTEGER)) AS DATE)) AS month_end,
       round(last_value * (1 + 0.01 * i.range), 4) AS forecast, round(last_value, 4) AS linear_part,
       CAST(0.0 AS DOUBLE) AS arima_part
FROM l, range(0, 6) i""")
def q_fallback_forecast(spark, d):
    f = forecast.fallback_forecast(_seg_total(spark, d), "total", "month", ["segment"], horizon=6)
    return finish(f, 4)


@register("fourier_model")
def q_fourier_model(spark, d):
    """Trend + yearly / monthly Fourier terms per symbol on daily closes; 80/20 MAE."""
    p = tables.daily_prices(spark, d).select("symbol", "day", "close")
    return forecast.fourier_model(p, "close", "day", ["symbol"])


@register("backtest")
def q_backtest(spark, d):
    """Last 6 months held out per segment; ARIMA selected on the rest; MAE / RMSE."""
    return forecast.backtest(_seg_total(spark, d), "total", "month", ["segment"], hold=6, max_p=2, max_d=1, max_q=2)


@register("forecast_report")
def q_forecast_report(spark, d):
    s = _seg_total(spark, d)
    m = forecast.arima_select(s, "total", "month", ["segment"], max_p=2, max_d=1, max_q=2)
    f = forecast.arima_forecast(s, "total", "month", m, ["segment"], horizon=6)
    return forecast.forecast_report(s, "total", "month", f, ["segment"])


@register("forecast_document")
def q_forecast_document(spark, d):
    """One JSON forecast document per segment (hybrid model, 3 months)."""
    from ..sources.files import forecast_documents
    f = tables.segment_features(spark, d)
    fc, metrics = forecast.hybrid(f, "total", "month", FEATURES, ["segment"], horizon=3,
                                  standardize=FEATURES[:-1])
    last = f.groupBy("segment").agg(F.max("month").alias("_t"))
    # evaluation: the same model of all but the last three months against those
    past = f.join(last, "segment").where(F.col("month") <= F.add_months("_t", -3)).drop("_t")
    then, _ = forecast.hybrid(past, "total", "month", FEATURES, ["segment"], horizon=3, standardize=FEATURES[:-1])
    then = then.join(last, "segment").select("segment", F.add_months("_t", F.col("step") - 3).alias("month"), "forecast")
    checked = linear.forecast_evaluation(then.join(f.select("segment", "month", "total"), ["segment", "month"]),
                                         "total", "forecast", ["segment"])
    fc = fc.join(last, "segment").withColumn("month", F.add_months("_t", F.col("step")))
    return forecast_documents(fc, metrics, ["segment"], "month", "forecast", evaluation=checked)


_REFIT_SQL = f"""{_SEG_SQL},
x AS (SELECT segment, month, total, CAST(year(month) * 12 + month(month) - 23940 AS DOUBLE) AS x FROM seg),
h AS (SELECT segment, count(*) AS n, regr_slope(total, x) AS b, regr_intercept(total, x) AS a
      FROM x WHERE month < DATE '2000-01-01' GROUP BY 1),
s AS (SELECT x.segment, month, total, a + b * x AS forecast, abs(total - (a + b * x)) / abs(total) AS e
      FROM x JOIN h ON x.segment = h.segment WHERE month >= DATE '2000-01-01')"""


def _split_trend(spark, d):
    """Monthly totals per segment with a month number, before and from 2000 on."""
    x = _seg_total(spark, d).withColumn("x", (F.year("month") * 12 + F.month("month") - 23940).cast("double"))
    return x.where("month < DATE'2000-01-01'"), x.where("month >= DATE'2000-01-01'")


@register("refit_after_alarm", f"""WITH {_REFIT_SQL},
f AS (SELECT segment, min(CASE WHEN e > 0.15 THEN month END) AS alarm FROM s GROUP BY 1),
m AS (SELECT s.segment, avg(e) AS mean_error, count(e) AS compared FROM s JOIN f ON s.segment = f.segment
      AND (f.alarm IS NULL OR s.month <= f.alarm) GROUP BY 1),
r AS (SELECT x.segment, count(*) AS n, regr_slope(total, x) AS b, regr_intercept(total, x) AS a
      FROM x LEFT JOIN f ON x.segment = f.segment WHERE month < DATE '2000-01-01' OR month <= f.alarm GROUP BY 1)
SELECT h.segment, CAST(h.n AS BIGINT) AS n_before, round(h.a, 2) AS intercept_before, round(h.b, 2) AS slope_before,
       f.alarm, round(m.mean_error, 8) AS mean_error, CAST(coalesce(m.compared, 0) AS BIGINT) AS compared,
       CAST(r.n AS BIGINT) AS n, round(r.a, 2) AS intercept, round(r.b, 2) AS slope
FROM h LEFT JOIN f ON h.segment = f.segment LEFT JOIN m ON h.segment = m.segment JOIN r ON h.segment = r.segment""")
def q_refit_after_alarm(spark, d):
    """Monitor, append, refit: trends before 2000 against the months that follow; the first error
    above 15 % appends the months up to it and solves the trend anew from its state."""
    past, new = _split_trend(spark, d)
    r = refit.refit_flagged(past, new, ["segment"], "month", ["x"], "total")
    return r.select("segment", "n_before", F.round("intercept_before", 2).alias("intercept_before"),
                    F.round(F.col("coef_before")[0], 2).alias("slope_before"), F.to_date("alarm").alias("alarm"),
                    F.round("mean_error", 8).alias("mean_error"), "compared", "n",
                    F.round("intercept", 2).alias("intercept"), F.round(F.col("coef")[0], 2).alias("slope"))


@register("forecast_evaluation", f"""WITH {_REFIT_SQL},
v AS (SELECT segment, avg(total) AS m FROM s GROUP BY 1)
SELECT s.segment, CAST(count(*) AS BIGINT) AS predictions, round(1 - sum((total - forecast) ^ 2) / sum((total - v.m) ^ 2), 6) AS r2,
       round(sqrt(avg((total - forecast) ^ 2)), 2) AS rmse, round(avg(abs(total - forecast)), 2) AS mae,
       round(avg(e) * 100, 6) AS mape, round(avg(e), 8) AS mean_error
FROM s JOIN v ON s.segment = v.segment GROUP BY 1""")
def q_forecast_evaluation(spark, d):
    """The evaluation and mean error of forecast documents: trends before 2000 against what followed."""
    from ..sources.files import forecast_documents
    past, new = _split_trend(spark, d)
    about = refit.shifts(past, ["segment"], ["x"], "total")
    model = refit.solve_states(refit.merge_states(refit.gram_state(past, about, ["segment"], ["x"], "total"), ["segment"], 1),
                               about, ["segment"], 1)
    scored = refit.predict(model, new, ["segment"], ["x"])
    checked = linear.forecast_evaluation(scored, "total", "forecast", ["segment"])
    none = F.lit(None).cast("int")
    trained = model.select("segment", F.lit(0.0).alias("alpha_ridge"), none.alias("p"), none.alias("d"), none.alias("q"),
                           F.lit(None).cast("double").alias("aic_arima"), F.lit(None).cast("double").alias("explained_variance"))
    docs = forecast_documents(scored, trained, ["segment"], "month", "forecast", evaluation=checked)
    e = F.col("doc.metrics.evaluation")
    return docs.select("segment", F.size("doc.predictions").cast("long").alias("predictions"), F.round(e["r2"], 6).alias("r2"),
                       F.round(e["rmse"], 2).alias("rmse"), F.round(e["mae"], 2).alias("mae"),
                       F.round(e["mape"], 6).alias("mape"), F.round("doc.mean_error", 8).alias("mean_error"))


# ---- closed forms of fitted models, with oracles ----------------------------------------

@register("trend_line", f"""WITH {_SEG_SQL},
p AS (SELECT segment, month, total, row_number() OVER (PARTITION BY segment ORDER BY month) AS pos FROM seg),
f AS (SELECT segment, regr_slope(total, pos) AS b, regr_intercept(total, pos) AS a FROM p GROUP BY 1)
SELECT p.segment, month, CAST(pos AS BIGINT) AS index, round(total, 2) AS total, round(a + b * pos, 2) AS trend
FROM p JOIN f ON p.segment = f.segment""")
def q_trend_line(spark, d):
    t = linear.poly_trend(_seg_total(spark, d), "total", "month", 1, ["segment"])
    return t.select("segment", "month", F.col("index").cast("long").alias("index"),
                    F.round("total", 2).alias("total"),
                    # trends of cents fall on half cents: the float noise goes before they are rounded
                    F.round(F.round("trend", 6), 2).alias("trend"))


@register("vif_pair", f"""WITH seg AS (
  SELECT c_mktsegment AS segment, date_trunc('month', o_orderdate) AS month, CAST(count(*) AS DOUBLE) AS n_orders,
         CAST(count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS DOUBLE) AS n_urgent
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
v AS (SELECT segment, 1 / (1 - power(corr(n_orders, n_urgent), 2)) AS vif FROM seg GROUP BY 1)
SELECT segment, feature, round(vif, {R}) AS vif, vif > 10 AS high FROM v, (VALUES ('n_orders'), ('n_urgent')) f(feature)""")
def q_vif_pair(spark, d):
    f = tables.segment_orders(spark, d).select("segment", "n_orders", "n_urgent")
    return _rnd(linear.vif(f, ["n_orders", "n_urgent"], ["segment"]))


@register("scenario_fallback", f"""WITH {_SEG_SQL},
l AS (SELECT segment, arg_max(total, month) AS v FROM seg GROUP BY 1),
f AS (SELECT segment, i.range AS i, v * (1 + 0.01 * i.range) AS f FROM l, range(0, 6) i)
SELECT segment, CAST(i + 1 AS INTEGER) AS step, round(f * (1 + 0.005 * i), 2) AS forecast,
       round(f * 0.9 * (1 - 0.005 * i * (1 + 0.1 * i)), 2) AS lower, round(f * 1.1 * (1 + 0.005 * i * (1 + 0.1 * i)), 2) AS upper
FROM f""")
def q_scenario_fallback(spark, d):
    """Scenario uplift of the fallback forecast with bounds of 10 % on both sides."""
    f = forecast.fallback_forecast(_seg_total(spark, d), "total", "month", ["segment"], horizon=6)
    f = f.withColumn("lower", F.col("forecast") * 0.9).withColumn("upper", F.col("forecast") * 1.1)
    return forecast.scenario(f).select("segment", "step", *[F.round(c, 2).alias(c) for c in ("forecast", "lower", "upper")])


@register("report_fallback", f"""WITH {_SEG_SQL},
h AS (SELECT segment, count(total) AS months, avg(total) AS history_mean, arg_min(total, month) AS f,
             arg_max(total, month) AS last_value FROM seg GROUP BY 1)
SELECT segment, CAST(months AS BIGINT) AS months, round(history_mean, 2) AS history_mean, round(last_value, 2) AS last_value,
       round((last_value - f) / f * 100, 4) AS trend_pct, round(last_value * 1.025, 2) AS forecast_mean,
       CAST(2.5 AS DOUBLE) AS change_vs_last_pct, round(last_value * 0.9, 2) AS range_low,
       round(last_value * 1.05 * 1.1, 2) AS range_high, CASE WHEN last_value > f THEN 'alza' ELSE 'baja' END AS direction
FROM h""")
def q_report_fallback(spark, d):
    s = _seg_total(spark, d)
    f = forecast.fallback_forecast(s, "total", "month", ["segment"], horizon=6)
    f = f.withColumn("lower", F.col("forecast") * 0.9).withColumn("upper", F.col("forecast") * 1.1)
    r = forecast.forecast_report(s, "total", "month", f, ["segment"])
    two = [F.round(c, 2).alias(c) for c in ("history_mean", "last_value", "forecast_mean", "range_low", "range_high")]
    return r.select("segment", "months", *two, F.round("trend_pct", 4).alias("trend_pct"),
                    F.round("change_vs_last_pct", 4).alias("change_vs_last_pct"), "direction")


@register("fourier_forecast")
def q_fourier_forecast(spark, d):
    """Thirty days ahead per symbol from trend and Fourier terms of the daily closes."""
    p = tables.daily_prices(spark, d).select("symbol", "day", "close")
    return forecast.fourier_forecast(p, "close", "day", ["symbol"], horizon=30)


@register("forecast_report_models")
def q_forecast_report_models(spark, d):
    """Report per symbol and model: ARIMA and trend + Fourier on daily closes."""
    p = tables.daily_prices(spark, d).select("symbol", "day", "close")
    m = forecast.arima_select(p, "close", "day", ["symbol"], max_p=2, max_d=1, max_q=1)
    models = {"ARIMA": forecast.arima_forecast(p, "close", "day", m, ["symbol"], horizon=30),
              "Fourier": forecast.fourier_forecast(p, "close", "day", ["symbol"], horizon=30)}
    return forecast.forecast_reports(p, "close", "day", models, ["symbol"])


@register("undated_blocks", """WITH
p AS (SELECT o_custkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos FROM orders)
SELECT o_custkey, CAST(floor((pos - 1) / 30.0) AS BIGINT) AS block, CAST(count(*) AS BIGINT) AS n,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM p GROUP BY 1, 2""")
def q_undated_blocks(spark, d):
    """No order carries a date here: every customer's orders are summed in blocks of 30."""
    o = tables.read(spark, d, "orders").withColumn("day", F.lit(None).cast("timestamp"))
    b = calendar.undated_blocks(o, "o_custkey", "o_orderkey",
                                {"n": F.lit(1), "total": F.col("o_totalprice").cast("decimal(18,2)")}, "day")
    return b.withColumn("total", F.col("total").cast("double"))
