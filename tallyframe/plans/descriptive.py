"""Descriptive analytics queries: profiles, group statistics, distributions, outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stats
from . import tables
from .registry import finish, register
from .tables import COMMERCE_SQL, DAILY_SQL

R = 6  # decimals kept in compared floating outputs


def _rnd(df, digits=R, keep=("density",)):
    return finish(df, digits, keep)


def _union_sql(parts):
    return "\nUNION ALL\n".join(parts)


LI_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@register("describe_lineitem", _union_sql([
    f"""SELECT '{c}' AS column, CAST(count({c}) AS DOUBLE) AS count, round(avg({c}), {R}) AS mean,
       round(stddev_samp({c}), {R}) AS std, round(min({c}), {R}) AS min, round(quantile_cont({c}, 0.25), {R}) AS q25,
       round(quantile_cont({c}, 0.5), {R}) AS q50, round(quantile_cont({c}, 0.75), {R}) AS q75,
       round(max({c}), {R}) AS max FROM lineitem""" for c in LI_COLS]))
def q_describe_lineitem(spark, d):
    return _rnd(stats.describe(tables.read(spark, d, "lineitem"), LI_COLS))


@register("summary_by_segment", f"""SELECT c_mktsegment, 'c_acctbal' AS column, CAST(count(c_acctbal) AS DOUBLE) AS count,
       round(sum(c_acctbal), 4) AS sum, round(avg(c_acctbal), {R}) AS mean, round(stddev_samp(c_acctbal), {R}) AS std,
       round(var_samp(c_acctbal), 4) AS var, round(min(c_acctbal), {R}) AS min, round(max(c_acctbal), {R}) AS max,
       round(median(c_acctbal), {R}) AS median
FROM customer GROUP BY c_mktsegment""")
def q_summary_by_segment(spark, d):
    s = stats.summary(tables.read(spark, d, "customer"), ["c_acctbal"], ["c_mktsegment"])
    s = s.withColumn("sum", F.round("sum", 4)).withColumn("var", F.round("var", 4))
    return _rnd(s)


@register("describe_strings", _union_sql([
    f"""SELECT '{c}' AS column, CAST(count({c}) AS BIGINT) AS count, CAST(count(DISTINCT {c}) AS BIGINT) AS "unique",
       (SELECT {c} FROM orders WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
       (SELECT CAST(count(*) AS BIGINT) FROM orders WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS freq
FROM orders""" for c in ("o_orderstatus", "o_orderpriority")]))
def q_describe_strings(spark, d):
    return stats.describe_strings(tables.read(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


_PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
_PART_TYPES = {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string",
               "p_size": "int", "p_retailprice": "double"}


@register("profile_part", _union_sql([
    f"""SELECT '{c}' AS column, '{_PART_TYPES[c]}' AS dtype, CAST(count({c}) AS BIGINT) AS non_null,
       CAST(count(*) - count({c}) AS BIGINT) AS nulls, CAST(count(DISTINCT {c}) AS BIGINT) AS distinct,
       round(CAST(count(*) - count({c}) AS DOUBLE) * 100.0 / count(*), {R}) AS null_pct FROM part""" for c in _PART_COLS]))
def q_profile_part(spark, d):
    return _rnd(stats.profile(tables.read(spark, d, "part"), _PART_COLS))


@register("commerce_by_category", f"""WITH {COMMERCE_SQL}
SELECT category, round(avg(price), {R}) AS price_mean, round(max(price), {R}) AS price_max,
       round(min(price), {R}) AS price_min, CAST(count(*) AS BIGINT) AS orders, round(stddev_samp(price), {R}) AS price_std,
       round(median(quantity), {R}) AS quantity_median, CAST(round(sum(CAST(total_amount AS DECIMAL(18,2))), 2) AS DOUBLE) AS revenue,
       round(avg(delivery_days), {R}) AS delivery_mean
FROM commerce WHERE category IS NOT NULL GROUP BY category""")
def q_commerce_by_category(spark, d):
    c = tables.commerce(spark, d)
    g = stats.group_agg(c, ["category"], {
        "price_mean": F.avg("price"), "price_max": F.max("price"), "price_min": F.min("price"),
        "orders": F.count(F.lit(1)), "price_std": F.stddev_samp("price"),
        "revenue": F.sum(F.col("total_amount").cast("decimal(18,2)")),
        "delivery_mean": F.avg("delivery_days")})
    med = stats.quantiles(c.where("category IS NOT NULL"), "quantity", [0.5], ["category"])
    g = g.join(med.withColumnRenamed("q50", "quantity_median"), "category", "left")
    return _rnd(g.withColumn("revenue", F.round("revenue", 2)))


@register("value_counts_priority", f"""SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS count,
       round(CAST(count(*) AS DOUBLE) * 100.0 / sum(count(*)) OVER (), {R}) AS share_pct
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1""")
def q_value_counts_priority(spark, d):
    return _rnd(stats.value_counts(tables.read(spark, d, "orders"), "o_orderpriority"))


@register("group_size", f"""WITH {COMMERCE_SQL}
SELECT category, payment, CAST(count(*) AS BIGINT) AS count FROM commerce GROUP BY 1, 2""")
def q_group_size(spark, d):
    return tables.commerce(spark, d).groupBy("category", "payment").count()


@register("mode_by_segment", """WITH c AS (SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer
                WHERE c_nationkey IS NOT NULL GROUP BY 1, 2),
m AS (SELECT c_mktsegment, max(n) AS mx FROM c GROUP BY 1)
SELECT c.c_mktsegment, min(c.c_nationkey) AS mode FROM c JOIN m ON c.c_mktsegment = m.c_mktsegment AND c.n = m.mx
GROUP BY 1""")
def q_mode_by_segment(spark, d):
    return stats.mode(tables.read(spark, d, "customer"), "c_nationkey", ["c_mktsegment"])


@register("quantiles_by_flag", f"""SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.1), {R}) AS q10,
       round(quantile_cont(l_extendedprice, 0.25), {R}) AS q25, round(quantile_cont(l_extendedprice, 0.5), {R}) AS q50,
       round(quantile_cont(l_extendedprice, 0.75), {R}) AS q75, round(quantile_cont(l_extendedprice, 0.9), {R}) AS q90
FROM lineitem GROUP BY 1""")
def q_quantiles_by_flag(spark, d):
    return _rnd(stats.quantiles(tables.read(spark, d, "lineitem"), "l_extendedprice",
                                [0.1, 0.25, 0.5, 0.75, 0.9], ["l_returnflag"]))


@register("shape_by_segment", f"""WITH g AS (SELECT c_mktsegment, count(c_acctbal) AS n, avg(c_acctbal) AS mean,
       median(c_acctbal) AS median, stddev_samp(c_acctbal) AS std, skewness(c_acctbal) AS skewness,
       kurtosis(c_acctbal) AS kurtosis, max(c_acctbal) - min(c_acctbal) AS range
  FROM customer WHERE c_acctbal IS NOT NULL GROUP BY 1)
SELECT c_mktsegment, CAST(n AS BIGINT) AS n, round(mean, {R}) AS mean, round(median, {R}) AS median, round(std, {R}) AS std,
       round(skewness, {R}) AS skewness, round(kurtosis, {R}) AS kurtosis, round(range, {R}) AS range,
       round(std / mean * 100, {R}) AS cv_pct,
       CASE WHEN skewness IS NULL THEN NULL WHEN abs(skewness) < 0.5 THEN 'simetrica'
            WHEN skewness > 0 THEN 'sesgo derecha' ELSE 'sesgo izquierda' END AS skew_direction,
       CASE WHEN mean > median THEN 'derecha' ELSE 'izquierda' END AS mean_vs_median
FROM g""")
def q_shape_by_segment(spark, d):
    return _rnd(stats.shape(tables.read(spark, d, "customer"), "c_acctbal", ["c_mktsegment"]))


@register("corr_by_flag", f"""SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), {R}) AS r,
       CAST(count(*) AS BIGINT) AS n,
       CASE WHEN abs(corr(l_quantity, l_extendedprice)) < 0.3 THEN 'debil'
            WHEN abs(corr(l_quantity, l_extendedprice)) < 0.7 THEN 'moderada' ELSE 'fuerte' END AS strength
FROM lineitem GROUP BY 1""")
def q_corr_by_flag(spark, d):
    return _rnd(stats.corr_pair(tables.read(spark, d, "lineitem"), "l_quantity", "l_extendedprice",
                                ["l_returnflag"]))


_CM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("corr_matrix", _union_sql(
    [f"SELECT '{x}' AS a, '{y}' AS b, round(corr({x}, {y}), {R}) AS r FROM lineitem"
     for i, x in enumerate(_CM) for y in _CM[i + 1:]]
    + [f"SELECT '{c}' AS a, '{c}' AS b, CAST(1.0 AS DOUBLE) AS r" for c in _CM]))
def q_corr_matrix(spark, d):
    return _rnd(stats.corr_matrix(tables.read(spark, d, "lineitem"), _CM))


@register("histogram_price", f"""WITH v AS (SELECT l_extendedprice AS v FROM lineitem WHERE l_extendedprice IS NOT NULL),
r AS (SELECT min(v) AS lo, max(v) AS hi, count(*) AS n FROM v),
b AS (SELECT least(CASE WHEN hi = lo THEN 1 ELSE CAST(floor((v - lo) / (hi - lo) * 20) AS INTEGER) + 1 END, 20) AS bin
      FROM v, r),
c AS (SELECT bin, count(*) AS c FROM b GROUP BY 1),
s AS (SELECT CAST(range AS INTEGER) AS bin FROM range(1, 21))
SELECT s.bin, round(lo + (s.bin - 1) * (hi - lo) / 20, {R}) AS lo, round(lo + s.bin * (hi - lo) / 20, {R}) AS hi,
       CAST(coalesce(c.c, 0) AS BIGINT) AS count,
       round(coalesce(c.c, 0) / (n * ((hi - lo) / 20)), 12) AS density,
       CAST(sum(coalesce(c.c, 0)) OVER (ORDER BY s.bin) AS BIGINT) AS cum_count
FROM s CROSS JOIN r LEFT JOIN c ON c.bin = s.bin""")
def q_histogram_price(spark, d):
    h = stats.histogram(tables.read(spark, d, "lineitem"), "l_extendedprice", 20)
    h = h.withColumn("density", F.round("density", 12)).withColumn("cum_count", F.col("cum_count").cast("long"))
    return _rnd(h)


@register("box_stats_category", f"""WITH {COMMERCE_SQL},
q AS (SELECT category, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median,
             quantile_cont(price, 0.75) AS q3 FROM commerce WHERE price IS NOT NULL GROUP BY 1)
SELECT q.category, round(q1, {R}) AS q1, round(median, {R}) AS median, round(q3, {R}) AS q3,
       round(min(CASE WHEN price >= q1 - 1.5 * (q3 - q1) THEN price END), {R}) AS whisker_low,
       round(max(CASE WHEN price <= q3 + 1.5 * (q3 - q1) THEN price END), {R}) AS whisker_high,
       CAST(count(CASE WHEN price < q1 - 1.5 * (q3 - q1) OR price > q3 + 1.5 * (q3 - q1) THEN 1 END) AS BIGINT) AS outliers,
       CAST(count(price) AS BIGINT) AS n, round(q3 - q1, {R}) AS iqr
FROM commerce c JOIN q ON c.category = q.category WHERE price IS NOT NULL GROUP BY q.category, q1, median, q3""")
def q_box_stats_category(spark, d):
    return _rnd(stats.box_stats(tables.commerce(spark, d), "price", ["category"]))


@register("iqr_outliers", """WITH q AS (SELECT l_returnflag, quantile_cont(l_quantity * l_extendedprice, 0.25) AS q25,
       quantile_cont(l_quantity * l_extendedprice, 0.75) AS q75 FROM lineitem GROUP BY 1)
SELECT l.l_orderkey, l.l_linenumber, l.l_returnflag, l.l_quantity * l.l_extendedprice AS amount
FROM lineitem l JOIN q ON l.l_returnflag = q.l_returnflag
WHERE l.l_quantity * l.l_extendedprice < q25 - 1.5 * (q75 - q25) OR l.l_quantity * l.l_extendedprice > q75 + 1.5 * (q75 - q25)""")
def q_iqr_outliers(spark, d):
    li = tables.read(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", (F.col("l_quantity") * F.col("l_extendedprice")).alias("amount"))
    return stats.iqr_outliers(li, "amount", ["l_returnflag"])


@register("high_value_days", f"""WITH {DAILY_SQL},
c AS (SELECT avg(volume) + stddev_samp(volume) AS cut FROM daily)
SELECT symbol, day, volume FROM daily, c WHERE volume > cut""")
def q_high_value_days(spark, d):
    return stats.above_mean_std(tables.daily_prices(spark, d).select("symbol", "day", "volume"), "volume")


@register("kde_discount", f"""WITH v AS (SELECT l_discount AS v, count(*) AS w FROM lineitem WHERE l_discount IS NOT NULL GROUP BY 1),
s AS (SELECT min(v) AS lo, max(v) AS hi, sum(w) AS n, sum(v * w) AS s1, sum(v * v * w) AS s2 FROM v),
h AS (SELECT lo, hi, n, power(n, -0.2) * sqrt(greatest(0.0, (s2 - s1 * s1 / n) / (n - 1))) AS h FROM s),
g AS (SELECT CAST(range AS INTEGER) AS point, lo + (hi - lo) * range / 49 AS x, h, n FROM h, range(0, 50))
SELECT point, round(x, {R}) AS x, round(sum(exp(-0.5 * power((x - v) / h, 2)) * w) / (n * h * sqrt(2 * pi())), 8) AS density
FROM g, v GROUP BY point, x, n, h""")
def q_kde_discount(spark, d):
    k = stats.kde(tables.read(spark, d, "lineitem"), "l_discount", 50)
    return _rnd(k.withColumn("density", F.round("density", 8)).withColumn("point", F.col("point").cast("int")))


@register("kde_by_flag", f"""WITH v AS (SELECT l_returnflag AS k, l_discount AS v, count(*) AS w FROM lineitem WHERE l_discount IS NOT NULL GROUP BY 1, 2),
s AS (SELECT k, min(v) AS lo, max(v) AS hi, sum(w) AS n, sum(v * w) AS s1, sum(v * v * w) AS s2 FROM v GROUP BY 1),
h AS (SELECT k, lo, hi, n, power(n, -0.2) * sqrt(greatest(0.0, (s2 - s1 * s1 / n) / (n - 1))) AS h FROM s),
g AS (SELECT k, CAST(range AS INTEGER) AS point, lo + (hi - lo) * range / 49 AS x, h, n FROM h, range(0, 50))
SELECT g.k AS l_returnflag, point, round(x, {R}) AS x,
       round(sum(exp(-0.5 * power((x - v) / h, 2)) * w) / (n * h * sqrt(2 * pi())), 8) AS density
FROM g JOIN v ON g.k IS NOT DISTINCT FROM v.k GROUP BY g.k, point, x, n, h""")
def q_kde_by_flag(spark, d):
    """Violin form: one density curve per return flag."""
    k = stats.kde(tables.read(spark, d, "lineitem"), "l_discount", 50, ["l_returnflag"])
    return _rnd(k.withColumn("density", F.round("density", 8)).withColumn("point", F.col("point").cast("int")))


@register("normal_curve", f"""WITH s AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi, avg(c_acctbal) AS m,
       stddev_samp(c_acctbal) AS sd FROM customer),
g AS (SELECT CAST(range AS INTEGER) AS point, lo + (hi - lo) * range / 99 AS x, m, sd FROM s, range(0, 100))
SELECT point, round(x, {R}) AS x, round(exp(-0.5 * power((x - m) / sd, 2)) / (sd * sqrt(2 * pi())), 12) AS density FROM g""")
def q_normal_curve(spark, d):
    n = stats.normal_curve(tables.read(spark, d, "customer"), "c_acctbal", 100)
    return _rnd(n.withColumn("density", F.round("density", 12)))


@register("group_contrast", f"""WITH g AS (SELECT c_mktsegment AS k, avg(c_acctbal) AS m FROM customer
       WHERE c_mktsegment IS NOT NULL GROUP BY 1),
a AS (SELECT min(k) AS group_a FROM g),
b AS (SELECT min(k) AS group_b FROM g, a WHERE k > group_a)
SELECT group_a, group_b, round(abs(ga.m - gb.m), {R}) AS difference, abs(ga.m - gb.m) > 2 AS notable
FROM a, b, g ga, g gb WHERE ga.k = group_a AND gb.k = group_b""")
def q_group_contrast(spark, d):
    return _rnd(stats.group_contrast(tables.read(spark, d, "customer"), "c_mktsegment", "c_acctbal"))


_DAILY_RET_SQL = f"""{DAILY_SQL},
ret AS (SELECT symbol, day, (close / lag(close) OVER (PARTITION BY symbol ORDER BY day) - 1) * 100 AS ret FROM daily)"""


@register("return_stats", f"""WITH {_DAILY_RET_SQL}
SELECT symbol, CAST(count(ret) AS BIGINT) AS days, CAST(count_if(ret > 0) AS BIGINT) AS positive_days,
       CAST(count_if(ret < 0) AS BIGINT) AS negative_days, round(stddev_samp(ret) * sqrt(252), {R}) AS volatility_annual,
       round(max(ret), {R}) AS best_return, arg_max(day, ret) AS best_day, round(min(ret), {R}) AS worst_return,
       arg_min(day, ret) AS worst_day, round(CAST(count_if(ret > 0) AS DOUBLE) * 100.0 / count(ret), {R}) AS positive_pct,
       round(CAST(count_if(ret < 0) AS DOUBLE) * 100.0 / count(ret), {R}) AS negative_pct
FROM ret GROUP BY symbol""")
def q_return_stats(spark, d):
    from ..operators import windows
    r = windows.pct_change(tables.daily_prices(spark, d), "close", "day", ["symbol"], "ret")
    return _rnd(stats.return_stats(r, "ret", "day", ["symbol"]))


@register("signed_histogram", f"""WITH {_DAILY_RET_SQL},
v AS (SELECT ret AS v FROM ret WHERE ret IS NOT NULL AND ret <> 0),
r AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
b AS (SELECT CASE WHEN v > 0 THEN 'positive' ELSE 'negative' END AS sign,
             least(CASE WHEN hi = lo THEN 1 ELSE CAST(floor((v - lo) / (hi - lo) * 15) AS INTEGER) + 1 END, 15) AS bin
      FROM v, r),
c AS (SELECT sign, bin, count(*) AS c FROM b GROUP BY 1, 2),
s AS (SELECT sg.sign, CAST(range AS INTEGER) AS bin FROM range(1, 16), (VALUES ('positive'), ('negative')) sg(sign))
SELECT s.sign, s.bin, round(lo + (s.bin - 1) * (hi - lo) / 15, {R}) AS lo, round(lo + s.bin * (hi - lo) / 15, {R}) AS hi,
       CAST(coalesce(c.c, 0) AS BIGINT) AS count
FROM s CROSS JOIN r LEFT JOIN c ON c.sign = s.sign AND c.bin = s.bin""")
def q_signed_histogram(spark, d):
    from ..operators import windows
    r = windows.pct_change(tables.daily_prices(spark, d), "close", "day", ["symbol"], "ret")
    return _rnd(stats.signed_histogram(r, "ret", 15))


@register("qq_points", f"""WITH v AS (SELECT c_mktsegment, c_acctbal AS value,
       row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal) AS pos,
       count(*) OVER (PARTITION BY c_mktsegment) AS n FROM customer WHERE c_acctbal IS NOT NULL),
m AS (SELECT *, CASE WHEN pos = 1 THEN 1 - power(0.5, 1.0 / n) WHEN pos = n THEN power(0.5, 1.0 / n)
                     ELSE (pos - 0.3175) / (n + 0.365) END AS mp FROM v),
t AS (SELECT c_mktsegment, value, pos, n, {{ppf}} AS theoretical FROM m),
f AS (SELECT c_mktsegment, regr_slope(value, theoretical) AS slope, regr_intercept(value, theoretical) AS intercept,
             corr(value, theoretical) AS r FROM t GROUP BY 1)
SELECT t.c_mktsegment, round(value, {R}) AS value, CAST(pos AS BIGINT) AS pos, CAST(n AS BIGINT) AS n,
       round(theoretical, {R}) AS theoretical, round(slope, 4) AS slope, round(intercept, 4) AS intercept,
       round(r, {R}) AS r
FROM t JOIN f ON t.c_mktsegment = f.c_mktsegment""".replace("{ppf}", __import__(
    "tallyframe.functions.mathx", fromlist=["x"]).norm_ppf_sql("mp")))
def q_qq_points(spark, d):
    q = stats.qq_points(tables.read(spark, d, "customer").select("c_mktsegment", "c_acctbal"),
                        "c_acctbal", ["c_mktsegment"])
    q = q.select("c_mktsegment", "value", F.col("pos").cast("long").alias("pos"), F.col("n").cast("long").alias("n"),
                 "theoretical", F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"), "r")
    return _rnd(q)


def _shapiro_sql():
    from ..functions.mathx import norm_cdf_sql, norm_ppf_sql
    an = ("mn / sqrt(mm) + 0.221157 * u - 0.147981 * power(u, 2) - 2.07119 * power(u, 3) "
          "+ 4.434685 * power(u, 4) - 2.706056 * power(u, 5)")
    an1 = ("mn1 / sqrt(mm) + 0.042981 * u - 0.293762 * power(u, 2) - 1.752461 * power(u, 3) "
           "+ 5.682633 * power(u, 4) - 3.582633 * power(u, 5)")
    lnn = "ln(CAST(n AS DOUBLE))"
    mu_big = f"(0.0038915 * power({lnn}, 3) - 0.083751 * power({lnn}, 2) - 0.31082 * {lnn} - 1.5861)"
    sg_big = f"exp(0.0030302 * power({lnn}, 2) - 0.082676 * {lnn} - 0.4803)"
    mu_small = "(-0.0006714 * power(n, 3) + 0.025054 * power(n, 2) - 0.39978 * n + 0.544)"
    sg_small = "exp(-0.0020322 * power(n, 3) + 0.062767 * power(n, 2) - 0.77857 * n + 1.3822)"
    z = (f"CASE WHEN n >= 12 THEN (ln(1 - W) - {mu_big}) / {sg_big} "
         f"ELSE (-ln(0.459 * n - 2.273 - ln(1 - W)) - {mu_small}) / {sg_small} END")
    return f"""WITH v AS (SELECT c_mktsegment, c_acctbal AS x FROM customer WHERE c_acctbal IS NOT NULL),
p AS (SELECT c_mktsegment, x, row_number() OVER (PARTITION BY c_mktsegment ORDER BY x) AS pos,
             count(*) OVER (PARTITION BY c_mktsegment) AS n FROM v),
m AS (SELECT *, {norm_ppf_sql("(CAST(pos AS DOUBLE) - 0.375) / (CAST(n AS DOUBLE) + 0.25)")} AS m FROM p),
s AS (SELECT c_mktsegment, sum(m * m) AS mm, max(n) AS n, avg(x) AS mean FROM m GROUP BY 1),
c AS (SELECT *, 1 / sqrt(CAST(n AS DOUBLE)) AS u,
             {norm_ppf_sql("(CAST(n AS DOUBLE) - 0.375) / (CAST(n AS DOUBLE) + 0.25)")} AS mn,
             {norm_ppf_sql("(CAST(n AS DOUBLE) - 1 - 0.375) / (CAST(n AS DOUBLE) + 0.25)")} AS mn1 FROM s),
a AS (SELECT *, {an} AS an, CASE WHEN n > 5 THEN {an1} END AS an1 FROM c),
e AS (SELECT *, CASE WHEN n > 5 THEN (mm - 2 * mn * mn - 2 * mn1 * mn1) / (1 - 2 * an * an - 2 * an1 * an1)
                     ELSE (mm - 2 * mn * mn) / (1 - 2 * an * an) END AS eps FROM a),
w AS (SELECT m.c_mktsegment, max(m.n) AS n,
             sum(CASE WHEN m.pos = m.n THEN an WHEN m.pos = 1 THEN -an
                      WHEN m.pos = m.n - 1 AND an1 IS NOT NULL THEN an1 WHEN m.pos = 2 AND an1 IS NOT NULL THEN -an1
                      ELSE m.m / sqrt(eps) END * x) AS num,
             sum((x - mean) * (x - mean)) AS ss
      FROM m JOIN e ON m.c_mktsegment = e.c_mktsegment GROUP BY 1),
ww AS (SELECT c_mktsegment, n, least(1.0, num * num / ss) AS W FROM w),
pz AS (SELECT *, {z} AS z FROM ww),
pv AS (SELECT *, CASE WHEN n < 4 THEN NULL ELSE 1 - {norm_cdf_sql("z")} END AS p_value FROM pz)
SELECT c_mktsegment, CAST(n AS BIGINT) AS n, round(W, 6) AS W, round(p_value, 6) AS p_value,
       CASE WHEN p_value IS NULL THEN NULL WHEN p_value > 0.05 THEN 'normal' ELSE 'no normal' END AS verdict
FROM pv"""


@register("shapiro_wilk", _shapiro_sql())
def q_shapiro_wilk(spark, d):
    """Normality of account balances per market segment (Royston's approximation)."""
    s = stats.shapiro_wilk(tables.read(spark, d, "customer"), "c_acctbal", ["c_mktsegment"])
    return _rnd(s.withColumn("n", F.col("n").cast("long")))


@register("nulls_before_after", """WITH p AS (SELECT l_orderkey, nullif(l_discount, 0) AS discount, nullif(l_tax, 0) AS tax FROM lineitem)
SELECT 'before' AS stage, 'discount' AS column, CAST(count(*) - count(discount) AS BIGINT) AS nulls FROM p
UNION ALL SELECT 'before', 'tax', CAST(count(*) - count(tax) AS BIGINT) FROM p
UNION ALL SELECT 'after', 'discount', CAST(0 AS BIGINT) UNION ALL SELECT 'after', 'tax', CAST(0 AS BIGINT)""")
def q_nulls_before_after(spark, d):
    from ..operators import clean
    li = tables.read(spark, d, "lineitem").select(
        "l_orderkey", F.expr("nullif(l_discount, 0)").alias("discount"), F.expr("nullif(l_tax, 0)").alias("tax"))
    filled = clean.impute_mean_mode(li, ["discount", "tax"], [])
    return clean.null_counts_before_after(li, filled, ["discount", "tax"])
