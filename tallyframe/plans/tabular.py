"""Projection / filter / cleaning, cross-tab, calendar, window and join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expr import band, band_desc, clean_amount, clip, exact_mean, parse_bilingual_date, safe_double
from ..operators import calendar, clean, crosstab, stats, windows
from . import tables
from .registry import finish, register
from .tables import COMMERCE_SQL, DAILY_SQL, LOG_SQL

R = 6


def _rnd(df, digits=R):
    return finish(df, digits)


# ---- projection, filters, coercion --------------------------------------------------

@register("select_rename", """SELECT o_orderkey AS order_id, o_totalprice AS total, c_mktsegment AS info_segment,
       c_nationkey AS info_nation FROM orders JOIN customer ON o_custkey = c_custkey""")
def q_select_rename(spark, d):
    o = tables.read(spark, d, "orders")
    c = tables.read(spark, d, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", "o_totalprice", F.struct(F.col("c_mktsegment").alias("segment"),
                                               F.col("c_nationkey").alias("nation")).alias("info"))
    return clean.flatten(clean.rename(j, {"o_orderkey": "order_id", "o_totalprice": "total"}), "info")


@register("derived_columns", f"""WITH {DAILY_SQL}
SELECT symbol, day, round((high + low) / 2, {R}) AS mid, round((close - open) / open * 100, {R}) AS change_pct,
       round(high - low, {R}) AS spread FROM daily""")
def q_derived_columns(spark, d):
    p = tables.daily_prices(spark, d)
    return _rnd(p.select("symbol", "day", ((F.col("high") + F.col("low")) / 2).alias("mid"),
                         ((F.col("close") - F.col("open")) / F.col("open") * 100).alias("change_pct"),
                         (F.col("high") - F.col("low")).alias("spread")))


@register("filter_orders", """SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
WHERE (o_orderstatus = 'F' AND o_totalprice BETWEEN 100000 AND 200000) OR o_orderpriority = '1-URGENT'""")
def q_filter_orders(spark, d):
    o = tables.read(spark, d, "orders")
    return o.where(((F.col("o_orderstatus") == "F") & F.col("o_totalprice").between(100000, 200000))
                   | (F.col("o_orderpriority") == "1-URGENT")).select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


_STRICT = "kind = 'purchase' AND size_gb > 300 AND rate > 95"
_RELAXED = "(kind = 'purchase' OR size_gb > 300) AND rate > 95"


@register("filter_cascade", f"""WITH {LOG_SQL},
t AS (SELECT *, CASE WHEN {_STRICT} THEN 0 WHEN {_RELAXED} THEN 1 ELSE 2 END AS lvl FROM plog)
SELECT event_id, kind, size_gb, rate FROM t WHERE lvl <= (SELECT min(lvl) FROM t)""")
def q_filter_cascade(spark, d):
    log = tables.processing_log(spark, d)
    return clean.filter_cascade(log, F.expr(_STRICT), F.expr(_RELAXED)).select("event_id", "kind", "size_gb", "rate")


@register("log_summary", f"""WITH {LOG_SQL},
t AS (SELECT *, CASE WHEN {_STRICT} THEN 0 WHEN {_RELAXED} THEN 1 ELSE 2 END AS lvl FROM plog),
f AS (SELECT * FROM t WHERE lvl <= (SELECT min(lvl) FROM t))
SELECT kind, CAST(count(*) AS BIGINT) AS records, round(avg(size_gb), {R}) AS mean_size_gb,
       round(sum(rate), {R}) AS total_rate FROM f GROUP BY kind""")
def q_log_summary(spark, d):
    log = clean.filter_cascade(tables.processing_log(spark, d), F.expr(_STRICT), F.expr(_RELAXED))
    return _rnd(stats.group_agg(log, ["kind"], {"records": F.count(F.lit(1)), "mean_size_gb": F.avg("size_gb"),
                                                "total_rate": F.sum("rate")}))


@register("isin_filter", """SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag IN ('R', 'A')""")
def q_isin_filter(spark, d):
    li = tables.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return clean.isin(li, "l_returnflag", ["R", "A"])


@register("isin_semi_join", """SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def q_isin_semi_join(spark, d):
    o = tables.read(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = tables.read(spark, d, "customer").where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    return clean.isin(o, "o_custkey", c)


# Mark bands (lower bounds, inclusive) and age bands.
MARK_BANDS = [(90, True, "A"), (80, True, "B"), (70, True, "C"), (60, True, "D")]
AGE_BANDS = [(23, False, "Joven (< 23)"), (26, True, "Adulto Joven (23-26)")]


@register("band_labels", """SELECT p_partkey,
       CASE WHEN p_size * 2 >= 90 THEN 'A' WHEN p_size * 2 >= 80 THEN 'B' WHEN p_size * 2 >= 70 THEN 'C'
            WHEN p_size * 2 >= 60 THEN 'D' ELSE 'F' END AS mark_band,
       CASE WHEN p_size < 23 THEN 'Joven (< 23)' WHEN p_size <= 26 THEN 'Adulto Joven (23-26)' ELSE 'Adulto (> 26)' END AS age_band,
       p_retailprice > 1500 AS premium
FROM part""")
def q_band_labels(spark, d):
    p = tables.read(spark, d, "part")
    return p.select("p_partkey", band_desc(F.col("p_size") * 2, MARK_BANDS, "F").alias("mark_band"),
                    band("p_size", AGE_BANDS, "Adulto (> 26)").alias("age_band"),
                    (F.col("p_retailprice") > 1500).alias("premium"))


@register("statement_cleaning", """SELECT o_orderkey AS doc, CAST(o_orderdate AS DATE) AS fecha,
       CASE WHEN o_orderstatus <> 'F' AND o_orderpriority <> '5-LOW' THEN o_totalprice ELSE 0.0 END AS debit,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0.0 END AS credit
FROM orders""")
def q_statement_cleaning(spark, d):
    s = tables.statement_strings(spark, tables.read(spark, d, "orders"))
    return s.select("doc", F.to_date(parse_bilingual_date("fecha")).alias("fecha"),
                    clean_amount("debitos").alias("debit"), clean_amount("creditos").alias("credit"))


@register("coerce_values", """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
       TRY_CAST(event_type AS DOUBLE) AS type_as_number, TRY_CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS ts
FROM events""")
def q_coerce_values(spark, d):
    e = tables.read(spark, d, "events")
    return e.select("event_id", safe_double(F.get_json_object("props", "$.k")).alias("k"),
                    safe_double("event_type").alias("type_as_number"),
                    F.col("ts").cast("string").try_cast("timestamp_ntz").alias("ts"))


_NULLED = """SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS discount, nullif(l_tax, 0) AS tax,
       nullif(l_linestatus, 'O') AS linestatus FROM lineitem"""


def _nulled(spark, d):
    return tables.read(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr("nullif(l_discount, 0)").alias("discount"),
        F.expr("nullif(l_tax, 0)").alias("tax"), F.expr("nullif(l_linestatus, 'O')").alias("linestatus"))


@register("drop_nulls", f"""WITH n AS ({_NULLED})
SELECT l_orderkey, l_linenumber, discount, tax FROM n WHERE discount IS NOT NULL AND tax IS NOT NULL""")
def q_drop_nulls(spark, d):
    return clean.drop_nulls(_nulled(spark, d), ["discount", "tax"]).select("l_orderkey", "l_linenumber",
                                                                           "discount", "tax")


@register("impute_mean_mode", f"""WITH n AS ({_NULLED}),
f AS (SELECT avg(discount) AS md, avg(tax) AS mt, coalesce(
        (SELECT linestatus FROM n WHERE linestatus IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
        'Desconocido') AS ml FROM n)
SELECT l_orderkey, l_linenumber, round(coalesce(discount, md), {R}) AS discount, round(coalesce(tax, mt), {R}) AS tax,
       coalesce(linestatus, ml) AS linestatus FROM n, f""")
def q_impute_mean_mode(spark, d):
    return _rnd(clean.impute_mean_mode(_nulled(spark, d), ["discount", "tax"], ["linestatus"]))


@register("impute_median", f"""WITH n AS ({_NULLED}),
f AS (SELECT coalesce(median(discount), avg(discount), 0.0) AS md, coalesce(median(tax), avg(tax), 0.0) AS mt FROM n)
SELECT l_orderkey, l_linenumber, round(coalesce(discount, md), {R}) AS discount, round(coalesce(tax, mt), {R}) AS tax
FROM n, f""")
def q_impute_median(spark, d):
    return _rnd(clean.impute_median(_nulled(spark, d).drop("linestatus"), ["discount", "tax"]))


@register("head_rows", """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
ORDER BY o_orderdate, o_orderkey LIMIT 10""")
def q_head_rows(spark, d):
    o = tables.read(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return clean.head(o, 10, ["o_orderdate", "o_orderkey"])


@register("sample_rows", """SELECT o_orderkey, o_totalprice FROM orders
ORDER BY CAST((CAST(o_orderkey + 42 AS DECIMAL(20,0)) * CAST(2654435761 AS DECIMAL(10,0))) % CAST(4294967296 AS DECIMAL(10,0)) AS DOUBLE) / 4294967296.0, o_orderkey
LIMIT 100""")
def q_sample_rows(spark, d):
    """Seeded uniform sample of 100 orders (hash order of the key: partition-independent)."""
    return clean.sample_n(tables.read(spark, d, "orders").select("o_orderkey", "o_totalprice"), 100, "o_orderkey", 42)


@register("required_columns", """SELECT * FROM (VALUES
  (CAST((SELECT count(*) FROM orders) AS BIGINT), 'o_orderkey', true, CAST((SELECT count(*) - count(o_orderkey) FROM orders) AS BIGINT), true),
  (CAST((SELECT count(*) FROM orders) AS BIGINT), 'o_totalprice', true, CAST((SELECT count(*) - count(o_totalprice) FROM orders) AS BIGINT), true),
  (CAST((SELECT count(*) FROM orders) AS BIGINT), 'o_missing', false, CAST(NULL AS BIGINT), true)
) t(rows, "column", present, nulls, enough_rows)""")
def q_required_columns(spark, d):
    return clean.check_required(tables.read(spark, d, "orders"), ["o_orderkey", "o_totalprice", "o_missing"], 8)


@register("clip_values", f"""SELECT c_custkey, round(CASE WHEN c_acctbal IS NULL THEN NULL
       ELSE greatest(0, least(5000, c_acctbal)) END, {R}) AS acctbal_clipped FROM customer""")
def q_clip_values(spark, d):
    c = tables.read(spark, d, "customer")
    return _rnd(c.select("c_custkey", clip("c_acctbal", 0.0, 5000.0).alias("acctbal_clipped")))


_PRIOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("one_hot", "SELECT o_orderkey, " + ", ".join(
    f"CAST(o_orderpriority = '{p}' AS INTEGER) AS \"o_orderpriority_{p}\"" for p in _PRIOS[1:]) + " FROM orders")
def q_one_hot(spark, d):
    o = tables.read(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return clean.one_hot(o, "o_orderpriority").drop("o_orderpriority")


@register("standardize", f"""WITH p AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq,
       avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp FROM lineitem WHERE l_shipdate < DATE '1999-01-01')
SELECT l_orderkey, l_linenumber, round((l_quantity - mq) / sq, {R}) AS l_quantity,
       round((l_extendedprice - mp) / sp, {R}) AS l_extendedprice FROM lineitem, p""")
def q_standardize(spark, d):
    li = tables.read(spark, d, "lineitem")
    fit = li.where(F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    out = clean.standardize(fit, ["l_quantity", "l_extendedprice"],
                            li.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"))
    return _rnd(out)


# ---- cross-tab, rates, calendar -----------------------------------------------------

_CATS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@register("crosstab_revenue", f"""WITH {COMMERCE_SQL}
SELECT payment, """ + ", ".join(
    f"round(coalesce(sum(CASE WHEN category = '{c}' THEN total_amount END), 0), 4) AS \"{c}\"" for c in _CATS)
    + " FROM commerce WHERE payment IS NOT NULL GROUP BY payment")
def q_crosstab_revenue(spark, d):
    x = crosstab.crosstab(tables.commerce(spark, d), "payment", "category", _CATS, F.sum("total_amount"), 0.0)
    return finish(x, 4)


@register("crosstab_count", f"""WITH {COMMERCE_SQL}
SELECT category, """ + ", ".join(
    f"CAST(count(CASE WHEN returned = {r} THEN 1 END) AS BIGINT) AS \"{r}\"" for r in (0, 1))
    + " FROM commerce WHERE category IS NOT NULL GROUP BY category")
def q_crosstab_count(spark, d):
    return crosstab.crosstab(tables.commerce(spark, d), "category", "returned", [0, 1])


@register("return_share", f"""WITH {COMMERCE_SQL},
x AS (SELECT category, count(CASE WHEN returned = 1 THEN 1 END) AS returned_rows,
             count(CASE WHEN returned = 0 THEN 1 END) AS kept_rows FROM commerce GROUP BY category)
SELECT category, CAST(returned_rows AS BIGINT) AS returned_rows, CAST(kept_rows AS BIGINT) AS kept_rows,
       round(CAST(returned_rows AS DOUBLE) * 100.0 / (returned_rows + kept_rows), {R}) AS share_pct FROM x""")
def q_return_share(spark, d):
    x = crosstab.crosstab(tables.commerce(spark, d), "category", "returned", [1, 0])
    x = x.withColumnRenamed("1", "returned_rows").withColumnRenamed("0", "kept_rows")
    return _rnd(crosstab.row_share(x, "returned_rows", "kept_rows"))


@register("return_rate", f"""WITH {COMMERCE_SQL}
SELECT category, round(avg(CAST(returned AS DOUBLE)) * 100, 2) AS rate_pct, CAST(count(*) AS BIGINT) AS rows
FROM commerce GROUP BY category""")
def q_return_rate(spark, d):
    return crosstab.group_rate(tables.commerce(spark, d), ["category"], "returned")


@register("discount_rate", f"""WITH {COMMERCE_SQL}
SELECT discount, round(avg(CAST(returned AS DOUBLE)) * 100, 2) AS rate_pct, CAST(count(*) AS BIGINT) AS rows
FROM commerce GROUP BY discount""")
def q_discount_rate(spark, d):
    return crosstab.group_rate(tables.commerce(spark, d), ["discount"], "returned")


@register("daily_totals", f"""WITH {COMMERCE_SQL}
SELECT order_date AS period, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       CAST(count(*) AS BIGINT) AS lines FROM commerce GROUP BY 1""")
def q_daily_totals(spark, d):
    c = tables.commerce(spark, d)
    return finish(calendar.period_totals(c, [], "order_date", "day", [
        F.sum(F.col("total_amount").cast("decimal(18,2)")).alias("revenue"), F.count(F.lit(1)).alias("lines")]))


@register("monthly_by_category", f"""WITH {COMMERCE_SQL}
SELECT category, CAST(date_trunc('month', order_date) AS DATE) AS period,
       CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue, CAST(count(*) AS BIGINT) AS lines
FROM commerce GROUP BY 1, 2""")
def q_monthly_by_category(spark, d):
    c = tables.commerce(spark, d)
    return finish(calendar.period_totals(c, ["category"], "order_date", "month", [
        F.sum(F.col("total_amount").cast("decimal(18,2)")).alias("revenue"), F.count(F.lit(1)).alias("lines")]))


_SEG_MONTHLY_SQL = """seg AS (
  SELECT c_mktsegment AS segment, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


def segment_monthly(spark, d):
    o = tables.read(spark, d, "orders")
    c = tables.read(spark, d, "customer").select("c_custkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey)
    m = calendar.period_totals(j, [F.col("c_mktsegment").alias("segment")], "o_orderdate", "month",
                               [F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total")], "month")
    return finish(m)


@register("series_growth", f"""WITH {_SEG_MONTHLY_SQL},
g AS (SELECT segment, arg_min(total, month) AS first_value, arg_max(total, month) AS last_value,
             CAST(sum(CAST(total AS DECIMAL(38,6))) AS DOUBLE) / count(total) AS mean
      FROM seg GROUP BY 1)
SELECT segment, round(first_value, 4) AS first_value, round(last_value, 4) AS last_value, round(mean, 4) AS mean,
       round((last_value - first_value) / first_value * 100, {R}) AS growth_pct,
       CASE WHEN last_value > first_value THEN 'up' WHEN last_value < first_value THEN 'down' ELSE 'flat' END AS trend
FROM g""")
def q_series_growth(spark, d):
    m = segment_monthly(spark, d)
    g = m.groupBy("segment").agg(F.min_by("total", "month").alias("first_value"),
                                 F.max_by("total", "month").alias("last_value"), exact_mean("total").alias("mean"))
    g = g.withColumn("growth_pct", (F.col("last_value") - F.col("first_value")) / F.col("first_value") * 100)
    g = g.withColumn("trend", F.when(F.col("last_value") > F.col("first_value"), "up")
                     .when(F.col("last_value") < F.col("first_value"), "down").otherwise("flat"))
    return g.select("segment", *[F.round(c, 4).alias(c) for c in ("first_value", "last_value", "mean")],
                    F.round("growth_pct", R).alias("growth_pct"), "trend")


# ---- windows ------------------------------------------------------------------------

@register("series_changes", f"""WITH {DAILY_SQL}
SELECT symbol, day, round(close - lag(close) OVER w, {R}) AS diff,
       round((close / lag(close) OVER w - 1) * 100, {R}) AS pct_change,
       round(sum(volume) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), {R}) AS cum_volume
FROM daily WINDOW w AS (PARTITION BY symbol ORDER BY day)""")
def q_series_changes(spark, d):
    p = tables.daily_prices(spark, d)
    p = windows.diff(p, "close", "day", ["symbol"])
    p = windows.pct_change(p, "close", "day", ["symbol"])
    p = windows.running_sum(p, "volume", "day", ["symbol"], "cum_volume")
    return _rnd(p.select("symbol", "day", "diff", "pct_change", "cum_volume"))


@register("cumulative_return", f"""WITH {DAILY_SQL},
r AS (SELECT symbol, day, (close / lag(close) OVER (PARTITION BY symbol ORDER BY day) - 1) * 100 AS ret FROM daily),
l AS (SELECT symbol, day, ret, sum(ln(1 + ret / 100)) OVER (PARTITION BY symbol ORDER BY day
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM r)
SELECT symbol, day, round(CASE WHEN ret IS NOT NULL THEN exp(s) END, 4) AS cum_return FROM l""")
def q_cumulative_return(spark, d):
    p = windows.pct_change(tables.daily_prices(spark, d), "close", "day", ["symbol"], "ret")
    p = windows.cumulative_return(p, "ret", "day", ["symbol"])
    return p.select("symbol", "day", F.round("cum_return", 4).alias("cum_return"))


@register("rolling_20", f"""WITH {DAILY_SQL}
SELECT symbol, day,
  round(CASE WHEN count(close) OVER w = 20 THEN avg(close) OVER w END, {R}) AS rolling_mean,
  round(CASE WHEN count(close) OVER w = 20 THEN stddev_samp(close) OVER w END, 4) AS rolling_std
FROM daily WINDOW w AS (PARTITION BY symbol ORDER BY day ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""")
def q_rolling_20(spark, d):
    p = windows.rolling(tables.daily_prices(spark, d), "close", "day", 20, ["symbol"])
    return p.select("symbol", "day", F.round("rolling_mean", R).alias("rolling_mean"),
                    F.round("rolling_std", 4).alias("rolling_std"))


@register("undo_diff", f"""WITH {_SEG_MONTHLY_SQL},
d AS (SELECT segment, month, total, total - lag(total) OVER (PARTITION BY segment ORDER BY month) AS diff FROM seg),
b AS (SELECT segment, arg_min(total, month) AS base FROM seg GROUP BY 1)
SELECT d.segment, d.month, round(base + coalesce(sum(diff) OVER (PARTITION BY d.segment ORDER BY month
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0), 2) AS level
FROM d JOIN b ON d.segment = b.segment""")
def q_undo_diff(spark, d):
    m = windows.diff(segment_monthly(spark, d), "total", "month", ["segment"])
    base = m.groupBy("segment").agg(F.min_by("total", "month").alias("_base"))
    m = m.join(base, "segment").withColumn("diff", F.coalesce("diff", F.lit(0.0)))
    r = windows.undo_diff(m, "diff", "month", F.col("_base"), ["segment"])
    return r.select("segment", "month", F.round("level", 2).alias("level"))


@register("hold_last", f"""WITH {_SEG_MONTHLY_SQL},
l AS (SELECT segment, arg_max(month, month) AS month, arg_max(total, month) AS total FROM seg GROUP BY 1)
SELECT segment, CAST(s.range AS INTEGER) AS step, month, total, CAST('hold' AS VARCHAR) AS source
FROM l, range(1, 4) s""")
def q_hold_last(spark, d):
    return windows.hold_last(segment_monthly(spark, d), ["segment"], "month", 3, {"source": "hold"})


@register("argmax_row", """SELECT c_mktsegment, c_custkey, c_acctbal FROM (
  SELECT c_mktsegment, c_custkey, c_acctbal,
         row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer)
WHERE rn = 1""")
def q_argmax_row(spark, d):
    c = tables.read(spark, d, "customer").select("c_mktsegment", "c_custkey", "c_acctbal")
    return windows.argmax_row(c, "c_acctbal", "c_custkey", ["c_mktsegment"])


@register("top_k_per_group", """SELECT p_type, p_partkey, p_retailprice, CAST(rank AS INTEGER) AS rank FROM (
  SELECT p_type, p_partkey, p_retailprice,
         row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part)
WHERE rank <= 3""")
def q_top_k_per_group(spark, d):
    p = tables.read(spark, d, "part").select("p_type", "p_partkey", "p_retailprice")
    return windows.top_k(p, "p_retailprice", 3, ["p_type"], tie="p_partkey")


@register("top_k_orders", """SELECT o_orderkey, o_totalprice, CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank
FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def q_top_k_orders(spark, d):
    o = tables.read(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return windows.top_k(o, "o_totalprice", 10, tie="o_orderkey")


@register("best_group", """SELECT c_mktsegment, round(avg(c_acctbal), 6) AS mean_balance FROM customer
GROUP BY 1 ORDER BY avg(c_acctbal) DESC, c_mktsegment LIMIT 1""")
def q_best_group(spark, d):
    g = tables.read(spark, d, "customer").groupBy("c_mktsegment").agg(F.avg("c_acctbal").alias("mean_balance"))
    return g.orderBy(F.col("mean_balance").desc(), "c_mktsegment").limit(1).select(
        "c_mktsegment", F.round("mean_balance", 6).alias("mean_balance"))


@register("autocorr", f"""WITH {_SEG_MONTHLY_SQL},
l AS (SELECT segment, total AS v, """ + ", ".join(
    f"lag(total, {k}) OVER (PARTITION BY segment ORDER BY month) AS l{k}" for k in range(1, 11)) + """ FROM seg),
g AS (SELECT segment, count(v) AS n, sum(v * v) AS ss, """ + ", ".join(f"sum(v * l{k}) AS p{k}" for k in range(1, 11))
    + """ FROM l GROUP BY 1)
SELECT segment, lag, round(acf, 6) AS acf FROM (""" + " UNION ALL ".join(
    f"SELECT segment, n, {k} AS lag, p{k} / ss AS acf FROM g" for k in range(1, 11)) + ") WHERE lag <= n - 1")
def q_autocorr(spark, d):
    a = windows.autocorr(segment_monthly(spark, d), "total", "month", ["segment"])
    return a.select("segment", "lag", F.round("acf", 6).alias("acf"))


@register("future_months", f"""WITH {_SEG_MONTHLY_SQL},
l AS (SELECT segment, max(month) AS month FROM seg GROUP BY 1)
SELECT segment, CAST(s.range AS INTEGER) AS step, CAST(date_trunc('month', month) + to_months(CAST(s.range AS INTEGER)) AS DATE) AS month_start
FROM l, range(1, 7) s""")
def q_future_months(spark, d):
    last = segment_monthly(spark, d).groupBy("segment").agg(F.max("month").alias("month"))
    return calendar.future_months(last, "segment", "month", 6)


# ---- joins --------------------------------------------------------------------------

_RATES_SQL = """tax AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, avg(l_tax) AS tax_rate
                FROM lineitem WHERE month(l_shipdate) <= 9 GROUP BY 1),
disc AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, avg(l_discount) AS discount_rate
         FROM lineitem WHERE month(l_shipdate) >= 4 GROUP BY 1),
merged AS (SELECT coalesce(tax.month, disc.month) AS month, tax_rate, discount_rate
           FROM tax FULL OUTER JOIN disc ON tax.month = disc.month),
filled AS (SELECT month,
  coalesce(last_value(tax_rate IGNORE NULLS) OVER (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           first_value(tax_rate IGNORE NULLS) OVER (ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS tax_rate,
  coalesce(last_value(discount_rate IGNORE NULLS) OVER (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           first_value(discount_rate IGNORE NULLS) OVER (ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS discount_rate
  FROM merged)"""


def macro_rates(spark, d):
    """Two monthly rate series with gaps (tax: Jan-Sep, discount: Apr-Dec each year),
    full-outer merged on month, forward- then back-filled. The merged series has one
    row per month (calendar-bounded), so its window is a single small partition."""
    from ..operators import joins
    li = tables.read(spark, d, "lineitem")
    mon = F.to_date(F.date_trunc("month", "l_shipdate")).alias("month")
    tax = li.where(F.month("l_shipdate") <= 9).groupBy(mon).agg(F.avg("l_tax").alias("tax_rate"))
    disc = li.where(F.month("l_shipdate") >= 4).groupBy(mon).agg(F.avg("l_discount").alias("discount_rate"))
    return joins.merge_series([tax, disc], "month")


@register("merge_series", f"""WITH {_RATES_SQL}
SELECT month, round(tax_rate, 8) AS tax_rate, round(discount_rate, 8) AS discount_rate FROM filled""")
def q_merge_series(spark, d):
    m = macro_rates(spark, d)
    return m.select("month", F.round("tax_rate", 8).alias("tax_rate"), F.round("discount_rate", 8).alias("discount_rate"))


@register("enrich_with_rates", f"""WITH {_SEG_MONTHLY_SQL}, {_RATES_SQL},
rng AS (SELECT min(month) AS lo, max(month) AS hi FROM seg)
SELECT seg.segment, seg.month, seg.total, round(f.tax_rate, 8) AS tax_rate, round(f.discount_rate, 8) AS discount_rate
FROM seg LEFT JOIN (SELECT filled.* FROM filled, rng WHERE month BETWEEN lo AND hi) f ON seg.month = f.month""")
def q_enrich_with_rates(spark, d):
    from ..operators import joins
    e = joins.enrich(segment_monthly(spark, d), macro_rates(spark, d), "month")
    return e.select("segment", "month", "total", F.round("tax_rate", 8).alias("tax_rate"),
                    F.round("discount_rate", 8).alias("discount_rate"))


@register("forecast_monitor", f"""WITH {_SEG_MONTHLY_SQL},
pred AS (SELECT segment, strftime(CAST(month + INTERVAL 1 MONTH AS DATE), '%Y-%m') AS ym, total AS predicted FROM seg),
act AS (SELECT segment, strftime(month, '%Y-%m') AS ym, total AS actual FROM seg),
j AS (SELECT act.segment, act.ym, actual, predicted, abs(actual - predicted) / abs(actual) AS rel_error
      FROM act LEFT JOIN pred ON act.segment = pred.segment AND act.ym = pred.ym)
SELECT segment, ym, actual, predicted, round(rel_error, {R}) AS rel_error, rel_error > 0.15 AS retrain,
       round(avg(rel_error) OVER (PARTITION BY segment ORDER BY ym ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), {R}) AS running_error
FROM j""")
def q_forecast_monitor(spark, d):
    from ..operators import joins
    m = segment_monthly(spark, d)
    naive = m.select("segment", F.add_months("month", 1).alias("month"), F.col("total").alias("predicted"))
    r = joins.monitor(m.withColumnRenamed("total", "actual"), naive, "segment", "month", "actual", "predicted")
    return _rnd(r)
