"""Statement text parsing, scalar function families and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar
from ..operators import crosstab
from ..sources import statement
from ..sources.statement import KNOWN_PLACES, MONTHS
from . import tables
from .registry import finish, register

R = 6


def _sql_list(xs):
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]"


_STMT_SQL = f"""WITH o AS (
  SELECT o_orderkey, o_custkey, o_orderstatus AS st, o_orderpriority AS pr, o_totalprice,
         {_sql_list(MONTHS)}[month(o_orderdate)] || ' ' || CAST(day(o_orderdate) AS VARCHAR) AS date,
         CASE o_orderstatus WHEN 'F' THEN 'ABONO NOMINA' WHEN 'O' THEN 'COMPRA POS' ELSE 'PAGO PSE' END AS txn,
         CASE WHEN o_orderstatus <> 'F' THEN 'D' || CAST(o_orderkey AS VARCHAR) ELSE '' END AS doc,
         {_sql_list(KNOWN_PLACES)}[CAST(o_custkey % {len(KNOWN_PLACES)} AS INTEGER) + 1] AS place,
         format('{{:,.2f}}', o_totalprice) AS amt, format('{{:,.2f}}', o_totalprice + 1000) AS bal,
         o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' AS csv
  FROM orders)
SELECT 'cust_' || CAST(o_custkey AS VARCHAR) AS file,
       CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS BIGINT) AS record,
       date, txn AS transaction, doc AS document, place,
       CASE WHEN csv THEN printf('%.2f', o_totalprice)
            WHEN pr IN ('4-NOT SPECIFIED', '5-LOW') OR st = 'F' THEN '' ELSE amt END AS debit,
       CASE WHEN csv OR pr IN ('4-NOT SPECIFIED', '5-LOW') OR st <> 'F' THEN '' ELSE amt END AS credit,
       CASE WHEN csv THEN printf('%.2f', o_totalprice + 1000) WHEN pr = '4-NOT SPECIFIED' THEN '' ELSE bal END AS balance,
       CASE WHEN csv THEN 'csv' ELSE 'text' END AS path
FROM o"""


@register("statement_parse", _STMT_SQL)
def q_statement_parse(spark, d):
    return statement.parse_statement(tables.statement_lines(spark, d))


# ---- scalar function families ----------------------------------------------------------

@register("string_functions", """SELECT p_partkey, upper(p_name) AS upper, lower(p_brand) AS lower,
       CAST(len(string_split(p_name, ' ')) AS INTEGER) AS words, CAST(strpos(p_name, 'e') - 1 AS INTEGER) AS find_e,
       starts_with(p_name, 'blue') AS starts_blue, suffix(p_name, 'bolt') AS ends_bolt,
       CAST(length(p_name) AS INTEGER) AS length, regexp_full_match(p_name, '\\p{L}+') AS is_alpha,
       regexp_full_match(CAST(p_size AS VARCHAR), '\\d+') AS is_digit,
       printf('%s (%s)', p_name, p_brand) AS label, trim('  ' || p_type || '  ') AS stripped,
       replace(p_name, ' ', '_') AS replaced, CAST(length(p_name) - length(replace(p_name, 'e', '')) AS INTEGER) AS count_e,
       substr(p_name, 2, 3) AS slice, reverse(p_name) AS reversed,
       upper(substr(p_name, 1, 1)) || lower(substr(p_name, 2)) AS capitalized,
       array_to_string([p_brand, p_type], '-') AS joined
FROM part""")
def q_string_functions(spark, d):
    return scalar.string_report(tables.read(spark, d, "part"))


@register("text_normalize", """SELECT doc_id, CAST(length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS INTEGER) AS normalized_chars,
       CAST(len(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ')) AS INTEGER) AS words
FROM documents""")
def q_text_normalize(spark, d):
    return scalar.normalized_text_stats(tables.read(spark, d, "documents"))


@register("numbers_in_text", """WITH x AS (SELECT doc_id, regexp_extract_all(text, '\\d+(?:\\.\\d+)?') AS nums FROM documents),
y AS (SELECT doc_id, nums, list_filter(nums, lambda v: NOT contains(v, '.')) AS ints,
             list_filter(nums, lambda v: contains(v, '.')) AS decs FROM x)
SELECT doc_id, CAST(len(nums) AS INTEGER) AS numbers, CAST(len(ints) AS INTEGER) AS integers,
       CAST(len(decs) AS INTEGER) AS decimals, TRY_CAST(ints[1] AS BIGINT) AS first_integer,
       TRY_CAST(decs[1] AS DOUBLE) AS first_decimal,
       list_max(list_transform(nums, lambda v: TRY_CAST(v AS DOUBLE))) AS max_value
FROM y""")
def q_numbers_in_text(spark, d):
    return scalar.numbers_in_text(tables.read(spark, d, "documents"), "text", "doc_id")


@register("money_format", """SELECT c_mktsegment, '$' || format('{:,.2f}', min(c_acctbal)) || ' - $' || format('{:,.2f}', max(c_acctbal)) AS balance_range,
       '$' || format('{:,.2f}', sum(CAST(c_acctbal AS DECIMAL(18,2)))) AS total
FROM customer GROUP BY 1""")
def q_money_format(spark, d):
    return scalar.money_report(tables.read(spark, d, "customer"), "c_mktsegment", "c_acctbal")


@register("date_functions", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(year(o_orderdate) AS INTEGER) AS year, strftime(o_orderdate, '%Y-%m') AS ym,
       CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS next_month,
       CAST(CAST(o_orderdate AS DATE) + INTERVAL 90 DAY AS DATE) AS plus_90,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start
FROM orders""")
def q_date_functions(spark, d):
    return scalar.date_report(tables.read(spark, d, "orders"), "o_orderkey", "o_orderdate")


@register("math_functions", f"""SELECT l_orderkey, l_linenumber, round(abs(l_extendedprice - 50000), {R}) AS abs_dev,
       round(sqrt(l_quantity), {R}) AS sqrt_qty, round(exp(l_discount), {R}) AS exp_disc,
       round(ln(l_extendedprice), {R}) AS log_price, round(sin(l_quantity), {R}) AS sin_qty,
       round(l_extendedprice / 3, 2) AS rounded
FROM lineitem""")
def q_math_functions(spark, d):
    return finish(scalar.math_report(tables.read(spark, d, "lineitem")), R)


_SEG_N_SQL = """seg AS (
  SELECT c_mktsegment AS segment, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, CAST(count(*) AS DOUBLE) AS n_orders
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


@register("ridge_path", f"""WITH {_SEG_N_SQL},
g AS (SELECT segment, count(*) AS n, avg(n_orders) AS mx, avg(total) AS my, regr_sxx(total, n_orders) AS sxx,
             regr_sxy(total, n_orders) AS sxy FROM seg GROUP BY 1),
a AS (SELECT CAST(range AS INTEGER) AS i, power(10, -3.0 + (6.0 * CAST(range AS DOUBLE)) / 19) AS alpha FROM range(0, 20)),
c AS (SELECT segment, alpha, mx, my, (sxy / sqrt(sxx / n)) / (sxx / (sxx / n) + alpha) / sqrt(sxx / n) AS coef
      FROM g, a)
SELECT segment, round(alpha, 10) AS alpha, round(my - coef * mx, 2) AS intercept, round(coef, 3) AS coef FROM c""")
def q_ridge_path(spark, d):
    """Monthly order value on order count per segment, ridge coefficient along a
    log-spaced alpha grid (10^-3 .. 10^3, 20 points)."""
    from ..operators import linear
    from . import tables as t
    f = t.segment_orders(spark, d)
    path = linear.ridge_path(f, "total", ["n_orders"], scalar.log_grid(spark, -3, 3, 20), ["segment"])
    return path.select("segment", F.round("alpha", 10).alias("alpha"), F.round("intercept", 2).alias("intercept"),
                       F.round(F.col("coef")[0], 3).alias("coef"))


@register("array_functions", f"""WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings)
SELECT vec_id, round(list_reduce(v, lambda a, b: a + b), {R}) AS total, round(list_reduce(v, lambda a, b: a + b) / len(v), {R}) AS mean,
       round(list_max(v), {R}) AS max, CAST(list_position(v, list_max(v)) AS INTEGER) AS argmax,
       CAST(len(list_filter(v, lambda x: x > 0)) AS INTEGER) AS positives,
       round(list_reduce(v[1:5], lambda a, b: a + b), {R}) AS head5_sum
FROM e""")
def q_array_functions(spark, d):
    return finish(scalar.array_report(tables.read(spark, d, "embeddings"), "vec_id", "embedding"), R)


@register("matrix_product", f"""WITH a AS (SELECT vec_id, label, CAST(i AS INTEGER) AS k, CAST(embedding[i] AS DOUBLE) AS x
           FROM embeddings, range(1, 65) r(i)),
c AS (SELECT label, k, avg(x) AS m FROM a GROUP BY 1, 2)
SELECT a.vec_id, c.label, round(sum(a.x * c.m), {R}) AS score FROM a JOIN c ON a.k = c.k GROUP BY 1, 2""")
def q_matrix_product(spark, d):
    from ..operators import linear
    e = tables.read(spark, d, "embeddings")
    coo = e.select("vec_id", "label", F.posexplode("embedding").alias("k", "x")).select(
        "vec_id", "label", (F.col("k") + 1).alias("k"), F.col("x").cast("double").alias("x"))
    cent = coo.groupBy("label", "k").agg(F.avg("x").alias("m"))
    prod = linear.coo_matmul(coo.select(F.col("vec_id").alias("i"), "k", F.col("x").alias("a")),
                             cent.select("k", F.col("label").alias("j"), F.col("m").alias("b")))
    return finish(prod.select(F.col("i").alias("vec_id"), F.col("j").alias("label"),
                              F.col("value").alias("score")), R)


@register("map_functions", f"""WITH v AS (SELECT l_orderkey, l_linenumber, sum(round(l_quantity * l_extendedprice, 2)) AS v
           FROM lineitem GROUP BY 1, 2),
m AS (SELECT l_orderkey, map(list(l_linenumber ORDER BY l_linenumber),
             list(v ORDER BY l_linenumber)) AS lines FROM v GROUP BY 1)
SELECT l_orderkey, CAST(cardinality(lines) AS INTEGER) AS n_lines,
       round(list_reduce(map_values(lines), lambda a, b: a + b), 2) AS order_value,
       round(lines[1], 2) AS line_1, CAST(list_max(map_keys(lines)) AS INTEGER) AS last_line
FROM m""")
def q_map_functions(spark, d):
    return scalar.map_report(tables.read(spark, d, "lineitem"))


# ---- set operations -----------------------------------------------------------------

_SETS_SQL = """WITH a AS (SELECT DISTINCT c_nationkey AS nation FROM customer WHERE c_acctbal > 9000),
b AS (SELECT DISTINCT s_nationkey AS nation FROM supplier WHERE s_acctbal > 5000)"""


@register("set_operations", f"""{_SETS_SQL}
SELECT 'union' AS op, nation FROM (SELECT nation FROM a UNION SELECT nation FROM b)
UNION ALL SELECT 'intersection', nation FROM (SELECT nation FROM a INTERSECT SELECT nation FROM b)
UNION ALL SELECT 'difference', nation FROM (SELECT nation FROM a EXCEPT SELECT nation FROM b)
UNION ALL SELECT 'added', nation FROM (SELECT nation FROM a UNION SELECT 99)
UNION ALL SELECT 'removed', nation FROM a WHERE nation <> 0""")
def q_set_operations(spark, d):
    c = tables.read(spark, d, "customer")
    s = tables.read(spark, d, "supplier")
    a = c.where(F.col("c_acctbal") > 9000).select(F.col("c_nationkey").alias("nation")).distinct()
    b = s.where(F.col("s_acctbal") > 5000).select(F.col("s_nationkey").alias("nation")).distinct()
    one = a.sparkSession.range(1).select(F.lit(99).cast("int").alias("nation"))
    tag = lambda df, t: df.select(F.lit(t).alias("op"), "nation")
    return (tag(crosstab.set_union(a, b), "union")
            .unionByName(tag(crosstab.set_intersection(a, b), "intersection"))
            .unionByName(tag(crosstab.set_difference(a, b), "difference"))
            .unionByName(tag(crosstab.set_union(a, one), "added"))
            .unionByName(tag(a.where(F.col("nation") != 0), "removed")))
