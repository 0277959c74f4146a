"""Stand-ins: the reference's datasets re-expressed over the driver's tables.

Each builder is lazy (a scan + projection); its SQL twin is a DuckDB CTE used by the
oracle queries, so both sides start from identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bank movements per market segment (the entity): a finished order (status F) is a
    credit, any other a debit; money as DECIMAL(18,2) so sums are exact."""
    o = read(spark, sf_dir, "orders").join(
        read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"),
        F.col("o_custkey") == F.col("c_custkey"))
    amt = F.col("o_totalprice").cast("decimal(18,2)")
    zero = F.lit(0).cast("decimal(18,2)")
    fin = F.col("o_orderstatus") == "F"
    return o.select(F.col("c_mktsegment").alias("entity_id"), F.col("o_orderdate").alias("t"),
                    F.when(fin, amt).otherwise(zero).alias("credit"),
                    F.when(~fin, amt).otherwise(zero).alias("debit"))


MOVEMENTS_SQL = """mv AS (
  SELECT c_mktsegment AS entity_id, o_orderdate AS t,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS credit,
         CASE WHEN o_orderstatus <> 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS debit
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

MONTHLY_SQL = MOVEMENTS_SQL + """,
mm AS (SELECT entity_id, last_day(t) AS month_end, sum(credit) AS income, sum(debit) AS spend
       FROM mv WHERE t IS NOT NULL GROUP BY 1, 2),
rng AS (SELECT entity_id, min(month_end) AS lo, max(month_end) AS hi FROM mm GROUP BY 1),
sp AS (SELECT entity_id, last_day(CAST(unnest(generate_series(CAST(date_trunc('month', lo) AS TIMESTAMP),
              CAST(date_trunc('month', hi) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE)) AS month_end FROM rng),
monthly AS (
  SELECT sp.entity_id, sp.month_end,
         CAST(coalesce(mm.income, 0) AS DOUBLE) AS income,
         CAST(coalesce(mm.spend, 0) AS DOUBLE) * 0.6 AS essential_spend,
         CAST(coalesce(mm.spend, 0) AS DOUBLE) * 0.4 AS discretionary_spend,
         CAST(coalesce(mm.income, 0) - coalesce(mm.spend, 0) AS DOUBLE) AS saving
  FROM sp LEFT JOIN mm ON sp.entity_id = mm.entity_id AND sp.month_end = mm.month_end)"""


def commerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commerce order lines: lineitem joined to its order and part.

    category = part type, payment = order priority, returned = return flag R,
    delivery_days = ship date - order date. Both joins are equi-joins on keys; Catalyst
    and AQE pick broadcast or sort-merge from the runtime sizes.
    """
    li = read(spark, sf_dir, "lineitem")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    p = read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return j.select(
        F.to_date("o_orderdate").alias("order_date"), F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"), F.col("p_type").alias("category"),
        F.col("o_orderpriority").alias("payment"), F.col("p_retailprice").alias("price"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("total_amount"),
        F.col("l_discount").alias("discount"), (F.col("l_returnflag") == "R").cast("int").alias("returned"),
        F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).alias("delivery_days"))


COMMERCE_SQL = """commerce AS (
  SELECT CAST(o_orderdate AS DATE) AS order_date, l_orderkey AS order_id, l_linenumber AS line,
         p_type AS category, o_orderpriority AS payment, p_retailprice AS price, l_quantity AS quantity,
         l_extendedprice AS total_amount, l_discount AS discount,
         CAST(l_returnflag = 'R' AS INTEGER) AS returned,
         CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS delivery_days
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""


def daily_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily OHLCV per symbol (= return flag) from line items: open / close are the
    prices of the first / last line of the day (by order key, line number), high / low
    the extremes, volume the quantity. One aggregate: partial per task, then per day."""
    li = read(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return li.groupBy(F.col("l_returnflag").alias("symbol"), F.to_date("l_shipdate").alias("day")).agg(
        F.min_by("l_extendedprice", key).alias("open"), F.max("l_extendedprice").alias("high"),
        F.min("l_extendedprice").alias("low"), F.max_by("l_extendedprice", key).alias("close"),
        F.sum("l_quantity").alias("volume"))


DAILY_SQL = """daily AS (
  SELECT l_returnflag AS symbol, CAST(l_shipdate AS DATE) AS day,
         arg_min(l_extendedprice, l_orderkey * 8 + l_linenumber) AS open, max(l_extendedprice) AS high,
         min(l_extendedprice) AS low, arg_max(l_extendedprice, l_orderkey * 8 + l_linenumber) AS close,
         sum(l_quantity) AS volume
  FROM lineitem GROUP BY 1, 2)"""


def processing_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processing log: type = event type, origin = user, size = value, event rate = the
    ``k`` field of the JSON props, latency missing when the rate is 0."""
    e = read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").try_cast("double")
    return e.select("event_id", "ts", F.col("event_type").alias("kind"), F.col("user_id").alias("origin"),
                    F.col("value").alias("size_gb"), k.alias("rate"),
                    F.when(k != 0, F.col("value") * 10).alias("latency_ms"))


LOG_SQL = """plog AS (
  SELECT event_id, ts, event_type AS kind, user_id AS origin, value AS size_gb,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS rate,
         CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) <> 0 THEN value * 10 END AS latency_ms
  FROM events)"""

# Spanish month abbreviations, January first.
SPANISH_MONTH_ABBR = ["Ene", "Feb", "Mar", "Abr", "May", "Jun", "Jul", "Ago", "Sep", "Oct", "Nov", "Dic"]


def statement_strings(spark: SparkSession, sf_dir) -> DataFrame:
    """All-string bank movements rendered from orders, in mixed formats: dates as
    '1997 Ago 05' / '1997 AUG 05' / '05/08/1997'; debits as '$ 1,234.50' (or a
    '1.234.567'-style malformed amount for low-priority orders), credits as plain text."""
    o = sf_dir if isinstance(sf_dir, DataFrame) else read(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    es = F.element_at(F.array(*[F.lit(m) for m in SPANISH_MONTH_ABBR]), F.month(d))
    fmt = F.col("o_orderkey") % 3
    fecha = (F.when(fmt == 0, F.concat_ws(" ", F.year(d).cast("string"), es, F.date_format(d, "dd")))
             .when(fmt == 1, F.upper(F.date_format(d, "yyyy MMM dd")))
             .otherwise(F.date_format(d, "dd/MM/yyyy")))
    money = F.format_number("o_totalprice", 2)
    deb = F.when(F.col("o_orderpriority") == "5-LOW", F.regexp_replace(money, ",", "."))\
        .otherwise(F.concat(F.lit("$ "), money))
    return o.select(F.col("o_orderkey").alias("doc"), fecha.alias("fecha"),
                    F.when(F.col("o_orderstatus") != "F", deb).otherwise(F.lit("")).alias("debitos"),
                    F.when(F.col("o_orderstatus") == "F", money).otherwise(F.lit("-")).alias("creditos"))


def statement_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statement text lines per customer file, rendered from orders.

    Each order is one record: ``MON d TXN [DOC] PLACE [amount] [balance]``; urgent orders
    put place and amounts on a continuation line; high-priority pending orders are
    written in CSV form; every file starts with a header line that precedes the first
    record. Not-specified priority -> no amounts, low priority -> balance only.
    """
    from ..sources.statement import KNOWN_PLACES, MONTHS
    o = read(spark, sf_dir, "orders")
    c = read(spark, sf_dir, "customer").select("c_custkey")
    d = F.col("o_orderdate")
    mon = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(d))
    opener = F.concat_ws(" ", mon, F.dayofmonth(d).cast("string"))
    place = F.element_at(F.array(*[F.lit(p) for p in KNOWN_PLACES]), (F.col("o_custkey") % len(KNOWN_PLACES) + 1).cast("int"))
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    txn = F.when(st == "F", "ABONO NOMINA").when(st == "O", "COMPRA POS").otherwise("PAGO PSE")
    doc = F.when(st != "F", F.concat(F.lit("D"), F.col("o_orderkey").cast("string")))
    amt = F.format_number("o_totalprice", 2)
    bal = F.format_number(F.col("o_totalprice") + 1000, 2)
    amounts = F.when(pr == "4-NOT SPECIFIED", F.lit(None)).when(pr == "5-LOW", bal).otherwise(F.concat_ws(" ", amt, bal))
    head = F.concat_ws(" ", opener, txn, doc)
    tail = F.concat_ws(" ", place, amounts)
    csv = (st == "P") & (pr == "2-HIGH")
    csv_line = F.concat_ws(",", opener, txn, doc, place, F.format_string("%.2f", "o_totalprice"), F.lit(""),
                           F.format_string("%.2f", F.col("o_totalprice") + 1000))
    two = (pr == "1-URGENT") & ~csv
    lines = F.when(csv, F.array(csv_line)).when(two, F.array(head, tail)).otherwise(
        F.array(F.concat_ws(" ", head, tail)))
    rec = o.select(F.concat(F.lit("cust_"), F.col("o_custkey").cast("string")).alias("file"),
                   F.col("o_orderkey"), F.posexplode(lines).alias("k", "line"))
    rec = rec.select("file", (F.col("o_orderkey") * 2 + F.col("k")).alias("line_no"), "line")
    headers = c.select(F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).alias("file"),
                       F.lit(-1).cast("long").alias("line_no"),
                       F.concat(F.lit("EXTRACTO DE CUENTA "), F.col("c_custkey").cast("string")).alias("line"))
    # contiguous line-number ranges play the role of file splits, so one busy account's
    # file is stitched block by block like a large file read in splits
    return headers.unionByName(rec).withColumn("block", F.floor(F.col("line_no") / LINES_PER_BLOCK).cast("long"))


LINES_PER_BLOCK = 1 << 16


def segment_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly order series per market segment, from orders and customer alone: total,
    n_orders, n_urgent and pay_type ('Abono extra' when most orders finished, else
    'Ordinario') with its drop-first indicator."""
    o = read(spark, sf_dir, "orders")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey)
    m = j.groupBy(F.col("c_mktsegment").alias("segment"), F.to_date(F.date_trunc("month", "o_orderdate")).alias("month")) \
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
             F.count(F.lit(1)).cast("double").alias("n_orders"),
             F.count_if(F.col("o_orderpriority") == "1-URGENT").cast("double").alias("n_urgent"),
             (F.count_if(F.col("o_orderstatus") == "F") * 2 > F.count(F.lit(1))).alias("_abono"))
    return m.withColumn("pay_type", F.when(F.col("_abono"), "Abono extra").otherwise("Ordinario")) \
        .withColumn("pay_abono", F.col("_abono").cast("double")).drop("_abono")


def segment_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``segment_orders`` with tax_rate / discount_rate: monthly macro rates of the series'
    own range."""
    from ..operators import joins
    li = read(spark, sf_dir, "lineitem")
    mon = F.to_date(F.date_trunc("month", "l_shipdate")).alias("month")
    rates = li.groupBy(mon).agg(F.avg("l_tax").alias("tax_rate"), F.avg("l_discount").alias("discount_rate"))
    return joins.enrich(segment_orders(spark, sf_dir), rates, "month")
