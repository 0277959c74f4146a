"""Scalar function families (strings, text, money, dates, math, arrays, maps) applied to
columns. Each report is one projection (or one small group-by for maps) of built-ins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .expr import capitalize, money, normalize_ws


def string_report(part: DataFrame) -> DataFrame:
    n = F.col("p_name")
    return part.select(
        "p_partkey", F.upper(n).alias("upper"), F.lower("p_brand").alias("lower"),
        F.size(F.split(n, " ")).alias("words"), (F.instr(n, "e") - 1).alias("find_e"),
        n.startswith("blue").alias("starts_blue"), n.endswith("bolt").alias("ends_bolt"),
        F.length(n).alias("length"), n.rlike(r"^\p{L}+$").alias("is_alpha"),
        F.col("p_size").cast("string").rlike(r"^\d+$").alias("is_digit"),
        F.format_string("%s (%s)", n, F.col("p_brand")).alias("label"),
        F.trim(F.concat(F.lit("  "), F.col("p_type"), F.lit("  "))).alias("stripped"),
        F.replace(n, F.lit(" "), F.lit("_")).alias("replaced"),
        (F.length(n) - F.length(F.replace(n, F.lit("e"), F.lit("")))).alias("count_e"),
        F.substring(n, 2, 3).alias("slice"), F.reverse(n).alias("reversed"),
        capitalize(n).alias("capitalized"),
        F.array_join(F.array(F.col("p_brand"), F.col("p_type")), "-").alias("joined"))


def normalized_text_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Whitespace-normalised length and word count of each whole text."""
    t = normalize_ws(text_col)
    return docs.select(id_col, F.length(t).alias("normalized_chars"), F.size(F.split(t, " ")).alias("words"))


def numbers_in_text(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """Numbers in each whole text, typed: how many, how many integers / decimals, the
    first integer (BIGINT, NULL when too long), the first decimal and the largest value."""
    nums = F.regexp_extract_all(F.col(text_col), F.lit(r"\d+(?:\.\d+)?"), 0)
    ints = F.filter(nums, lambda x: ~x.contains("."))
    decs = F.filter(nums, lambda x: x.contains("."))
    return df.select(id_col, F.size(nums).alias("numbers"), F.size(ints).alias("integers"),
                     F.size(decs).alias("decimals"), F.try_element_at(ints, F.lit(1)).try_cast("bigint").alias("first_integer"),
                     F.try_element_at(decs, F.lit(1)).try_cast("double").alias("first_decimal"),
                     F.array_max(F.transform(nums, lambda x: x.try_cast("double"))).alias("max_value"))


def money_report(df: DataFrame, key: str, v: str) -> DataFrame:
    g = df.groupBy(key).agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"),
                            F.sum(F.col(v).cast("decimal(18,2)")).alias("_t"))
    return g.select(key, F.concat(money("_lo"), F.lit(" - "), money("_hi")).alias("balance_range"),
                    money("_t").alias("total"))


def date_report(df: DataFrame, id_col: str, t: str) -> DataFrame:
    day = F.to_date(t)
    return df.select(id_col, day.alias("day"), F.month(t).alias("month"), F.year(t).alias("year"),
                     F.date_format(t, "yyyy-MM").alias("ym"), F.add_months(day, 1).alias("next_month"),
                     F.date_add(day, 90).alias("plus_90"), F.trunc(day, "month").alias("month_start"))


def math_report(li: DataFrame) -> DataFrame:
    return li.select("l_orderkey", "l_linenumber", F.abs(F.col("l_extendedprice") - 50000).alias("abs_dev"),
                     F.sqrt("l_quantity").alias("sqrt_qty"), F.exp("l_discount").alias("exp_disc"),
                     F.log("l_extendedprice").alias("log_price"), F.sin("l_quantity").alias("sin_qty"),
                     F.round(F.col("l_extendedprice") / 3, 2).alias("rounded"))


def log_grid(spark: SparkSession, lo: float, hi: float, n: int) -> DataFrame:
    """n points evenly spaced in log10 between 10^lo and 10^hi."""
    i = F.col("id").cast("int")
    return spark.range(n).select(i.alias("i"),
                                 F.pow(F.lit(10.0), F.lit(float(lo)) + (F.lit(float(hi - lo)) * i) / (n - 1)).alias("alpha"))


def array_report(df: DataFrame, id_col: str, arr: str) -> DataFrame:
    v = F.transform(arr, lambda x: x.cast("double"))
    total = F.aggregate(v, F.lit(0.0), lambda a, b: a + b)
    return df.select(id_col, total.alias("total"), (total / F.size(v)).alias("mean"),
                     F.array_max(v).alias("max"),
                     F.array_position(v, F.array_max(v)).cast("int").alias("argmax"),
                     F.size(F.filter(v, lambda x: x > 0)).alias("positives"),
                     F.aggregate(F.slice(v, 1, 5), F.lit(0.0), lambda a, b: a + b).alias("head5_sum"))


def map_report(li: DataFrame) -> DataFrame:
    """Per order: line number -> quantity * price map (repeated line numbers summed);
    size, value total, line 1, last line. The collect is per order (a handful of lines),
    never per table."""
    per_line = li.groupBy("l_orderkey", "l_linenumber").agg(
        F.sum(F.round(F.col("l_quantity") * F.col("l_extendedprice"), 2)).alias("v"))
    entry = F.struct(F.col("l_linenumber").alias("k"), F.col("v"))
    g = per_line.groupBy("l_orderkey").agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("lines"))
    return g.select("l_orderkey", F.size("lines").alias("n_lines"),
                    F.round(F.aggregate(F.map_values("lines"), F.lit(0.0), lambda a, b: a + b), 2).alias("order_value"),
                    F.round(F.element_at("lines", F.lit(1)), 2).alias("line_1"),
                    F.array_max(F.map_keys("lines")).alias("last_line"))
