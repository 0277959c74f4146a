"""Round trips through files derived from the driver's tables: the file sources and
sinks (delimited / typed CSV, partitioned CSV output, landed macro series) exercised
on data that grows with the tables. Files go to the session's shared checkpoint
folder (``spark.checkpoint.dir``), one fresh sub-folder per call."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import checkpoint_dir
from ..sources import files
from . import tables
from .registry import register


def _scratch(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tallyframe-io/{name}-{uuid.uuid4().hex}"


@register("csv_roundtrip", """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def q_csv_roundtrip(spark, d):
    """customer -> header CSV partitioned by segment -> typed read with a declared schema
    (the partition column comes back from the folder names)."""
    path = _scratch(spark, "customer-csv")
    c = tables.read(spark, d, "customer")
    files.write_csv(c.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"), path,
                    partition_by=["c_mktsegment"])
    back = files.read_typed(spark, path, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double")
    return back.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", F.col("c_mktsegment").cast("string"))


@register("macro_series_file", """SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS fecha,
       CAST(round(avg(l_tax), 6) AS DOUBLE) AS tasa_uvr
FROM lineitem GROUP BY 1""")
def q_macro_series_file(spark, d):
    """A monthly rate series landed as a ';'-separated file with Spanish headers and
    decimal commas, read back with separator sniffing and normalised (series code 60)."""
    path = _scratch(spark, "macro-series")
    li = tables.read(spark, d, "lineitem")
    m = li.groupBy(F.to_date(F.date_trunc("month", "l_shipdate")).alias("m")).agg(F.avg("l_tax").alias("v"))
    landed = m.select(F.date_format("m", "yyyy-MM-dd").alias("Fecha Corte"),
                      F.regexp_replace(F.format_string("%.6f", "v"), r"\.", ",").alias("Valor Dato"))
    landed.coalesce(1).write.mode("overwrite").option("header", True).option("sep", ";").csv(path)
    return files.normalise_series(files.read_delimited(spark, path), "60")
