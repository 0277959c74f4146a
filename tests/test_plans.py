"""Plan-shape checks for the scale properties the operators rely on."""

import contextlib
import io

import numpy as np
import pandas as pd

from conftest import SF_SMALL
from tallyframe.operators import ranks, stats, windows
import __spark_entry__ as E


def _plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def _skewed(spark, n=30000):
    rng = np.random.default_rng(1)
    keys = np.where(np.arange(n) < n // 3, "hot", np.char.add("k", (np.arange(n) % 500).astype(str)))
    return spark.createDataFrame(pd.DataFrame({"g": keys, "v": rng.normal(size=n)}))


def test_hot_group_positions_need_no_window_over_rows(spark):
    df = _skewed(spark)
    p = ranks.group_positions(df, ["g"], "v", "pos", "n")
    got = p.where("g = 'hot'").select("pos").toPandas().pos.sort_values().to_numpy()
    assert (got == np.arange(1, 10001)).all()
    plan = _plan(p, "simple")
    # counts of parts are summed up; the rows themselves meet no window and no range exchange again
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("sum(_c" in line for line in windows) and "rangepartitioning" not in plan
    assert "SPARK_PARTITION_ID" not in plan and "monotonically_increasing_id" not in plan


def test_quantiles_count_equal_values_first(spark):
    df = _skewed(spark)
    plan = _plan(stats.quantiles(df, "v", [0.5], ["g"]), "simple")
    assert "rangepartitioning" not in plan and "partial_count" in plan


def test_grouped_top_k_limits_before_the_shuffle(spark):
    plan = _plan(windows.top_k(_skewed(spark), "v", 3, ["g"]))
    head = plan.split("\n\n")[0]
    assert head.count("WindowGroupLimit") == 2 and head.count("Exchange") == 1


def test_scans_read_only_needed_columns(spark):
    q = E.queries()
    plan = _plan(q["monthly_cash_flow"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan
    plan = _plan(q["describe_lineitem"](spark, SF_SMALL))
    assert "l_orderkey" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_filters_reach_the_scan(spark):
    plan = _plan(E.queries()["filter_orders"](spark, SF_SMALL))
    assert "PushedFilters: [Or(" in plan or "PushedFilters: [Or" in plan


def test_monthly_cash_flow_two_aggregate_shuffles_no_sort_merge_join(spark):
    plan = _plan(E.queries()["monthly_cash_flow"](spark, SF_SMALL)).split("\n\n")[0]
    assert plan.count("Exchange") - plan.count("BroadcastExchange") == 2
    assert "SortMergeJoin" not in plan


def test_order_series_never_scan_lineitem(spark):
    q = E.queries()
    for name in ("regression_metrics", "dickey_fuller", "temporal_split", "poly_trend", "trend_line",
                 "vif_pair", "ridge_path"):
        assert "l_shipdate" not in _plan(q[name](spark, SF_SMALL)), name
