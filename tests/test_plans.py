"""Plan shape and whole-pipeline properties."""

import os
import re
import tempfile
from decimal import Decimal

import pytest

from conftest import SF_SMALL, query_frame

from kasir.plans import monthly, pipeline
from kasir.queries import CFG, QUERIES, Menu, Sales
from kasir.sources import fixtures as fx


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(df) -> int:
    return _plan(df).count("Exchange hashpartitioning") + _plan(df).count("Exchange RoundRobin")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_in_any_plan(spark, name):
    p = _plan(query_frame(spark, name))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_raw_facts_are_not_shuffled_for_a_small_dimension(spark):
    """The store joins are map-side from the start: the first exchange over
    bill and menu lines is the aggregate's own."""
    for df in (Sales(spark, SF_SMALL).combined, Menu(spark, SF_SMALL).combined):
        initial = _plan(df).split("== Initial Plan ==")[-1]
        assert "SortMergeJoin [Branch" not in initial and "SortMergeJoin [_key" not in initial
        assert not re.search(r"Exchange hashpartitioning\((Branch|_key|l_suppkey)#", initial)
        assert "BroadcastHashJoin [Branch" in initial


def test_dimension_joins_follow_sizes(spark):
    """Spark broadcasts a dimension that turns out small, never one above the
    threshold; nothing deals facts out anew to spread them."""
    def ran():
        df = QUERIES["combine_sales"](spark, SF_SMALL)
        df.collect()
        return _plan(df)

    plan = ran().split("Initial Plan")[0]
    assert "BroadcastHashJoin" in plan and "RoundRobin" not in plan
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        assert "BroadcastHashJoin" not in ran()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_group_and_store_marts_add_one_exchange(spark):
    s = Sales(spark, SF_SMALL)
    base = _exchanges(s.combined)
    assert _exchanges(s.daily2) == base + 1
    assert _exchanges(s.daily3) == base + 1


def test_monthly_adds_no_exchange_over_daily(spark):
    s = Sales(spark, SF_SMALL)
    assert _exchanges(monthly.monthly_channel(s.daily1, CFG)) == _exchanges(s.daily1)
    assert _exchanges(monthly.monthly_group(s.daily2, CFG)) == _exchanges(s.daily2)
    assert _exchanges(monthly.monthly_store(s.daily3, CFG)) == _exchanges(s.daily3)


def test_filters_reach_the_scan(spark):
    p = _plan(query_frame(spark, "menu_cutover"))
    scan = next(x for x in p.split("\n") if "FileScan" in x and "o_orderdate" in x)
    assert re.search(r"PushedFilters: \[.*LessThan(OrEqual)?\(o_orderdate,", scan)


def test_net_is_conserved_across_grains(spark):
    """Store keys are unique in the fixture, so every grain sums to the same
    total: combined -> daily2 -> daily3 -> monthly3."""
    s = Sales(spark, SF_SMALL)

    def total(df, col="total_sales_net"):
        return df.agg({col: "sum"}).first()[0]

    t = total(s.combined)
    assert total(s.daily2) == t
    assert total(s.daily3) == t
    assert total(monthly.monthly_store(s.daily3, CFG)) == t
    assert isinstance(t, Decimal)


def test_lag_sum_identity(spark):
    """Sum of previous values = sum of values minus each series' last value."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    d3 = Sales(spark, SF_SMALL).daily3
    w = Window.partitionBy("RESTO").orderBy(F.col("Date").desc(), F.col("total_sales_net").desc())
    last = d3.withColumn("rn", F.row_number().over(w)).where("rn = 1")
    lhs = d3.agg(F.sum("previous_sales_net")).first()[0]
    rhs = d3.agg(F.sum("total_sales_net")).first()[0] - last.agg(F.sum("total_sales_net")).first()[0]
    assert lhs == rhs


def test_pipeline_publishes_all_tables(spark, scratch):
    wh = tempfile.mkdtemp(dir=scratch)
    out = {k: f"kasir_t.{k}" for k in pipeline.SALES_OUTPUTS}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS kasir_t LOCATION '{os.path.join(wh, 'kasir_t')}'")
    pipeline.run_sales(spark, fx.sales_inputs(spark, SF_SMALL), CFG, outputs=out)
    s = Sales(spark, SF_SMALL)
    assert spark.table(out["daily2"]).count() == s.daily2.count()
    m = monthly.monthly_channel(spark.table(out["daily1"]), CFG)
    assert _exchanges(m) == 0          # bucketed by RESTO: no shuffle
    assert m.count() == spark.table(out["monthly1"]).count()
    pipeline.run_sales(spark, fx.sales_inputs(spark, SF_SMALL), CFG, outputs=out)
    assert spark.table(out["daily2"]).count() == s.daily2.count()   # replace, not append


def test_bucket_count_follows_config(spark, scratch):
    cfg = CFG.with_(store_partitions=4)
    wh = tempfile.mkdtemp(dir=scratch)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS kasir_b LOCATION '{os.path.join(wh, 'kasir_b')}'")
    out = {k: f"kasir_b.{k}" for k in pipeline.SALES_OUTPUTS}
    pipeline.run_sales(spark, fx.sales_inputs(spark, SF_SMALL), cfg, outputs=out)
    m = monthly.monthly_store(spark.table(out["daily3"]), cfg)
    assert _exchanges(m) == 0


def test_cli_menu_batch_and_ingest(spark, scratch):
    """The command line rebuilds the menu tables from parquet inputs and
    loads a report file."""
    from kasir import cli
    d = tempfile.mkdtemp(dir=scratch)
    m = fx.menu_inputs(spark, SF_SMALL)
    args = ["menu"]
    for key in ("productmix", "menu_report", "lookup_legacy", "lookup_modern", "store"):
        path = os.path.join(d, key)
        getattr(m, key).write.mode("overwrite").parquet(path)
        args += ["--table", f"{key}={path}"]
    out = cli.main(args, spark)
    assert spark.table(out["prodmix2"]).count() > 0
    csv = os.path.join(d, "r.csv")
    with open(csv, "w") as f:
        f.write("Menu Recap\nSales Date,Branch,Menu Name,Qty,Subtotal,Service Charge,Tax Total,VAT Total,Total\n"
                "2025-01-02,7,MIE,2,10.00,0,1.00,0,11.00\n")
    res = cli.main(["ingest", "menu", csv, "--target", "default.cli_menu_t", "--once", "--check"], spark)
    again = cli.main(["ingest", "menu", csv, "--target", "default.cli_menu_t", "--once"], spark)
    assert again["rows"] == 0
    with open(csv, "a") as f:
        f.write("2025-01-02,7,MIE,two,10.00,0,1.00,0,11.00\n")
    bad = cli.main(["ingest", "menu", csv, "--target", "default.cli_menu_t", "--once", "--check"], spark)
    assert bad["bad_cells"] == 1 and bad["first"][0]["value"] == "two"
    assert res["rows"] == 1 and spark.table("default.cli_menu_t").count() == 1
