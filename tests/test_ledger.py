"""One small literal-row test per semantic trap: each asserts
the required meaning, and where useful that the naive form differs."""

import datetime as dt
import random

from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DecimalType, DoubleType, LongType, StringType,
                               StructField, StructType)

from kasir.config import DEFAULT, STORE_ATTRS
from kasir.functions import expr as X
from kasir.plans import cohorts, menu, monthly, sales, tracker

D = dt.date
CFG = DEFAULT.with_(cohort_open_from="2024-10-01", as_of="2025-06-01")

STORE_SCHEMA = StructType([StructField("CODE_GIS", StringType()), StructField("NEW_CODE_STORE", StringType()),
                           StructField("STORE", StringType()), StructField("OPEN_STORE", DateType())]
                          + [StructField(a, StringType()) for a in STORE_ATTRS if a not in
                             ("OPEN_STORE", "CODE_GIS")])


def store_df(spark, rows):
    full = []
    for code_gis, code, open_, extra in rows:
        attrs = {a: f"{a}-{extra}" for a in STORE_ATTRS if a not in ("OPEN_STORE", "CODE_GIS")}
        full.append(Row(CODE_GIS=code_gis, NEW_CODE_STORE=code, STORE=code, OPEN_STORE=open_, **attrs))
    return spark.createDataFrame(full, STORE_SCHEMA)


def legacy_df(spark, rows):
    schema = StructType([StructField("Date", DateType()), StructField("RESTO", StringType()),
                         StructField("Order_Type", StringType()),
                         StructField("Value", DecimalType(18, 2))])
    return spark.createDataFrame(rows, schema)


def bills_df(spark, rows):
    schema = StructType([StructField("Sales Date", DateType()), StructField("Branch", StringType()),
                         StructField("Visit Purpose", StringType()), StructField("Bill Number", StringType()),
                         StructField("Net Sales", DecimalType(18, 2))])
    return spark.createDataFrame(rows, schema)


def test_s1_channel_derived_before_grouping(spark):
    from decimal import Decimal as Dec
    v = legacy_df(spark, [(D(2025, 1, 1), "A", "CASH", Dec("110.00")),
                          (D(2025, 1, 1), "A", "QRIS", Dec("220.00"))])
    out = sales.legacy_money(v, CFG).collect()
    assert len(out) == 1 and out[0]["Order_Type"] == "OFFLINE"
    assert float(out[0]["total_sales_net"]) == 300.0
    naive = v.groupBy("Date", "RESTO", "Order_Type").count().count()
    assert naive == 2


def test_s2_greatest_propagates_null(spark):
    df = spark.createDataFrame([(None,), (D(2019, 5, 1),), (D(2024, 2, 1),)], "d date")
    got = [r[0] for r in df.select(X.year_bucket("d", 2022, 2016)).collect()]
    assert got == [2016, 2022, 2024]
    naive = df.select(F.coalesce(F.greatest(F.year("d"), F.lit(2022)), F.lit(2016))).first()[0]
    assert naive == 2022


def test_s3_sunday_week_matches_strftime_U(spark):
    days = [D(2010, 1, 1) + dt.timedelta(days=i) for i in range(0, 22 * 366, 3)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = dict(df.select("d", X.sunday_week("d").alias("w")).collect())
    for d in days:
        assert got[d] == int(d.strftime("%U")), d
    iso = dict(df.select("d", F.weekofyear("d")).collect())
    assert any(iso[d] != got[d] for d in days)


def test_s4_trim_strips_unicode_whitespace(spark):
    df = spark.createDataFrame([(" \t x y 　\n",)], "s string")
    assert df.select(X.unicode_trim("s")).first()[0] == "x y"
    assert df.select(F.trim("s")).first()[0] != "x y"


def test_s5_whitespace_runs_ascii_only(spark):
    df = spark.createDataFrame([(" Nasi \t\n  Goreng ",), ("a\x0bb",), ("A B",)], "s string")
    got = [r[0] for r in df.select(X.product_key("s")).collect()]
    assert got == ["nasi goreng", "a\x0bb", "a b"]


def test_s6_null_dates_sort_first_in_lag(spark):
    from kasir.operators.previous import with_previous
    df = spark.createDataFrame([("A", None, 1), ("A", D(2025, 1, 2), 2), ("A", D(2025, 1, 1), 3)],
                               "k string, d date, v int")
    out = {r["v"]: r["p"] for r in with_previous(df, ["k"], "d", {"p": F.col("v")}).collect()}
    assert out == {1: None, 3: 1, 2: 3}


def test_s7_tax_divisor_is_floating(spark):
    from decimal import Decimal as Dec
    v = legacy_df(spark, [(D(2025, 1, 1), "A", "CASH", Dec("10.00"))])
    got = float(sales.legacy_money(v, CFG).first()["total_sales_net"])
    assert abs(got - 10 / 1.1) < 1e-6


def test_s8_month_is_a_date(spark):
    df = spark.createDataFrame([(D(2025, 3, 17),)], "d date").select(X.month_of("d").alias("m"))
    assert isinstance(df.schema["m"].dataType, DateType)
    assert df.first()[0] == D(2025, 3, 1)


def test_s10_duplicate_store_rows_multiply_sums_not_distinct_counts(spark):
    from decimal import Decimal as Dec
    st = store_df(spark, [("1", "S1", None, "x"), ("1", "S1", None, "x")])
    b = bills_df(spark, [(D(2025, 1, 1), "1", "01.DINE IN", "B1", Dec("10.00")),
                         (D(2025, 1, 1), "1", "01.DINE IN", "B2", Dec("5.00"))])
    r = sales.modern_daily(b, st, CFG).first()
    assert r["total_tc"] == 2 and float(r["total_sales_net"]) == 30.0


def _combined(spark, rows):
    schema = StructType([StructField("Date", DateType()), StructField("RESTO", StringType()),
                         StructField("Order_Type", StringType()), StructField("Order_Type_Group", StringType()),
                         StructField("total_tc", LongType()),
                         StructField("total_sales_net", DecimalType(38, 6))])
    return spark.createDataFrame(rows, schema)


def test_s10_group_mart_matches_join_then_group(spark):
    """Aggregate-join-aggregate equals join-then-group, with identical and
    with differing duplicate store rows."""
    from decimal import Decimal as Dec
    c = _combined(spark, [(D(2025, 1, 1), "S1", "GOFOOD", "ONLINE", 2, Dec("10")),
                          (D(2025, 1, 1), "S1", "GRABFOOD", "ONLINE", 3, Dec("20")),
                          (D(2025, 1, 2), "S1", "OFFLINE", "OFFLINE", 1, Dec("7")),
                          (D(2025, 1, 2), None, "OFFLINE", "OFFLINE", 1, Dec("1"))])
    for dup in (["x", "x"], ["x", "y"]):
        st = store_df(spark, [("1", "S1", None, dup[0]), ("2", "S1", None, dup[1])])
        got = sales.daily_group(c, st, CFG).select("Date", "RESTO", "Order_Type_Group",
                                                   "total_sales_net", "total_tc", "NAMA_OPS")
        j = c.join(st, c["RESTO"] == st["NEW_CODE_STORE"], "left")
        want = j.groupBy("Date", "RESTO", "Order_Type_Group", *STORE_ATTRS).agg(
            F.sum("total_sales_net").alias("total_sales_net"), F.sum("total_tc").alias("total_tc")
        ).select("Date", "RESTO", "Order_Type_Group", "total_sales_net", "total_tc", "NAMA_OPS")
        key = repr
        assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_s11_lag_ties_do_not_depend_on_input_order(spark):
    from decimal import Decimal as Dec
    rows = [(D(2025, 1, 1), "S1", "OFFLINE", "OFFLINE", 5, Dec("50")),
            (D(2025, 1, 1), "S1", "OFFLINE", "OFFLINE", 3, Dec("30")),
            (D(2025, 1, 2), "S1", "OFFLINE", "OFFLINE", 4, Dec("40"))]
    st = store_df(spark, [("1", "S1", D(2024, 1, 1), "x")])
    outs = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        df = _combined(spark, list(rows)).repartition(3)
        outs.add(tuple(sorted(map(tuple, sales.daily_channel(df, st, CFG)
                                  .select("total_tc", "previous_tc").collect()),
                              key=lambda t: (t[0], t[1] if t[1] is not None else -1))))
    assert len(outs) == 1


def test_s12_monthly_average_over_rows_present(spark):
    from decimal import Decimal as Dec
    c = _combined(spark, [(D(2025, 1, 1), "S1", "GOFOOD", "ONLINE", 1, Dec("10")),
                          (D(2025, 1, 1), "S1", "GOFOOD", "ONLINE", 1, Dec("20")),
                          (D(2025, 1, 9), "S1", "GOFOOD", "ONLINE", 1, Dec("60"))])
    st = store_df(spark, [("1", "S1", None, "x")])
    d1 = sales.daily_channel(c, st, CFG)
    r = monthly.monthly_channel(d1, CFG).first()
    assert r["avg_sales_net"] == 30.0 and float(r["total_sales_net"]) == 90.0


def test_monthly_average_null_for_null_store(spark):
    from decimal import Decimal as Dec
    c = _combined(spark, [(D(2025, 1, 1), None, "GOFOOD", "ONLINE", 1, Dec("10"))])
    st = store_df(spark, [("1", "S1", None, "x")])
    r = monthly.monthly_store(sales.daily_store(c, st, CFG), CFG).first()
    assert r["avg_sales_net"] is None and float(r["total_sales_net"]) == 10.0


def test_s14_daily_channel_divides_lag_again(spark):
    from decimal import Decimal as Dec
    c = _combined(spark, [(D(2025, 1, 1), "S1", "GOFOOD", "ONLINE", 1, Dec("11")),
                          (D(2025, 1, 2), "S1", "GOFOOD", "ONLINE", 1, Dec("22"))])
    st = store_df(spark, [("1", "S1", None, "x")])
    d1 = {r["Date"]: r["previous_sales_net"] for r in sales.daily_channel(c, st, CFG).collect()}
    d2 = {r["Date"]: r["previous_sales_net"] for r in sales.daily_group(c, st, CFG).collect()}
    assert abs(d1[D(2025, 1, 2)] - 11 / 1.1) < 1e-9
    assert float(d2[D(2025, 1, 2)]) == 11.0


def test_s15_menu_cutover_drops_null_dates(spark):
    pm = spark.createDataFrame([(None, "S1", "Mie", 1.0), (D(2025, 5, 31), "S1", "Mie", 2.0),
                                (D(2025, 6, 1), "S1", "Mie", 4.0)],
                               "Date date, Code string, Product string, QTY double")
    lk = spark.createDataFrame([("  mie ", "MIE", "FOOD", "M")],
                               "product string, product_cleaned string, category string, product_cleaned_2 string")
    out = menu.legacy_menu(pm, lk, CFG).collect()
    assert [(r["Qty"], r["category"]) for r in out] == [(2.0, "FOOD")]


def test_pr7_gap_adjustment(spark):
    df = spark.createDataFrame(
        [("HOMAL1", 100.0, 2.0, None), ("A", 100.0, None, 9.0), ("B", 100.0, 0.0, 9.0),
         ("C", 100.0, 1.5, 9.0), ("D", None, 1.5, 9.0)],
        "code string, a double, g double, taf double")
    got = {r[0]: r[1] for r in df.select("code", X.gap_adjusted(
        F.col("code"), F.col("a"), F.col("g"), F.col("taf"), "HOMAL1")).collect()}
    assert got == {"HOMAL1": None, "A": 100.0, "B": 100.0, "C": 150.0, "D": None}


def test_pr8_null_day_keeps_target(spark):
    t = spark.createDataFrame([("S1", None, 5.0), ("S1", D(2025, 5, 31), 6.0), ("S1", D(2025, 6, 1), 7.0)],
                              "code string, date_daily date, target_sales_nett double")
    st = store_df(spark, [("1", "S1", None, "x")])
    empty_daily = spark.createDataFrame([], "Date date, RESTO string, total_sales_net decimal(38,6)")
    adj = spark.createDataFrame([], "date date, RESTO string, percentage_gap double, sales_taf double")
    out = {r["target_sales_nett"]: r["ytd_target_sales"]
           for r in tracker.target_tracker(t, empty_daily, adj, st, CFG).collect()}
    assert out == {5.0: 5.0, 6.0: 6.0, 7.0: None}


def test_fi2_cohort_keeps_pre_opening_days(spark):
    from decimal import Decimal as Dec
    d3 = spark.createDataFrame(
        [(D(2024, 12, 30), "S1", Dec("1"), D(2025, 1, 1)), (D(2025, 1, 1), "S1", Dec("2"), D(2025, 1, 1)),
         (D(2025, 4, 1), "S1", Dec("3"), D(2025, 1, 1)), (D(2025, 1, 1), "S1", Dec("2"), D(2025, 1, 1))],
        "Date date, RESTO string, total_sales_net decimal(38,6), OPEN_STORE date")
    got = sorted((r["days_opened"], float(r["total_sales_net"]))
                 for r in cohorts.first_n_days(d3, CFG).collect())
    assert got == [(-1, 1.0), (1, 2.0)]  # day 91 is out; the duplicate row collapses


def test_types_of_published_columns(spark):
    from decimal import Decimal as Dec
    c = _combined(spark, [(D(2025, 1, 1), "S1", "GOFOOD", "ONLINE", 1, Dec("10"))])
    st = store_df(spark, [("1", "S1", None, "x")])
    out = sales.reported(sales.daily_channel(c, st, CFG))
    assert isinstance(out.schema["total_sales_net"].dataType, DoubleType)
    assert isinstance(out.schema["total_tc"].dataType, LongType)


def test_s13_feeds_overlap_and_both_rows_stay(spark):
    """A store, day and channel in both feeds gives two rows, not a sum."""
    from decimal import Decimal as Dec
    st = store_df(spark, [("1", "S1", None, "x")])
    day = D(2025, 1, 1)
    bills = spark.createDataFrame([(day, "1", "03.GOFOOD INT", "B1", Dec("10.1234"))],
                                  "`Sales Date` date, Branch string, `Visit Purpose` string, "
                                  "`Bill Number` string, `Net Sales` decimal(18,4)")
    value = spark.createDataFrame([(day, "S1", "GOFOOD", Dec("11.0000"))],
                                  "Date date, RESTO string, Order_Type string, Value decimal(18,4)")
    tc = spark.createDataFrame([(day, "S1", "GOFOOD", 4)], "Date date, RESTO string, Order_Type string, Value bigint")
    got = sorted((r["total_tc"], r["total_sales_net"]) for r in sales.combine_sales(bills, value, tc, st, CFG).collect())
    assert got == [(1, Dec("10.123400")), (4, Dec("10.000000"))]


def test_money_is_not_cut_to_cents(spark):
    from decimal import Decimal as Dec
    st = store_df(spark, [("1", "S1", None, "x")])
    bills = spark.range(1000).select(F.lit(D(2025, 1, 1)).alias("Sales Date"), F.lit("1").alias("Branch"),
                                     F.lit("01.DINE IN").alias("Visit Purpose"),
                                     F.col("id").cast("string").alias("Bill Number"),
                                     F.lit(27272.7273).alias("Net Sales"))
    r = sales.modern_daily(bills, st, CFG).first()
    assert r["total_sales_net"] == Dec("27272727.300000") and r["total_tc"] == 1000


def test_f06_current_date_by_default(spark):
    row = spark.range(1).select(X.as_of_date(None).alias("a"), F.current_date().alias("b")).first()
    assert row["a"] == row["b"] and isinstance(row["a"], dt.date)
