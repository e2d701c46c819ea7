"""Mechanisms for scale: the same rows as the plain way, evenly spread, and
tables that stay readable when a job is killed."""

import datetime as dt
import os
import tempfile
import warnings

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from kasir.config import STORE_ATTRS
from kasir.functions import casts
from kasir.operators import dims, loads, sinks
from kasir.operators.previous import with_previous, with_previous_ranged
from kasir.plans import bill_state, ingest, months, sales
from kasir.queries import CFG, Sales
from kasir.session import release_staged, run_folder, staged
from kasir.sources import fixtures as fx
from kasir.sources import reports


def same_rows(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


# --- heavy hitters -----------------------------------------------------------------


@pytest.fixture(scope="module")
def hot(spark):
    """Facts with a third on one key and a fifth on none; a dimension with
    repeated keys, a null key and keys that no fact has."""
    i = F.col("id")
    fact = spark.range(30_000).select(
        F.when(i % 3 == 0, F.lit("hot")).when(i % 5 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("k"), i % 700)).alias("b"), i.alias("x"))
    dim = spark.createDataFrame([(f"k{i}", f"n{i}") for i in range(500)] + [("hot", "h1"), ("k7", "again"),
                                                                            (None, "null"), ("z", "none")],
                                "c string, n string")
    return fact, dim


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("limit", [0, None])
def test_skew_proof_join_gives_the_same_rows(hot, how, limit):
    fact, dim = hot
    same_rows(dims.join_skew_proof(fact, dim, "b", "c", how, limit, parts=12),
              fact.join(dim, fact["b"] == dim["c"], how))
    same_rows(dims.join_skew_proof(fact.limit(0), dim, "b", "c", how, limit), fact.limit(0).join(dim, F.lit(True), "inner"))
    same_rows(dims.join_skew_proof(fact, dim.limit(0), "b", "c", how, limit),
              fact.join(dim.limit(0), fact["b"] == dim["c"], how))


def test_skew_proof_join_has_no_straggler(spark, hot):
    fact, dim = hot
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "12",
            "spark.sql.autoBroadcastJoinThreshold": "10m"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        sizes = {}
        for name, df in (("split", dims.join_skew_proof(fact, dim, "b", "c", "left", 0, parts=12)),
                         ("plain", fact.hint("merge").join(dim, fact["b"] == dim["c"], "left"))):
            sizes[name] = sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        assert max(sizes["plain"]) > 3 * 30_000 / 12
        assert max(sizes["split"]) < 2 * 30_000 / 12
        small = dims.join_skew_proof(fact, dim, "b", "c", "left")
        assert "Exchange hashpartitioning" not in small._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_heavy_hitters_are_found(spark, hot):
    got = {r["_hot"]: r["_salts"] for r in dims.heavy_hitters(hot[0], "b", 12).collect()}
    assert got == {"hot": 8 * 12 * 10_000 // 26_000 + 1}       # 10,000 of 26,000 rows with a key


# --- previous values over ranges ------------------------------------------------------


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_previous_over_ranges(spark, parts):
    rows = [(k, c, d, float(d * 7 % 5)) for k, n in ((None, 300), ("a", 4), ("b", 60), ("c", 1))
            for c in (None, "x") for d in range(n)]
    rows += [("a", "x", None, 1.0), ("b", None, None, None), ("b", "x", 3, 2.0), ("b", "x", 3, 2.0)]
    df = spark.createDataFrame(rows, "k string, c string, d int, v double").repartition(5)
    args = (["k", "c"], "d", {"p": F.col("v"), "q": F.col("d") * 2}, ["v"])
    same_rows(with_previous_ranged(df, *args, parts=parts), with_previous(df, *args))


def test_ranges_are_even(spark):
    """One series with nearly all rows: no range has over twice the median."""
    df = spark.range(20_000).select(F.when(F.col("id") % 50 == 0, "s").alias("k"), F.col("id").alias("d"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        dealt = df.repartitionByRange(16, F.col("k").asc_nulls_first(), F.col("d").asc_nulls_first())
        n = sorted(r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(n) >= 14 and n[-1] <= 2 * n[len(n) // 2]


def test_marts_by_ranges(spark):
    s = Sales(spark, SF_SMALL)
    cfg = CFG.with_(ranged_previous=True)
    same_rows(sales.daily_store(s.combined, s.i.store, cfg), s.daily3)


# --- replacing a table ---------------------------------------------------------------


class Killed(BaseException):
    """Not an Exception: nothing tidies up after it, as after a kill."""


def test_a_killed_publish_leaves_old_or_new_rows(spark, monkeypatch):
    """Killed before and after every catalog or write step."""
    name, steps = "default.killed", 0
    sinks.publish(spark.range(3).withColumn("a", F.lit("old")), name)
    run = spark.sql
    from pyspark.sql import DataFrameWriter, SparkSession
    save = DataFrameWriter.saveAsTable
    for after in range(40):
        left = [after]

        def tick():
            left[0] -= 1
            if left[0] < 0:
                raise Killed

        def sql(self, q, *a, **k):
            if q.lstrip().split()[0] not in ("CREATE", "DROP", "ALTER"):
                return run(q, *a, **k)
            tick()
            out = run(q, *a, **k)
            tick()
            return out

        def write(self, *a, **k):
            tick()
            save(self, *a, **k)
            tick()

        with monkeypatch.context() as m:
            m.setattr(SparkSession, "sql", sql)
            m.setattr(DataFrameWriter, "saveAsTable", write)
            try:
                sinks.publish(spark.range(5).withColumn("b", F.lit(float(after))), name, bucket_by=["id"], buckets=2)
                done = True
            except Killed:
                done = False
        df = spark.table(name)
        assert (df.columns, df.count()) in ((["id", "a"], 3), (["id", "b"], 5))
        if done:
            steps = after
            break
    assert steps >= 6
    sinks.publish(spark.range(1), name)
    assert spark.table(name).count() == 1 and len(sinks.versions(spark, name)) == 2
    sinks.drop(spark, name)
    assert not sinks.versions(spark, name) and not spark.catalog.tableExists(name)


def test_a_plain_table_becomes_a_version(spark):
    name = "default.plain_before"
    spark.range(4).write.saveAsTable(name)
    sinks.write(spark.range(2), name, "overwrite")
    assert spark.table(name).count() == 2
    # Killed between the two steps of the change: the rows come back.
    spark.range(4).write.saveAsTable("default.plain_killed")
    spark.sql("ALTER TABLE default.plain_killed RENAME TO default.plain_killed__v0")
    sinks.repair(spark, "default.plain_killed")
    assert spark.table("default.plain_killed").count() == 4


def test_append_reaches_the_current_version(spark):
    name = "default.append_version"
    sinks.publish(spark.range(3), name, bucket_by=["id"], buckets=2)
    sinks.write(spark.range(2), name, "append")
    assert spark.table(name).count() == 5
    assert "Bucketed: true" in spark.table(name).groupBy("id").count()._jdf.queryExecution().executedPlan().toString()


def test_staged_tables_are_released(spark):
    import glob
    local = run_folder(spark).removeprefix("file:")
    df = staged(spark.range(3), "release-me")
    assert df.count() == 3 and glob.glob(f"{local}/release-me-*")


# --- months --------------------------------------------------------------------------


def _names(spark, tag):
    return {k: f"default.m_{tag}_{k}" for k in ("combined", "tails", "daily1")}


def _feeds(spark, bills):
    i = fx.sales_inputs(spark, SF_SMALL)
    empty = i.sales_value.limit(0)
    b = spark.createDataFrame([(d and dt.date.fromisoformat(d), *r) for d, *r in bills],
                              "`Sales Date` date, Branch string, `Visit Purpose` string, `Bill Number` string, "
                              "`Net Sales` int").withColumn("Net Sales", F.col("Net Sales").cast("decimal(18,4)"))
    return type(i)(b, empty, i.sales_tc.limit(0), i.store, i.targets, i.adjustments)


BILLS = [("2024-01-05", "1", "01.DINE IN", "a", 10), ("2024-02-07", "1", "01.DINE IN", "b", 20),
         ("2024-05-01", "1", "01.DINE IN", "c", 30), ("2024-02-09", "2", "04.GRAB FOOD INT", "d", 5),
         ("2024-04-09", "2", "04.GRAB FOOD INT", "e", 6), (None, "1", "01.DINE IN", "f", 7),
         ("2024-03-02", "none", "x", "g", 8), ("2024-03-03", "none", "x", "h", 9)]


@pytest.mark.parametrize("case, before, after, month, made", [
    # a row more in the month; a series' last row gone; a whole month gone; the month NULL
    ("more", BILLS[:1] + BILLS[2:], BILLS, "2024-02-01", {"2024-02-01", "2024-05-01"}),
    ("less", BILLS, BILLS[:3] + BILLS[4:], "2024-02-01", {"2024-02-01", "2024-04-01"}),
    ("gone", BILLS, BILLS[:6], "2024-03-01", {"2024-03-01"}),
    ("null", BILLS[:5] + BILLS[6:], BILLS, None, {None, "2024-01-01"}),
    ("same", BILLS, BILLS, "2024-02-01", {"2024-02-01"}),
])
def test_one_month_equals_a_full_rebuild(spark, case, before, after, month, made):
    names = _names(spark, case)
    months.publish_months(spark, _feeds(spark, before), names, None, CFG)
    one = month and dt.date.fromisoformat(month)
    got = months.publish_months(spark, _feeds(spark, after), names, [one], CFG)
    assert {m and m.isoformat() for m in got} == made
    i = _feeds(spark, after)
    full = sales.daily_channel(sales.combine_sales(i.bills, i.sales_value, i.sales_tc, i.store, CFG), i.store, CFG)
    same_rows(spark.table(names["daily1"]).select(*full.columns), full)
    read = spark.table(names["daily1"]).where(months.is_month([one]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in read


# --- mergeable bill counts --------------------------------------------------------------


def test_merged_counts_equal_a_full_count(spark):
    st = fx.store(spark, SF_SMALL)
    rows = [(dt.date(2024, 1, 1 + i % 3), str(i % 4), "01.DINE IN", f"b{i % 17}" if i % 6 else None, 1.5) for i in range(90)]
    rows += [(None, None, None, "x", 2.0), (dt.date(2024, 1, 9), "1", "z", None, 1.0)]
    df = spark.createDataFrame(rows, "`Sales Date` date, Branch string, `Visit Purpose` string, `Bill Number` string, "
                                     "`Net Sales` double")
    names = {p: f"default.state_{p}" for p in bill_state.PARTS}
    state = bill_state.empty(spark, CFG)
    for k, load in enumerate((df.limit(0), df.where("abs(hash(`Bill Number`, Branch)) % 2 = 0"),
                              df.where("coalesce(abs(hash(`Bill Number`, Branch)) % 2 = 1, true)"), df.limit(0))):
        state = bill_state.update(state, load, CFG)
        bill_state.store(state, names)
        state = bill_state.load(spark, names)
    same_rows(bill_state.counts(state, st, CFG), sales.modern_daily(df, st, CFG).select(*bill_state.counts(state, st, CFG).columns))
    ids = [r["id"] for r in state.bills.collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))


# --- loads ---------------------------------------------------------------------------------

HEADER = ",".join(("Sales Date", *reports.REPORTS["menu"].numeric, "Name"))


def _menu(folder, name, rows):
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write("Title\n\n" + HEADER + "\n" + "".join(f"{r}\n" for r in rows))


def test_each_content_is_loaded_once(spark, scratch):
    d, t = tempfile.mkdtemp(dir=scratch), "default.once_t"
    _menu(d, "a.csv", ["2025-01-01,1,2,3,4,5,6,a"])
    _menu(d, "copy of a.csv", ["2025-01-01,1,2,3,4,5,6,a"])
    go = lambda **k: ingest.ingest(spark, d, "menu", table=t, once=True, **k)
    assert go()["rows"] == 1 and go()["rows"] == 0
    _menu(d, "b.csv", ["2025-01-02,1,2,3,4,5,6,b", "2025-01-02,1,2,3,4,5,6,b2"])
    assert go(check=True)["rows"] == 2
    assert sorted(r.Name for r in spark.table(t).collect()) == ["a", "b", "b2"]
    assert loads.ledger(spark, t).count() == 2
    with pytest.raises(ValueError, match="append"):
        go(mode="overwrite")
    plain = "default.twice_t"
    for _ in range(2):
        ingest.ingest(spark, os.path.join(d, "b.csv"), "menu", table=plain)
    assert spark.table(plain).count() == 4
    with pytest.raises(ValueError, match="no ledger"):
        ingest.ingest(spark, d, "menu", table=plain, once=True)


def test_a_load_killed_before_its_commit_is_not_seen(spark, scratch):
    d, t = tempfile.mkdtemp(dir=scratch), "default.once_killed"
    _menu(d, "a.csv", ["2025-01-01,1,2,3,4,5,6,a"])
    ingest.ingest(spark, d, "menu", table=t, once=True)
    _menu(d, "b.csv", ["2025-01-02,1,2,3,4,5,6,b"])
    load = loads.new_load(spark, t, d)
    load.write_rows(ingest.prepare(spark, load.paths, "menu"))
    assert spark.table(t).count() == 1 and spark.table(f"{t}__rows").count() == 2
    ingest.ingest(spark, d, "menu", table=t, once=True)
    assert spark.table(t).count() == 2 and spark.table(f"{t}__rows").count() == 2


def test_bad_cells_are_listed_and_nothing_is_written(spark, scratch):
    d, t = tempfile.mkdtemp(dir=scratch), "default.bad_cells_t"
    _menu(d, "a.csv", ["2025-01-01,1,2,3,4,5,6,a", '2025-01-01,"1,5",2,3,4,5,6,"two\nlines"', "2025-01-01,1,2,3,x,5,2f,c"])
    _menu(d, "b.csv", ["2025-01-01,1,2,3,4,5,6,b", "2025-01-01,,nan,3,4,5,inf,b"])
    with pytest.raises(ingest.BadCells) as e:
        ingest.ingest(spark, d, "menu", table=t, check=True)
    assert e.value.count == 3 and not spark.catalog.tableExists(t)
    got = sorted((r.file.rsplit("/", 1)[1], r.line, r.column, r.value, r.n_in_file) for r in e.value.cells.collect())
    assert got == [("a.csv", 5, "Qty", "1,5", 3), ("a.csv", 7, "Tax Total", "x", 3), ("a.csv", 7, "Total", "2f", 3)]
    assert ingest.bad_cells(spark, d, "menu", most=1).count() == 1
    assert ingest.ingest(spark, os.path.join(d, "b.csv"), "menu", table=t, check=True)["rows"] == 2


# --- dates and durations as the original dataframe library reads them ---------------------

DATE_COLUMNS = [
    ["2025-01-02", "03/04/2025", "2025-05-06 10:00:00", "x"], ["03/04/2025", "13/04/2025", "2025-01-01", None],
    ["13/04/2025", "03/04/2025", "04/13/2025"], [None, "n/a", "2025-01-02", "03/04/2025"],
    ["2-Jan-2025", "3-FEB-2025", "2025-01-01"], ["2025/1/2", "2025/01/03", "2025-01-02"],
    ["2025-01-02 10:11:12", "2025-01-03", "2025-01-04 1:02:03"], ["03-04-2025", "13-04-2025"],
    ["2 Jan 2025", "2-Jan-2025"], ["01/02/2025 9:05", "01/03/2025 10:05:00", "1/3/2025 10:05"],
    ["2025-01-02T10:11:12", "2025-01-03 10:11:12"], ["1/2/2025", "01/02/2025"], ["20250102", "2025-01-02"],
    ["02/30/2025", "03/01/2025"], ["13/13/2025", "03/01/2025"], ["2025-02-30", "2025-03-01"], [None, None],
]


def test_one_date_layout_per_column(spark):
    rows = [(f, i, v) for f, col in enumerate(DATE_COLUMNS) for i, v in enumerate(col)]
    df = spark.createDataFrame([(f"f{f:02d}", i, v) for f, i, v in rows], "_file string, _row long, d string").repartition(4)
    got = {(r["_file"], r["_row"]): r["d"] for r in ingest.cast_date_by_column(df, ["d"]).collect()}
    for f, col in enumerate(DATE_COLUMNS):
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            want = pd.to_datetime(pd.Series(col), errors="coerce").dt.date
        assert [got[f"f{f:02d}", i] for i in range(len(col))] == [None if pd.isna(x) else x for x in want], col


UNIT_DURATIONS = [
    "5 min", "2h30m", "1.5 hours", "PT5M", "P1DT2H3M4.5S", "P1W", "PT", "P", "1 day 2 hours", "1d2h", "3 weeks",
    "5min 3s", "-2h30m", "2h -30m", "- 5 min", "+5 min", "10s", "100 ms", "5us", "7 ns", "5 n", "1 L", "1 t", "5 T",
    "5 H", "1 D", "1 M", "5 W", "1 days 2h", "1 hr", "1hours", "2 H30 M", "1.0000000001 s", "0.1 s", ".5 h", "5. h",
    "1,5 h", "5 minutes, 3 seconds", "99999999 days", "PT1.123456789S", "PT1H2M", "P1Y", "-PT5M", "pt5m", "1 second",
    "2 secs", "3 hrs", "4 mins", "1 wk", "12 y", "5min3", "5  min ", " 5 min", "1 days", "5 Min", "5 MIN", "1m",
    "1 microsecond", "3 µs", "5minute", "PT0S", "P1DT", "P1D", "PT36H", "-P1D", "1h30", "1 day, 2 h", "1e3 s",
    "--5 min", "1h2d", "1h1h", "1.5h30m", "1.9 ns", "2.5 us", "0.3 days", "1.1 h", "0 s", "min", "5 blinks",
]


def test_durations_with_units(spark):
    df = spark.createDataFrame([(v,) for v in UNIT_DURATIONS], "d string")
    got = [r[0] for r in df.select(casts.duration_nanos("d")).collect()]
    for v, g in zip(UNIT_DURATIONS, got):
        x = pd.to_timedelta(pd.Series([v]), errors="coerce").iloc[0]
        assert g == (None if pd.isna(x) else x.value), v


def test_release_comes_last(spark):
    """Kept last: deletes what the other tests staged, but for the fixtures'
    dimension, which later modules build again."""
    folder = run_folder(spark)
    fx._MEMO.clear()
    from conftest import _FRAMES
    from kasir.queries import _Stages
    _FRAMES.clear()
    _Stages._cache.clear()
    release_staged(spark)
    assert not os.path.exists(folder.removeprefix("file:"))
    assert fx.store(spark, SF_SMALL).count() > 0


def test_queries_bound_what_a_task_reads(spark):
    """Also where the session comes with Spark's own sizes."""
    from conftest import SF_SMALL
    from kasir.queries import QUERIES
    from kasir.session import JOB_CONF
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes",
             "spark.sql.codegen.hugeMethodLimit")
    for k in names:
        spark.conf.unset(k)
    QUERIES["map_visit_purpose"](spark, SF_SMALL)
    assert {k: spark.conf.get(k) for k in names} == {k: JOB_CONF[k] for k in names}


def test_a_folder_stands_for_all_files_below_it(spark, tmp_path):
    from kasir.operators.loads import file_digests
    from kasir.sources.reports import raw_lines
    for at, text in (("north", "a\nb\n"), ("south/deep", "c\n")):
        (tmp_path / at).mkdir(parents=True)
        (tmp_path / at / "x.csv").write_text(text)
    assert sorted(r["_line"] for r in raw_lines(spark, str(tmp_path)).collect()) == ["a", "b", "c"]
    assert sorted(r["bytes"] for r in file_digests(spark, str(tmp_path)).collect()) == [2, 4]


def test_a_key_with_few_bills_keeps_few_bytes(spark):
    """Sets of bills are integers of 64 ids each, also with the last bit set."""
    from kasir.plans import bill_state
    rows = [(dt.date(2024, 1, 1), "1", "01.DINE IN", str(i), 1.0) for i in range(200)]
    load = lambda part: spark.createDataFrame(
        part, "`Sales Date` date, Branch string, `Visit Purpose` string, `Bill Number` string, `Net Sales` double")
    state = bill_state.empty(spark)
    for part in (rows[:150], rows[100:]):
        state = bill_state.update(state, load(part))
    assert dict(state.bits.dtypes)["bits"] == "bigint"
    assert state.bits.count() <= 5
    stores = spark.createDataFrame([("1", "S")], "CODE_GIS string, NEW_CODE_STORE string")
    assert [r["total_tc"] for r in bill_state.counts(state, stores).collect()] == [200]


# --- partitions that follow the input -------------------------------------------------


@pytest.mark.parametrize("name", ["monthly_store", "month_average", "distinct_daily", "days_open"])
def test_tasks_stay_small_with_few_shuffle_partitions(spark, name):
    """A session's two shuffle partitions do not become two tasks, however large
    the input: the marts' tasks follow the advisory size."""
    from kasir.functions.expr import days_since
    from kasir.plans import cohorts, monthly
    from kasir.session import ensure_job_conf
    at = F.col("id")
    combined = spark.range(60_000).select(
        F.date_add(F.lit(dt.date(2024, 1, 1)), (at % 300).cast("int")).alias("Date"),
        F.concat(F.lit("S"), F.floor(at / 300).cast("string")).alias("RESTO"),
        F.lit("OFFLINE").alias("Order_Type"), F.lit("OFFLINE").alias("Order_Type_Group"),
        (at % 7).alias("total_tc"), (at % 1009).cast(CFG.net_type).alias("total_sales_net"))
    store = spark.range(200).select(
        F.concat(F.lit("S"), at.cast("string")).alias("NEW_CODE_STORE"), F.lit(dt.date(2024, 1, 5)).alias("OPEN_STORE"),
        *[F.lit("x").alias(c) for c in STORE_ATTRS[1:]])
    build = {
        "monthly_store": lambda: monthly.monthly_store(sales.daily_store(combined, store, CFG), CFG),
        "month_average": lambda: monthly.month_average(sales.daily_group(combined, store, CFG), monthly.GRAINS["group"]),
        "distinct_daily": lambda: cohorts.distinct_daily(sales.daily_store(combined, store, CFG), CFG),
        "days_open": lambda: sales.daily_store(combined, store, CFG).select("RESTO", days_since("Date", "OPEN_STORE"))}
    sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
             "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k", "spark.sql.shuffle.partitions": "2"}
    before = {k: spark.conf.get(k, None) for k in sizes}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        ensure_job_conf(spark)
        for k, v in sizes.items():
            spark.conf.set(k, v)
        rows = [r["count"] for r in build[name]().groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    whole = 60_000 if name in ("distinct_daily", "days_open") else 200 * 10
    assert sum(rows) == whole and max(rows) < whole / 4


@pytest.mark.parametrize("name", ["daily_store", "distinct_daily"])
def test_stores_with_several_dimension_rows_do_not_fill_one_task(spark, name):
    """Dimension rows multiply a store's rows after the exchange by store, whose
    partitions are then not joined up by the bytes before that."""
    from kasir.plans import cohorts
    from kasir.session import ensure_job_conf
    ensure_job_conf(spark)
    at = F.col("id")
    combined = spark.range(200 * 10).select(
        F.date_add(F.lit(dt.date(2024, 1, 1)), (at % 10).cast("int")).alias("Date"),
        F.concat(F.lit("S"), F.floor(at / 10).cast("string")).alias("RESTO"),
        F.lit("OFFLINE").alias("Order_Type"), F.lit("OFFLINE").alias("Order_Type_Group"),
        (at % 7).alias("total_tc"), (at % 1009).cast(CFG.net_type).alias("total_sales_net"))
    store = spark.range(200 * 40).select(
        F.concat(F.lit("S"), (at % 200).cast("string")).alias("NEW_CODE_STORE"),
        F.date_add(F.lit(dt.date(2023, 1, 1)), F.floor(at / 200).cast("int")).alias("OPEN_STORE"),
        *[F.lit("x").alias(c) for c in STORE_ATTRS[1:]])
    daily = sales.daily_store(combined, store, CFG)
    out = daily if name == "daily_store" else cohorts.distinct_daily(daily, CFG.with_(cohort_open_from="2023-01-01"))
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "-1")
        rows = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set(limit, before)
    assert sum(rows) == 200 * 10 * 40 and max(rows) < sum(rows) / 10


def test_initial_partitions_follow_the_session(spark):
    from kasir.session import INITIAL_KEY, INITIAL_PARTITIONS, initial_partitions
    keys = ("spark.sql.shuffle.partitions", INITIAL_KEY)
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for parts, own, least in ((8, None, 1000), (12, None, 1008), (3000, None, 3000), (8, "5000", 5000)):
            spark.conf.set(keys[0], str(parts))
            spark.conf.unset(INITIAL_KEY) if own is None else spark.conf.set(INITIAL_KEY, own)
            assert initial_partitions(spark) == least >= INITIAL_PARTITIONS
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
