"""Report ingest: casts against the dataframe library the uploads used,
report files with preambles, all-or-nothing loads, sinks."""

import os
import tempfile

import pandas as pd
import pytest

from pyspark.sql import functions as F

from kasir.functions import casts
from kasir.operators import sinks
from kasir.operators.quality import null_profile
from kasir.plans import ingest
from kasir.sources import reports


def _one(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(expr(F.col("s"))).collect()]


DURATIONS = ["00:00:30", "26:00:00", "1 days 02:00:00", "-00:00:30", "00:00:01.5",
             "00:61:00", "12:34:56.123456", "2 days 23:59:59", "-1 days 02:00:00",
             "-1 days +02:00:00", "-0 days 00:00:30", "+00:00:30", "1 day 01:00:00",
             "1 days, 01:00:00", "-1 days -02:00:00", "- 00:00:30", "-2 days", "1 days",
             "00:00:30.1234567", "90:00:00", " 00:00:05 ", "00:00:00.000000500", "5", "-5",
             "1.5", "26:00", "00:05", "soon", "", "13:05"]


def _pandas_duration(v):
    td = pd.to_timedelta(pd.Series([v]), errors="coerce")
    return td.apply(lambda x: str(x).split(" ")[-1] if pd.notnull(x) else None).iloc[0]


def test_clean_duration_matches_pandas(spark):
    df = spark.createDataFrame([(v,) for v in DURATIONS], "d string")
    got = [r[0] for r in ingest.clean_durations(df, ["d"]).collect()]
    want = [_pandas_duration(v) for v in DURATIONS]
    for v, g, w in zip(DURATIONS, got, want):
        assert g == w, (v, g, w)


def test_duration_seconds_keeps_days(spark):
    df = spark.createDataFrame([("26:00:00",), ("1 days 02:00:00",)], "d string")
    out = ingest.clean_durations(df, ["d"], seconds=True).collect()
    assert [r[0] for r in out] == [93600.0, 93600.0]


def test_strict_numeric(spark):
    got = _one(spark, ["1.5", " 2.5 ", "1e3", "", None, "nan", "inf"],
               lambda c: casts.strict_double(c, "x"))
    assert got[:5] == [1.5, 2.5, 1000.0, None, None]
    assert got[5] is None and got[6] == float("inf")
    for bad in ("1,000", "1.5d", "2f", "1e", "0x1", "."):
        with pytest.raises(Exception, match="not a number"):
            _one(spark, [bad], lambda c: casts.strict_double(c, "x"))


def test_durations_out_of_range_are_missing(spark):
    df = spark.createDataFrame([("9999999:00:00",), ("999999999 days",), ("00:00:05",),
                                ("99999999999999999999 days",)], "d string")
    assert [r[0] for r in ingest.clean_durations(df, ["d"]).collect()] == [None, None, "00:00:05", None]


def test_lenient_date(spark):
    got = _one(spark, ["2025-03-04", "2025-03-04 10:11:12", "03/04/2025", "n/a", None],
               casts.lenient_date)
    import datetime as dt
    assert got == [dt.date(2025, 3, 4)] * 3 + [None, None]


def test_lenient_time(spark):
    got = _one(spark, ["1:2:3", "13:05:00", "13:05", "24:00:00", "25:61:00", "x"], casts.lenient_time)
    assert got == ["01:02:03", "13:05:00", None, None, None, None]
    pd_got = [None if pd.isna(x) else x.strftime("%H:%M:%S") for x in
              pd.to_datetime(pd.Series(["1:2:3", "13:05:00", "13:05", "24:00:00", "25:61:00", "x"]),
                             format="%H:%M:%S", errors="coerce")]
    assert got == pd_got


def test_drop_blank(spark):
    df = spark.createDataFrame([("A",), ("  ",), (None,), (" ",), ("B ",)], "k string")
    assert [r[0] for r in ingest.drop_blank(df, "k").collect()] == ["A", "B "]


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


SALES_HEADER = ("Bill Number,Sales Date,Sales In Date,Sales Out Date,Sales In Time,Sales Out Time,"
                + ",".join(reports.REPORTS["sales"].numeric) + ",Branch")


def _sales_line(bill, date, t, net, branch="101"):
    nums = ["1"] * len(reports.REPORTS["sales"].numeric)
    nums[reports.REPORTS["sales"].numeric.index("Net Sales")] = net
    return f"{bill},{date},{date},{date},{t},{t}," + ",".join(nums) + f",{branch}"


def test_read_report_finds_header_below_preamble(spark, scratch):
    d = tempfile.mkdtemp(dir=scratch)
    preamble = 'Sales Recap Report\n\nBranch: ALL,,\n"Period: 1 Jan\n- 31 Jan"\n\n'
    _write(os.path.join(d, "a.csv"), preamble + SALES_HEADER + "\n"
           + _sales_line("B1", "2025-01-01", "9:05:07", "100.5") + "\n"
           + _sales_line("", "2025-01-01", "9:05:07", "1") + "\n"
           + _sales_line("B2", "n/a", "25:00:00", "") + "\n")
    # second file: other preamble, one extra column
    _write(os.path.join(d, "b.csv"), "Title\n" + SALES_HEADER + ",Cashier\n"
           + _sales_line("B3", "01/02/2025", "10:00:00", "7") + ",ANI\n")
    raw = reports.read_report(spark, [os.path.join(d, "a.csv"), os.path.join(d, "b.csv")], "sales")
    assert "Cashier" in raw.columns
    typed = ingest.cleanse(raw, "sales")
    rows = {r["Bill Number"]: r for r in typed.collect()}
    assert set(rows) == {"B1", "B2", "B3"}
    assert rows["B1"]["Net Sales"] == 100.5 and rows["B1"]["Sales In Time"] == "09:05:07"
    assert rows["B2"]["Sales Date"] is None and rows["B2"]["Net Sales"] is None
    assert rows["B3"]["Cashier"] == "ANI" and rows["B1"]["Cashier"] is None
    import datetime as dt
    assert rows["B3"]["Sales Date"] == dt.date(2025, 1, 2)


def _menu_header(*more):
    return ",".join(("Sales Date", *reports.REPORTS["menu"].numeric, *more))


def test_no_cell_is_lost(spark, scratch):
    """Quotes, commas and line breaks in cells; blank and repeated headers;
    more than 64 columns; a row wider than its header."""
    d = tempfile.mkdtemp(dir=scratch)
    wide = [f"W{i}" for i in range(80)]
    nums = ",".join("123456")
    _write(os.path.join(d, "a.csv"), "Title,\"with \"\"quotes\"\", and comma\"\n\n"
           + _menu_header("Name", "", "name", *wide, "Last") + "\n"
           + f'2025-01-01,{nums},"big ""hot, red""\nbowl",x,y,' + ",".join(f"v{i}" for i in range(80)) + ",end,over\n")
    _write(os.path.join(d, "b.csv"), _menu_header("Other", "Name") + f"\n2025-01-02,{nums},o,n\n")
    df = reports.read_report(spark, [os.path.join(d, "a.csv"), os.path.join(d, "b.csv")], "menu")
    a, b = sorted((r.asDict() for r in df.collect()), key=lambda r: r["Sales Date"])
    assert a["Name"] == 'big "hot, red"\nbowl' and a["Unnamed: 8"] == "x" and a["name.1"] == "y"
    assert [a[w] for w in wide] == [f"v{i}" for i in range(80)]
    assert a["Last"] == "end" and a["Unnamed: 91"] == "over"
    assert (b["Other"], b["Name"], b["Last"], b["Unnamed: 8"]) == ("o", "n", None, None)


def test_files_are_scanned_once(spark, scratch):
    """Everything after the scan reads the staged lines and rows."""
    d = tempfile.mkdtemp(dir=scratch)
    _write(os.path.join(d, "a.csv"), _menu_header() + "\n2025-01-02,1,2,3,4,5,6\n")
    for df in (reports.raw_lines(spark, d), reports.raw_rows(spark, d), reports.read_report(spark, d, "menu")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan text" not in plan and "FileScan csv" not in plan and "FileScan parquet" in plan


ODD_CELLS = ['plain', '"quoted"', '"com,ma"', '"two ""words"""', '"line\nbreak"', '"a\n\n""\n,b"', '""', '', '"cr\r\nlf"',
             '"' + "long, " * 200 + '\n"', " spaced ", '"é\n日本"']


@pytest.mark.parametrize("split", ["40b", "333b", "128m"])
def test_records_across_splits(spark, scratch, split):
    """A file cut anywhere, inside quoted line breaks too, gives the records and
    line numbers that a sequential reader gives."""
    import csv
    import random
    rng = random.Random(3)
    d = tempfile.mkdtemp(dir=scratch)
    rows = [[rng.choice(ODD_CELLS) for _ in range(rng.randint(1, 6))] for _ in range(120)]
    text = ("\ufeff" + "\n".join(",".join(r) for r in rows[:60]) + "\n\n  \n"
            + "\r\n".join(",".join(r) for r in rows[60:]) + "\r\n")
    with open(os.path.join(d, "a.csv"), "w", encoding="utf-8", newline="") as f:
        f.write(text)
    import io
    # A line of white space is blank; one of an empty quoted cell is not.
    want = [[x or None for x in r] for r in csv.reader(io.StringIO(text.lstrip("\ufeff"), newline=""))
            if r and not (len(r) == 1 and r[0].isspace())]
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        spark.conf.set(keys[0], split)
        spark.conf.set(keys[1], "1b")
        got = reports.raw_rows(spark, d).orderBy("_row").collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    blank = lambda cells: [x or None for x in cells]
    assert [blank(r["_cells"]) for r in got] == want
    lines = text.split("\n")
    for r in got:
        first = next((x for x in r["_cells"] if x), None)
        if first:
            assert first.split("\n")[0].replace('"', "")[:5] in lines[r["_row"]].replace('""', '"').replace('"', "")


def test_preview_is_the_first_rows_of_each_file(spark, scratch):
    d = tempfile.mkdtemp(dir=scratch)
    for f in "ab":
        _write(os.path.join(d, f"{f}.csv"), "T\n" + _menu_header("Name") + "\n"
               + "".join(f"2025-01-01,1,2,3,4,5,6,{f}{i}\n" for i in range(7)))
    got = [r["Name"] for r in ingest.preview_files(spark, d, "menu", 3).orderBy("Name").collect()]
    assert got == ["a0", "a1", "a2", "b0", "b1", "b2"]


def test_date_formats_reach_the_load(spark, scratch):
    d = tempfile.mkdtemp(dir=scratch)
    _write(os.path.join(d, "a.csv"), _menu_header() + "\n25/12/2024,1,2,3,4,5,6\n")
    import datetime as dt
    ingest.ingest(spark, d, "menu", table="default.formats_t", formats=("d/M/yyyy",))
    assert spark.table("default.formats_t").first()["Sales Date"] == dt.date(2024, 12, 25)
    assert ingest.prepare(spark, d, "menu").first()["Sales Date"] is None


def test_missing_header_fails_before_write(spark, scratch):
    d = tempfile.mkdtemp(dir=scratch)
    _write(os.path.join(d, "a.csv"), "x,y\n1,2\n")
    with pytest.raises(ValueError, match="no header row"):
        ingest.ingest(spark, os.path.join(d, "a.csv"), "sales", table="default.never_written")
    assert not spark.catalog.tableExists("default.never_written")


def test_bad_number_fails_whole_batch(spark, scratch):
    d = tempfile.mkdtemp(dir=scratch)
    _write(os.path.join(d, "a.csv"), SALES_HEADER + "\n" + _sales_line("B1", "2025-01-01", "1:1:1", "1") + "\n")
    _write(os.path.join(d, "b.csv"), SALES_HEADER + "\n" + _sales_line("B2", "2025-01-01", "1:1:1", "1;5") + "\n")
    with pytest.raises(Exception, match="not a number"):
        ingest.ingest(spark, [os.path.join(d, "a.csv"), os.path.join(d, "b.csv")], "sales",
                      table="default.bad_batch")
    assert not spark.catalog.tableExists("default.bad_batch")


def test_append_doubles_overwrite_replaces(spark, scratch):
    d = tempfile.mkdtemp(dir=scratch)
    f = os.path.join(d, "a.csv")
    _write(f, SALES_HEADER + "\n" + _sales_line("B1", "2025-01-01", "1:1:1", "1") + "\n"
           + _sales_line("B2", "2025-01-01", "1:1:1", "2") + "\n")
    t = "default.sales_ingest_t"
    s1 = ingest.ingest(spark, f, "sales", "append", table=t)
    ingest.ingest(spark, f, "sales", "append", table=t)
    assert s1["rows"] == 2 and spark.table(t).count() == 4
    ingest.ingest(spark, f, "sales", "overwrite", table=t)
    assert spark.table(t).count() == 2
    with pytest.raises(ValueError):
        sinks.write(spark.table(t), "default.x", "merge")


def test_publish_replaces_schema(spark):
    t = "default.publish_t"
    sinks.publish(spark.range(3).withColumn("a", F.lit("x")), t)
    sinks.publish(spark.range(2).withColumn("b", F.lit(1.0)), t)
    df = spark.table(t)
    assert df.count() == 2 and df.columns == ["id", "b"]


def test_a_failed_write_leaves_the_old_rows(spark, scratch):
    good = spark.range(3).withColumn("x", F.lit(1.0))
    bad = spark.range(5).withColumn("x", F.when(F.col("id") == 4, F.raise_error(F.lit("broken")).cast("double")))
    tables = {n: f"default.safe_{n}" for n in ("publish", "bucketed", "overwrite", "append")}
    for t in tables.values():
        sinks.publish(good, t)
    for act in (lambda: sinks.publish(bad, tables["publish"]),
                lambda: sinks.publish(bad, tables["bucketed"], bucket_by=["id"], buckets=2),
                lambda: sinks.write(bad, tables["overwrite"], "overwrite"),
                lambda: sinks.write(bad, tables["append"], "append")):
        with pytest.raises(Exception, match="broken"):
            act()
    for t in tables.values():
        assert spark.table(t).count() == 3, t
    for t in tables.values():
        assert len(sinks.versions(spark, t)) == 1
    d = tempfile.mkdtemp(dir=scratch)
    _write(os.path.join(d, "a.csv"), SALES_HEADER + "\n" + _sales_line("B2", "2025-01-01", "1:1:1", "1;5") + "\n")
    with pytest.raises(Exception, match="not a number"):
        ingest.ingest(spark, d, "sales", "overwrite", table=tables["overwrite"])
    assert spark.table(tables["overwrite"]).count() == 3


def test_append_by_name(spark):
    t = "default.append_by_name"
    sinks.write(spark.createDataFrame([(1, "a")], "n int, s string"), t, "append")
    sinks.write(spark.createDataFrame([("b",)], "S string"), t, "append")
    assert sorted((r.n or 0, r.s) for r in spark.table(t).collect()) == [(0, "b"), (1, "a")]
    with pytest.raises(ValueError, match="extra"):
        sinks.write(spark.createDataFrame([(1, 2)], "n int, extra int"), t, "append")


def test_no_machine_local_folder_on_a_cluster(spark, monkeypatch):
    from kasir import session

    class Cluster:
        class conf:
            get = staticmethod(lambda k, d=None: d)
            set = staticmethod(lambda k, v: None)

        class sparkContext:
            master = "spark://somewhere:7077"
            getCheckpointDir = staticmethod(lambda: None)
            setCheckpointDir = staticmethod(lambda d: pytest.fail(d))

    session.ensure_job_conf(Cluster)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Cluster)


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, "a"), (3, None)], "x int, y string")
    r = null_profile(df).first()
    assert (r["rows"], r["x"], r["y"]) == (3, 1, 2)


def test_unknown_kind():
    with pytest.raises(ValueError):
        reports.spec("inventory")
