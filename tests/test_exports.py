"""Many small export files and their disk: rows of their own, no large tables."""

import gzip
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from kasir.operators import loads
from kasir.plans import ingest
from kasir.session import staged
from kasir.sources import fixtures as fx
from kasir.sources import reports

HEADER = ",".join(("Sales Date", *reports.REPORTS["menu"].numeric, "Name"))
CELLS = ["plain", '"quoted"', '"com,ma"', '"two ""words"""', '"line\nbreak"', '"a\n\n""\n,b"', '""', "", " x ", 'mid"dle"', "é"]


def _file(folder, name, text):
    data = text.encode()
    with open(os.path.join(folder, name), "wb") as f:
        f.write(gzip.compress(data) if name.endswith(".gz") else data)


def _odd_files(folder, n=12):
    rng = random.Random(5)
    for i in range(n):
        end = "\r\n" if i % 3 == 0 else "\n"
        rows = [",".join(["2025-01-01", *"123456", *[rng.choice(CELLS) for _ in range(rng.randint(0, 5))]])
                for _ in range(rng.randint(0, 30))]
        text = end.join([*(["Title", "", "  "] if i % 2 else []), HEADER + ("," * (i % 4)), *rows]) + (end if i % 5 else "")
        _file(folder, f"f{i:02d}.csv" + (".gz" if i % 4 == 1 else ""), ("\ufeff" if i % 4 == 2 else "") + text)


def _rows(spark, d):
    df = reports.read_report(spark, d, "menu", position=True)
    return sorted(df.columns), sorted(repr(r.asDict()) for r in df.select(*sorted(df.columns)).collect())


def test_small_files_as_texts_and_in_splits_give_the_same(spark, scratch, monkeypatch):
    d = tempfile.mkdtemp(dir=scratch)
    _odd_files(d)
    _file(d, "empty.csv", "")
    _file(d, "blank.csv", "\n  \n")
    whole = _rows(spark, d)
    monkeypatch.setattr(reports, "WHOLE_BYTES", 600)      # some one way, some the other
    assert _rows(spark, d) == whole
    monkeypatch.setattr(reports, "WHOLE_BYTES", 0)
    assert _rows(spark, d) == whole and len(whole[1]) > 50


@pytest.mark.parametrize("kind", ["sales", "menu", "service_time"])
def test_small_files_are_read_without_a_shuffle_of_rows(spark, kind):
    """As many shuffled rows as files and layouts, not as lines."""
    from conftest import SF_SMALL
    plan = ingest.prepare(spark, fx.sales_report_files(spark, SF_SMALL, kind), kind) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_writes_give_the_disk_of_their_shuffles_back(spark):
    """the shuffle files of a staged table are gone with the write."""
    store = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    size = lambda: sum(f.length() for f in (lambda it: [it.next() for _ in iter(it.hasNext, False)])(
        store.getAllFiles().iterator()) if "shuffle_" in f.getName())
    before = size()
    df = spark.range(300_000).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("h")).repartition(4, "id")
    assert staged(df, "shuffled").count() == 300_000
    assert size() - before < 5_000_000


def test_exports_are_packed(spark):
    """the text of the exports is several times what they take."""
    from conftest import SF_SMALL
    top = fx.sales_report_files(spark, SF_SMALL, "sales").rpartition("/")[0]
    files = [os.path.join(d, f) for d, _, names in os.walk(top) for f in names if not f.startswith(("_", "."))]
    texts = [gzip.open(f, "rb").read() for f in files]
    assert sum(map(len, texts)) > 3 * sum(map(os.path.getsize, files))
    assert all(t.startswith(fx.REPORT_TITLE.encode()) for t in texts)


def test_every_bad_cell_is_listed(spark, scratch):
    """more in one file than any cap had."""
    d = tempfile.mkdtemp(dir=scratch)
    _file(d, "a.csv", HEADER + "\n" + "".join(f"2025-01-01,x{i},2,3,4,5,6,n\n" for i in range(1500)))
    got = ingest.bad_cells(spark, d, "menu").collect()
    assert sorted(r["line"] for r in got) == list(range(2, 1502)) and {r["n_in_file"] for r in got} == {1500}
    with pytest.raises(ingest.BadCells) as e:
        ingest.ingest(spark, d, "menu", table="default.all_bad", check=True)
    assert e.value.cells.count() == 1500


def test_the_bad_cells_query_has_no_cap():
    """neither the query nor its SQL cuts a file's list."""
    import inspect
    from kasir import oracle, queries
    sql = queries.ORACLES["bad_cells"]
    assert "nth <=" not in sql and "most" not in inspect.getsource(queries.q_bad_cells)


@pytest.mark.parametrize("listed", [0, 10_000])
def test_loads_of_many_files_are_joined_instead_of_listed(spark, scratch, monkeypatch, listed):
    """the files of a large batch stay a table."""
    monkeypatch.setattr(loads, "LISTED", listed)
    d, t = tempfile.mkdtemp(dir=scratch), f"default.many_{listed}"
    go = lambda: ingest.ingest(spark, d, "menu", table=t, once=True)["rows"]
    line = "2025-01-01,1,2,3,4,5,6,"
    _file(d, "a b%.csv", f"{HEADER}\n{line}a\n")
    _file(d, "copy.csv", f"{HEADER}\n{line}a\n")
    assert (go(), go()) == (1, 0)
    _file(d, "c.csv", f"{HEADER}\n{line}c\n{line}c\n")
    monkeypatch.setattr(reports, "WHOLE_BYTES", 0)
    assert (go(), go()) == (2, 0)
    assert sorted(r["Name"] for r in spark.table(t).collect()) == ["a", "c", "c"]
    assert loads.ledger(spark, t).count() == 2


def test_column_layouts_are_sent_to_the_rows(spark, scratch):
    """rows are not shuffled by file to meet their file's date layout."""
    d = tempfile.mkdtemp(dir=scratch)
    _odd_files(d)
    plan = ingest.prepare(spark, d, "menu", date_layout="column")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_exports_without_a_branch_are_read(spark, scratch):
    """Keys that are NULL have files of their own, which no reader passes over."""
    from conftest import SF_SMALL
    d = tempfile.mkdtemp(dir=scratch)
    part = F.when(F.col("l_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("l_suppkey"))
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").limit(500)
    li.withColumn("l_suppkey", part).coalesce(1).write.parquet(f"{d}/lineitem.parquet")
    want = spark.read.parquet(f"{d}/lineitem.parquet").groupBy(F.col("l_suppkey").cast("string")).count()
    got = ingest.prepare(spark, fx.sales_report_files(spark, d, "menu"), "menu").groupBy("Branch").count()
    counts = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert counts(got) == counts(want) and any(k is None for k, _ in counts(got))
