"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over
the driver's tables, and has a DuckDB twin in ``kasir.oracle``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kasir import oracle as O
from kasir.config import MENU_STORE_ATTRS, SAME_YEAR_ATTRS, STORE_ATTRS
from kasir.functions.expr import date_lit, days_since, map_labels, sunday_week, year_bucket
from kasir.operators.dims import check_unique
from kasir.operators import sinks
from kasir.operators.previous import with_previous, with_previous_ranged
from kasir.operators.quality import null_profile, unmatched_keys
from kasir.plans import bill_state, cohorts, ingest, menu, monthly, months, pipeline, sales, tracker
from kasir.plans.sales import reported
from kasir.session import ensure_job_conf
from kasir.sources import fixtures as fx
from kasir.sources.reports import read_report

CFG = fx.FIXTURE_CONFIG


class _Stages:
    """Plans built once per (application, folder, config) and reused."""

    _cache: dict = {}

    def __new__(cls, spark: SparkSession, sf_dir: str, cfg=CFG):
        key = (cls.__name__, spark.sparkContext.applicationId, sf_dir, cfg)
        if key not in cls._cache:
            cls._cache[key] = super().__new__(cls)
        return cls._cache[key]


class Sales(_Stages):
    """The sales jobs chained over the fixture inputs of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg=CFG):
        if getattr(self, "i", None) is not None:
            return
        self.cfg = cfg
        self.i = fx.sales_inputs(spark, sf_dir)

    @cached_property
    def combined(self) -> DataFrame:
        i = self.i
        return sales.combine_sales(i.bills, i.sales_value, i.sales_tc, i.store, self.cfg)

    @cached_property
    def daily1(self) -> DataFrame:
        return sales.daily_channel(self.combined, self.i.store, self.cfg)

    @cached_property
    def daily2(self) -> DataFrame:
        return sales.daily_group(self.combined, self.i.store, self.cfg)

    @cached_property
    def daily3(self) -> DataFrame:
        return sales.daily_store(self.combined, self.i.store, self.cfg)


class Menu(_Stages):
    """The menu jobs chained over the fixture inputs of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg=CFG):
        if getattr(self, "i", None) is not None:
            return
        self.cfg = cfg
        self.i = fx.menu_inputs(spark, sf_dir)

    @cached_property
    def combined(self) -> DataFrame:
        i = self.i
        return menu.combine_menu(i.productmix, i.menu_report, i.lookup_legacy, i.lookup_modern,
                                 i.store, self.cfg)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def query(spark, sf_dir):
            ensure_job_conf(spark)
            return reported(fn(spark, sf_dir))

        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# --- pipelines (one per published table) -----------------------------------------

_COMBINED = ["Date", "RESTO", "Order_Type", "Order_Type_Group", "total_tc", "total_sales_net"]
_D1 = ["Date", "RESTO", "Order_Type", "Order_Type_Group", "total_sales_net", "total_tc",
       "previous_sales_net", "previous_tc", *STORE_ATTRS]
_D2 = ["Date", "RESTO", "Order_Type_Group", "total_sales_net", "total_tc",
       "previous_sales_net", "previous_tc", *STORE_ATTRS]
_D3 = ["Date", "RESTO", "total_sales_net", "total_tc", "previous_sales_net", "previous_tc",
       *STORE_ATTRS]
_DM = {"total_sales_net", "previous_sales_net"}


def _monthly_cols(keys):
    return ["month", *keys, "total_sales_net", "total_tc", "avg_sales_net", "avg_tc",
            "previous_sales_net", "previous_tc", "avg_previous_sales_net", "avg_previous_tc",
            *STORE_ATTRS]


@register("combine_sales", O.final("combined", _COMBINED, {"total_sales_net"}))
def q_combine_sales(spark, sf):
    return Sales(spark, sf).combined


@register("daily_channel", O.final("daily1", _D1, _DM))
def q_daily_channel(spark, sf):
    return Sales(spark, sf).daily1


@register("daily_group", O.final("daily2", _D2, _DM))
def q_daily_group(spark, sf):
    return Sales(spark, sf).daily2


@register("daily_store", O.final("daily3", _D3, _DM))
def q_daily_store(spark, sf):
    return Sales(spark, sf).daily3


@register("monthly_channel", O.final("monthly1", _monthly_cols(monthly.GRAINS["channel"]), _DM))
def q_monthly_channel(spark, sf):
    return monthly.monthly_channel(Sales(spark, sf).daily1, CFG)


@register("monthly_group", O.final("monthly2", _monthly_cols(monthly.GRAINS["group"]), _DM))
def q_monthly_group(spark, sf):
    return monthly.monthly_group(Sales(spark, sf).daily2, CFG)


@register("monthly_store", O.final("monthly3", _monthly_cols(monthly.GRAINS["store"]), _DM))
def q_monthly_store(spark, sf):
    return monthly.monthly_store(Sales(spark, sf).daily3, CFG)


_COHORT = ["Date", "RESTO", "OPEN_STORE", "total_sales_net", "days_opened"]


@register("first_90_days", O.final("sales_90days", _COHORT, {"total_sales_net"}))
def q_first_90_days(spark, sf):
    return cohorts.first_n_days(Sales(spark, sf).daily3, CFG)


@register("opened_same_year", O.final("sales_nso", ["Date", "RESTO", *SAME_YEAR_ATTRS, "sales_nett"],
                                      {"sales_nett"}))
def q_opened_same_year(spark, sf):
    return cohorts.opened_same_year(Sales(spark, sf).daily1, CFG)


_TRACKER = ["code", "date_daily", "week_number", "month", "target_sales_nett", "ytd_target_sales",
            "OPEN_STORE", "year_open_store", "year_open_store2", "STORE", "PROVINSI", "KOTA",
            "JAVA___OUTER_JAVA", "AREA_HEAD", "actual_sales_nett", "actual_sales_nett_2"]


@register("target_tracker", O.final("tracker", _TRACKER, {"actual_sales_nett"}))
def q_target_tracker(spark, sf):
    s = Sales(spark, sf)
    return tracker.target_tracker(s.i.targets, s.daily1, s.i.adjustments, s.i.store, CFG)


_MENU = ["Date", "Code", "product_cleaned", "category", "product_cleaned_2", "Qty"]


@register("combine_menu", O.final("combined_menu", _MENU))
def q_combine_menu(spark, sf):
    return Menu(spark, sf).combined


@register("menu_detail", O.final("prodmix1", [*_MENU, *MENU_STORE_ATTRS]))
def q_menu_detail(spark, sf):
    m = Menu(spark, sf)
    return menu.menu_detail(m.combined, m.i.store, CFG)


@register("menu_category", O.final("prodmix2", ["Date", "Code", "category", "Qty", *MENU_STORE_ATTRS]))
def q_menu_category(spark, sf):
    m = Menu(spark, sf)
    return menu.menu_category(m.combined, m.i.store, CFG)


PIPELINES = tuple(QUERIES)   # the 13 published tables, registered above


# --- single operators (each over whole fixture tables) -----------------------------

def single(name: str, cols: list[str] | None = None, money: set[str] = frozenset(),
        cte: str | None = None):
    """Register an operator query whose oracle is the CTE ``chk_<name>`` (or
    the stage CTE ``cte``)."""
    cte = cte or f"chk_{name}"
    sql = O.with_ctes([cte], f"SELECT {O._money(cols, set(money)) if cols else '*'} FROM {cte}")
    return register(name, sql)


@single("map_visit_purpose")
def q_map_visit_purpose(spark, sf):
    """PR3: visit purpose -> channel, per bill line."""
    b = fx.bills(spark, sf)
    return b.select("Sales Date", "Branch", "Bill Number", "Visit Purpose",
                    map_labels("Visit Purpose", CFG.visit_purpose_channels,
                               CFG.unknown_channel).alias("Order_Type"))


@single("map_tender", ["Date", "RESTO", "Order_Type", "total_sales_net"], {"total_sales_net"}, cte="legacy_money")
def q_map_tender(spark, sf):
    """PR4 + A02 + PR6: tender -> channel derived before grouping (two
    tenders of one channel form one group), summed, tax stripped."""
    return sales.legacy_money(fx.sales_value(spark, sf), CFG)


@single("tc_by_channel", ["Date", "RESTO", "Order_Type", "total_tc"], cte="legacy_count")
def q_legacy_count(spark, sf):
    """PR4 + A03."""
    return sales.legacy_count(fx.sales_tc(spark, sf), CFG)


@single("channel_group")
def q_channel_group(spark, sf):
    """PR5: channel -> group, with row counts over the combined feed."""
    return Sales(spark, sf).combined.groupBy("Order_Type", "Order_Type_Group").agg(
        F.count(F.lit(1)).alias("n_rows"))


@single("bill_count", ["Date", "RESTO", "Order_Type", "total_tc", "total_sales_net"], {"total_sales_net"},
     cte="modern_daily")
def q_bill_count(spark, sf):
    """J01 + A01: distinct bills and net per (Date, store, channel)."""
    return sales.modern_daily(fx.bills(spark, sf), fx.store(spark, sf), CFG)


@single("legacy_join", ["Date", "RESTO", "Order_Type", "total_tc", "total_sales_net"], {"total_sales_net"},
     cte="legacy_daily")
def q_legacy_join(spark, sf):
    """Inner join of legacy money and count."""
    return sales.legacy_daily(fx.sales_value(spark, sf), fx.sales_tc(spark, sf), CFG)


@single("feed_union", ["Date", "RESTO", "Order_Type", "total_tc", "total_sales_net"], {"total_sales_net"},
     cte="feed_union")
def q_feed_union(spark, sf):
    """Both feeds stacked, duplicates kept."""
    i = fx.sales_inputs(spark, sf)
    cols = ["Date", "RESTO", "Order_Type", "total_tc", "total_sales_net"]
    return sales.modern_daily(i.bills, i.store, CFG).select(*cols).unionByName(
        sales.legacy_daily(i.sales_value, i.sales_tc, CFG).select(*cols))


@single("store_attrs_left", ["Date", "RESTO", "Order_Type", "Order_Type_Group", "total_sales_net",
                        "total_tc", *STORE_ATTRS], {"total_sales_net"}, cte="combined_store")
def q_store_attrs_left(spark, sf):
    """Combined rows with store attributes (left: unmatched keep NULLs)."""
    s = Sales(spark, sf)
    return sales.with_store(s.combined, s.i.store, CFG).select(
        "Date", "RESTO", "Order_Type", "Order_Type_Group", "total_sales_net", "total_tc", *STORE_ATTRS)


@single("product_key_join", ["Date", "Code", "Product", "QTY", "product_cleaned", "category",
                             "product_cleaned_2"], cte="menu_legacy_matched")
def q_product_key_join(spark, sf):
    """J15 + FI5: legacy menu rows up to the cut-over, matched on the
    normalised product key."""
    i = fx.menu_inputs(spark, sf)
    return menu.legacy_menu_matched(i.productmix, i.lookup_legacy, CFG)


@single("product_key_join_modern")
def q_product_key_join_modern(spark, sf):
    """Modern menu rows matched on the normalised menu-name key."""
    i = fx.menu_inputs(spark, sf)
    return menu.modern_menu_matched(i.menu_report, i.lookup_modern, CFG)


@single("month_average", ["month", "RESTO", "Order_Type_Group", "avg_sales_net", "avg_tc"], cte="monthly2_avg")
def q_month_average(spark, sf):
    """Mean of the daily rows present per (month, store, group)."""
    return monthly.month_average(Sales(spark, sf).daily2, monthly.GRAINS["group"])


@single("distinct_daily", ["Date", "RESTO", "OPEN_STORE", "total_sales_net", "days_opened"],
     {"total_sales_net"}, cte="distinct_daily")
def q_distinct_daily(spark, sf):
    """DISTINCT over the cohort columns (no day-count filter)."""
    return cohorts.distinct_daily(Sales(spark, sf).daily3, CFG)


@single("same_year_filter", ["Date", "RESTO", "Order_Type", "OPEN_STORE", "total_sales_net"],
     {"total_sales_net"})
def q_same_year_filter(spark, sf):
    """FI3: rows in the store's opening year."""
    return (Sales(spark, sf).daily1.where(F.year("Date") == F.year("OPEN_STORE"))
            .select("Date", "RESTO", "Order_Type", "OPEN_STORE", "total_sales_net"))


@single("days_open")
def q_days_open(spark, sf):
    """PR10: 1-based days since opening for every store-day."""
    return Sales(spark, sf).daily3.select("Date", "RESTO", "OPEN_STORE",
                                          days_since("Date", "OPEN_STORE").alias("days_opened"))


@single("sunday_week")
def q_sunday_week(spark, sf):
    """Sunday-based week of year for every ship date."""
    d = fx.bills(spark, sf).select(F.col("Sales Date").alias("Date")).distinct()
    return d.select("Date", sunday_week("Date").alias("week_number"))


@single("year_bucket")
def q_year_bucket(spark, sf):
    """PR11 + F07: opening-year bucket with NULL-propagating GREATEST."""
    st = fx.store(spark, sf)
    return st.select("NEW_CODE_STORE", "OPEN_STORE", F.year("OPEN_STORE").alias("year_open_store"),
                     year_bucket("OPEN_STORE", CFG.year_floor, CFG.year_when_null)
                     .alias("year_open_store2"))


@single("gap_adjust", ["code", "date_daily", "month", "target_sales_nett", "actual_sales_nett",
                "actual_sales_nett_2"], {"actual_sales_nett"}, cte="tr_gap")
def q_gap_adjust(spark, sf):
    """J12 + J13 + PR7: targets with actuals and the monthly adjustment."""
    s = Sales(spark, sf)
    return tracker.gap_adjust(tracker.with_actuals(s.i.targets, s.daily1, CFG), s.i.adjustments, CFG)


@single("to_date_mask")
def q_to_date_mask(spark, sf):
    """PR8: target masked from the as-of day on."""
    t = fx.targets(spark, sf)
    return t.select("code", "date_daily", "target_sales_nett",
                    F.when(F.col("date_daily") >= date_lit(CFG.as_of), F.lit(None))
                    .otherwise(F.col("target_sales_nett")).alias("ytd_target_sales"))


@single("menu_cutover")
def q_menu_cutover(spark, sf):
    """FI5: legacy menu rows up to the cut-over date (pushed to the scan)."""
    return fx.productmix(spark, sf).where(F.col("Date") <= date_lit(CFG.legacy_menu_until))


@single("drop_blank_key")
def q_drop_blank_key(spark, sf):
    """IN1: rows without a bill number (NULL or whitespace) dropped."""
    return ingest.drop_blank(fx.raw_sales_report(spark, sf), "Bill Number")


@single("typed_numeric")
def q_typed_numeric(spark, sf):
    """IN2: strict numeric typing; empty cells are NULL."""
    r = ingest.cast_strict(fx.raw_sales_report(spark, sf), ["Net Sales", "Pax Total"])
    return r.select("No", "Bill Number", "Net Sales", "Pax Total")


@single("typed_date")
def q_typed_date(spark, sf):
    """IN3: lenient dates (ISO and month-first slashes); junk -> NULL."""
    r = ingest.cast_date(fx.raw_sales_report(spark, sf), ["Sales Date"])
    return r.select("No", "Bill Number", "Sales Date")


@single("typed_time")
def q_typed_time(spark, sf):
    """IN4: exact H:M:S times of day; hour 25 -> NULL."""
    r = ingest.cast_time(fx.raw_sales_report(spark, sf), ["Sales In Time"])
    return r.select("No", "Bill Number", "Sales In Time")


@single("typed_timestamp")
def q_typed_timestamp(spark, sf):
    """IN5: lenient timestamps."""
    r = ingest.cast_timestamp(fx.raw_sales_report(spark, sf), ["Sales Date In"])
    return r.select("No", "Bill Number", "Sales Date In")


@single("clean_duration")
def q_clean_duration(spark, sf):
    """IN6: durations printed as their clock tail."""
    r = fx.raw_sales_report(spark, sf).withColumn("raw_duration", F.col("Kitchen Process"))
    r = ingest.clean_durations(r, ["Kitchen Process"])
    return r.select("No", "Bill Number", "raw_duration", "Kitchen Process")


def _typed_report(spark, sf):
    r = ingest.drop_blank(fx.raw_sales_report(spark, sf), "Bill Number")
    r = ingest.cast_strict(r, ["Net Sales", "Pax Total"])
    r = ingest.cast_date(r, ["Sales Date"])
    r = ingest.cast_time(r, ["Sales In Time"])
    r = ingest.clean_durations(r, ["Kitchen Process"])
    return ingest.cast_timestamp(r, ["Sales Date In"])


@single("typed_report")
def q_typed_report(spark, sf):
    """IN1-IN6 composed: one report typed end to end."""
    return _typed_report(spark, sf)


@single("null_profile")
def q_null_profile(spark, sf):
    """IN10: NULL count of every column of the typed report, one pass."""
    return null_profile(_typed_report(spark, sf))


@single("stack_files")
def q_stack_files(spark, sf):
    """IN8 + U3: all export files stacked by name; those of odd branches have
    no X columns."""
    rows = read_report(spark, fx.sales_report_files(spark, sf), "sales")
    return rows.select("No", "Branch", "Note", "X1", "X45")


@single("unmatched_branches")
def q_unmatched_branches(spark, sf):
    """Bill rows whose branch has no store row (they publish under a NULL store)."""
    return unmatched_keys(fx.bills(spark, sf), "Branch", fx.store(spark, sf), "CODE_GIS")


@single("duplicate_store_keys")
def q_duplicate_store_keys(spark, sf):
    """Stores held by more than one store row (these multiply fact rows):
    every seventh store is entered twice."""
    st = fx.store(spark, sf).select("STORE", "CODE_GIS")
    again = st.where(F.replace("CODE_GIS", F.lit("X"), F.lit("")).cast("int") % 7 == 0)
    return check_unique(st.unionAll(again), "STORE")


@single("read_report")
def q_read_report(spark, sf):
    """SC3-SC5 + I1: per-branch Sales exports (title and branch lines above
    the header) written from lineitem, then read back, header located per
    file, stacked and typed."""
    read = ingest.prepare(spark, fx.sales_report_files(spark, sf), "sales")
    return read.withColumnRenamed("note.1", "note_1")


@single("read_menu_report")
def q_read_menu_report(spark, sf):
    """Per-branch Menu exports read back and typed (date, 6 numbers)."""
    return ingest.prepare(spark, fx.sales_report_files(spark, sf, "menu"), "menu")


@single("read_service_report")
def q_read_service_report(spark, sf):
    """Per-branch Service Time exports read back and typed (timestamp,
    3 durations as clock text, 2 numbers)."""
    return ingest.prepare(spark, fx.sales_report_files(spark, sf, "service_time"), "service_time")


@single("preview")
def q_preview(spark, sf):
    """IN11 + SO3: the first five typed rows of every export file."""
    first = ingest.preview_files(spark, fx.sales_report_files(spark, sf), "sales")
    return first.select("No", "Bill Number", "Sales Date", "Net Sales", "Branch", "Note",
                        F.col("_nth").alias("row_in_file"))


def _table_name(kind: str) -> str:
    return f"default.kasir_{kind}_{uuid.uuid4().hex}"


@single("append_write")
def q_append_write(spark, sf):
    """SK2: the report appended twice, the second time without a column."""
    r, t = fx.raw_sales_report(spark, sf), _table_name("append")
    sinks.write(r.select("No", "Bill Number", "Net Sales"), t, "append")
    sinks.write(r.select("Bill Number", "No"), t, "append")
    return spark.table(t)


@single("overwrite_write")
def q_overwrite_write(spark, sf):
    """SK3: a table overwritten by rows with other columns."""
    r, t = fx.raw_sales_report(spark, sf), _table_name("overwrite")
    sinks.write(r.select("No", "Net Sales"), t, "append")
    sinks.write(r.select("No", "Bill Number", "Pax Total"), t, "overwrite")
    return spark.table(t)


@single("publish_replace")
def q_publish_replace(spark, sf):
    """SK1 + SO2: a bucketed, sorted table published over another."""
    r, t = fx.raw_sales_report(spark, sf), _table_name("publish")
    sinks.publish(r.select("No"), t)
    sinks.publish(r.select("Bill Number", "Net Sales"), t, bucket_by=["Bill Number"], buckets=4,
                  sort_within=["Bill Number"])
    return spark.table(t)


@single("published_tables")
def q_published_tables(spark, sf):
    """P1 + P2: both batches run, every published table read back."""
    out = {k: _table_name(k) for k in (*pipeline.SALES_OUTPUTS, *pipeline.MENU_OUTPUTS)}
    own = lambda names: {k: out[k] for k in names}
    pipeline.run_sales(spark, fx.sales_inputs(spark, sf), CFG, own(pipeline.SALES_OUTPUTS))
    pipeline.run_menu(spark, fx.menu_inputs(spark, sf), CFG, own(pipeline.MENU_OUTPUTS))
    amount = {"sales_nso": "sales_nett", "tracker": "actual_sales_nett", "combined_menu": "Qty",
              "prodmix1": "Qty", "prodmix2": "Qty"}
    counts = [spark.table(t).agg(
        F.lit(k).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col(amount.get(k, "total_sales_net")).cast("decimal(38,6)")).cast("double").alias("amount"))
        for k, t in out.items()]
    return reduce(DataFrame.unionAll, counts)


@single("lag_tiebreak")
def q_lag_tiebreak(spark, sf):
    """Two rows a day and channel; ties go by net, then count."""
    c = Sales(spark, sf).combined.select("Date", "RESTO", "Order_Type", "total_tc", "total_sales_net")
    both = c.unionAll(c.withColumn("total_tc", F.col("total_tc") + 1))
    out = with_previous(both, ["RESTO", "Order_Type"], "Date", {"previous_tc": F.col("total_tc")},
                        tiebreak=["total_sales_net", "total_tc"])
    return out.select("Date", "RESTO", "Order_Type", "total_tc", "previous_tc")


# --- mechanisms for scale: the same results by another way --------------------------

# Splits the heavy hitters of every dimension, however small.
SPLIT = CFG.with_(split_dimensions_above=0)


@single("skew_join", ["Date", "RESTO", "Order_Type", "total_tc", "total_sales_net"], {"total_sales_net"})
def q_skew_join(spark, sf):
    """J01 + A01 with the heavy-hitter split: a third of all bill lines on one
    branch, a tenth on none."""
    return sales.modern_daily(fx.hot_bills(spark, sf), fx.store(spark, sf), SPLIT)


@single("skew_join_menu", _MENU, cte="combined_menu")
def q_skew_join_menu(spark, sf):
    """J15-J17 with the heavy-hitter split."""
    i = fx.menu_inputs(spark, sf)
    return menu.combine_menu(i.productmix, i.menu_report, i.lookup_legacy, i.lookup_modern, i.store, SPLIT)


@single("previous_by_ranges", ["Date", "RESTO", "Order_Type", "total_tc", "previous_tc", "previous_sales_net"],
        {"previous_sales_net"})
def q_previous_by_ranges(spark, sf):
    """W1 over ranges: half of the rows of all stores moved to the NULL store."""
    c = Sales(spark, sf).combined.select("Date", "RESTO", "Order_Type", "total_tc", "total_sales_net")
    hot = c.withColumn("RESTO", F.when(F.col("total_tc") % 2 == 0, F.col("RESTO")))
    out = with_previous_ranged(hot, ["RESTO", "Order_Type"], "Date",
                               {"previous_tc": F.col("total_tc"), "previous_sales_net": F.col("total_sales_net")},
                               tiebreak=["total_sales_net", "total_tc"])
    return out.select("Date", "RESTO", "Order_Type", "total_tc", "previous_tc", "previous_sales_net")


@single("daily_by_ranges", _D1, _DM, cte="daily1")
def q_daily_by_ranges(spark, sf):
    """Q02 with previous values found over ranges."""
    s = Sales(spark, sf)
    return sales.daily_channel(s.combined, s.i.store, CFG.with_(ranged_previous=True))


LATE_MONTH = "1997-03-01"


@single("month_republish", _D1, _DM, cte="daily1")
def q_month_republish(spark, sf):
    """SK1 + SO2 + W1 by month: all months published while one is incomplete,
    then that month alone; the daily mart equals a full rebuild."""
    names = {k: _table_name(f"months_{k}") for k in ("combined", "tails", "daily1")}
    months.publish_months(spark, fx.partial_inputs(spark, sf, LATE_MONTH), names, None, CFG)
    months.publish_months(spark, fx.sales_inputs(spark, sf), names, [dt.date.fromisoformat(LATE_MONTH)], CFG)
    return spark.table(names["daily1"]).select(*_D1)


@single("bill_count_merged", ["Date", "RESTO", "Order_Type", "total_tc", "total_sales_net"], {"total_sales_net"},
        cte="modern_daily")
def q_bill_count_merged(spark, sf):
    """A01, mergeable: three loads merged one after the other; the lines of a
    bill are spread over them."""
    state = bill_state.empty(spark, CFG)
    for load in fx.bill_increments(spark, sf, 3):
        state = bill_state.update(state, load, CFG)
    return bill_state.counts(state, fx.store(spark, sf), CFG)


@single("load_once", cte="chk_read_menu_report")
def q_load_once(spark, sf):
    """SK2 + IN12: half of the export files loaded, then all, then all again;
    each file counts once."""
    files, t = fx.sales_report_files(spark, sf, "menu"), _table_name("once")
    for paths in (files.replace("export_part=*", "export_part=0"), files, files):
        ingest.ingest(spark, paths, "menu", table=t, once=True)
    return spark.table(t)


@single("bad_cells")
def q_bad_cells(spark, sf):
    """IN2 + IN12: every cell that would fail the load, by file and line."""
    got = ingest.bad_cells(spark, fx.sales_report_files(spark, sf, "menu_bad"), "menu")
    at = lambda k: F.regexp_extract("file", f"{k}=([0-9]+)", 1).cast("bigint")
    return got.select(at("export_branch").alias("branch"), at("export_part").alias("part"), "line", "column",
                      "value", "n_in_file")


@single("all_or_nothing", cte="chk_read_menu_report")
def q_all_or_nothing(spark, sf):
    """IN12: a good batch, then one with bad cells, which leaves no row."""
    t = _table_name("whole")
    ingest.ingest(spark, fx.sales_report_files(spark, sf, "menu"), "menu", table=t)
    for check in (True, False):
        try:
            ingest.ingest(spark, fx.sales_report_files(spark, sf, "menu_bad"), "menu", table=t, check=check)
        except Exception as e:
            if "not a number" not in str(e) and "not numbers" not in str(e):
                raise
    return spark.table(t)


@single("batch_shape")
def q_batch_shape(spark, sf):
    """IN9: rows, columns and missing cells of a typed batch."""
    return ingest.batch_shape(_typed_report(spark, sf))


@single("column_dates")
def q_column_dates(spark, sf):
    """IN3 by column: each file's first date decides its layout."""
    read = ingest.prepare(spark, fx.sales_report_files(spark, sf, "menu_layouts"), "menu", date_layout="column")
    return read.select("No", "Branch", "Menu Name", "Sales Date", "Total")


@single("unit_durations")
def q_unit_durations(spark, sf):
    """IN6 with units: total seconds and clock text."""
    d = fx.unit_durations(spark, sf)
    both = d.select("*", F.col("raw_duration").alias("clock"), F.col("raw_duration").alias("seconds"))
    return ingest.clean_durations(ingest.clean_durations(both, ["clock"]), ["seconds"], seconds=True)


__all__ = ["QUERIES", "ORACLES", "PIPELINES", "Sales", "Menu"]
