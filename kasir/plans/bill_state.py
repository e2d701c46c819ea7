"""Distinct bill counts that new files are merged into (J01 + A01, mergeable).

Counting distinct bills again over all history costs a shuffle of every bill line
ever loaded. The state keeps, instead:

* ``bills``: a dictionary, each bill number with a dense id;
* ``bits``: per (day, branch, channel) the set of its bills, as bits of the ids
  by bucket (64 ids each, one integer). New bills get their ids in the order of
  day, branch and channel, so a key's bills share buckets; a key with one bill
  costs one integer, not a whole bitmap;
* ``sums``: net sales per (day, branch, channel).

An update touches the new lines only, shuffled by bill and by key; bitmaps are
merged by OR, sums by addition. Branches are mapped to stores when counts are
read, so a changed store dimension needs no recount, and branches of one store
merge exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kasir.config import DEFAULT, Config
from kasir.functions.expr import map_labels
from kasir.operators.dims import join_key
from kasir.operators.sinks import publish
from kasir.plans.sales import CHANNEL
from kasir.session import staged

KEY = ("Date", "Branch", CHANNEL)
_KEY_TYPE = f"Date date, Branch string, {CHANNEL} string"
DICTIONARY = "bill string, id bigint"
BITS = f"{_KEY_TYPE}, bucket bigint, bits bigint"
PARTS = ("bills", "bits", "sums")


@dataclass
class BillState:
    bills: DataFrame
    bits: DataFrame
    sums: DataFrame


def empty(spark: SparkSession, cfg: Config = DEFAULT) -> BillState:
    return BillState(spark.createDataFrame([], DICTIONARY), spark.createDataFrame([], BITS),
                     spark.createDataFrame([], f"{_KEY_TYPE}, net {cfg.net_type}"))


def load(spark: SparkSession, names: dict[str, str]) -> BillState:
    return BillState(*[spark.table(names[p]) for p in PARTS])


def store(state: BillState, names: dict[str, str]) -> None:
    """Publish the state's three tables. The dictionary goes first: it may hold
    more bills than the sets use."""
    for p in PARTS:
        publish(getattr(state, p), names[p])


def _numbered(new: DataFrame, base: int) -> DataFrame:
    """(bill, id): dense ids from ``base`` on, in the order of ``first``."""
    spark = new.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = staged(new.repartitionByRange(n, "first", "bill").sortWithinPartitions("first", "bill")
                   .withColumn("seq", F.monotonically_increasing_id()), "bill-numbers")
    part = F.shiftright("seq", 33)
    ranges = dealt.groupBy(part.alias("part")).agg(F.min("seq").alias("lo"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)      # one row per range
    shift = ranges.select("part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("lo")).alias("shift"))
    return dealt.withColumn("part", part).join(shift, "part").select(
        "bill", (F.col("seq") + F.col("shift") + F.lit(base)).alias("id"))


def update(state: BillState, bills: DataFrame, cfg: Config = DEFAULT) -> BillState:
    """The state with new bill lines merged in. ``bills``: as in Q01."""
    lines = staged(bills.select(
        F.col("Sales Date").alias("Date"), "Branch",
        map_labels("Visit Purpose", cfg.visit_purpose_channels, cfg.unknown_channel).alias(CHANNEL),
        F.col("Bill Number").alias("bill"), F.col("Net Sales").cast(cfg.money_type).alias("net"))
        .groupBy(*KEY, "bill").agg(F.sum("net").cast(cfg.net_type).alias("net")), "bill-lines")
    known = lines.where("bill is not null")
    new = (known.groupBy("bill").agg(F.min(F.struct(*KEY)).alias("first"))
           .join(state.bills, "bill", "left_anti"))
    base = (state.bills.agg(F.max("id")).first()[0] or 0) + 1
    dictionary = staged(state.bills.unionByName(_numbered(new, base)), "bill-dictionary")

    own = (known.join(dictionary, "bill")
           .select(*KEY, F.shiftright("id", 6).alias("bucket"), F.expr("shiftleft(1L, cast(id & 63 as int))").alias("bits")))
    bits = state.bits.unionByName(own).groupBy(*KEY, "bucket").agg(F.bit_or("bits").alias("bits"))
    sums = (state.sums.unionByName(lines.groupBy(*KEY).agg(F.sum("net").cast(cfg.net_type).alias("net")))
            .groupBy(*KEY).agg(F.sum("net").cast(cfg.net_type).alias("net")))
    return BillState(dictionary, staged(bits, "bill-bits"), staged(sums, "bill-sums"))


def counts(state: BillState, stores: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Distinct bills and net per (Date, RESTO, channel), as ``modern_daily``
    gives over all lines merged so far."""
    st = stores.select("CODE_GIS", F.col("NEW_CODE_STORE").alias("RESTO"))
    out = ["Date", "RESTO", CHANNEL]

    def placed(df: DataFrame) -> DataFrame:
        return join_key(df, st, "Branch", "CODE_GIS", "left", cfg.split_dimensions_above)

    merged = placed(state.bits).groupBy(*out, "bucket").agg(
        F.bit_count(F.bit_or("bits")).cast("bigint").alias("tc"))
    zero = F.lit(0).cast("bigint")
    rows = merged.select(*out, "tc", F.lit(None).cast(cfg.net_type).alias("net")).unionAll(
        placed(state.sums).select(*out, zero, "net"))
    return rows.groupBy(*out).agg(F.sum("tc").alias("total_tc"), F.sum("net").cast(cfg.net_type).alias("total_sales_net"))
