"""Combined sales (both feeds) and the daily marts at three grains.

Q01 combine_sales  -> Date, RESTO, Order_Type, Order_Type_Group, total_tc, total_sales_net
Q02 daily_channel  -> Q01 rows + store attributes + previous day per (RESTO, channel)
Q03 daily_group    -> per (Date, RESTO, channel group) + attributes + previous day
Q04 daily_store    -> per (Date, RESTO) + attributes + previous day

Money is summed as decimals (exact, independent of row order) and only turned
into doubles by ``reported``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from kasir.config import DEFAULT, STORE_ATTRS, Config
from kasir.functions.expr import channel_group, map_labels
from kasir.operators.dims import join_dim, join_key
from kasir.operators.previous import with_previous, with_previous_ranged
from kasir.session import initial_partitions

GROUP = "Order_Type_Group"
CHANNEL = "Order_Type"


def modern_daily(bills: DataFrame, store: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Bill-level feed -> distinct bills and net sales per (Date, RESTO, channel)."""
    b = bills.select(
        F.col("Sales Date").alias("Date"),
        F.col("Branch"),
        map_labels("Visit Purpose", cfg.visit_purpose_channels, cfg.unknown_channel).alias(CHANNEL),
        F.col("Bill Number").alias("bill"),
        F.col("Net Sales").cast(cfg.money_type).alias("net"),
    )
    st = store.select(F.col("CODE_GIS"), F.col("NEW_CODE_STORE").alias("RESTO"))
    j = join_key(b, st, "Branch", "CODE_GIS", "left", cfg.split_dimensions_above)
    # COUNT(DISTINCT bill) is planned as two aggregations (per key + bill,
    # then per key), so a store-day holding a large share of all bills is
    # still spread over many tasks by bill number.
    return j.groupBy("Date", "RESTO", CHANNEL).agg(
        F.count_distinct("bill").alias("total_tc"),
        exact_sum("net", cfg).alias("total_sales_net"),
    )


def exact_sum(c: str, cfg: Config = DEFAULT) -> F.Column:
    """Exact decimal money sum as ``net_type``; an overflow raises (ANSI)."""
    return F.sum(F.col(c).cast(cfg.money_type)).cast(cfg.net_type)


def legacy_channel(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Legacy rows with the tender label replaced by its channel. The channel
    is derived before any grouping, so two tenders of one channel form one
    group."""
    return df.select(
        "Date", "RESTO",
        map_labels("Order_Type", cfg.tender_channels, cfg.unknown_channel).alias(CHANNEL),
        "Value")


def legacy_money(value: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Legacy money per (Date, RESTO, channel), tax stripped."""
    v = legacy_channel(value, cfg)
    s = exact_sum("Value", cfg)
    return v.groupBy("Date", "RESTO", CHANNEL).agg(
        (s.cast("double") / F.lit(float(cfg.tax_divisor)))
        .cast(DecimalType(24, 6)).cast(cfg.net_type).alias("total_sales_net"))


def legacy_count(tc: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Legacy transaction count per (Date, RESTO, channel)."""
    return legacy_channel(tc, cfg).groupBy("Date", "RESTO", CHANNEL).agg(
        F.sum("Value").alias("total_tc"))


def legacy_daily(value: DataFrame, tc: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Inner join of legacy money and count: keys on one side only vanish.
    Both sides are aggregated on the join keys, so the join reuses their
    partitioning (no extra exchange)."""
    m = legacy_money(value, cfg)
    c = legacy_count(tc, cfg)
    return m.join(c, ["Date", "RESTO", CHANNEL], "inner").select(
        "Date", "RESTO", CHANNEL, "total_tc", "total_sales_net")


def combine_sales(bills: DataFrame, value: DataFrame, tc: DataFrame, store: DataFrame,
                  cfg: Config = DEFAULT) -> DataFrame:
    """Q01: both feeds stacked (duplicates kept), with the channel group."""
    cols = ["Date", "RESTO", CHANNEL, "total_tc", "total_sales_net"]
    u = modern_daily(bills, store, cfg).select(*cols).unionByName(
        legacy_daily(value, tc, cfg).select(*cols))
    return u.select(
        "Date", "RESTO", CHANNEL,
        channel_group(CHANNEL, cfg.online_channels).alias(GROUP),
        "total_tc", F.col("total_sales_net").cast(cfg.net_type).alias("total_sales_net"))


def copies(store: DataFrame) -> int:
    """Dimension rows per store, on average, rounded down."""
    key = F.col("NEW_CODE_STORE")
    rows, keys = store.agg(F.count(key), F.count_distinct(key)).first()
    return rows // max(keys, 1)


def by_store(df: DataFrame, store: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Hash-partition on RESTO. Every store-level job (daily and monthly
    marts, cohorts, tracker actuals) groups or windows by keys that start
    with RESTO, so one partitioning serves them all; it is also the bucketing
    of the published daily marts, and Spark drops this exchange when the
    input is already partitioned that way. Without ``store_partitions`` there
    are as many as the session starts a shuffle with (``initial_partitions``),
    joined up to its advisory size. Stores with several dimension rows each
    multiply their rows after this exchange, which that size does not see: then
    the partitions are not joined up. One store's rows are bounded
    (days x channels x dimension rows), and so are the unmatched (NULL RESTO)
    rows, which the combined feed has already summed per day and channel."""
    if cfg.store_partitions:
        return df.repartition(cfg.store_partitions, "RESTO")
    if copies(store) > 1:
        return df.repartition(initial_partitions(df.sparkSession), "RESTO")
    return df.repartition("RESTO")


def store_attrs(store: DataFrame, attrs: Sequence[str] = STORE_ATTRS) -> DataFrame:
    """Store key + attributes, with the key renamed so it cannot clash."""
    return store.select(F.col("NEW_CODE_STORE").alias("_store_key"), *attrs)


def with_store(df: DataFrame, store: DataFrame, cfg: Config = DEFAULT,
               attrs: Sequence[str] = STORE_ATTRS, how: str = "left") -> DataFrame:
    """Attach store attributes on RESTO = NEW_CODE_STORE (left: unmatched rows
    keep NULL attributes; duplicate store rows multiply fact rows)."""
    st = store_attrs(store, attrs)
    return join_dim(df, st, df["RESTO"] == st["_store_key"], how).drop("_store_key")


def previous(cfg: Config):
    return with_previous_ranged if cfg.ranged_previous else with_previous


def daily_base(rows: DataFrame) -> DataFrame:
    """The columns of Q02 before its previous values."""
    return rows.select("Date", "RESTO", CHANNEL, GROUP, "total_sales_net", "total_tc", *STORE_ATTRS)


# Q02's series, its order within a day, and what LAG takes over.
DAILY_SERIES = ("RESTO", CHANNEL)
DAILY_TIES = ("total_sales_net", "total_tc", GROUP, *STORE_ATTRS)


def daily_values(cfg: Config) -> dict[str, F.Column]:
    return {"previous_sales_net": F.col("total_sales_net").cast("double") / F.lit(float(cfg.daily_channel_lag_divisor)),
            "previous_tc": F.col("total_tc")}


def daily_channel(combined: DataFrame, store: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Q02 (daily1): every combined row with store attributes and the previous
    row of its (RESTO, channel) series."""
    base = daily_base(with_store(by_store(combined, store, cfg), store, cfg))
    out = previous(cfg)(base, DAILY_SERIES, "Date", daily_values(cfg), tiebreak=DAILY_TIES)
    return out.select("Date", "RESTO", CHANNEL, GROUP, "total_sales_net", "total_tc",
                      "previous_sales_net", "previous_tc", *STORE_ATTRS)


def _grouped_with_store(combined: DataFrame, store: DataFrame, keys: Sequence[str],
                        cfg: Config) -> DataFrame:
    """Sum net and tc of ``combined ⋈ store`` grouped by ``keys`` + attributes.

    Exact rewrite of "join, then group by keys and all attributes":
    rows are first summed per ``keys`` (at most a few channel rows per key),
    then joined, then summed again per keys + attributes, which reproduces the
    multiplication by duplicate store rows. The input is hash-partitioned once
    on RESTO, which every following aggregate and the LAG window reuse, so the
    whole mart costs one exchange.
    """
    pre = (by_store(combined, store, cfg)
           .groupBy(*keys)
           .agg(F.sum("total_sales_net").alias("total_sales_net"),
                F.sum("total_tc").alias("total_tc")))
    j = with_store(pre, store, cfg)
    return j.groupBy(*keys, *STORE_ATTRS).agg(
        F.sum("total_sales_net").cast(cfg.net_type).alias("total_sales_net"),
        F.sum("total_tc").alias("total_tc"))


def daily_group(combined: DataFrame, store: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Q03 (daily2): per (Date, RESTO, channel group)."""
    g = _grouped_with_store(combined, store, ["Date", "RESTO", GROUP], cfg)
    out = previous(cfg)(
        g, ["RESTO", GROUP], "Date",
        {"previous_sales_net": F.col("total_sales_net"), "previous_tc": F.col("total_tc")},
        tiebreak=["total_sales_net", "total_tc", *STORE_ATTRS])
    return out.select("Date", "RESTO", GROUP, "total_sales_net", "total_tc",
                      "previous_sales_net", "previous_tc", *STORE_ATTRS)


def daily_store(combined: DataFrame, store: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Q04 (daily3): per (Date, RESTO)."""
    g = _grouped_with_store(combined, store, ["Date", "RESTO"], cfg)
    out = previous(cfg)(
        g, ["RESTO"], "Date",
        {"previous_sales_net": F.col("total_sales_net"), "previous_tc": F.col("total_tc")},
        tiebreak=["total_sales_net", "total_tc", *STORE_ATTRS])
    return out.select("Date", "RESTO", "total_sales_net", "total_tc",
                      "previous_sales_net", "previous_tc", *STORE_ATTRS)


def reported(df: DataFrame) -> DataFrame:
    """Final projection for publishing: decimals become doubles."""
    return df.select(*[
        F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
        else F.col(f"`{f.name}`") for f in df.schema.fields])


__all__ = [
    "by_store", "combine_sales", "daily_channel", "daily_group", "daily_store",
    "legacy_count", "legacy_daily", "legacy_money", "modern_daily", "reported", "with_store",
]
