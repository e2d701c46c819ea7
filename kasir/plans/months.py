"""Publishing by month: only the months that a batch touches are made again.

The combined feed and the daily channel mart (Q01, Q02) are stored partitioned
by month. ``publish_months`` replaces the months it is given:

1. the combined feed of those months, from feeds filtered to them;
2. the last row of every series in each month (``tails``), a small table;
3. the daily mart of those months, and of the later month in which a series
   continues if its last row there has changed: previous values look one row
   back, so no other month can differ.

A month's first row of a series takes its previous values from the last row of
an earlier month (the carry), so no history is read but the tails.

Every step replaces whole partitions (dynamic partition overwrite), so running it
again gives the same tables. Rows without a date are the month NULL, the earliest.
Store attributes are those of the day a month is made; after a change of the
dimension publish all months.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kasir.config import DEFAULT, Config
from kasir.operators.previous import carries, last_rows, with_carry
from kasir.operators.sinks import quoted
from kasir.plans.sales import DAILY_SERIES, DAILY_TIES, combine_sales, daily_base, daily_values, with_store
from kasir.session import freed_shuffles, staged
from kasir.sources.tables import SalesInputs

Month = dt.date | None
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


def month_of(date: Column | str) -> Column:
    return F.trunc(date, "month")


def in_months(date: str, months: Sequence[Month]) -> Column:
    """Bounds on the date itself, so that they reach the scan."""
    d = F.col(f"`{date}`")

    def one(m: Month) -> Column:
        if m is None:
            return d.isNull()
        after = (m.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        return (d >= F.lit(m)) & (d < F.lit(after))

    return reduce(lambda a, b: a | b, [one(m) for m in months], F.lit(False))


def is_month(months: Sequence[Month]) -> Column:
    known = F.col("month").isin([m for m in months if m is not None])
    return (known | F.col("month").isNull()) if None in months else known


def replace_months(df: DataFrame, name: str, months: Sequence[Month] | None) -> None:
    """Write ``df`` (with a column ``month``) as the partitions of ``months`` of
    table ``name``, None for all. A month without rows loses its partition."""
    spark = df.sparkSession
    if months is not None and spark.catalog.tableExists(name):
        has = {r["month"] for r in df.select("month").distinct().collect()}      # at most ``months``
        for m in set(months) - has:
            spark.sql(f"ALTER TABLE {quoted(name)} DROP IF EXISTS PARTITION (month = {_literal(m)})")
    # A few files per month, a large month in several.
    rows = df.select(*[c for c in df.columns if c != "month"], "month").hint("rebalance", "month")
    with freed_shuffles(spark):
        if months is None or not spark.catalog.tableExists(name):
            rows.write.format("parquet").partitionBy("month").mode("overwrite").saveAsTable(name)
        else:
            _overwrite_partitions(rows, name)


MODE = "spark.sql.sources.partitionOverwriteMode"


def _overwrite_partitions(rows: DataFrame, name: str) -> None:
    """Replace the partitions that ``rows`` has; ``insertInto`` takes the mode
    from the session only."""
    conf = rows.sparkSession.conf
    before = conf.get(MODE)
    conf.set(MODE, "dynamic")
    try:
        rows.write.insertInto(name, overwrite=True)
    finally:
        conf.set(MODE, before)


def _literal(m: Month) -> str:
    return "NULL" if m is None else f"DATE '{m.isoformat()}'"


def _tails(base: DataFrame, cfg: Config) -> DataFrame:
    """(month, _key, _last): the last row of each series in each month."""
    order = [F.col(c) for c in ("Date", *DAILY_TIES)]
    key = F.struct(*[F.col(c) for c in DAILY_SERIES]).alias("_key")
    return last_rows(base, ["month", key], order, daily_values(cfg))


def _continued(before: DataFrame, after: DataFrame, tails: DataFrame) -> list[Month]:
    """Months in which a series whose tail differs between ``before`` and
    ``after`` goes on."""
    b = before.select("month", "_key", F.col("_last").alias("_before"))
    a = after.select("month", "_key", F.col("_last").alias("_after"))
    same = b["month"].eqNullSafe(a["month"]) & (b["_key"] == a["_key"])
    changed = (b.join(a, same, "full").where(~F.col("_before").eqNullSafe(F.col("_after")))
               .select(F.coalesce(b["_key"], a["_key"]).alias("_changed"),
                       F.coalesce(b["month"], a["month"]).alias("_from")))
    later = tails.where("month is not null").join(changed, F.col("_key") == F.col("_changed")).where(
        F.col("_from").isNull() | (F.col("month") > F.col("_from")))
    following = later.groupBy("_key", "_from").agg(F.min("month").alias("month"))
    return [r["month"] for r in following.select("month").distinct().collect()]


def publish_months(spark: SparkSession, inputs: SalesInputs, names: dict[str, str],
                   months: Sequence[Month] | None = None, cfg: Config = DEFAULT) -> list[Month] | None:
    """(Re)make ``months`` (None: all) of the tables ``names`` (combined,
    tails, daily1). The months of the daily mart that were made."""
    i = inputs
    if months is not None:
        months = sorted(set(months), key=lambda m: (m is not None, m or dt.date.min))
        i = SalesInputs(i.bills.where(in_months("Sales Date", months)), i.sales_value.where(in_months("Date", months)),
                        i.sales_tc.where(in_months("Date", months)), i.store, i.targets, i.adjustments)
    combined = combine_sales(i.bills, i.sales_value, i.sales_tc, i.store, cfg)
    first = months is None or not all(spark.catalog.tableExists(n) for n in names.values())
    combined = combined.withColumn("month", month_of("Date"))
    # Chosen months are looked at before they are written; all are written at once.
    replace_months(combined if first else staged(combined, "months-combined"),
                   names["combined"], None if first else months)

    def base(chosen: Sequence[Month] | None) -> DataFrame:
        rows = spark.table(names["combined"])
        rows = rows if chosen is None else rows.where(is_month(chosen))
        attributed = with_store(rows, i.store, cfg)
        return daily_base(attributed).withColumn("month", month_of("Date"))

    touched = None
    if first:
        replace_months(_tails(base(None), cfg), names["tails"], None)
    else:
        before = staged(spark.table(names["tails"]).where(is_month(months)), "tails-before")
        after = staged(_tails(base(months), cfg), "tails-after")
        replace_months(after, names["tails"], months)
        on = _continued(before, after, spark.table(names["tails"]))
        touched = [*months, *sorted(set(on) - set(months))]
    carry = carries(spark.table(names["tails"]), "month")
    daily = with_carry(base(touched), "month", DAILY_SERIES, [F.col(c) for c in ("Date", *DAILY_TIES)],
                       daily_values(cfg), carry if touched is None else carry.where(is_month(touched)))
    replace_months(daily if touched is None else staged(daily, "months-daily"), names["daily1"], touched)
    return touched
