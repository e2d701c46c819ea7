"""Previous-period values (LAG by one row in time order).

``with_previous`` is the plain window: every series (partition key) is one task's
work. ``with_previous_ranged`` gives the same rows when one series may hold a
large share of them, such as the NULL store: rows are dealt by range of (key,
order), each range finds the previous row locally, and the first row of a key in
a range takes over the last row of the range before (the carry).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kasir.session import staged


def _order(order: str, tiebreak: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`").asc_nulls_first() for c in (order, *tiebreak)]


def with_previous(df: DataFrame, partition: Sequence[str], order: str,
                  values: dict[str, Column], tiebreak: Sequence[str] = ()) -> DataFrame:
    """Add ``name = lag(expr)`` for each entry of ``values``.

    "Previous" is the previous row of the partition, not the previous
    calendar day. Rows are ordered by ``order`` then ``tiebreak`` (ascending,
    NULL first), so rows that still tie are identical in every column and the
    output does not depend on arrival order.
    """
    w = Window.partitionBy(*partition).orderBy(*_order(order, tiebreak))
    return df.select("*", *[F.lag(expr).over(w).alias(name) for name, expr in values.items()])


def last_rows(df: DataFrame, key: Sequence[str], order: Sequence[Column], values: dict[str, Column]) -> DataFrame:
    """(key, _last): the values of each key's last row. ``max_by`` combines
    within tasks; a struct orders its fields NULL first."""
    return df.groupBy(*key).agg(F.max_by(F.struct(*[v.alias(f"v{i}") for i, v in enumerate(values.values())]),
                                         F.struct(*order)).alias("_last"))


def with_carry(df: DataFrame, part: str, key: Sequence[str], order: Sequence[Column],
               values: dict[str, Column], carry: DataFrame) -> DataFrame:
    """LAG over rows that are cut into parts: within (part, key) by a window,
    and for its first row from ``carry`` (part, _key, _last): the last row of the
    key in earlier parts."""
    w = Window.partitionBy(part, "_key").orderBy(*order)
    keyed = df.withColumn("_key", F.struct(*[F.col(f"`{c}`") for c in key]))
    local = keyed.select("*", F.row_number().over(w).alias("_nth"),
                         *[F.lag(v).over(w).alias(f"_v{i}") for i, v in enumerate(values.values())])
    joined = local.join(carry.select(part, "_key", "_last"), [part, "_key"], "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[F.when(F.col("_nth") == 1, F.col(f"_last.v{i}")).otherwise(F.col(f"_v{i}")).alias(name)
          for i, name in enumerate(values)])


def carries(last: DataFrame, part: str) -> DataFrame:
    """(part, _key, _last) of the key's row before each part, from the last rows
    of all parts (part, _key, _last). One row per part and key."""
    w = Window.partitionBy("_key").orderBy(part)
    return last.select(part, "_key", F.lag("_last").over(w).alias("_last"))


def with_previous_ranged(df: DataFrame, partition: Sequence[str], order: str,
                         values: dict[str, Column], tiebreak: Sequence[str] = (),
                         parts: int | None = None) -> DataFrame:
    """As ``with_previous``; no series need fit one task. ``parts``: ranges
    (default: the session's shuffle partitions). The dealt rows are staged."""
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*[F.col(f"`{c}`").asc_nulls_first() for c in partition], *_order(order, tiebreak)]
    dealt = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    # The id holds the range in its upper bits and the place within it below.
    rows = staged(dealt.withColumn("_seq", F.monotonically_increasing_id()), "lag-ranges")
    rows = rows.withColumn("_range", F.shiftright("_seq", 33))
    within = [F.col("_seq")]
    last = last_rows(rows, ["_range", F.struct(*[F.col(f"`{c}`") for c in partition]).alias("_key")], within, values)
    out = with_carry(rows, "_range", partition, within, values, carries(last, "_range"))
    return out.drop("_seq", "_range")
