"""Batch checks: NULL profile, unmatched keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame) -> DataFrame:
    """One row: total rows and the NULL count of every column, in one pass."""
    return df.select(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


def unmatched_keys(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Fact keys with no dimension row, with how many fact rows carry each
    (these rows end up under a NULL store downstream). Left-anti join, then a
    partial + final count per key."""
    f = fact.select(F.col(f"`{fact_key}`").alias("key"))
    d = dim.select(F.col(f"`{dim_key}`").alias("key"))
    return f.join(d, "key", "left_anti").groupBy("key").agg(F.count(F.lit(1)).alias("n_rows"))
