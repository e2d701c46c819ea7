"""Fact-to-dimension joins.

``join_dim`` leaves the strategy to Spark, which knows sizes in bytes: a
dimension whose files are under ``spark.sql.autoBroadcastJoinThreshold`` is
broadcast when the query is planned, so the fact is not shuffled. A dimension
that is itself a query has no such size; pass it through ``session.staged``
first.

``join_skew_proof`` is for a dimension that may be too large for that while one
key holds a large share of the fact. It measures the dimension's bytes as it
stages it and broadcasts a small one. Beyond the threshold it splits the heavy
hitters: a mergeable sketch over the key column finds keys that hold more rows
than a partition should; each is spread over ``FINE`` salts for every partition
it would fill (several, as salts meet by chance), its dimension rows are copied to
those salts, and all other keys have one salt. One shuffle join on (key, salt) then serves both. Facts without a
key match nothing, so they are spread over all partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kasir.session import staged

# Keys looked at by the sketch, at most: any further one holds less than a
# thousandth of the rows. The sketch tracks ten times as many.
MOST_HOT = 1000
TRACKED = 10_000
FINE = 8


def join_dim(fact: DataFrame, dim: DataFrame, on: Column | list[str] | str, how: str) -> DataFrame:
    """Join a fact to a dimension on the right."""
    return fact.join(dim, on=on, how=how)


def join_key(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, how: str,
             limit: int | None = None) -> DataFrame:
    """Join on one key each; with a ``limit`` see ``join_skew_proof``."""
    if limit is not None:
        return join_skew_proof(fact, dim, fact_key, dim_key, how, limit)
    return join_dim(fact, dim, fact[fact_key] == dim[dim_key], how)


def measured(dim: DataFrame, name: str = "dimension") -> tuple[DataFrame, int]:
    """``dim`` staged, and the bytes its rows take in memory, about: measured
    on the write itself."""
    seen = Observation()
    sizes = [F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) + 8 for f in dim.schema]
    row = sum(sizes[1:], sizes[0]) if sizes else F.lit(0)
    out = staged(dim.observe(seen, F.sum(row.cast("long")).alias("bytes")), name)
    return out, seen.get["bytes"] or 0


def broadcast_limit(dim: DataFrame) -> int:
    """The session's ``spark.sql.autoBroadcastJoinThreshold`` in bytes."""
    text = dim.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").lower().removesuffix("b")
    unit = {"k": 10, "m": 20, "g": 30}.get(text[-1:], 0)
    return int(text.rstrip("kmg")) << unit


def heavy_hitters(fact: DataFrame, key: str, parts: int) -> DataFrame:
    """(key, salts): the keys that hold more rows than one of ``parts``
    partitions should, with ``FINE`` salts per partition they would fill. At most
    ``MOST_HOT`` rows; one pass over the key column, whose sketches of bounded
    size are merged."""
    col = F.col(f"`{key}`")
    seen = fact.where(col.isNotNull()).select(col.alias("k")).agg(
        F.expr(f"approx_top_k(k, {MOST_HOT}, {TRACKED})").alias("top"), F.count("*").alias("rows"))
    top = seen.select(F.explode("top").alias("t"), "rows")
    share = F.col("t.count") * parts / F.col("rows")
    return top.where(share > 1).select(F.col("t.item").alias("_hot"), F.ceil(share * FINE).cast("int").alias("_salts"))


def join_skew_proof(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, how: str = "left",
                    limit: int | None = None, parts: int | None = None) -> DataFrame:
    """``fact`` joined to ``dim`` on ``fact_key = dim_key`` ("left" or
    "inner"), with the columns of both; duplicate dimension rows multiply fact
    rows. ``limit``: bytes up to which the dimension is broadcast (default: the
    session's threshold). ``parts``: partitions of the join."""
    if how not in ("left", "inner"):
        raise ValueError(f"join type {how!r}: use left or inner")
    dim, size = measured(dim)
    on = fact[fact_key] == dim[dim_key]
    if size <= (broadcast_limit(dim) if limit is None else limit):
        return fact.join(F.broadcast(dim), on, how)
    spark = fact.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = staged(heavy_hitters(fact, fact_key, parts), "heavy-hitters")

    key = F.col(f"`{fact_key}`")
    salts = F.when(key.isNull(), F.lit(parts * FINE)).otherwise(F.coalesce("_salts", F.lit(1)))
    left = fact.join(F.broadcast(hot), key == F.col("_hot"), "left").withColumn(
        "_salt", (F.monotonically_increasing_id() % salts).cast("int"))
    if how == "inner":
        left = left.where(key.isNotNull())
    right = dim.join(F.broadcast(hot.withColumnRenamed("_salts", "_copies")),
                     F.col(f"`{dim_key}`") == F.col("_hot"), "left").withColumn(
        "_at", F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1)))
    # Neither side is small: keep the planner from shipping one whole.
    joined = left.drop("_hot", "_salts").hint("merge").join(
        right.drop("_hot", "_copies"), (F.col(f"`{fact_key}`") == F.col(f"`{dim_key}`"))
        & (F.col("_salt") == F.col("_at")), how)
    return joined.drop("_salt", "_at")


def check_unique(dim: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once (duplicates multiply fact rows in a
    join; they are reported, never silently removed)."""
    return dim.groupBy(key).count().where(F.col("count") > 1)
