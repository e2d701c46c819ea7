"""Exact deduplication as a stateful stream, with DataFrame functions only.

Documents arrive as a file stream, some files at a time. A streaming aggregation
keyed by the text's SHA-256 keeps, without expiry, in the disk-backed (RocksDB)
state store: the largest (id, content locator) seen and the number of rows. Rows
of one digest are combined in each task before they reach the state, so a text
that fills a third of the input costs one row per task. Every micro-batch meets
the state that the ones before it left, and each run resumes from its checkpoint,
so later files are matched against everything seen before. After a run the state
is read once, through Spark's state data source.

The digest alone is not trusted: every row of a digest with more than one row
(a hit) is compared byte for byte with the text of the row that stays. The hits
of one digest are spread over salts of ``SALT_ROWS`` rows, from their first
shuffle on, with a copy of the kept text each. Rows that differ (a digest
collision) are grouped again by digest and whole text.

Defined results: a null text counts as empty. A null id sorts before all
others. Rows repeated with the same id and text form a group; the locator (file,
then row) decides which one stays. A text of any length is hashed and compared
whole. Extra columns are ignored. An empty folder gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from kasir.llm.common import prepare, shared_path, slots, staged, text_or_empty

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# Each state partition would otherwise reserve some MB of disk for its logs.
FALLOCATE = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"
# Hits of one digest that share a copy of the kept text.
SALT_ROWS = 256
# A group is hot when it holds more rows than one of so many parts per task; there
# are at most this many hot groups per shuffle partition.
HOT_PARTS = 4
# Files of the registered query's micro-batches.
FILES_PER_BATCH = 12

STATE_SCHEMA = "digest binary, doc_id bigint, file string, row bigint, group_size bigint"


def located(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(digest, at, text): ``at`` is the id and the content locator."""
    text = text_or_empty(text_col)
    at = F.struct(F.col(id_col).cast("long").alias("doc_id"),
                  F.col("_metadata.file_path").alias("file"),
                  F.col("_metadata.row_index").alias("row"))
    return docs.select(F.unhex(F.sha2(text, 256)).alias("digest"), at.alias("at"), text.alias("text"))


def update_state(spark: SparkSession, path: str, schema: StructType, home: str,
                 id_col: str = "doc_id", text_col: str = "text",
                 files_per_batch: int | None = None) -> DataFrame:
    """Feed the files under ``path`` that the state in ``home`` has not seen,
    and return the whole state: one row per digest. ``home`` is a folder all
    executors share; it holds the checkpoint with the state."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # As a pattern the path may name a folder of files or a single file.
    stream = located(reader.parquet(f"{path[:-1]}[{path[-1]}]"), id_col, text_col)
    groups = stream.groupBy("digest").agg(F.max("at").alias("at"), F.count("*").alias("group_size"))
    settings = {PROVIDER: ROCKSDB, FALLOCATE: "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        # Only the state counts: what a batch changed in it goes nowhere.
        query = (groups.writeStream.outputMode("update").trigger(availableNow=True).format("noop")
                 .queryName(f"exact-dedup-{uuid.uuid4().hex}")
                 .option("checkpointLocation", f"{home}/checkpoint").start())
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    if query.lastProgress is None and not _has_state(spark, home):      # the folder was always empty
        return spark.createDataFrame([], STATE_SCHEMA)
    state = spark.read.format("statestore").load(f"{home}/checkpoint")
    at, size = (F.col(f"value.`{c}`") for c in state.schema["value"].dataType.names)
    return staged(state.select(F.col("key.digest").alias("digest"), at["doc_id"].alias("doc_id"),
                               at["file"].alias("file"), at["row"].alias("row"), size.alias("group_size")),
                  "exact-state")


def _has_state(spark: SparkSession, home: str) -> bool:
    """Whether some micro-batch was committed."""
    try:
        return spark.read.text(f"{home}/checkpoint/commits/*").limit(1).count() > 0
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return False


def resolve(docs: DataFrame, state: DataFrame, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per row of ``docs`` (a file scan of what the state has seen):
    doc_id, keep_id, group_size, kept, text_sha256."""
    rows = located(docs, id_col, text_col)
    kept_at = F.struct("doc_id", "file", "row")
    groups = state.select("digest", kept_at.alias("keep"), "group_size")

    alone = groups.where("group_size = 1")
    singles = alone.select(F.col("keep.doc_id").alias("doc_id"), F.col("keep.doc_id").alias("keep_id"),
                           "group_size", F.lit(True).alias("kept"), "digest")

    # Hot groups are few, by their definition, so every task can know them; their
    # rows are salted before any shuffle, all others have salt 0.
    spark = docs.sparkSession
    n_rows = state.agg(F.sum("group_size")).first()[0] or 0
    hot_size = max(SALT_ROWS, n_rows // (HOT_PARTS * slots(spark)))
    copies = groups.where("group_size > 1").withColumn(
        "salts", F.when(F.col("group_size") > hot_size, F.ceil(F.col("group_size") / SALT_ROWS)).otherwise(1))
    hot = F.broadcast(copies.where("salts > 1").select("digest", "salts"))
    spread = copies.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).drop("salts")
    dealt = (rows.join(hot, "digest", "left")
             .withColumn("salt", F.pmod(F.xxhash64("at"), F.coalesce("salts", F.lit(1)))).drop("salts"))
    hits = staged(dealt.join(spread, ["digest", "salt"]), "exact-hits")
    originals = (hits.where("at = keep").select("digest", F.col("text").alias("original"))
                 .join(copies.select("digest", "salts"), "digest")
                 .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).drop("salts"))
    checked = (hits.join(originals, ["digest", "salt"])
               .withColumn("same", F.col("text") == F.col("original")).drop("original"))

    # Collisions: rows whose bytes differ from the kept row's. There are none
    # unless two texts share a SHA-256.
    odd = checked.where("not same")
    odd_groups = (odd.groupBy("digest", "text")
                  .agg(F.max("at").alias("keep2"), F.count("*").alias("size2")))
    odd_rows = (odd.join(odd_groups, ["digest", "text"])
                .select("at.doc_id", F.col("keep2.doc_id").alias("keep_id"),
                        F.col("size2").alias("group_size"), (F.col("at") == F.col("keep2")).alias("kept"),
                        "digest"))
    # Copied to all salts of the digest, so that no hit moves again.
    n_odd = (odd.groupBy("digest").agg(F.count("*").alias("n_odd")).join(copies.select("digest", "salts"), "digest")
             .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).drop("salts"))
    even = (checked.where("same").drop("text").join(n_odd, ["digest", "salt"], "left")
            .select("at.doc_id", F.col("keep.doc_id").alias("keep_id"),
                    (F.col("group_size") - F.coalesce("n_odd", F.lit(0))).alias("group_size"),
                    (F.col("at") == F.col("keep")).alias("kept"), "digest"))
    out = singles.unionByName(even).unionByName(odd_rows)
    return out.select("doc_id", "keep_id", "group_size", "kept",
                      F.lower(F.hex("digest")).alias("text_sha256"))


def dedup_folder(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text",
                 home: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Exact duplicates among the Parquet files under ``path``, taken
    ``files_per_batch`` at a time (all at once by default)."""
    schema = StructType([StructField(id_col, LongType()), StructField(text_col, StringType())])
    home = home or shared_path(spark, "exact-dedup")
    state = update_state(spark, path, schema, home, id_col, text_col, files_per_batch)
    return resolve(spark.read.schema(schema).parquet(path), state, id_col, text_col)


def op10_exact_dedup(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    return dedup_folder(spark, f"{sf_dir}/documents.parquet", files_per_batch=FILES_PER_BATCH)


# DuckDB twin of op10_exact_dedup.
OP10_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
