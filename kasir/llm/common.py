"""Helpers shared by the training-data operators.

Anything that must outlive a stage is written under the shared folder the
session names (``spark.checkpoint.dir``), never to a machine-local one, so a
lost executor costs only its running tasks.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kasir.session import run_folder

# Rows and bytes per Arrow batch handed to Python: texts can be long, so few.
ARROW_ROWS = 1000
ARROW_BYTES = "8m"
# Rows per batch where the work is on the batch's distinct words: bytes rule.
TEXT_ROWS = 10_000
# Staged tables carry whole texts: a row group this size keeps a writing task's
# buffer small.
ROW_GROUP = 16 << 20

_shipped: set[str] = set()


def prepare(spark: SparkSession, arrow_rows: int = ARROW_ROWS) -> None:
    """Session settings the operators rely on; ships this package to the
    Python workers once per application."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(arrow_rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="kasir-code-"), "kasir-code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the run's shared folder, which
    ``session.release_staged`` deletes."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the
    lineage and lets several consumers read one result."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").option("parquet.block.size", str(ROW_GROUP)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def name_clash_free(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet."""
    have = {c.lower() for c in df.columns}
    name = base
    while name.lower() in have:
        name = "_" + name
    return name


def text_or_empty(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slots(spark: SparkSession) -> int:
    """Shuffle partitions of the session: the width operators deal work to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
