"""SparkSession settings the jobs assume."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC dates, AQE re-planning (coalescing small
# shuffle partitions, splitting skewed join partitions), no web UI. A task's
# memory is bounded by what it reads: rows grow about fifty times from a
# compressed shuffle to the maps and sorts of a stage (store attributes join in
# its middle), so both sizes are well below Spark's 64 and 128 MB. Small files
# are read many to a task, and listed by a few hundred tasks instead of 10,000.
# The JIT leaves methods above 8,000 bytes to the interpreter: such a stage runs
# its expressions in smaller ones. ``initial_partitions`` goes with them.
JOB_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.files.openCostInBytes": "128k",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "200",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Hash partitions a shuffle starts with, at least. AQE joins small ones up to the
# advisory size but never cuts one, so the shuffle partitions of a session, which
# are often a small multiple of its cores, would let a task grow with the input.
INITIAL_PARTITIONS = 1000
INITIAL_KEY = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def initial_partitions(spark: SparkSession) -> int:
    """Partitions a shuffle starts with, before AQE joins small ones: the
    smallest multiple of the session's shuffle partitions from
    ``INITIAL_PARTITIONS`` on, or what the session has set, if that is more. As a
    multiple, each lies within one bucket of a table with as many buckets as
    shuffle partitions."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))      # Spark's own default
    own = int(spark.conf.get(INITIAL_KEY, None) or 0)
    return max(own, -(-INITIAL_PARTITIONS // n) * n)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "kasir", extra: dict[str, str] | None = None) -> SparkSession:
    """Local session for tests and the benchmark. On a cluster use the
    cluster's session and only apply ``ensure_job_conf``."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g"))
    for k, v in {**JOB_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_job_conf(spark)
    return spark


def ensure_job_conf(spark: SparkSession) -> None:
    """Apply the SQL settings above to an existing session."""
    for k, v in JOB_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    spark.conf.set(INITIAL_KEY, str(initial_partitions(spark)))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder ``spark.checkpoint.dir`` names. Only a local session,
    whose executors share the driver's disk, gets a scratch folder when the
    setting is absent."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="kasir-ckpt-", dir=os.environ.get("KASIR_SCRATCH"))
        sc.setCheckpointDir(d)
    return d


def run_folder(spark: SparkSession) -> str:
    """This application's folder below the shared one: whatever a job stages is
    there, so ``release_staged`` can find it."""
    return f"{checkpoint_dir(spark).rstrip('/')}/kasir-{spark.sparkContext.applicationId}"


FREE_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Writes in this block give the disk of their shuffles back when they are
    done, not when the driver happens to collect garbage. Only for frames that
    are written once."""
    before = spark.conf.get(FREE_KEY, "false")
    spark.conf.set(FREE_KEY, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_KEY, before)


def staged(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back. Cuts the
    lineage, lets several consumers read one result, and tells the planner the
    result's bytes."""
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with freed_shuffles(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def release_staged(spark: SparkSession) -> None:
    """Delete all that this application has staged. Call it when no frame of
    the run is needed any more: frames read their staged tables lazily."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
