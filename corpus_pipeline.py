"""Cleaning pipeline over ``documents``: language, quality, repeated lines,
near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept; what one stage returns is written as Parquet in the shared folder and
read back for the next. All but the last return the columns of ``documents``.

Defined results: see the operators; a null or empty text has no letter and goes
in the first stage. Rows repeated with the same id and text count as one
document once near duplicates are removed; rows with one id and different texts
are versions of one document and stay or go with their own components. Of each
component of near duplicates exactly one row stays, also where ids are null or
repeat: the smallest by id (null last), shingle set digest and text digest. A
text without words is a component of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kasir.llm import language, quality
from kasir.llm.common import TEXT_ROWS, prepare, staged, table, text_or_empty
from kasir.llm.line_dedup import dedup_lines
from kasir.llm.ngram_join import ngram_components, text_digest
from kasir.llm.packing import pack_documents

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# A document whose language is ambiguous, with a score below this, goes.
LEAST_LANGUAGE_SCORE = 0.5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those of no clear language."""
    prepare(spark)
    model = language.fit(docs.where(~language.held_out()))
    known = language.predict(docs.select(*COLUMNS), model)
    unclear = F.col("ambiguous") & (F.col("score") < LEAST_LANGUAGE_SCORE)
    return known.where((F.col("lang_pred") != language.UNKNOWN) & ~unclear).select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents scored below the quality cut."""
    prepare(spark)
    model = quality.fit(docs.where(~quality.held_out()), table(spark, sf_dir, "labels").where(~quality.held_out()))
    return quality.score(docs.select(*COLUMNS), model).where("predicted = 1").select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps each repeated line in its first document only."""
    prepare(spark)
    out = dedup_lines(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row, of the smallest id, of each near-duplicate component."""
    prepare(spark)
    rows = ngram_components(docs, with_rows=True)
    row = F.struct(F.col("doc").isNull().alias("no_id"), "doc", "c", "t1", "t2")
    first = (rows.where("n > 0").groupBy("part").agg(F.min(row).alias("row"))
             .select("row.doc", "row.t1", "row.t2"))
    stay = first.unionByName(rows.where("n = 0").select("doc", "t1", "t2"))
    t1, t2 = text_digest(text_or_empty("text"))
    kept = docs.select(*COLUMNS).join(
        stay, F.col("doc_id").eqNullSafe(F.col("doc")) & (t1 == F.col("t1")) & (t2 == F.col("t2")), "left_semi")
    return kept.dropDuplicates(["doc_id", "text"])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of at most 2048 tokens."""
    import public_tokenizers
    prepare(spark, TEXT_ROWS)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), added_tokens=True)


STAGES = [
    ("language_id", language_stage),
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("ngram_join", near_duplicate_stage),
    ("packing", packing_stage),
]

# Language and quality come from fitted models, which SQL cannot express;
# tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
