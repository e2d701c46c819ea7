"""Line-level deduplication with DataFrame functions only.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z
lower-cased. A key of at least ``min_chars`` code points found in two or more
documents keeps its lines only in the document with the smallest id; all
shorter lines stay. A line therefore goes exactly when an earlier document
holds its key, so nothing needs counting: it is enough to know each key's first
document.

Key digests are dealt out by range and sorted by key, document and position
inside each range (secondary sort), so first occurrences are read off as a
stream. A key may sit in a third of all documents, so this happens twice: first
under (key, salt), the salt being one of as many values as there are shuffle
partitions, picked by document and text; only the first document of each (key, salt)
goes on to the second pass, where a key has at most one row per salt and
document line. The result is one compressed bitmap per document with a dropped
line: the runs of kept lines. Texts take no part until ``apply_bitmaps``.

Defined results: a null or empty text is one empty line, which always stays. A
null id sorts after all others; each text without an id is a document of its own,
and those are ordered by a text fingerprint. Rows repeated with the same id and
text are one document and all get its bitmap; rows with one id and different
texts are versions of one document, told apart by the fingerprint: they share
the id's place in the order and keep a line that only they hold. A text of any
length is split whole, in one row. Columns ``n_lines`` and ``n_dropped`` of the
input are replaced; all others pass through, whatever their names. An empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kasir.llm.common import name_clash_free, slots, text_or_empty

# The white space a key loses, and the letters it folds.
EDGE = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 10


def line_key(line):
    return F.translate(F.btrim(line, F.lit(EDGE)), UPPER, LOWER)


def line_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = MIN_CHARS) -> DataFrame:
    """(k1, k2, doc, fp, pos) of every line long enough to be compared; the
    two words together are a 128-bit digest of the key."""
    text = text_or_empty(text_col)
    lines = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("fp"),
                        F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    keyed = lines.select("doc", "fp", "pos", line_key(F.col("line")).alias("key"))
    keyed = keyed.where(F.char_length("key") >= min_chars)
    return keyed.select(F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2"),
                        "doc", "fp", "pos")


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, fp, pos) of every line whose key an earlier document holds."""
    n = slots(docs.sparkSession)
    rows = line_digests(docs, id_col, text_col, min_chars)
    rows = rows.withColumn("salt", F.pmod(F.hash("doc", "fp"), F.lit(n)))

    def firsts(df: DataFrame, *key: str) -> DataFrame:
        order = (F.col("doc").asc_nulls_last(), F.col("fp"), F.col("pos"))
        w = (Window.partitionBy(*key).orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        dealt = df.repartitionByRange(n, *key)
        # Without an id the text is the document.
        same = F.first("doc").over(w).eqNullSafe(F.col("doc")) & (
            F.col("doc").isNotNull() | (F.first("fp").over(w) == F.col("fp")))
        return dealt.withColumn("later", ~same)

    local = firsts(rows, "k1", "k2", "salt")
    rest = local.where(~F.col("later")).drop("later", "salt")
    final = firsts(rest, "k1", "k2")
    cols = ("doc", "fp", "pos")
    return local.where("later").select(*cols).unionAll(final.where("later").select(*cols))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, fp, n_dropped, kept): one row per document that loses a line.
    ``kept`` is its keep bitmap in run-length form: the 1-runs as
    (start, length), the last one open-ended (length null)."""
    gone = dropped_lines(docs, id_col, text_col, min_chars)
    # A row repeated with the same id and text drops the same position twice.
    per_doc = gone.groupBy("doc", "fp").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    at = F.col("gone")
    edges = F.concat(F.array(F.lit(-1)), at)
    runs = F.transform(edges, lambda e, i: F.struct(
        (e + 1).alias("start"),
        F.when(i < F.size(at), F.get(at, i) - e - 1).alias("length")))
    return per_doc.select("doc", "fp", F.size(at).cast("long").alias("n_dropped"),
                          F.filter(runs, lambda r: ~r["length"].eqNullSafe(F.lit(0))).alias("kept"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` reduced to its kept lines, plus ``n_lines``
    (before) and ``n_dropped``. Documents without a bitmap keep all lines."""
    text = text_or_empty(text_col)
    doc, fp, gone, runs = (name_clash_free(docs, n) for n in ("doc", "fp", "dropped", "kept"))
    marks = bitmaps.select(F.col("doc").alias(doc), F.col("fp").alias(fp), F.col("n_dropped").alias(gone),
                           F.col("kept").alias(runs))
    joined = docs.join(marks, F.col(f"`{id_col}`").eqNullSafe(F.col(doc)) & (F.xxhash64(text) == F.col(fp)), "left")
    lines = F.split(text, "\n", -1)
    size = F.size(lines)
    kept = F.flatten(F.transform(runs, lambda r: F.slice(
        lines, r["start"] + 1, F.coalesce(r["length"], size - r["start"]))))
    out = F.when(F.col(runs).isNull(), text).otherwise(F.array_join(kept, "\n"))
    own = [c for c in docs.columns if c.lower() not in (text_col.lower(), "n_lines", "n_dropped")]
    return joined.select(*[F.col(f"`{c}`") for c in own], out.alias(text_col),
                         size.cast("long").alias("n_lines"),
                         F.coalesce(gone, F.lit(0)).cast("long").alias("n_dropped"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS) -> DataFrame:
    return apply_bitmaps(docs, keep_bitmaps(docs, id_col, text_col, min_chars), id_col, text_col)


def op3_line_dedup(spark, sf_dir: str) -> DataFrame:
    from kasir.llm.common import prepare, table
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


# DuckDB twin of op3_line_dedup.
OP3_SQL = r"""
WITH lines AS (
  SELECT doc_id, i AS pos, parts[i] AS line,
         translate(trim(parts[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), firsts AS (
  SELECT k, min(doc_id) AS first_doc, count(DISTINCT doc_id) AS docs
  FROM lines WHERE length(k) >= 10 GROUP BY k
), marked AS (
  SELECT l.doc_id, l.pos, l.line,
         coalesce(f.docs >= 2 AND l.doc_id <> f.first_doc, false) AS gone
  FROM lines l LEFT JOIN firsts f ON l.k = f.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
