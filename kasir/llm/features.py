"""Text features and bounded training samples for the two classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kasir.llm.common import slots

CHUNK = 1 << 20                 # bytes hashed at once

# Multipliers of the three positions of an n-gram (odd, well mixed).
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def _language_bytes() -> bytes:
    """ASCII letters and bytes of longer characters stay, the rest is blank."""
    return bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def _shape_bytes() -> bytes:
    """Letters by case, digits and longer characters each become one class;
    punctuation and white space stay as they are."""
    out = []
    for b in range(256):
        c = chr(b)
        out.append(ord("x") if b >= 128 or c.islower() else ord("X") if c.isupper()
                   else ord("0") if c.isdigit() else b)
    return bytes(out)


LANGUAGE_BYTES = _language_bytes()
SHAPE_BYTES = _shape_bytes()


def gram_counts(data: bytes, size: int, orders: tuple[int, ...] = (1, 2, 3)) -> np.ndarray:
    """Counts of hashed byte n-grams of a whole text, in ``size`` buckets."""
    total = np.zeros(size, dtype=np.int64)
    shift = np.uint32(32 - int(size).bit_length() + 1)
    for at in range(0, len(data), CHUNK):
        b = np.frombuffer(data, dtype=np.uint8)[at:at + CHUNK + max(orders) - 1].astype(np.uint32) + np.uint32(1)
        own = min(CHUNK, len(data) - at)
        for n in orders:
            if len(b) >= n:
                h = np.zeros(len(b) - n + 1, dtype=np.uint32)
                for i in range(n):
                    h = (h ^ b[i:len(b) - n + 1 + i]) * _MIX[i]
                    h ^= h >> np.uint32(15)
                total += np.bincount(((h * _MIX[0]) >> shift)[:own], minlength=size)
    return total


def unit(counts: np.ndarray) -> np.ndarray:
    """Square roots of the counts, scaled to length 1."""
    x = np.sqrt(counts.astype(np.float32))
    n = float(np.sqrt((x * x).sum()))
    return x / n if n else x


def language_features(text: str, size: int) -> np.ndarray:
    return unit(gram_counts(text.lower().encode("utf-8", "replace").translate(LANGUAGE_BYTES), size))


def quality_features(text: str, size: int) -> np.ndarray:
    """Hashed shape n-grams plus a few measures of repetition and length."""
    raw = text.encode("utf-8", "replace")
    grams = unit(gram_counts(raw.translate(SHAPE_BYTES), size))
    words, lines = text.split(), text.split("\n")
    n, m = max(len(words), 1), max(len(lines), 1)
    chars = max(len(text), 1)
    letters = sum(map(len, words)) or 1
    extras = np.array([
        len(set(words)) / n, len(set(lines)) / m, min(letters / n, 30) / 30,
        min(np.log1p(n) / 10, 1.5), min(np.log1p(m) / 8, 1.5), len(raw) / chars - 1,
        float(n < 8), float(not words)], dtype=np.float32)
    return np.concatenate([grams, extras])


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``. A null id is in fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)), F.lit(0))


def row_hash(*cols: str) -> Column:
    return F.xxhash64(F.lit("sample"), *cols)


def sample_by_class(rows: DataFrame, class_col: str, hash_col: str, most: int) -> tuple[DataFrame, dict]:
    """(class, hash) of at most ``most`` distinct rows, and the count of each
    class among all rows. Every class gets the same quota (one row at least, so
    with more than ``most`` classes there are as many rows as classes), filled
    by the smallest hashes. The hash is of all that a row is drawn by, id and
    text: neither a repeated id nor a repeated row counts more than once."""
    counts = {r[0]: r[1] for r in rows.groupBy(class_col).count().collect()}
    quota = max(1, most // max(len(counts), 1))
    n = slots(rows.sparkSession)
    picked = rows.select(class_col, hash_col).distinct().withColumn("salt", F.pmod(F.col(hash_col), F.lit(n)))
    for key in ([class_col, "salt"], [class_col]):      # a class may hold a third of all rows
        w = Window.partitionBy(*key).orderBy(hash_col)
        picked = picked.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= quota).drop("nth")
    return picked.drop("salt"), counts


def drawn(rows: DataFrame, picked: DataFrame, class_col: str, hash_col: str, text_col: str) -> DataFrame:
    """(class, text) of the picked rows, each once. ``picked`` is bounded (see
    ``sample_by_class``), so it is sent to every task."""
    hits = rows.join(F.broadcast(picked), [class_col, hash_col])
    return hits.groupBy(class_col, hash_col).agg(F.first(text_col).alias(text_col)).select(class_col, text_col)
