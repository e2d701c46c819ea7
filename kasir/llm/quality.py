"""Quality scores by Bradley-Terry pairwise ranking.

A document's worth is linear in its features; of a preferred and a rejected
document the preferred one wins with probability sigmoid(difference). The
weights are learned by logistic loss on feature differences over preference
pairs: labelled rows of class 1 against labelled rows of class 0. Worths are
then cut at a quantile: the cut lies where the share of training rows below it
equals the share of class 0 among all labelled rows, and is mapped to score
``CUT``; the scale is the spread of the worths around it.

All distinct labelled rows train. They are dealt by a hash of id and text into
blocks of about ``BLOCK`` rows; each block learns from every pair it holds, and
the weights are the blocks' mean, weighted by rows. A class too rare to reach all
blocks goes to as many as give each about ``LEAST`` of its rows. The cut is the
exact quantile over all labelled rows. Of a row only its features (a few hundred
bytes) are moved, and every document is scored from its whole text, which goes to
Python once and does not come back.

Defined results: a null text scores as an empty one. Labels other than 0 and 1,
and null labels, train nothing. Without rows of both classes every score is
``CUT``. Null and repeated ids are scored row by row; a repeated row trains once,
a null id has no label. Texts of any length are read whole. Columns ``score`` and
``predicted`` of ``docs`` are replaced, all others pass through. An empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

from kasir.llm.common import name_clash_free, slots, staged, text_or_empty
from kasir.llm.features import fold, quality_features, row_hash

SIZE = 4096             # shape n-gram buckets
BLOCK = 2000            # labelled rows fitted together
LEAST = 200             # rows of the rarer class in a block
STEPS = 300
RATE = 10.0
POWERS = 20             # rounds that find the curvature
PENALTY = 1e-4
CUT = 0.7
GROUPS = 64             # sums of weights that reach the driver
BINS = 4096
FEW = 10_000            # rows looked through on the driver for a quantile
ENTRY = np.dtype([("at", "<u4"), ("x", "<f4")])     # a feature other than 0


class QualityModel:
    """score(text): sigmoid of the scaled distance from the cut."""

    def __init__(self, weights=None, cut: float = 0.0, scale: float = 1.0, size: int = SIZE):
        self.weights, self.cut, self.scale, self.size = weights, cut, scale, size

    def score(self, text: str) -> float:
        if self.weights is None:
            return CUT
        worth = float(quality_features(text, self.size) @ self.weights)
        z = np.clip((worth - self.cut) * self.scale, -30, 30) + np.log(CUT / (1 - CUT))
        return float(1 / (1 + np.exp(-z)))


def steepest(x: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """The loss's largest curvature, about, by power iteration."""
    v = np.ones(x.shape[1], dtype=np.float32)
    for _ in range(POWERS):
        s = x @ (v / max(np.linalg.norm(v), 1e-30)).astype(np.float32)
        d = (s[good] - s[bad]) / len(good)
        v = x.T @ (np.bincount(good, d, len(x)) - np.bincount(bad, d, len(x))).astype(np.float32)
    return float(np.linalg.norm(v)) / 4 + PENALTY


def descend(x: np.ndarray, good: np.ndarray, bad: np.ndarray, rate: float) -> np.ndarray:
    w = np.zeros(x.shape[1], dtype=np.float32)
    ahead = w
    for t in range(STEPS):
        s = x @ ahead
        g = -1 / (1 + np.exp(np.clip(s[good] - s[bad], -30, 30))) / len(good)
        per_row = np.bincount(good, g, len(x)) - np.bincount(bad, g, len(x))
        new = ahead - rate * (x.T @ per_row.astype(np.float32) + PENALTY * ahead)
        ahead = new + t / (t + 3) * (new - w)
        w = new
    return w


def fit_pairs(x: np.ndarray, good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Weights from pairs of row numbers (preferred, rejected). Steps that ran
    away, to a loss above that of no weights, are taken again at a safe rate."""
    w = descend(x, good, bad, RATE)
    s = (x @ w).astype(float)
    if np.logaddexp(0, s[bad] - s[good]).mean() > np.log(2) + 1e-6:
        w = descend(x, good, bad, min(RATE, 1 / steepest(x, good, bad)))
    return w


def packed(text: str, size: int) -> bytes:
    x = quality_features(text, size)
    at = np.flatnonzero(x)
    out = np.empty(len(at), ENTRY)
    out["at"], out["x"] = at, x[at]
    return out.tobytes()


def fit_block(y: np.ndarray, xs: list[bytes], features: int) -> np.ndarray:
    """Weights from all pairs of a row of class 1 and a row of class 0."""
    entries = np.frombuffer(b"".join(xs), ENTRY)
    row = np.repeat(np.arange(len(xs)), [len(b) // ENTRY.itemsize for b in xs])
    used, col = np.unique(entries["at"], return_inverse=True)
    x = np.zeros((len(xs), len(used)), dtype=np.float32)
    x[row, col] = entries["x"]
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    w = np.zeros(features)
    if len(good) and len(bad):
        w[used] = fit_pairs(x, np.repeat(good, len(bad)), np.tile(bad, len(good)))
    return w


def labelled(docs: DataFrame, labels: DataFrame | None, label_col: str, id_col: str, text_col: str,
             size: int) -> DataFrame:
    """(y, h, x, n): the features of each distinct labelled row, found n times.
    Features are far smaller than texts, so they are made before the join."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            yield pa.array([packed(t.as_py(), size) for t in b], pa.binary())

    udf = F.arrow_udf(run, "binary", ArrowUDFType.SCALAR_ITER)
    marks = (docs if labels is None else labels).where(F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).distinct()
    texts = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), row_hash(id_col, text_col).alias("h"), udf(text_or_empty(text_col)).alias("x"))
    return marks.join(texts, "id").groupBy("y", "h").agg(F.first("x").alias("x"), F.count(F.lit(1)).alias("n"))


def dealt(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``rows`` with their ``block``. ``counts``: rows by class."""
    blocks = -(-sum(counts.values()) // BLOCK)
    copies = {k: min(blocks, -(-LEAST * blocks // n)) for k, n in counts.items()}
    last = F.when(F.col("y") == 0, F.lit(copies[0] - 1)).otherwise(F.lit(copies[1] - 1))
    spread = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), last)))
    block = F.pmod(F.pmod("h", F.lit(blocks)) + F.col("copy"), F.lit(blocks))
    return spread.withColumn("block", block).drop("copy").repartition(
        min(blocks, slots(rows.sparkSession)), "block")


def mean_weights(rows: DataFrame, counts: dict[int, int], features: int) -> np.ndarray:
    """The mean of the blocks' weights, by rows; added up in ``GROUPS`` sums."""
    names = ["block", "n", "w"]

    def one(t: pa.Table) -> pa.Table:
        t = t.sort_by([("h", "ascending"), ("y", "ascending")])
        w = fit_block(t["y"].to_numpy(), t["x"].to_pylist(), features) * t.num_rows
        return pa.table([t["block"].slice(0, 1), pa.array([t.num_rows]), pa.array([w.tobytes()], pa.binary())], names)

    def add(t: pa.Table) -> pa.Table:
        t = t.sort_by("block")
        w = sum(np.frombuffer(b.as_py()) for b in t["w"])
        return pa.table([t["block"].slice(0, 1), pa.array([sum(t["n"].to_pylist())]),
                         pa.array([w.tobytes()], pa.binary())], names)

    schema = "block long, n long, w binary"
    fits = dealt(rows, counts).groupBy("block").applyInArrow(one, schema)
    sums = fits.groupBy(F.pmod("block", F.lit(GROUPS))).applyInArrow(add, schema).collect()
    sums = sorted(sums, key=lambda r: r["block"])
    return (sum(np.frombuffer(bytes(r["w"])) for r in sums) / sum(r["n"] for r in sums)).astype(np.float32)


def at_rank(rows: DataFrame, rank: int) -> float:
    """The ``rank``-th smallest ``worth`` (from 1), exactly; a row counts ``n``
    times. Bins narrow down to a few rows, so no task sorts them all."""
    worth = F.col("worth")
    lo, hi = rows.agg(F.min(worth), F.max(worth)).first()
    while lo < hi:
        left = rows.where(worth.between(lo, hi))
        step = (hi - lo) / BINS
        place = F.least(F.floor((worth - F.lit(lo)) / F.lit(step)), F.lit(BINS)) if step > 0 else worth
        bins = left.groupBy(place.alias("bin")).agg(
            F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows"), F.min(worth).alias("lo"), F.max(worth).alias("hi"))
        for b in sorted(bins.collect(), key=lambda r: r["lo"]):
            if rank <= b["n"]:
                break
            rank -= b["n"]
        lo, hi = b["lo"], b["hi"]
        if b["rows"] <= FEW:
            for r in sorted(left.where(worth.between(lo, hi)).select("worth", "n").collect()):
                if rank <= r["n"]:
                    return r["worth"]
                rank -= r["n"]
    return lo


def spread(rows: DataFrame) -> float:
    """Standard deviation of the worths. Decimal sums do not depend on the order
    of rows."""
    n, total, squares = rows.agg(
        F.count(F.lit(1)), F.sum(F.col("worth").cast("decimal(24,12)")),
        F.sum((F.col("worth") * F.col("worth")).cast("decimal(24,12)"))).first()
    return float(np.sqrt(max(float(squares) / n - (float(total) / n) ** 2, 0)))


def fit(docs: DataFrame, labels: DataFrame | None = None, label_col: str = "quality",
        id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> QualityModel:
    """Fit on all labelled rows of ``docs``; ``labels`` (ids and labels) may be a
    table of its own."""
    rows = staged(labelled(docs, labels, label_col, id_col, text_col, size), "quality-rows")
    classes = rows.groupBy("y").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n")).collect()
    if len(classes) < 2:
        return QualityModel(size=size)
    w = mean_weights(rows, {r["y"]: r["rows"] for r in classes}, len(quality_features("", size)))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            found = [np.frombuffer(x.as_py(), ENTRY) for x in b]
            yield pa.array([float(e["x"] @ w[e["at"]]) for e in found], pa.float64())

    worth = F.arrow_udf(run, "double", ArrowUDFType.SCALAR_ITER)
    # A class weighs as many rows as it has with repeats; whole numbers keep the rank exact.
    (n0, all0), (n1, all1) = [(r["rows"], r["n"]) for r in sorted(classes, key=lambda r: r["y"])]
    shared = math.gcd(all0 * n1, all1 * n0)
    weigh = [F.lit(Decimal(k // shared)).cast("decimal(38,0)") for k in (all0 * n1, all1 * n0)]
    worths = staged(rows.select(worth("x").alias("worth"), F.when(F.col("y") == 0, weigh[0]).otherwise(weigh[1])
                                .alias("n")), "quality-worths")
    below = at_rank(worths, -(-all0 * n0 * n1 // shared))
    above = worths.where(F.col("worth") > below).agg(F.min("worth")).first()[0]
    cut = below if above is None else (below + above) / 2
    return QualityModel(w, cut, 2.0 / max(spread(worths), 1e-6), size)


def score(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``score`` and ``predicted``. Only the texts go to Python,
    and only the scores come back."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            yield pa.array([model.score(t.as_py()) for t in b], pa.float64())

    # Not deterministic for the optimizer: a filter on the score must not run it again.
    udf = F.arrow_udf(run, "double", ArrowUDFType.SCALAR_ITER).asNondeterministic()
    own = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    got = name_clash_free(docs, "worth")
    marked = docs.withColumn(got, udf(text_or_empty(text_col)))
    return marked.select(*[F.col(f"`{c}`") for c in own], F.col(got).alias("score"),
                         (F.col(got) >= CUT).cast("int").alias("predicted"))


def held_out(id_col: str = "doc_id"):
    return fold(id_col, 4) == 2


def op2_quality(spark, sf_dir: str) -> DataFrame:
    from kasir.llm.common import prepare, table
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs.where(~held_out()), table(spark, sf_dir, "labels").where(~held_out()))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return score(rows, model).select("doc_id", "held_out", "score", "predicted")
