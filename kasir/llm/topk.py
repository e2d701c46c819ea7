"""Exact top-k inner products by distributed histogram selection.

Vectors become integer rows and are stacked into blocks; query vectors likewise.
Every query block meets every vector block once per round, through an equi-join
on the vector block's group, and all scores of the pair are one matrix product. A
task adds up the histograms of the pairs it sees before they leave it. Round 1
counts, per query, how many candidates fall into each bin of the range
the norms allow. The bins' global sums locate the bin of the k-th largest score;
the next round splits that bin alone, and so on until each query's bin holds a
single score or few enough rows lie at or above its lower edge. The last round
emits scores at or above that edge. Where a bin is one score wide, the rows on
it are ties: each block passes on only the k smallest ids among them, which is
all that any order can still need. A final rank per query breaks ties by id.

Scores are exact: products are taken in float64 when no partial sum can reach
2^53, else in 64-bit integers, else in Python's; ``ValueError`` is raised when a
score itself reaches 2^61.

Defined results: vectors that are null, or hold a null or a non-finite
component, take no part; nor do null ids. Vectors are compared only with those
of the same length. A repeated id is a separate candidate, except that rows with
the query's own id are never its candidates. Fewer than k candidates: all are
returned. Extra columns are ignored, whatever their names; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kasir.llm.common import slots, staged

SCALE = 1024
BINS = 512             # bins per query and round
BLOCK = 1024           # rows per vector block, at most
QUERY_BLOCK = 256      # rows per query block, at most
HELD = 32              # query blocks whose histograms a task adds up at once
SLACK = 64             # rows above the edge, beyond k, that end the rounds
EXACT_FLOAT = 1 << 53
EXACT_INT = 1 << 61

BLOCK_TYPE = "dim int, ids binary, matrix binary, top long, norm double"


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): usable vectors with each component floor(scale * x)."""
    x = F.col(vec_col)
    fine = (F.col(id_col).isNotNull() & x.isNotNull()
            & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))))
    whole = F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")))
    return df.where(F.coalesce(fine, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"))


def stack(vectors: DataFrame, rows: int) -> DataFrame:
    """Blocks of at most ``rows`` vectors of one length each."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, rows_ = zip(*held.pop(dim))
            m = np.array(rows_, dtype=np.int64).reshape(len(ids), dim)
            f = m.astype(np.float64)
            top = int(np.abs(f).max()) if m.size else 0
            return pa.RecordBatch.from_pydict({
                "dim": pa.array([dim], pa.int32()), "ids": [np.array(ids, dtype="<i8").tobytes()],
                "matrix": [m.astype("<i8").tobytes()], "top": [top],
                "norm": [float(np.sqrt((f * f).sum(axis=1)).max(initial=0.0))]})

        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.setdefault(len(v), []).append((i, v))
                if len(held[len(v)]) >= rows:
                    yield block(len(v))
        for dim in list(held):
            yield block(dim)

    return vectors.mapInArrow(build, BLOCK_TYPE)


def _ids(b: bytes) -> np.ndarray:
    return np.frombuffer(b, dtype="<i8")


def _scores(q: dict, v: dict) -> np.ndarray:
    """All scores of a query block against a vector block."""
    dim = q["dim"]
    bound = q["top"] * v["top"] * max(dim, 1)
    a, b = _ids(q["matrix"]).reshape(-1, dim), _ids(v["matrix"]).reshape(-1, dim)
    if bound < EXACT_FLOAT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < EXACT_INT:
        return a @ b.T
    exact = a.astype(object) @ b.T.astype(object)
    exact[q["id"][:, None] == v["id"][None, :]] = 0         # a row never meets itself
    if max(map(abs, exact.ravel()), default=0) >= EXACT_INT:
        raise ValueError("inner products of these vectors do not fit 61 bits")
    return exact.astype(np.int64)


def _pairs(batches: Iterator[pa.RecordBatch]):
    """(query block, vector block, scores, own) of each joined row; ``own``
    marks the query's own rows."""
    for batch in batches:
        for row in batch.to_pylist():
            q = {k[2:]: x for k, x in row.items() if k.startswith("q_")}
            v = {k[2:]: x for k, x in row.items() if k.startswith("v_")}
            q["id"], v["id"] = _ids(q["ids"]), _ids(v["ids"])
            yield q, v, _scores(q, v), q["id"][:, None] == v["id"][None, :]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Histogram rows (query block, index, bin, n) of the open bins, added up
    over the task's pairs; sums of at most ``HELD`` query blocks are held."""
    held: dict[int, np.ndarray] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for block, n in held.items():
            i, b = np.nonzero(n)
            yield pa.RecordBatch.from_pydict({
                "qblock": pa.array(np.full(len(i), block), pa.int64()), "i": pa.array(i, pa.int32()),
                "bin": pa.array(b, pa.int32()), "n": pa.array(n[i, b], pa.int64())})
        held.clear()

    for q, _, s, own in _pairs(batches):
        lo, width, hi = (_ids(q[k])[:, None] for k in ("lo", "width", "hi"))
        at = (s - lo) // width
        # Outside the open bin, or of a query that needs no more counting.
        at[own | (s < lo) | (s >= hi) | (at >= BINS)] = BINS
        flat = (np.arange(len(s))[:, None] * (BINS + 1) + at).ravel()
        n = np.bincount(flat, minlength=len(s) * (BINS + 1)).reshape(len(s), BINS + 1)[:, :BINS]
        if q["block"] not in held and len(held) == HELD:
            yield from rows()
        held[q["block"]] = held[q["block"]] + n if q["block"] in held else n
    yield from rows()


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores at or above each query's edge; of ties on it the k first ids."""
    for q, v, s, own in _pairs(batches):
        edge, single, k = _ids(q["lo"]), _ids(q["width"]) == 1, q["k"]
        take = (s > edge[:, None]) | ((s == edge[:, None]) & ~single[:, None])
        take &= ~own
        tie = (s == edge[:, None]) & single[:, None] & ~own
        order = np.argsort(v["id"], kind="stable")
        nth = np.cumsum(tie[:, order], axis=1)
        take[:, order] |= tie[:, order] & (nth <= k)
        i, j = np.nonzero(take)
        yield pa.RecordBatch.from_pydict({
            "query_id": pa.array(q["id"][i], pa.int64()), "vec_id": pa.array(v["id"][j], pa.int64()),
            "score": pa.array(s[i, j], pa.int64())})


def _refined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Next round's state of each query block from its summed histogram: the
    k-th value's bin, the rows known to lie above it, and whether to go on."""
    for batch in batches:
        for row in batch.to_pylist():
            lo, width, hi, above = (_ids(row[k]).copy() for k in ("lo", "width", "hi", "above"))
            k, done = row["k"], np.frombuffer(row["done"], dtype="u1").astype(bool)
            hist = np.zeros((len(lo), BINS), dtype=np.int64)
            for e in row["hist"] or []:
                hist[e["i"], e["bin"]] = e["n"]
            seen = above[:, None] + np.cumsum(hist[:, ::-1], axis=1)[:, ::-1]
            hit = seen >= k                              # rows at or above the bin's edge
            b = np.where(hit.any(axis=1), BINS - 1 - np.argmax(hit[:, ::-1], axis=1), 0)
            own = np.arange(len(lo))
            new_above = seen[own, b] - hist[own, b]
            few = seen[own, b] <= k + SLACK
            go = ~done
            lo[go] += b[go] * width[go]
            hi[go] = lo[go] + width[go]
            above[go] = new_above[go]
            done |= few | (width == 1)
            # A bin one score wide, or one with few rows, is final.
            width = np.where(go & ~done, -(-width // BINS), np.where(go & few & (width > 1), 2, width))
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([row["block"]], pa.int64()), "lo": [lo.astype("<i8").tobytes()],
                "width": [width.astype("<i8").tobytes()], "hi": [hi.astype("<i8").tobytes()],
                "above": [above.astype("<i8").tobytes()],
                "done": [done.astype("u1").tobytes()], "open": [not done.all()]})


def top_k(df: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id",
          vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each row that
    ``is_query`` selects, among all other rows."""
    spark = df.sparkSession
    groups = slots(spark)
    vectors = integer_vectors(df, id_col, vec_col, scale)
    asked = integer_vectors(df.where(is_query), id_col, vec_col, scale)
    n_blocks, n_asked = -(-df.count() // BLOCK), -(-asked.count() // QUERY_BLOCK)
    # Blocks are cut within tasks, so there are no more tasks than slots.
    deal = lambda n: max(1, min(n, groups))
    blocks = staged(stack(vectors.repartition(deal(n_blocks)), BLOCK), "vector-blocks")
    blocks = blocks.withColumn("g", F.pmod(F.xxhash64("ids"), F.lit(groups)))
    # Cauchy-Schwarz: no score lies beyond the product of the largest norms.
    qblocks = staged(stack(asked.repartition(deal(n_asked)), QUERY_BLOCK), "query-blocks")
    qblocks = staged(qblocks.withColumn("block", F.monotonically_increasing_id()), "query-numbers")
    norms = blocks.groupBy("dim").agg(F.max("norm").alias("far"))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["ids"]) // 8
                reach = min(int(row["norm"] * row["far"]) + 2, EXACT_INT)
                width = np.full(n, -(-(2 * reach + 1) // BINS), dtype="<i8")
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([row["block"]], pa.int64()),
                    "lo": [np.full(n, -reach, dtype="<i8").tobytes()], "width": [width.tobytes()],
                    "hi": [(width * BINS - reach).tobytes()], "above": [np.zeros(n, dtype="<i8").tobytes()],
                    "done": [np.zeros(n, dtype="u1").tobytes()], "open": [True]})

    state_type = "block bigint, lo binary, width binary, hi binary, above binary, done binary, open boolean"
    state = staged(qblocks.join(norms, "dim").select("block", "ids", "norm", "far")
                   .mapInArrow(first, state_type), "topk-state")

    def meet(st: DataFrame) -> DataFrame:
        """Each query block with its state, beside every vector block."""
        q = qblocks.join(st, "block").select(
            *[F.col(c).alias(f"q_{c}") for c in ("dim", "ids", "matrix", "top", "block", "lo", "width", "hi")],
            F.lit(k).alias("q_k"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("g"))
        v = blocks.select(*[F.col(c).alias(f"v_{c}") for c in ("dim", "ids", "matrix", "top")], "g")
        return v.join(q, (v["g"] == q["g"]) & (v["v_dim"] == q["q_dim"])).drop("g")

    while state.where("open").limit(1).count():
        n = (meet(state.where("open")).mapInArrow(_count, "qblock bigint, i int, bin int, n bigint")
             .groupBy("qblock", "i", "bin").agg(F.sum("n").alias("n")))
        per_block = n.groupBy("qblock").agg(F.collect_list(F.struct("i", "bin", "n")).alias("hist"))
        rounds = (state.where("open").join(per_block, F.col("block") == F.col("qblock"), "left")
                  .select("block", "lo", "width", "hi", "above", "done", F.lit(k).alias("k"), "hist")
                  .mapInArrow(_refined, state_type))
        state = staged(rounds.unionByName(state.where("not open")), "topk-state")

    found = meet(state).mapInArrow(_emit, "query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op4_top_k(spark, sf_dir: str) -> DataFrame:
    from kasir.llm.common import prepare, table
    prepare(spark, arrow_rows=64)        # a joined row holds two blocks
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


# DuckDB twin of op4_top_k.
OP4_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([q.e[i] * c.e[i] FOR i IN range(1, len(q.e) + 1)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 100 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
