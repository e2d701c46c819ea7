"""Approximate nearest neighbours by cosine: robust-pruned directed graphs.

Equal vectors are one node, so a vector that a third of all rows repeat neither
fills a shard nor floods a neighbourhood; a node lists the smallest ids of its
rows, as many as an answer can need. Nodes are dealt into shards of about
``SHARD`` by a hash of the vector, and one task builds the graph of a shard:

* nodes enter in random order, in batches that double up to a share of the
  shard; a greedy search from the entry point proposes each one's neighbours
  (all nodes the search expanded);
* relaxed distance pruning keeps, of the proposed ones, the nearest first, and
  drops every other that is nearer to a kept one, by the factor ``ALPHA``, than
  to the node itself; at most ``DEGREE`` diverse edges remain;
* each edge is entered backward too, and a node with more than ``ROOM`` edges is
  pruned again. A second pass over all nodes repairs early choices.

The index is a table with one row per shard. A search sends query blocks to the
groups of shards; a task holds the shards of its group (a bounded number) and
lets the query blocks stream by. In each shard a beam search of width ``BEAM``
walks the graph; the nodes in the final beam are scored exactly, in float64 on
the original vectors. Every shard's best are merged per query.

Every row is indexed; nothing is sampled. Recall is measured in tests/llm.

Defined results: vectors that are null, zero, or hold a null or a non-finite
component take no part; nor do null ids. Vectors are compared only with those of
the same length. A row repeated with the same id and vector counts once; an id
on several vectors is several candidates, and several queries if it is one.
Rows with the query's own id are never its candidates. Ties go to the smaller
id. Fewer than k candidates in reach: all that were found. Extra columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kasir.llm.common import slots, staged

DEGREE = 32             # edges that pruning leaves a node, at most
ROOM = 48               # edges of a node, at most: pruned to DEGREE beyond
BUILD_BEAM = 48         # beam of the searches that propose neighbours
BEAM = 128              # beam of a query
ALPHA = 1.2
SHARD = 8192            # nodes of a shard, about
HELD = 4                # shards that a searching task holds at once, about
QUERY_BLOCK = 256
GROWTH = 16             # a batch enters at most 1/16 of the shard at once
CELLS = 1 << 24         # cells of a working array, about

NODE = "shard long, dim int, vector binary, ids array<bigint>"
GRAPH = "shard long, dim int, n int, vectors binary, edges binary, entry int, ids binary, counts binary"
FOUND = "query long, query_id long, vec_id long, score double"


# --- nodes -----------------------------------------------------------------------


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v): vectors that take part, in double precision."""
    x = F.col(vec_col)
    fine = (F.col(id_col).isNotNull() & F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
        & F.exists(x, lambda e: e != F.lit(0.0)))
    return df.where(F.coalesce(fine, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda e: e.cast("double")).alias("v"))


def distinct_nodes(vectors: DataFrame, k: int) -> DataFrame:
    """(v, ids): one row per distinct vector with its k + 1 smallest ids: without
    the query's own id, k are left. Ids are ranked under a salt first, so that a
    vector held by a third of all rows is spread over tasks."""
    n = slots(vectors.sparkSession)
    rows = vectors.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(n)))
    for key in (["v", "salt"], ["v"]):
        w = Window.partitionBy(*key).orderBy("vec_id")
        # Repeated rows have one rank, so they count once.
        rows = rows.withColumn("nth", F.dense_rank().over(w)).where(F.col("nth") <= k + 1).drop("nth")
        rows = rows.dropDuplicates([*key, "vec_id"])
    return rows.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


# --- graphs ----------------------------------------------------------------------


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component near 1:
    exact, and no square overflows or vanishes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def unit(x: np.ndarray) -> np.ndarray:
    s = scaled(x)
    return (s / np.sqrt((s * s).sum(axis=1, keepdims=True))).astype(np.float32)


def beam_search(x: np.ndarray, edges: np.ndarray, entry: int, asked: np.ndarray, width: int,
                keep_expanded: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """(beam, expanded): node numbers, -1 where there are fewer. All queries
    take their steps together; each expands its nearest unexpanded node until
    its beam holds none. ``x`` and ``asked`` are unit vectors, so a larger
    product is nearer."""
    b, n = len(asked), len(x)
    seen = np.zeros((b, n + 1), dtype=bool)         # the last column takes -1
    seen[:, entry] = seen[:, n] = True
    ids = np.full((b, width), -1)
    near = np.full((b, width), -np.inf, dtype=np.float32)
    done = np.ones((b, width), dtype=bool)
    ids[:, 0], near[:, 0], done[:, 0] = entry, asked @ x[entry], False
    expanded, rows = [], np.arange(b)
    while len(rows):
        at = np.argmax(np.where(done[rows], -np.inf, near[rows]), axis=1)
        now = ids[rows, at]
        done[rows, at] = True
        if keep_expanded:
            step = np.full(b, -1)
            step[rows] = now
            expanded.append(step)
        new = edges[now]
        known = seen[rows[:, None], new]
        seen[rows[:, None], new] = True
        got = np.einsum("ij,ikj->ik", asked[rows], x[new])
        got[known] = -np.inf
        all_near = np.concatenate([near[rows], got], axis=1)
        top = np.argpartition(-all_near, width - 1, axis=1)[:, :width]
        near[rows] = np.take_along_axis(all_near, top, axis=1)
        ids[rows] = np.take_along_axis(np.concatenate([ids[rows], np.where(known, -1, new)], axis=1), top, axis=1)
        done[rows] = np.take_along_axis(np.concatenate([done[rows], known], axis=1), top, axis=1)
        rows = rows[~done[rows].all(axis=1)]
    return ids, np.stack(expanded, axis=1) if expanded else None


def once_each(nodes: np.ndarray, proposed: np.ndarray) -> np.ndarray:
    """``proposed`` without the node itself and repeats, -1 last."""
    own = np.sort(np.where(proposed == nodes[:, None], -1, proposed), axis=1)[:, ::-1].copy()
    repeat = own[:, 1:] == own[:, :-1]
    own[:, 1:][repeat] = -1
    return np.sort(own, axis=1)[:, ::-1]


def robust_prune(x: np.ndarray, nodes: np.ndarray, own: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """(nodes, degree) edges chosen from ``own`` (-1: none)."""
    vec = x[own]
    # Distances of unit vectors from their products.
    far = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ikj->ik", x[nodes], vec), 0))
    between = np.sqrt(np.maximum(2 - 2 * np.matmul(vec, vec.transpose(0, 2, 1)), 0))
    left = own >= 0
    out = np.full((len(nodes), degree), -1)
    rows = np.arange(len(nodes))
    for j in range(degree):
        at = np.argmin(np.where(left, far, np.inf), axis=1)
        any_left = left[rows, at]
        if not any_left.any():
            break
        out[:, j] = np.where(any_left, own[rows, at], -1)
        left &= alpha * between[rows, at] > far
        left[rows, at] = False
    return out


def pruned(x: np.ndarray, nodes: np.ndarray, proposed: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """``robust_prune`` of all that is proposed, in parts of bounded memory."""
    own = once_each(nodes, proposed)
    own = own[:, :max(1, int((own >= 0).sum(axis=1).max(initial=0)))]
    c = own.shape[1]
    step = max(1, CELLS // (c * max(c, x.shape[1])))
    return np.concatenate([robust_prune(x, nodes[i:i + step], own[i:i + step], degree, alpha)
                           for i in range(0, len(nodes), step)])


def add_backward(x: np.ndarray, edges: np.ndarray, nodes: np.ndarray, degree: int, alpha: float) -> None:
    """Enter the edges of ``nodes`` backward, pruning where they are too many.
    A node with many new edges takes them in several turns."""
    room = edges.shape[1]
    to = edges[nodes].ravel()
    frm = np.repeat(nodes, room)
    frm, to = frm[to >= 0], to[to >= 0]
    order = np.lexsort((frm, to))
    frm, to = frm[order], to[order]
    starts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else np.zeros(0, int)
    nth = np.arange(len(to)) - np.repeat(starts, np.diff(np.r_[starts, len(to)]))
    turn = nth // room
    for t in range(int(turn.max(initial=-1)) + 1):
        a, b, k = frm[turn == t], to[turn == t], nth[turn == t] % room
        who, at = np.unique(b, return_inverse=True)
        extra = np.full((len(who), room), -1)
        extra[at, k] = a
        both = once_each(who, np.concatenate([edges[who], extra], axis=1))
        full = both[:, room] >= 0
        edges[who[~full]] = both[~full, :room]
        if full.any():
            edges[who[full], :degree] = pruned(x, who[full], both[full], degree, alpha)
            edges[who[full], degree:] = -1


def build_graph(x: np.ndarray, degree: int, width: int, alpha: float, room: int = ROOM,
                seed: int = 11) -> tuple[np.ndarray, int]:
    """(edges, entry point) over unit vectors; -1 stands for 'none'."""
    n = len(x)
    padded = np.concatenate([x, np.zeros((1, x.shape[1]), np.float32)])     # x[-1]
    entry = int(np.argmax(x @ x.mean(axis=0)))
    edges = np.full((n + 1, max(room, degree)), -1)
    order = np.random.default_rng(seed).permutation(n)
    for one_pass, a in ((0, 1.0), (1, alpha)):
        lo = 0
        while lo < n:
            size = max(1, n // GROWTH) if one_pass else min(max(lo, 1), max(1, n // GROWTH))
            size = min(size, max(1, CELLS // (n + 1)))
            nodes = order[lo:lo + size]
            _, expanded = beam_search(padded[:-1], edges, entry, x[nodes], width, keep_expanded=True)
            edges[nodes, :degree] = pruned(padded, nodes, np.concatenate([expanded, edges[nodes]], axis=1), degree, a)
            edges[nodes, degree:] = -1
            add_backward(padded, edges, nodes, degree, a)
            lo += size
    return edges[:-1], entry


def build_index(df: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding", shard: int = SHARD,
                degree: int = DEGREE, width: int = BUILD_BEAM, alpha: float = ALPHA) -> DataFrame:
    """One row per shard: its vectors, edges, entry point and ids. ``k`` is the
    largest number of neighbours that will be asked for."""
    nodes = staged(distinct_nodes(usable(df, id_col, vec_col), k), "graph-nodes")
    n_shards = max(1, -(-nodes.count() // shard))
    dealt = nodes.select(F.pmod(F.xxhash64("v"), F.lit(n_shards)).alias("shard"), F.size("v").alias("dim"), "v", "ids")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def graph(key, vectors, ids) -> pa.RecordBatch:
            x = np.array(vectors, dtype="<f8")
            edges, entry = build_graph(unit(x), degree, width, alpha)
            return pa.RecordBatch.from_pydict({
                "shard": [key[0]], "dim": pa.array([key[1]], pa.int32()), "n": pa.array([len(x)], pa.int32()),
                "vectors": [x.tobytes()], "edges": [edges.astype("<i4").tobytes()],
                "entry": pa.array([entry], pa.int32()), "ids": [np.concatenate(ids).astype("<i8").tobytes()],
                "counts": [np.array([len(i) for i in ids], dtype="<i4").tobytes()]})

        key, vectors, ids = None, [], []
        for b in batches:
            for *now, v, i in zip(*(c.to_pylist() for c in b.columns)):
                if now != key:
                    if vectors:
                        yield graph(key, vectors, ids)
                    key, vectors, ids = now, [], []
                vectors.append(v)
                ids.append(i)
        if vectors:
            yield graph(key, vectors, ids)

    placed = dealt.repartitionById(n_shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "dim", "v")
    return staged(placed.mapInArrow(build, GRAPH), "graph-index")


# --- search ----------------------------------------------------------------------


class Shard:
    def __init__(self, row: dict):
        n, dim = row["n"], row["dim"]
        self.dim, self.entry = dim, row["entry"]
        self.vectors = scaled(np.frombuffer(row["vectors"], dtype="<f8").reshape(n, dim))
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.x = np.concatenate([unit(self.vectors), np.zeros((1, dim), np.float32)])
        edges = np.frombuffer(row["edges"], dtype="<i4").reshape(n, -1).astype(np.int64)
        self.edges = np.concatenate([edges, np.full((1, edges.shape[1]), -1)])
        counts = np.frombuffer(row["counts"], dtype="<i4")
        self.ids, self.first = np.frombuffer(row["ids"], dtype="<i8"), np.r_[0, np.cumsum(counts)]

    def search(self, ids: np.ndarray, vectors: np.ndarray, k: int, width: int) -> Iterator[tuple[int, int, float]]:
        """(query's place, vec_id, score) of the k best found for each query."""
        q = scaled(vectors)
        norms = np.sqrt((q * q).sum(axis=1))
        step = max(1, CELLS // len(self.x))
        for lo in range(0, len(q), step):
            beam, _ = beam_search(self.x[:-1], self.edges, self.entry, unit(q[lo:lo + step]), width)
            for i, found in enumerate(beam, lo):
                found = found[found >= 0]
                score = (self.vectors[found] * q[i]).sum(axis=1) / (self.norms[found] * norms[i])
                best = [(-s, int(m)) for s, f in zip(score.tolist(), found.tolist())
                        for m in self.ids[self.first[f]:self.first[f + 1]] if m != ids[i]]
                yield from ((i, m, -s) for s, m in sorted(best)[:k])


def search(index: DataFrame, asked: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
           width: int = BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each distinct
    (id, vector) of ``asked``."""
    spark = index.sparkSession
    queries = usable(asked, id_col, vec_col).dropDuplicates(["vec_id", "v"])
    queries = staged(queries.withColumn("query", F.monotonically_increasing_id()), "graph-queries")
    # So many groups that each holds a few shards.
    n_shards = index.count()
    groups = max(1, min(slots(spark), n_shards), -(-n_shards // HELD))
    shards = index.select(F.pmod(F.col("shard"), F.lit(groups)).alias("g"), F.lit(0).alias("kind"), "dim", "shard",
                          "n", "vectors", "edges", "entry", "ids", "counts",
                          F.lit(None).cast("long").alias("query"), F.lit(None).cast("array<double>").alias("v"))
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (
        ("n", "int"), ("vectors", "binary"), ("edges", "binary"), ("entry", "int"), ("ids", "binary"),
        ("counts", "binary"))]
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("g")
    sent = queries.select(every, F.lit(1).alias("kind"), F.size("v").alias("dim"), F.col("vec_id").alias("shard"),
                          *nothing, "query", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[Shard]] = {}
        waiting: list[tuple] = []

        def answers() -> Iterator[pa.RecordBatch]:
            by_dim: dict[int, list] = {}
            for w in waiting:
                by_dim.setdefault(len(w[2]), []).append(w)
            waiting.clear()
            for dim, rows in by_dim.items():
                ids = np.array([r[1] for r in rows])
                vectors = np.array([r[2] for r in rows])
                for s in held.get(dim, []):
                    got = list(s.search(ids, vectors, k, width))
                    at, vec, score = zip(*got) if got else ((), (), ())
                    yield pa.RecordBatch.from_pydict({
                        "query": pa.array([rows[i][0] for i in at], pa.int64()),
                        "query_id": pa.array(ids[list(at)] if at else [], pa.int64()),
                        "vec_id": pa.array(vec, pa.int64()), "score": pa.array(score, pa.float64())})

        group = None
        for b in batches:
            for row in b.to_pylist():
                if row["g"] != group:
                    yield from answers()
                    group, held = row["g"], {}
                if row["kind"] == 0:
                    held.setdefault(row["dim"], []).append(Shard(row))
                else:
                    waiting.append((row["query"], row["shard"], row["v"]))
                    if len(waiting) == QUERY_BLOCK:
                        yield from answers()
        yield from answers()

    together = (shards.unionByName(sent).repartitionById(groups, F.col("g").cast("int"))
                .sortWithinPartitions("g", "kind", "shard"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc("vec_id"))
    return (together.mapInArrow(run, FOUND).withColumn("rank", F.row_number().over(best))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def nearest(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
            **options) -> DataFrame:
    """Index all rows of ``df`` and search it for the rows ``is_query`` selects."""
    index = build_index(df, k, id_col, vec_col, **options)
    return search(index, df.where(is_query), k, id_col, vec_col)


def op13_graph_neighbours(spark, sf_dir: str) -> DataFrame:
    from kasir.llm.common import prepare, table
    prepare(spark, arrow_rows=64)        # a row can hold a shard
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
