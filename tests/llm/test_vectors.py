"""Centroid clustering against brute force, graph search by its recall."""

import math
import random
from hashlib import sha256

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL, duck
from llm_fixtures import llm  # noqa: F401
from kasir.llm import centroids, graph_index

NAN, INF = float("nan"), float("inf")
VEC = "vec_id bigint, embedding array<double>, cluster string, rank string, score double, v int, g string"


def frame(llm, rows):
    return llm.createDataFrame([(i, v, "x", "y", 1.0, 2, "z") for i, v in rows], VEC).repartition(3)


# --- centroids -------------------------------------------------------------------


def brute_clusters(rows, k, rounds, dim, scale, seed):
    vecs = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    starts = sorted((sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in vecs if i is not None)[:k]
    cents = [v for _, v in starts]
    if not cents:
        return []

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))

    for _ in range(rounds):
        own = [near(v)[1] for _, v in vecs]
        cents = [[sum(col) // len(col) for col in zip(*[v for (_, v), w in zip(vecs, own) if w == n])]
                 if n in own else c for n, c in enumerate(cents)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in vecs), key=repr)


def clusters(llm, rows, **kw):
    got, _ = centroids.cluster(frame(llm, rows), **kw)
    return sorted(((r.vec_id, r.cluster, r.distance) for r in got.collect()), key=repr)


def awkward(rng, dim):
    rows = [(i, [rng.uniform(-2, 2) for _ in range(dim)]) for i in range(150)]
    rows += [(200 + i, [0.5] * dim) for i in range(80)]                     # a third ties
    rows += [(3, [1.0] * dim), (3, [1.0] * dim), (3, [-1.0] * dim), (None, [0.25] * dim), (None, [9.0] * dim)]
    return rows + [(400, None), (401, []), (402, [1.0] * (dim + 1)), (403, [None] + [1.0] * (dim - 1)),
                   (404, [NAN] * dim), (405, [INF] * dim), (406, [0.0] * dim), (407, [-1e3] * dim)]


@pytest.mark.parametrize("dim", [1, 3, 8])
def test_clusters_against_brute_force(llm, dim):
    rows = awkward(random.Random(dim), dim)
    kw = dict(k=7, rounds=3, dim=dim, scale=16, seed=2)
    assert clusters(llm, rows, **kw) == brute_clusters(rows, **kw)


def test_few_or_no_vectors(llm):
    kw = dict(k=7, rounds=2, dim=2, scale=16, seed=2)
    for rows in ([(1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [-1.0, 3.0])], [(1, [0.5, 0.5])], [],
                 [(None, [1.0, 1.0])], [(1, None)]):
        assert clusters(llm, rows, **kw) == brute_clusters(rows, **kw)


def test_large_components_are_refused(llm):
    with pytest.raises(Exception, match="too large to be clustered"):
        clusters(llm, [(1, [1e300, 0.0]), (2, [0.0, 0.0])], k=2, rounds=1, dim=2, scale=16, seed=2)


def test_walk_finds_the_nearest_and_stops_early():
    rng = np.random.default_rng(1)
    for cents, x in ((rng.integers(-9, 9, (40, 3)), rng.integers(-9, 9, (500, 3))),      # many ties
                     (np.repeat(rng.integers(-9, 9, (5, 6)), 8, axis=0), rng.integers(-9, 9, (300, 6))),
                     (rng.integers(-10**6, 10**6, (40, 4)), rng.integers(-10**6, 10**6, (500, 4)))):
        walker = centroids.Walker(cents)
        who, best = walker.nearest(x)
        d = ((x[:, None, :] - cents[None]) ** 2).sum(axis=2)
        assert (best == d.min(axis=1)).all() and (who == d.argmin(axis=1)).all()
        assert walker.steps < x.size * len(cents)


def test_cluster_query_against_sql(llm):
    res = duck(SF_SMALL).execute(centroids.OP12_SQL)
    cols = [d[0] for d in res.description]
    got = centroids.op12_centroids(llm, SF_SMALL).select(*cols).collect()
    assert sorted(map(tuple, got)) == sorted(res.fetchall())


# --- graph search ----------------------------------------------------------------


def brute_nearest(rows, k, is_query):
    vecs = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and any(v)
            and all(x is not None and math.isfinite(x) for x in v)}
    out = []

    def cosine(a, b):
        a, b = ([math.ldexp(x, -math.frexp(max(map(abs, v)))[1]) for x in v] for v in (a, b))
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b))

    for q, a in vecs:
        if is_query(q):
            best = sorted((-round(cosine(a, b), 12), i) for i, b in vecs if i != q and len(a) == len(b))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def found(llm, rows, k, **options):
    got = graph_index.nearest(frame(llm, rows), F.col("vec_id") % 5 == 0, k, **options).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 12)) for r in got)


def test_small_tables_are_answered_exactly(llm):
    """A beam that holds a whole shard finds everything: nulls, odd vectors,
    ties, repeated rows and ids, other lengths, huge and tiny components."""
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-2, 2) for _ in range(6)]) for i in range(60)]
    rows += [(100 + i, [0.5] * 6) for i in range(90)]
    rows += [(7, rows[7][1]), (10, rows[10][1]), (11, [1.0, 2.0, 3.0, -4.0, 0.0, 0.0]), (45, [3.0, -1.0, 0.0, 0.0, 0.0, 1.0])]
    rows += [(300, None), (305, []), (310, [None] * 6), (315, [NAN] * 6), (320, [INF] * 6), (325, [0.0] * 6),
             (None, [1.0] * 6), (330, [1e200, -1e200, 0.0, 1e199, 0.0, 5e199]), (335, [1e-300] * 5 + [0.0]),
             (340, [1.0, 0.0]), (341, [0.0, 2.0]), (345, [1.0, 1.0])]
    for shard in (1000, 25):
        assert found(llm, rows, 4, shard=shard) == brute_nearest(rows, 4, lambda i: i % 5 == 0)


def test_lone_and_no_vectors(llm):
    assert found(llm, [(0, [1.0, 0.5])], 5) == []
    assert found(llm, [], 5) == []
    assert found(llm, [(0, [1.0, 0.5]), (5, [1.0, 0.5])], 5) == [(0, 1, 5, 1.0), (5, 1, 0, 1.0)]


def test_pruning_keeps_diverse_edges():
    """The nearest proposal stays; a proposal nearer to a kept one, by the
    factor, goes; equal and own entries never stay twice."""
    x = graph_index.unit(np.random.default_rng(2).normal(size=(60, 5)))
    padded = np.concatenate([x, np.zeros((1, 5), np.float32)])
    nodes = np.arange(10)
    proposed = np.random.default_rng(3).integers(-1, 60, (10, 40))
    out = graph_index.pruned(padded, nodes, proposed, 6, 1.2)
    d = np.sqrt(np.maximum(2 - 2 * x @ x.T, 0))
    for p in nodes:
        left = sorted({int(c) for c in proposed[p]} - {-1, int(p)}, key=lambda c: d[p, c])
        want = []
        while left and len(want) < 6:
            want.append(left[0])
            left = [c for c in left[1:] if 1.2 * d[want[-1], c] > d[p, c]]
        assert [c for c in out[p] if c >= 0] == want


@pytest.mark.parametrize("sf, shard", [(SF_MID, 8192), ("/root/testdata/sf0.1", 700)])
def test_recall_of_the_query(llm, monkeypatch, sf, shard):
    got = graph_index.nearest(llm.read.parquet(f"{sf}/embeddings.parquet"), F.col("vec_id") % 50 == 0, shard=shard)
    rows = got.collect()
    table = pq.read_table(f"{sf}/embeddings.parquet")
    ids, x = np.array(table["vec_id"]), np.array(table["embedding"].to_pylist(), dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    place = {i: n for n, i in enumerate(ids.tolist())}
    want = set()
    for i in ids[ids % 50 == 0].tolist():
        s = x @ x[place[i]]
        want |= {(i, m) for _, m in sorted((-s[place[j]], j) for j in ids.tolist() if j != i)[:5]}
    assert len(rows) == len(want)
    assert len(want & {(r.query_id, r.vec_id) for r in rows}) >= 0.97 * len(want)
    for r in rows[:50]:
        assert abs(r.score - float(x[place[r.query_id]] @ x[place[r.vec_id]])) < 1e-12
