"""Merkle manifest against a plain recursive one."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, duck
from llm_fixtures import TEXTS, llm  # noqa: F401
from kasir.llm import merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, tree string, pos string, level int"
RNG = random.Random(5)
ROWS = ([(i, RNG.choice([None, "", "a", "b", "é", "Z"]), None if j % 7 == 0 else "en", j, t)
         for j, (i, t) in enumerate(TEXTS)]
        + [(100 + i, "hot", "de", i, f"line {i}\nend") for i in range(200)]
        + [(50, "hot", None, None, None)] * 3 + [(None, None, None, None, None)] * 2
        + [(60, "hot", "de", 1, t) for t in ("x\ny", "xy", "x\ny")] + [(400, "lone", "de", 2, "a\nb")])


def h(s: str) -> str:
    return sha256(s.encode()).hexdigest()


def leaf(row) -> str:
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def up(level):
    return [level[i:i + 3] for i in range(0, len(level), 3)]


def path(nodes, i):
    """(siblings, last node) of the i-th node."""
    out = []
    while len(nodes) > 1:
        run = up(nodes)[i // 3]
        out += run[:i % 3] + run[i % 3 + 1:]
        nodes, i = [h("".join(r)) for r in up(nodes)], i // 3
    return out, nodes[0]


def folded(nodes, i, digest):
    nodes = [*nodes]
    nodes[i] = digest
    return path(nodes, 0)[1]


def brute(rows):
    trees: dict = {}
    for r in rows:
        trees.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    levels = {s: sorted(trees[s], key=lambda x: x[:3]) for s in names}
    subroots = [path([x[2] for x in levels[s]], 0)[1] for s in names]
    root = path(subroots, 0)[1]
    out = []
    for k, s in enumerate(names):
        own = [x[2] for x in levels[s]]
        for i, (_, _, digest, r) in enumerate(levels[s]):
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            text = r[4].replace("\n", "") if even and r[4] is not None else r[4]
            proof = path(own, i)[0] + path(subroots, k)[0]
            again = folded(subroots, k, folded(own, i, leaf((*r[:4], text))))
            out.append((r[0], digest, subroots[k], root, h("".join(proof)), again, again == root))
    return sorted(out, key=repr)


def run(llm, rows, tmp_path):
    at = str(tmp_path / "in")
    llm.createDataFrame([(*r, "x", "y", 3) for r in rows], SCHEMA).repartition(3).write.parquet(f"{at}/documents.parquet")
    return sorted((tuple(r) for r in merkle.op11_merkle_manifest(llm, at).collect()), key=repr)


@pytest.mark.parametrize("tier", [1, 2, 8])
def test_manifest_of_awkward_rows(llm, tmp_path, monkeypatch, tier):
    monkeypatch.setattr(merkle, "TIER", tier)
    monkeypatch.setattr(merkle, "BLOCK", 3 ** tier)
    assert run(llm, ROWS, tmp_path) == brute(ROWS)


def test_lone_row_and_no_rows(llm, tmp_path):
    one = [(4, "a", "en", 3, "a\nb")]
    assert run(llm, one, tmp_path / "one") == brute(one)
    assert run(llm, [], tmp_path / "none") == []


def test_query_against_sql(llm):
    res = duck(SF_SMALL).execute(merkle.OP11_SQL)
    cols = [d[0] for d in res.description]
    got = merkle.op11_merkle_manifest(llm, SF_SMALL).select(*cols).collect()
    assert sorted(map(tuple, got)) == sorted(res.fetchall())


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28])
def test_requests_are_complete_and_minimal(n):
    """With the fetched nodes each proof is whole; none of them could be left
    out, and none follows from the leaves."""
    nodes = [[h(str(i)) for i in range(n)]]
    while len(nodes[-1]) > 1:
        nodes.append([h("".join(r)) for r in up(nodes[-1])])
    for known in ([0], [n - 1], list(range(n)), random.Random(n).sample(range(n), -(-n // 2))):
        need = list(merkle.missing(known, n))
        assert len(need) == len(set(need))
        fetched = {c: nodes[c[0]][c[1]] for c in need}
        runs, last = merkle.runs_of({i: nodes[0][i] for i in known}, n, fetched)
        assert last == nodes[-1][0]
        for i in known:
            assert merkle.siblings(i, runs, [], {}) == path(nodes[0], i)[0]
        for c in need:
            with pytest.raises(KeyError):
                merkle.runs_of({i: nodes[0][i] for i in known}, n, {k: v for k, v in fetched.items() if k != c})
    if n > 1:
        assert list(merkle.missing(range(n), n)) == []


def test_proofs_of_some_leaves(llm):
    """Proofs of a few rows alone, with their digests, fold to the root."""
    docs = llm.createDataFrame([(*r, "x", "y", 3) for r in ROWS], SCHEMA)
    tree = merkle.build(docs)
    some = tree.leaves.where((F.col("tree") == "shot") & (F.col("pos") % 9 == 4))
    got = merkle.prove(tree, some, with_proofs=True).join(some.select("tree", "pos", "n", "s", "m"), ["tree", "pos"])
    rows = got.collect()
    assert len(rows) == some.count() > 3
    for r in rows:
        assert r.folded_root == tree.root == merkle.fold(r.leaf, r.proof, r.pos, r.n, r.s, r.m)
        assert r.proof_sha256 == h("".join(r.proof))
        assert merkle.fold(h("other"), r.proof, r.pos, r.n, r.s, r.m) != tree.root
