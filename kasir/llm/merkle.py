"""Merkle manifest of a dataset, with octopus multiproofs.

Every row is a leaf: the SHA-256 of its fields in canonical form. The leaves of
one source, in id order, form a tree in which runs of ``ARITY`` nodes become
their digest; the sources' roots form the tree above in the same way.

* Positions. Leaves are dealt by range of (source, id, digest) and numbered
  within their range; ranges are then shifted by the rows of the source before
  them. A source that holds a third of all rows spans many ranges.
* Trees. A task hashes ``TIER`` levels of one block of ``ARITY ** TIER`` nodes
  at a time, so that the number of rounds is the logarithm to base 6561.
* Proofs. A leaf partition is a block of wanted leaves. It works out the minimal
  union of node coordinates that its leaves' proofs need and that it cannot
  derive itself; all partitions' coordinates are fetched in one join; then each
  derives the interior nodes its proofs share and expands every leaf's own
  proof locally. A node near the root is asked for by many partitions: requests
  are salted, and each (node, salt) is looked up once.

Defined results: a null field is ``-``, so it differs from an empty one. Leaves
with a null source are a tree of their own, the first one. Null ids come first;
repeated ids are ordered by digest. Rows repeated in every field are separate
leaves with one digest. A text of any length is hashed whole, on the JVM side;
only digests are shuffled. Extra columns are ignored. An empty table has no
root, no leaf and no proof.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kasir.llm.common import slots, staged

ARITY = 3
TIER = 8                        # levels hashed by one task
BLOCK = ARITY ** TIER           # nodes of one block
ROWS = 4000                     # rows sent back at once, about
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# Keys of the trees, in the order of their roots: the null source, then the
# others bytewise; the tree above them has a key of its own.
NULL_TREE, NAMED_TREE, TOP_TREE = "n", "s", "t"

NODE = "tree string, level int, idx bigint, digest string, n bigint"
NEED = "tree string, block bigint, ntree string, level int, idx bigint"
PROVED = ("tree string, pos bigint, id bigint, leaf string, subroot string, proof array<string>, "
          "proof_sha256 string, folded_root string")


def field(c: Column) -> Column:
    """``-`` when null, else UTF-8 byte count, ``:`` and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def row_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


def H(parts: Sequence[str]) -> str:
    return sha256("".join(parts).encode("ascii")).hexdigest()


# --- positions -------------------------------------------------------------------


def spans(rows: DataFrame) -> DataFrame:
    """(tree, part, shift, n) of numbered rows: what turns ``seq`` into the
    position in the tree, and the tree's size. A row per range and tree."""
    ranges = rows.groupBy("tree", F.shiftright("seq", 33).alias("part")).agg(
        F.min("seq").alias("lo"), F.count("*").alias("rows"))
    w = Window.partitionBy("tree").orderBy("part")
    before = F.coalesce(F.sum("rows").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return ranges.select("tree", "part", (before - F.col("lo")).alias("shift"),
                         F.sum("rows").over(Window.partitionBy("tree")).alias("n"))


def numbered(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows``, sorted over ranges, with ``seq``: consecutive in each range."""
    keys = [F.col(c).asc_nulls_first() for c in order]
    dealt = rows.repartitionByRange(slots(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    return staged(dealt.withColumn("seq", F.monotonically_increasing_id()), name)


def placed(rows: DataFrame, at: DataFrame) -> DataFrame:
    """Numbered rows with their ``pos`` and whatever else ``at`` holds."""
    return (rows.withColumn("part", F.shiftright("seq", 33)).join(at, ["tree", "part"])
            .withColumn("pos", F.col("seq") + F.col("shift")).drop("seq", "part", "shift"))


# --- trees -----------------------------------------------------------------------


def in_blocks(rows: DataFrame, *within: str) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", *within)


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """((tree, block), rows) of batches sorted by their first two columns."""
    key, held = None, []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if row[:2] != key:
                if held:
                    yield key, held
                key, held = row[:2], []
            held.append(row[2:])
    if held:
        yield key, held


def batches_of(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= ROWS:
            yield batch()
            held = []
    if held:
        yield batch()


def hash_tier(rows: DataFrame, level: int) -> DataFrame:
    """Nodes of the ``TIER`` levels above ``level`` from its rows (tree, pos,
    digest, n), where n is the number of the tree's leaves."""
    schema = pa.schema([("tree", pa.string()), ("level", pa.int32()), ("idx", pa.int64()),
                        ("digest", pa.string()), ("n", pa.int64())])

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (tree, block), held in groups(batches):
            n = held[0][2]
            run, first = [d for _, d, _ in held], block * BLOCK
            for up in range(level + 1, level + TIER + 1):
                if n <= ARITY ** (up - 1):          # one node was left below
                    break
                run = [H(run[i:i + ARITY]) for i in range(0, len(run), ARITY)]
                first //= ARITY
                yield from ((tree, up, first + i, d, n) for i, d in enumerate(run))

    dealt = in_blocks(rows.select("tree", F.expr(f"pos div {BLOCK}").alias("block"), "pos", "digest", "n"), "pos")
    return dealt.mapInArrow(lambda b: batches_of(nodes(b), schema), NODE)


def hash_tree(leaves: DataFrame, most: int, name: str) -> list[DataFrame]:
    """All nodes above ``leaves`` (tree, pos, digest, n), a staged table per
    tier; ``most`` is the size of the largest tree."""
    tiers, level, rows = [], 0, leaves
    while most > ARITY ** level:
        tiers.append(staged(hash_tier(rows, level), f"{name}-nodes"))
        level += TIER
        rows = tiers[-1].where((F.col("level") == level) & (F.col("n") > ARITY ** level)).select(
            "tree", F.col("idx").alias("pos"), "digest", "n")
    return tiers


def last_nodes(leaves: DataFrame, tiers: list[DataFrame]) -> DataFrame:
    """(tree, digest) of each tree's last remaining node."""
    out = leaves.where("n = 1").select("tree", "digest")
    for t in tiers:
        # The lowest level at which one node is left.
        low = F.pow(F.lit(float(ARITY)), F.col("level").cast("double"))
        out = out.unionAll(t.where((F.col("idx") == 0) & (F.col("n") <= low)).select("tree", "digest"))
    return out


@dataclass
class Manifest:
    """``leaves``: (tree, pos, n, s, m, id, digest, claimed), n leaves in the
    tree, which is the s-th of m; ``tiers`` and ``tops``: nodes of the sources'
    trees and of the tree above, whose leaves are ``roots``."""

    leaves: DataFrame
    tiers: list[DataFrame]
    roots: DataFrame
    tops: list[DataFrame]
    root: str | None


def build(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id",
          source_col: str = "source", claimed: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``. ``claimed`` replaces fields of the rows that
    someone later presents for verification (by default the rows themselves)."""
    source = F.col(source_col).cast("string")
    cols = {c: F.col(f"`{c}`") for c in fields}
    rows = docs.select(
        F.coalesce(F.concat(F.lit(NAMED_TREE), source), F.lit(NULL_TREE)).alias("tree"),
        F.col(id_col).cast("long").alias("id"), row_digest(list(cols.values())).alias("digest"),
        row_digest(list({**cols, **(claimed or {})}.values())).alias("claimed"))
    # Rows equal in every field are told apart by their place, so that many of
    # them still spread over ranges.
    rows = staged(rows, "merkle-leaves").withColumn("row", F.monotonically_increasing_id())
    rows = numbered(rows, ("tree", "id", "digest", "claimed", "row"), "merkle-numbered").drop("row")
    at = staged(spans(rows), "merkle-spans")

    trees = at.groupBy("tree").agg(F.max("n").alias("leaves")).select(
        F.lit(TOP_TREE).alias("tree"), F.col("tree").alias("source"), "leaves")
    order = numbered(trees, ("tree", "source"), "merkle-sources")
    tree_at = staged(placed(order, spans(order)).select(
        F.col("source").alias("tree"), F.col("pos").alias("s"), F.col("n").alias("m"), "leaves"), "merkle-order")
    sizes = tree_at.agg(F.max("leaves").alias("n"), F.max("m").alias("m")).first()

    leaves = staged(placed(rows, at.join(tree_at.drop("leaves"), "tree")), "merkle-placed")
    level0 = leaves.select("tree", "pos", "digest", "n")
    tiers = hash_tree(level0, sizes["n"] or 0, "merkle")
    roots = staged(last_nodes(level0, tiers).join(tree_at, "tree").select(
        F.lit(TOP_TREE).alias("tree"), F.col("s").alias("pos"), "digest", F.col("m").alias("n")), "merkle-roots")
    tops = hash_tree(roots, sizes["m"] or 0, "merkle-top")
    top = last_nodes(roots, tops).first()
    return Manifest(leaves, tiers, roots, tops, top["digest"] if top else None)


# --- proofs ----------------------------------------------------------------------


def missing(known: Sequence[int], n: int) -> Iterator[tuple[int, int]]:
    """The fewest (level, index) that make the proofs of the leaves ``known``
    complete, in a tree of n leaves: the members of their runs, level by level,
    that do not follow from the leaves themselves."""
    level, have = 0, sorted(set(known))
    while n > 1:
        own, parents = set(have), sorted({i // ARITY for i in have})
        for p in parents:
            for i in range(ARITY * p, min(ARITY * (p + 1), n)):
                if i not in own:
                    yield level, i
        level, have, n = level + 1, parents, -(-n // ARITY)


def runs_of(known: dict[int, str], n: int, fetched: dict[tuple[int, int], str]) -> tuple[list[dict], str]:
    """Per level the runs {parent: digests} over the leaves ``known``, and the
    last node."""
    runs: list[dict[int, list[str]]] = []
    while n > 1:
        level = len(runs)
        here = {p: [known[i] if i in known else fetched[level, i]
                    for i in range(ARITY * p, min(ARITY * (p + 1), n))]
                for p in {i // ARITY for i in known}}
        runs.append(here)
        known, n = {p: H(run) for p, run in here.items()}, -(-n // ARITY)
    return runs, next(iter(known.values()))


def siblings(i: int, runs: list[dict], above: list[str], memo: dict) -> list[str]:
    """The proof of node i of the lowest level of ``runs``, left to right, then
    ``above``; what leaves of one run share is worked out once."""

    def from_level(level: int, i: int) -> list[str]:
        if level == len(runs):
            return above
        got = memo.get((level, i))
        if got is None:
            run, k = runs[level][i // ARITY], i % ARITY
            got = memo[level, i] = run[:k] + run[k + 1:] + from_level(level + 1, i // ARITY)
        return got

    return from_level(0, i)


def fold(digest: str, proof: Sequence[str], pos: int, n: int, s: int, m: int) -> str:
    """The root that ``digest`` at place ``pos`` of n, in the s-th of m trees,
    gives with the siblings ``proof``."""
    at = 0
    for i, size in ((pos, n), (s, m)):
        while size > 1:
            k, run = i % ARITY, min(ARITY, size - i + i % ARITY)
            digest = H([*proof[at:at + k], digest, *proof[at + k:at + run - 1]])
            at, i, size = at + run - 1, i // ARITY, -(-size // ARITY)
    return digest


def prove(tree: Manifest, wanted: DataFrame | None = None, with_proofs: bool = False) -> DataFrame:
    """Proofs of ``wanted`` (rows of ``tree.leaves``; all of them by default):
    (tree, pos, id, leaf, subroot, proof, proof_sha256, folded_root).
    ``proof`` is null unless asked for."""
    wanted = tree.leaves if wanted is None else wanted
    n_salts = slots(wanted.sparkSession)
    block = F.expr(f"pos div {BLOCK}").alias("block")
    need_schema = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("ntree", pa.string()),
                             ("level", pa.int32()), ("idx", pa.int64())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (name, number), held in groups(batches):
            _, n, s, m = held[0]
            yield from ((name, number, name, level, i) for level, i in missing([r[0] for r in held], n))
            yield from ((name, number, TOP_TREE, level, i) for level, i in missing([s], m))

    need = staged(in_blocks(wanted.select("tree", block, "pos", "n", "s", "m"), "pos")
                  .mapInArrow(lambda b: batches_of(ask(b), need_schema), NEED)
                  .withColumn("salt", F.pmod(F.hash("tree", "block"), F.lit(n_salts))), "merkle-need")

    # A few numbers per tier: the levels that are asked for at all.
    levels = {(r["top"], r["level"]) for r in need.select(
        (F.col("ntree") == TOP_TREE).alias("top"), "level").distinct().collect()}
    key = ["ntree", "level", "idx"]
    answers = None
    for top, leaves, tiers in ((False, tree.leaves, tree.tiers), (True, tree.roots, tree.tops)):
        tables = [leaves.select("tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), "digest"),
                  *(t.select("tree", "level", "idx", "digest") for t in tiers)]
        for tier, table in enumerate(tables):
            low = (tier - 1) * TIER + 1 if tier else 0
            here = [lv for t, lv in levels if t == top and low <= lv <= tier * TIER]
            if not here:
                continue
            asked = need.where(((F.col("ntree") == TOP_TREE) == F.lit(top)) & F.col("level").isin(here))
            found = (asked.select(*key, "salt").distinct()
                     .join(table.where(F.col("level").isin(here)).withColumnRenamed("tree", "ntree"), key))
            got = asked.join(found, [*key, "salt"]).select("tree", "block", "ntree", "level", "idx", "digest")
            answers = got if answers is None else answers.unionAll(got)

    null = F.lit(None)
    rows = wanted.select("tree", block, F.lit(1).alias("kind"), F.lit(0).alias("level"), "pos", "digest",
                         "id", "claimed", "n", "s", "m")
    if answers is not None:
        rows = rows.unionAll(answers.select(
            "tree", "block", F.when(F.col("ntree") == TOP_TREE, -1).otherwise(0).alias("kind"), "level",
            F.col("idx").alias("pos"), "digest", null.cast("long"), null.cast("string"),
            null.cast("long"), null.cast("long"), null.cast("long")))
    out_schema = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("id", pa.int64()),
                            ("leaf", pa.string()), ("subroot", pa.string()), ("proof", pa.list_(pa.string())),
                            ("proof_sha256", pa.string()), ("folded_root", pa.string())])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (name, _), held in groups(batches):
            fetched: dict[int, dict] = {-1: {}, 0: {}}
            own = []
            for kind, level, pos, digest, *rest in held:
                if kind == 1:
                    own.append((pos, digest, *rest))
                else:
                    fetched[kind][level, pos] = digest
            n, s, m = own[0][4:]
            runs, subroot = runs_of({pos: d for pos, d, *_ in own}, n, fetched[0])
            top_runs, _ = runs_of({s: subroot}, m, fetched[-1])
            above = siblings(s, top_runs, [], {})
            memo: dict = {}
            for pos, digest, doc, claimed, *_ in own:
                proof = siblings(pos, runs, above, memo)
                yield (name, pos, doc, digest, subroot, proof if with_proofs else None, H(proof),
                       fold(claimed, proof, pos, n, s, m))

    return in_blocks(rows, "kind", "pos").mapInArrow(lambda b: batches_of(expand(b), out_schema), PROVED)


def op11_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    from kasir.llm.common import prepare, table
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    tree = build(docs, claimed={"text": text})
    root = F.lit(tree.root).cast("string")
    return prove(tree).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"))


# DuckDB twin of op11_merkle_manifest.
def _canonical(text: str) -> str:
    def one(c: str) -> str:
        v = f"CAST({c} AS VARCHAR)"
        return f"coalesce(strlen({v}) || ':' || {v}, '-')"
    return "sha256(" + " || ".join(one(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


OP11_SQL = f"""
WITH RECURSIVE crc_table AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
           lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))) AS t
), doc_crc AS MATERIALIZED (
  SELECT doc_id AS id_, xor(list_reduce(list_concat([4294967295],
           list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ord(d) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc32_of
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), crc_table
), leaves AS MATERIALIZED (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS tree,
         {_canonical("text")} AS leaf, {_canonical("replace(text, chr(10), '')")} AS cut
  FROM documents
), placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY tree) AS n
  FROM leaves
), nodes AS (
  SELECT tree, 0 AS lvl, idx, leaf AS h, n FROM placed
  UNION ALL
  SELECT tree, lvl + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3
  FROM nodes WHERE n > 1 GROUP BY tree, lvl, idx // 3, n
), subroots AS MATERIALIZED (
  SELECT tree, h AS subroot, row_number() OVER (ORDER BY CAST(tree AS BLOB)) - 1 AS idx, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS lvl, idx, subroot AS h, n FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3
  FROM tops WHERE n > 1 GROUP BY lvl, idx // 3, n
), runs AS MATERIALIZED (
  SELECT tree, lvl, idx // 3 AS p, list(h ORDER BY idx) AS hs FROM nodes GROUP BY 1, 2, 3
), top_runs AS MATERIALIZED (
  SELECT lvl, idx // 3 AS p, list(h ORDER BY idx) AS hs FROM tops GROUP BY 1, 2
), low AS (
  SELECT doc_id, tree, 0 AS lvl, idx, idx AS pos, n, leaf, '' AS proof,
         CASE WHEN crc32_is_even THEN cut ELSE leaf END AS acc
  FROM (SELECT *, coalesce(crc32_of % 2 = 0, false) AS crc32_is_even FROM placed
        LEFT JOIN (SELECT id_, crc32_of FROM doc_crc) ON doc_id = id_)
  UNION ALL
  SELECT l.doc_id, l.tree, l.lvl + 1, l.idx // 3, l.pos, (l.n + 2) // 3, l.leaf,
         l.proof || array_to_string(r.hs[1:l.idx % 3], '') || array_to_string(r.hs[l.idx % 3 + 2:], ''),
         sha256(array_to_string(r.hs[1:l.idx % 3], '') || l.acc || array_to_string(r.hs[l.idx % 3 + 2:], ''))
  FROM low l JOIN runs r ON r.tree = l.tree AND r.lvl = l.lvl AND r.p = l.idx // 3 WHERE l.n > 1
), high AS (
  SELECT l.doc_id, l.tree, l.pos, 0 AS lvl, s.idx, s.n, l.leaf, s.subroot, l.proof, l.acc
  FROM low l JOIN subroots s ON s.tree = l.tree WHERE l.n = 1
  UNION ALL
  SELECT h.doc_id, h.tree, h.pos, h.lvl + 1, h.idx // 3, (h.n + 2) // 3, h.leaf, h.subroot,
         h.proof || array_to_string(r.hs[1:h.idx % 3], '') || array_to_string(r.hs[h.idx % 3 + 2:], ''),
         sha256(array_to_string(r.hs[1:h.idx % 3], '') || h.acc || array_to_string(r.hs[h.idx % 3 + 2:], ''))
  FROM high h JOIN top_runs r ON r.lvl = h.lvl AND r.p = h.idx // 3 WHERE h.n > 1
)
SELECT h.doc_id, h.leaf, h.subroot, t.h AS root, sha256(h.proof) AS proof_sha256, h.acc AS folded_root,
       h.acc = t.h AS verified
FROM high h CROSS JOIN (SELECT h FROM tops WHERE n = 1) t WHERE h.n = 1
"""
