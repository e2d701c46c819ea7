"""Near-duplicate components by a grouped prefix join on word shingles.

Two documents link when the Jaccard similarity of their shingle sets reaches
``PERCENT``. In any fixed order of all shingles, linked sets share a shingle
among their first n - ceil(PERCENT% of n) + 1: their prefixes. The order used
puts shingles that many documents hold last, so prefixes hold rare ones. How
common a shingle is, is counted over all documents and kept as one byte in a
table of fixed size by hash: any such table gives an order, and so a right
result; a fuller one only finds fewer rare shingles.

Documents with the same set form a class, classes with the same size and prefix
a group. Only groups enter the inverted index of prefix shingles. Within each
posting, every group is first compared with up to three hubs per size step, the
groups that share most with others, and each class with its group's lead: stars,
so a large group of near copies costs a few comparisons per member. Candidates are expanded to classes and
verified on whole sets. Group pairs that share a posting, have compatible sizes
and lie in different components after that are compared in full, so no link that
changes a component is missed; links inside a known component are not needed.
Long postings are compared in blocks, a task holding a few of them at a time.

Shingles are compared by 64-bit hashes, whole sets by 128-bit digests.

Defined results: null or wordless texts have no shingles, are linked with
nothing and form their own component. Rows repeated with one id, or with null
ids, are rows of their own; a component's id is its smallest id that is not
null. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from kasir.llm.common import slots, staged, text_or_empty
from kasir.llm.components import components
from kasir.llm.shingles import shingle_set

WORDS = 5
PERCENT = 80
# A shingle is common when this many documents hold it.
COMMON = 16
SKETCH_BITS = 22                # size of the table of common shingles
HUBS = 3                        # per posting and size step
FEW = 8                         # shorter postings have one hub
LONG = 64                       # postings from here on make each open pair once
BLOCK = 256                     # groups of a long posting that meet in a task at once
COUNTED = 1 << 21               # shingles counted at once in a task


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - (percent * n + 99) // 100 + 1


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def common_shingles(docs: DataFrame, text_col: str, words: int) -> np.ndarray:
    """Per hash bucket, the binary logarithm of the most documents that hold one
    of its shingles, if ``COMMON`` or more, else 0. Each task reports what it
    sees twice or more. A wrong count costs time, never a link."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            token, n = np.unique(np.concatenate(held), return_counts=True)
            many = n >= 2
            return pa.RecordBatch.from_pydict({"token": pa.array(token[many].view(np.int64)),
                                               "n": pa.array(n[many].astype(np.int64))})

        for b in batches:
            for t in b.column(0):
                held.append(shingle_set(t.as_py(), words))
                size += len(held[-1])
                if size >= COUNTED:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    seen = docs.select(text_or_empty(text_col).alias("text")).mapInArrow(count, "token bigint, n bigint")
    often = seen.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON)
    bucket = F.expr(f"shiftrightunsigned(token, {64 - SKETCH_BITS})")
    # At most 2^SKETCH_BITS rows, one per bucket.
    found = (often.groupBy(bucket.alias("bucket")).agg(F.floor(F.log2(F.max("n"))).cast("int").alias("size"))
             .toPandas())
    sketch = np.zeros(1 << SKETCH_BITS, dtype=np.uint8)
    sketch[found["bucket"].to_numpy(np.int64)] = found["size"].to_numpy(np.uint8)
    return sketch


def ordered_prefix(u: np.ndarray, sketch: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The prefix of a sorted set, rare shingles first, and how many common
    ones it holds."""
    p = prefix_length(len(u), percent)
    rank = sketch[u >> np.uint64(64 - SKETCH_BITS)]
    if rank.any():
        order = np.lexsort((u, rank))[:p]
        return u[order], int((rank[order] > 0).sum())
    return u[:p], 0


def text_digest(text: Column) -> list[Column]:
    """t1, t2: a 128-bit digest that tells rows with one id, or none, apart."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")]


def marks_of(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int,
             with_rows: bool = False) -> DataFrame:
    """(doc, n, c, g, common, prefix) per row: set size, set digest, prefix
    digest, common shingles at the prefix's end, prefix. ``with_rows`` adds
    the text's digest (t1, t2)."""
    import xxhash
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(common_shingles(docs, text_col, words))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = shared.value
        for b in batches:
            n, c, g, k, pre = [], [], [], [], []
            for t in b.column(1):
                u = shingle_set(t.as_py(), words)
                p, many = ordered_prefix(u, sketch, percent) if len(u) else (u, 0)
                pre.append(p.tobytes())
                n.append(len(u))
                c.append(xxhash.xxh3_128_digest(u.tobytes()))
                g.append(xxhash.xxh3_64_intdigest(pre[-1]) - (1 << 63))
                k.append(many)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(c, pa.binary()), pa.array(g, pa.int64()),
                 pa.array(k, pa.int32()), pa.array(pre, pa.binary()), *b.columns[2:]],
                names=["doc", "n", "c", "g", "common", "prefix", *b.schema.names[2:]])

    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), text.alias("text"),
                       *(text_digest(text) if with_rows else []))
    out = "doc bigint, n bigint, c binary, g bigint, common int, prefix binary"
    return staged(rows.mapInArrow(mark, out + (", t1 bigint, t2 bigint" if with_rows else "")), "shingle-marks")


def postings_of(marks: DataFrame) -> DataFrame:
    """(token, n, g, held) of every prefix shingle that two or more groups
    hold; ``held`` is how many do."""
    groups = marks.where("n > 0").groupBy("n", "g").agg(F.first("prefix").alias("prefix"),
                                                        F.max("common").alias("common"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [np.frombuffer(p.as_py(), dtype=np.int64) for p in b.column("prefix")]
            sizes = np.array([len(p) for p in parts])
            many = np.asarray(b.column("common"))
            # Position from the end decides whether a shingle is a common one.
            left = np.concatenate([np.arange(s, 0, -1) for s in sizes]) if len(sizes) else np.zeros(0)
            yield pa.RecordBatch.from_pydict({
                "token": pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64()),
                "n": pa.array(np.repeat(np.asarray(b.column("n")), sizes), pa.int64()),
                "g": pa.array(np.repeat(np.asarray(b.column("g")), sizes), pa.int64()),
                "common": pa.array(left <= np.repeat(many, sizes), pa.bool_())})

    rows = groups.mapInArrow(spread, "token bigint, n bigint, g bigint, common boolean")
    own = Window.partitionBy("token")
    rare = (rows.where("not common").withColumn("held", F.count("*").over(own)).where("held > 1")
            .select("token", "n", "g", "held"))
    # Postings of common shingles may be long: count them with map-side sums.
    often = rows.where("common").select("token", "n", "g")
    held = often.groupBy("token").agg(F.count("*").alias("held")).where("held > 1")
    return staged(rare.unionByName(often.join(held, "token").select("token", "n", "g", "held")), "postings")


def id_filter(needed: DataFrame) -> tuple[np.ndarray, int]:
    """A bitmap of hashed ids, of 16 bits per id and at most 2^26 bits: a
    filter before the shuffle that lets through too much at worst."""
    bits = 1 << 15
    n = needed.count()
    while bits < 16 * n and bits < 1 << 26:
        bits *= 2
    at = F.pmod(F.xxhash64("doc"), F.lit(bits)) + 1
    rows = (needed.groupBy(F.bitmap_bucket_number(at).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("map")).collect())
    bitmap = np.zeros(bits // 8, dtype=np.uint8)
    for r in rows:
        lo = (r["bucket"] - 1) * 4096
        bitmap[lo:lo + 4096] = np.frombuffer(bytes(r["map"]), dtype=np.uint8)[:len(bitmap) - lo]
    return bitmap, bits


def sets_of(docs: DataFrame, needed: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(c, u): the whole sets of the classes in ``needed`` (c, doc)."""
    import xxhash
    bitmap, bits = id_filter(needed)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        for b in batches:
            at = np.asarray(b.column(0))
            keep = np.flatnonzero(bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1)
            texts = b.column(1)
            sets = [shingle_set(texts[int(i)].as_py(), words).tobytes() for i in keep]
            yield pa.RecordBatch.from_pydict({
                "c": pa.array([xxhash.xxh3_128_digest(x) for x in sets], pa.binary()),
                "u": pa.array(sets, pa.binary())})

    rows = docs.select(F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(bits)).alias("at"),
                       text_or_empty(text_col).alias("text"))
    sets = rows.mapInArrow(build, "c binary, u binary")
    # An id may be repeated: one copy of each set.
    return sets.join(needed.select("c").distinct(), "c", "left_semi").dropDuplicates(["c"])


def verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, id_col: str, text_col: str,
             words: int, percent: int) -> DataFrame:
    """The rows of ``pairs`` (a, b: classes) that are similar, staged."""
    nodes = pairs.select(F.col("a").alias("c")).unionAll(pairs.select(F.col("b").alias("c"))).distinct()
    needed = staged(nodes.join(classes, "c").select("c", "doc"), "needed-classes")
    sets = staged(sets_of(docs, needed, id_col, text_col, words), "shingle-sets")
    one = sets.select(F.col("c").alias("a"), F.col("u").alias("ua"))
    two = sets.select(F.col("c").alias("b"), F.col("u").alias("ub"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yes = [similar(np.frombuffer(x.as_py(), dtype=np.uint64), np.frombuffer(y.as_py(), dtype=np.uint64),
                           percent) for x, y in zip(b.column("ua"), b.column("ub"))]
            keep = pa.array(yes, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)],
                                             names=["a", "b"])

    both = pairs.join(two, "b").join(one, "a").select("a", "b", "ua", "ub")
    return staged(both.mapInArrow(check, "a binary, b binary"), "links")


def compatible(x: str, y: str, percent: int):
    small, large = F.least(x, y), F.greatest(x, y)
    return small * 100 >= large * percent


def can_be_similar(shared, percent: int):
    """Whether sets of n1 and n2 shingles whose prefixes share so many can reach
    the similarity: beyond the shared ones, at most all that follows the prefix
    of one of the two can be common."""
    most = shared + F.floor((F.greatest("n1", "n2") * percent + 99) / 100) - 1
    return most * (100 + percent) >= (F.col("n1") + F.col("n2")) * percent


def enough_shared(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups (n1, g1, n2, g2), a row per shared prefix shingle, that
    can still be similar."""
    counted = pairs.groupBy("n1", "g1", "n2", "g2").agg(F.count("*").alias("shared"))
    return counted.where(can_be_similar(F.col("shared"), percent)).drop("shared")


def block_sides(long: DataFrame, own: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The two sides of the pairs to judge within long postings (token, n, g, p,
    q), dealt to cells (token, k, i, j) of about ``BLOCK`` groups a side.

    ``p`` and ``q`` are the least and greatest component in a group. The groups
    wholly in a posting's most frequent component, ``major``, need not meet one
    another, so they are on the second side alone: where one component fills a
    posting, the pairs grow with its length and not with the square. ``k`` is
    the size step of the second side; only sizes of neighbouring steps can be
    similar (the steps are a trifle wider than the similarity allows)."""
    step = F.floor(F.log(F.col("n").cast("double")) / math.log(100.0 / percent * (1 + 1e-6)))
    most = (long.where("p = q").groupBy("token", "p").agg(F.count("*").alias("m"))
            .groupBy("token").agg(F.max_by("p", F.struct("m", "p")).alias("top")))
    rows = (long.join(most, "token", "left").withColumn("k", step)
            .withColumn("major", F.coalesce(F.expr("p = q and p = top"), F.lit(False)))
            .select("token", "k", "n", "g", "p", "q", "major"))
    rows = staged(rows, "long-postings")
    near = rows.where("not major").withColumn("k", F.explode(F.array(*[F.col("k") + d for d in (-1, 0, 1)])))
    blocks = [side.groupBy("token", "k").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))
              for side, name in ((near, "rows1"), (rows, "rows2"))]
    cells = blocks[0].join(blocks[1], ["token", "k"])

    def dealt(side: DataFrame, nr: int) -> DataFrame:
        here, there = ("i", "j") if nr == 1 else ("j", "i")
        return (side.join(cells, ["token", "k"]).join(own, ["n", "g"])
                .withColumn(here, F.pmod(F.hash("n", "g"), F.col(f"rows{nr}")))
                .withColumn(there, F.explode(F.sequence(F.lit(0), F.col(f"rows{3 - nr}") - 1)))
                .select("token", "k", "i", "j",
                        *[F.col(c).alias(f"{c}{nr}") for c in ("n", "g", "p", "q", "major", "hot", "cold")]))

    return dealt(near, 1), dealt(rows, 2)


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     words: int = WORDS, percent: int = PERCENT, with_rows: bool = False) -> DataFrame:
    """(doc, n, c, component) per row of ``docs``. ``with_rows`` adds ``part``,
    which names the component also where it has no id (null for a wordless
    text, a component of its own), and the text's digest (t1, t2)."""
    marks = marks_of(docs, id_col, text_col, words, percent, with_rows)
    more_cols = ("part", "t1", "t2") if with_rows else ()
    classes = staged(marks.where("n > 0").groupBy("c").agg(
        F.min("doc").alias("doc"), F.max("n").alias("n"), F.max("g").alias("g")), "classes")
    leads = staged(classes.groupBy("n", "g").agg(F.min("c").alias("lead"), F.count("*").alias("members")),
                   "groups")
    postings = postings_of(marks)

    # Stars: classes around their group's lead, groups around the hubs of each
    # posting and size step; hubs of neighbouring steps are paired too. A group
    # whose shingles many others hold was edited least, so it makes a good hub.
    inner = (classes.join(leads.where("members > 1"), ["n", "g"])
             .where("c <> lead").select(F.col("lead").alias("a"), F.col("c").alias("b")))
    weights = postings.groupBy("n", "g").agg(F.sum("held").alias("weight"))
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)))
    stepped = postings.withColumn("k", step)
    slot = F.when(F.col("held") < FEW, F.lit(0)).otherwise(F.pmod(F.hash("n", "g"), F.lit(HUBS)))
    tops = (stepped.join(weights, ["n", "g"]).groupBy("token", "k", slot.alias("slot"))
            .agg(F.max(F.struct("weight", "g", "n")).alias("top")).select("token", "k", "top"))
    tops = staged(tops, "hubs")
    star = stepped.join(tops, ["token", "k"]).select(
        F.col("top.n").alias("n1"), F.col("top.g").alias("g1"), F.col("n").alias("n2"), F.col("g").alias("g2"))
    up = tops.select("token", (F.col("k") + 1).alias("k"), F.col("top").alias("below"))
    bridge = tops.join(up, ["token", "k"]).select(
        F.col("below.n").alias("n1"), F.col("below.g").alias("g1"), F.col("top.n").alias("n2"),
        F.col("top.g").alias("g2"))
    group_pairs = enough_shared(star.unionByName(bridge).where("g1 <> g2 or n1 <> n2")
                                .where(compatible("n1", "n2", percent)), percent)
    first = leads.select(F.col("n").alias("n1"), F.col("g").alias("g1"), F.col("lead").alias("a"))
    second = leads.select(F.col("n").alias("n2"), F.col("g").alias("g2"), F.col("lead").alias("b"))
    outer = group_pairs.join(first, ["n1", "g1"]).join(second, ["n2", "g2"]).select("a", "b")
    ordered = (F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    tried = staged(inner.unionByName(outer).select(*ordered).distinct(), "star-pairs")
    links = verified(docs, classes, tried, id_col, text_col, words, percent)
    labels = components(links)

    # What the stars left open: group pairs of a posting in different parts.
    placed = staged(classes.join(labels, classes["c"] == labels["node"], "left")
                    .select("c", "doc", "n", "g", F.coalesce("label", "c").alias("part")), "placed")
    parts = placed.groupBy("n", "g").agg(F.min("part").alias("p"), F.max("part").alias("q"))
    located = postings.join(parts, ["n", "g"])
    mixed = (located.groupBy("token").agg(F.min("p").alias("lo"), F.max("q").alias("hi"))
             .where("lo <> hi").select("token"))
    open_ = staged(located.join(mixed, "token"), "open-postings")
    apart = (F.expr("g1 < g2 or (g1 = g2 and n1 < n2)") & compatible("n1", "n2", percent)
             & F.expr("p1 <> q1 or p2 <> q2 or p1 <> p2"))

    # Short postings: a row per pair and shared shingle, then counted.
    few = open_.where(F.col("held") < LONG)
    x, y = (few.select("token", *[F.col(c).alias(f"{c}{i}") for c in ("n", "g", "p", "q")]) for i in (1, 2))
    short = enough_shared(x.join(y, (x["token"] == y["token"]) & apart).select("n1", "g1", "n2", "g2"), percent)
    # Long postings: a pair is made once, in that of its smallest long-posted
    # shingle, and counted on the spot over all shingles that it shares. Pairs
    # that share one are judged here, whatever the short postings say.
    own = open_.groupBy("n", "g").agg(
        F.array_sort(F.collect_list(F.when(F.col("held") >= LONG, F.col("token")))).alias("hot"),
        F.collect_list(F.when(F.col("held") < LONG, F.col("token"))).alias("cold"))
    x, y = block_sides(open_.where(F.col("held") >= LONG), own, percent)
    hot = F.array_intersect("hot1", "hot2")
    shared = F.size(hot) + F.size(F.array_intersect("cold1", "cold2"))
    met = (F.expr("(major2 or g1 < g2 or (g1 = g2 and n1 < n2)) and (p1 <> q1 or p2 <> q2 or p1 <> p2)")
           & compatible("n1", "n2", percent)
           & (F.get(hot, F.lit(0)) == F.col("token")) & can_be_similar(shared, percent))
    rest = short.unionByName(x.join(y, ["token", "k", "i", "j"]).where(met).select("n1", "g1", "n2", "g2"))
    # Groups whose own members fell apart are compared with themselves as well.
    within = (parts.where("p <> q").select(F.col("n").alias("n1"), F.col("g").alias("g1"),
                                        F.col("n").alias("n2"), F.col("g").alias("g2")))
    members1 = placed.select(F.col("n").alias("n1"), F.col("g").alias("g1"), F.col("c").alias("a"),
                             F.col("part").alias("part1"))
    members2 = placed.select(F.col("n").alias("n2"), F.col("g").alias("g2"), F.col("c").alias("b"),
                             F.col("part").alias("part2"))
    open_pairs = (rest.unionByName(within).join(members1, ["n1", "g1"]).join(members2, ["n2", "g2"])
                  .where("part1 <> part2").select("a", "b").select(*ordered).distinct()
                  .join(tried, ["a", "b"], "left_anti"))
    more = verified(docs, classes, staged(open_pairs, "open-pairs"), id_col, text_col, words, percent)

    # Join the parts that a late link connects.
    part = placed.select("c", "part")
    late = (more.join(part.select(F.col("c").alias("a"), F.col("part").alias("pa")), "a")
            .join(part.select(F.col("c").alias("b"), F.col("part").alias("pb")), "b")
            .select(F.col("pa").alias("a"), F.col("pb").alias("b")))
    merged = components(late)
    final = (placed.join(merged, placed["part"] == merged["node"], "left")
             .select("c", "doc", F.coalesce("label", "part").alias("part")))
    ids = final.groupBy("part").agg(F.min("doc").alias("component"))
    by_class = staged(final.join(ids, "part").select("c", "component", *more_cols[:1]), "components")
    rows = marks.select("doc", "n", "c", *more_cols[1:])
    return rows.join(by_class, "c", "left").select(
        "doc", "n", "c", F.when(F.col("n") == 0, F.col("doc")).otherwise(F.col("component")).alias("component"),
        *more_cols)


def op9_ngram_join(spark, sf_dir: str) -> DataFrame:
    from kasir.llm.common import prepare, table
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_components(docs).select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
                                         F.col("component").alias("component_id"))


# DuckDB twin of op9_ngram_join.
OP9_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id
  GROUP BY x.doc_id, y.doc_id
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * common >= 80 * (p.n + q.n - common)
), edges AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION
  SELECT r.node, e.b FROM reach r JOIN edges e ON r.other = e.a
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT node AS doc_id, min(other) AS component_id FROM reach GROUP BY node) r USING (doc_id)
"""
