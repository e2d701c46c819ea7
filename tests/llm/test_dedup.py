"""Line dedup, exact dedup and near-duplicate components against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, duck
from llm_fixtures import docs, llm, no_docs  # noqa: F401
from kasir.llm import components as comp
from kasir.llm import exact_dedup, line_dedup, ngram_join, shingles

EDGE = " \t\n\x0b\f\r"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def oracle(name, sql, llm, query):
    con = duck(SF_SMALL)
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    want = sorted(tuple(r) for r in res.fetchall())
    assert sorted(tuple(r) for r in query(llm, SF_SMALL).select(*cols).collect()) == want, name


def test_queries_against_sql(llm):
    oracle("op3", line_dedup.OP3_SQL, llm, line_dedup.op3_line_dedup)
    oracle("op9", ngram_join.OP9_SQL, llm, ngram_join.op9_ngram_join)
    oracle("op10", exact_dedup.OP10_SQL, llm, exact_dedup.op10_exact_dedup)


# --- lines -------------------------------------------------------------------

def dedup_lines(rows):
    """(id, text) -> (id, kept text, lines, dropped), ids in order, null last."""
    order = lambda i: (i is None, i or 0)
    first = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = line.strip(EDGE).translate(FOLD)
            if len(key) >= 10 and (key not in first or order(i) < order(first[key])):
                first[key] = i
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(k := x.strip(EDGE).translate(FOLD)) < 10 or first[k] == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def by_id(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r))


def test_lines_of_awkward_texts(llm, docs):
    got = line_dedup.dedup_lines(docs)
    want = dedup_lines([(r.doc_id, r.text) for r in docs.collect()])
    assert by_id([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()]) == by_id(want)
    assert {"salt", "n", "score", "ids"} <= set(got.columns)


def test_lines_in_random_documents(llm):
    rng = random.Random(2)
    pool = [f"a repeated line number {i}" for i in range(8)] + ["", "x", "  A repeated LINE number 3 ", "not a long\t"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 6)))) for i in range(200)]
    rng.shuffle(rows)
    got = line_dedup.dedup_lines(llm.createDataFrame(rows, "doc_id bigint, text string").repartition(5))
    assert by_id([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()]) == by_id(dedup_lines(rows))


def test_texts_without_an_id_are_documents_of_their_own(llm):
    rows = ([(None, f"one line of many texts\nown line number {i}") for i in range(40)]
            + [(None, "one line of many texts\nown line number 7")]
            + [(None, "a line with an id too\nx"), (5, "a line with an id too"), (5, "a line with an id too\nb")])
    got = [(r.doc_id, r.text) for r in
           line_dedup.dedup_lines(llm.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()]
    assert len(got) == len(rows)
    assert len({t for _, t in got if t.startswith("one line")}) == 1
    assert {t.split("\n")[-1] for _, t in got if "own line" in t} == {f"own line number {i}" for i in range(40)}
    assert sorted(t for i, t in got if i == 5) == ["a line with an id too", "a line with an id too\nb"]
    assert (None, "x") in got


def test_clashing_line_columns_pass_through(llm):
    rows = [(1, "a shared line\nx", "d", "k"), (2, "y\na shared line", "d", "k")]
    df = llm.createDataFrame(rows, "doc_id bigint, text string, doc string, kept string")
    got = sorted((r.doc_id, r.text, r.doc, r.kept) for r in line_dedup.dedup_lines(df).collect())
    assert got == [(1, "a shared line\nx", "d", "k"), (2, "y", "d", "k")]


def test_bitmap_is_the_runs_of_kept_lines(llm):
    rows = [(1, "line number one\nline number two"), (2, "a\nline number one\nb\nline number two\nc")]
    got = line_dedup.keep_bitmaps(llm.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert [(r.doc, r.n_dropped, [tuple(k) for k in r.kept]) for r in got] == [
        (2, 2, [(0, 1), (2, 1), (4, None)])]


def test_no_lines(llm, no_docs):
    assert line_dedup.dedup_lines(no_docs).count() == 0


def test_line_plan_is_native_and_dealt_by_range(llm, docs):
    plan = line_dedup.dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "Python" not in plan and "Arrow" not in plan


# --- exact copies --------------------------------------------------------------

def exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        top = max(ids, key=lambda i: (i is not None, i or 0))
        out += [(i, top, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return out


def rows_of(df):
    return by_id([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()])


def test_exact_copies_of_awkward_texts(llm, docs, tmp_path):
    path = str(tmp_path / "docs")
    docs.repartition(3).write.parquet(path)
    got = exact_dedup.dedup_folder(llm, path)
    assert rows_of(got) == by_id(exact([(r.doc_id, r.text) for r in docs.collect()]))
    # Of rows with the same id and text exactly one stays.
    assert got.where("kept").count() == got.select("text_sha256").distinct().count()


def test_state_outlives_a_run(llm, tmp_path):
    path, home = str(tmp_path / "in"), str(tmp_path / "home")
    one, two = [(1, "a"), (2, "b"), (3, "a")], [(4, "b"), (5, "c"), (0, "a")]
    for rows, seen in ((one, one), (two, one + two)):
        llm.createDataFrame(rows, "doc_id bigint, text string").write.mode("append").parquet(path)
        assert rows_of(exact_dedup.dedup_folder(llm, path, home=home)) == by_id(exact(seen))
    # Nothing new: the last image stands.
    assert rows_of(exact_dedup.dedup_folder(llm, path, home=home)) == by_id(exact(one + two))


def test_batches_meet_the_state(llm, tmp_path):
    """Files taken one at a time: groups span micro-batches, the last of which
    brings nothing new; the state is read, not an image of it."""
    rows = [(i, f"text {i % 7}") for i in range(40)] + [(100, None), (101, "")]
    path = str(tmp_path / "files")
    llm.createDataFrame(rows, "doc_id bigint, text string").repartition(6).write.parquet(path)
    home = str(tmp_path / "home")
    assert rows_of(exact_dedup.dedup_folder(llm, path, home=home, files_per_batch=1)) == by_id(exact(rows))
    commits = [p for p in (tmp_path / "home" / "checkpoint" / "commits").iterdir() if p.name.isdigit()]
    assert len(commits) >= 6


def test_a_hot_text_is_spread(llm, tmp_path, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SALT_ROWS", 5)
    rows = [(i, "hot" if i % 3 == 0 else f"t{i % 50}") for i in range(300)]
    path = str(tmp_path / "hot")
    llm.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(path)
    assert rows_of(exact_dedup.dedup_folder(llm, path)) == by_id(exact(rows))


def test_digest_hits_are_checked_byte_for_byte(llm, tmp_path, monkeypatch):
    real = exact_dedup.located

    def weak(docs, id_col, text_col):
        """A digest that knows only the text's length."""
        return real(docs, id_col, text_col).withColumn("digest", F.unhex(F.sha2(F.length("text").cast("string"), 256)))

    monkeypatch.setattr(exact_dedup, "located", weak)
    rows = [(1, "aa"), (2, "bb"), (3, "aa"), (4, "bb"), (5, "ccc"), (6, "bb"), (7, "d"), (8, "aa")]
    path = str(tmp_path / "in")
    llm.createDataFrame(rows, "doc_id bigint, text string").write.parquet(path)
    got = by_id([(r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.dedup_folder(llm, path).collect()])
    assert got == by_id([r[:3] for r in exact(rows)])


def test_exact_copies_in_an_empty_folder(llm, no_docs, tmp_path):
    path = str(tmp_path / "none")
    no_docs.write.parquet(path)
    assert exact_dedup.dedup_folder(llm, path).count() == 0


# --- near copies -----------------------------------------------------------------

def shingle_texts(text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", (text or "").translate(FOLD)) if w]
    return {" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near(rows):
    sets = [shingle_texts(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), d if not sets[i] else min(ids, default=None)))
    return out


def near_rows(df):
    return by_id([(r.doc, r.n, r.component) for r in df.collect()])


def test_near_copies_of_awkward_texts(llm, docs):
    want = near([(r.doc_id, r.text) for r in docs.collect()])
    assert near_rows(ngram_join.ngram_components(docs)) == by_id(want)


def corpus(seed, n, vocabulary, common=()):
    """Clusters of edited copies, chains of edits, and shared passages."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    rows = []
    while len(rows) < n:
        base = [word() for _ in range(rng.randint(1, 60))]
        if common and rng.random() < 0.5:
            at = rng.randint(0, len(base))
            base[at:at] = common
        for _ in range(rng.randint(1, 8)):
            rows.append(" ".join(base))
            if rng.random() < 0.8:
                base = list(base)
                base[rng.randrange(len(base))] = word()
    rng.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in enumerate(rows[:n])]


@pytest.mark.parametrize("seed,vocabulary,common", [
    (1, 50, ()), (2, 5000, [f"c{i}" for i in range(30)]), (3, 3, ())])
def test_near_copies_in_random_documents(llm, seed, vocabulary, common, monkeypatch):
    monkeypatch.setattr(ngram_join, "COMMON", 4)
    monkeypatch.setattr(ngram_join, "FEW", 3)
    monkeypatch.setattr(ngram_join, "LONG", 5)
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    rows = corpus(seed, 260, vocabulary, common)
    got = ngram_join.ngram_components(llm.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    assert near_rows(got) == by_id(near(rows))


def test_blocks_of_long_postings_miss_no_pair(llm, monkeypatch):
    """Every pair of one posting that may link is in some cell; groups of the
    most frequent component meet only others; cells stay small."""
    monkeypatch.setattr(ngram_join, "BLOCK", 10)
    rng = random.Random(4)
    rows = []
    for g in range(600):
        p = "big" if g % 3 else f"p{rng.randrange(40)}"
        q = max(p, "q") if g % 17 == 0 else p
        rows += [(t, rng.choice([1, 4, 5, 79, 80, 99, 100, 125]), g, p, q) for t in ((1, 2) if g % 2 else (1,))]
    long = llm.createDataFrame(rows, "token bigint, n bigint, g bigint, p string, q string")
    own = long.groupBy("n", "g").agg(F.sort_array(F.collect_list("token")).alias("hot"),
                                     F.array().cast("array<bigint>").alias("cold"))
    x, y = ngram_join.block_sides(long, own, 80)
    cells = x.join(y, ["token", "k", "i", "j"]).select("token", "n1", "g1", "p1", "q1", "n2", "g2", "p2", "q2")
    met, seen = set(), 0
    for r in cells.collect():
        assert not (r.p1 == r.q1 == r.p2 == r.q2 == "big")
        met.add((r.token, frozenset([(r.n1, r.g1), (r.n2, r.g2)])))
        seen += 1
    want = {(a[0], frozenset([a[1:3], b[1:3]])) for a in rows for b in rows
            if a[0] == b[0] and a[2] < b[2] and 100 * min(a[1], b[1]) >= 80 * max(a[1], b[1])
            and not a[3] == a[4] == b[3] == b[4] == "big"}
    assert want <= met and seen < 2 * 600 * 600
    per_cell = y.groupBy("token", "k", "i", "j").count().agg(F.max("count")).first()[0]
    assert per_cell < 40


def test_near_copies_in_an_empty_table(llm, no_docs):
    assert ngram_join.ngram_components(no_docs).count() == 0


def test_prefix_bound():
    """Sets of the sizes' greatest allowed difference still meet in a prefix."""
    for n in range(1, 200):
        need = -(-80 * n // 100)
        assert ngram_join.prefix_length(n) == n - need + 1


def test_shingles_over_chunks(monkeypatch):
    text = " ".join(f"w{i * i % 1009}" for i in range(3000)) + "\tEnd"
    whole = shingles.shingle_set(text)
    monkeypatch.setattr(shingles, "CHUNK", 100)
    assert np.array_equal(whole, shingles.shingle_set(text))
    assert len(whole) == len(shingle_texts(text))


def test_components_of_chains_and_stars(llm):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.node: r.label for r in comp.components(llm.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}
    assert comp.components(llm.createDataFrame([], "a bigint, b bigint")).count() == 0
