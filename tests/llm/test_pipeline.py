"""The pipeline stage by stage against brute force, and as a whole."""

import importlib
import sys

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from llm_fixtures import docs, llm  # noqa: F401
from test_dedup import dedup_lines, near
from test_tokens import check_packing

import corpus_pipeline as cp
from kasir.llm import language, quality
from kasir.llm.common import staged, table

STAGES = dict(cp.STAGES)


@pytest.fixture(scope="module")
def steps(llm):
    """What each stage of the pipeline was given and what it returned."""
    docs, out = table(llm, SF_SMALL, "documents"), {}
    for name, stage in cp.STAGES:
        after = staged(stage(llm, docs, SF_SMALL), name)
        out[name] = (docs, after)
        docs = after
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_keep_the_columns_of_documents(steps):
    assert [n for n, _ in cp.STAGES] == ["language_id", "quality", "line_dedup", "ngram_join", "packing"]
    for name, (_, after) in list(steps.items())[:-1]:
        assert tuple(after.columns) == cp.COLUMNS, name


def test_language_and_quality_drop_what_they_reject(llm, steps):
    before, after = steps["language_id"]
    model = language.fit(before.where(~language.held_out()))
    kept = {i for i, t in rows(before) if not (p := model.predict(t))[2] and p[0] != "und" or p[1] >= 0.5}
    assert {i for i, _ in rows(after)} == kept
    before, after = steps["quality"]
    model = quality.fit(before, table(llm, SF_SMALL, "labels").where(~quality.held_out()))
    assert {i for i, _ in rows(after)} == {i for i, t in rows(before) if model.score(t or "") >= quality.CUT}


def test_lines_and_near_copies(steps):
    before, after = steps["line_dedup"]
    assert sorted(rows(after)) == sorted((i, t) for i, t, _, _ in dedup_lines(rows(before)))
    before, after = steps["ngram_join"]
    want = sorted(i for i, _, component in near(rows(before)) if i == component)
    assert sorted(i for i, _ in rows(after)) == want


def test_packing_takes_every_document(steps):
    before, after = steps["packing"]
    got = after.collect()
    check_packing(got, 2048)
    assert {r.doc_id for r in got} == {i for i, _ in rows(before)}


def test_run_is_the_stages_in_order(llm, steps):
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = cp.run(llm, SF_SMALL).select(*key)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, steps["packing"][1].select(*key).collect()))


@pytest.mark.parametrize("name", list(STAGES))
def test_awkward_documents(llm, name, docs):
    given = docs.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"),
                        F.length("text").cast("bigint").alias("n_chars"), "salt", "n")
    assert STAGES[name](llm, given, SF_SMALL).count() >= (1 if name != "language_id" else 0)
    assert STAGES[name](llm, given.limit(0), SF_SMALL).count() == 0


def test_one_row_of_each_component_stays(llm):
    """Null and repeated ids: rows are chosen one by one, not by id."""
    say = lambda name, n=60: " ".join(f"{name}{i}" for i in range(n))
    given = [(None, say("a")), (None, say("a") + " end"), (None, say("a").upper()),     # a group without ids
             (None, say("b")), (3, say("b") + " end"),                  # null beside an id
             (5, say("c")), (5, say("d") + " end"), (4, say("d")),      # one id on two texts
             (6, say("e")), (6, say("e").upper()), (6, say("e")),       # one id, one set, two texts
             (None, say("f")), (None, say("f"))]
    df = llm.createDataFrame([(i, t, "en", "s", len(t)) for i, t in given],
                             "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = rows(cp.near_duplicate_stage(llm, df.repartition(4), SF_SMALL))
    group = lambda t: t[0].lower()
    assert sorted(group(t) for _, t in got) == ["a", "b", "c", "d", "e", "f"]
    assert {group(t): i for i, t in got} == {"a": None, "b": 3, "c": 5, "d": 4, "e": 6, "f": None}
    assert set(got) <= set(given)


def test_registered_beside_the_other_queries():
    entry = importlib.import_module("__spark_entry__")
    names = list(entry.queries())
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))
    assert "corpus_pipeline" in sys.modules
