"""Language and quality classifiers: defined results and held-out accuracy."""

import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from llm_fixtures import docs, llm, no_docs  # noqa: F401
from kasir.llm import features, language, quality


def test_codewords_are_far_apart():
    for k in (2, 3, 4, 6, 9, 30):
        code = language.codewords(k)
        apart = min(int((a != b).sum()) for i, a in enumerate(code) for b in code[:i])
        assert code.shape[0] == k and apart >= (2 ** (k - 2) if k <= 6 else code.shape[1] // 4)
        assert (np.abs(code.sum(axis=0)) < k).all() or k > 6     # no constant column


def test_grams_cover_whole_texts(monkeypatch):
    data = bytes(range(1, 250)) * 40
    whole = features.gram_counts(data, 512)
    assert whole.sum() == 3 * len(data) - 3
    monkeypatch.setattr(features, "CHUNK", 97)
    assert np.array_equal(whole, features.gram_counts(data, 512))


@pytest.fixture(scope="module")
def sample():
    docs = pq.read_table(f"{SF_MID}/documents.parquet").to_pandas()
    labels = pq.read_table(f"{SF_MID}/labels.parquet").to_pandas()
    return docs.merge(labels, on="doc_id", how="left").set_index("doc_id")


def crc(i):
    return zlib.crc32(str(i).encode())


def test_language_on_held_out_documents(llm, sample):
    got = language.op6_language(llm, SF_MID).collect()
    assert len(got) == len(sample)
    assert all(r.held_out == (crc(r.doc_id) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and sample.lang[r.doc_id] is not None]
    assert np.mean([r.lang_pred == sample.lang[r.doc_id] for r in held]) > 0.97


def test_quality_on_held_out_documents(llm, sample):
    got = quality.op2_quality(llm, SF_MID).collect()
    assert len(got) == len(sample)
    assert all(r.held_out == (crc(r.doc_id) % 4 == 2) and r.predicted == (r.score >= 0.7) for r in got)
    held = [(r, sample.quality[r.doc_id]) for r in got if r.held_out and sample.quality[r.doc_id] in (0, 1)]
    assert np.mean([r.predicted == y for r, y in held]) > 0.95
    good, bad = ([r.score for r, y in held if y == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.98


def test_pairs_learn_an_order():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 5)).astype(np.float32)
    worth = x @ np.array([2, -1, 0, 0.5, 0])
    i, j = rng.integers(0, 300, (2, 4000))
    w = quality.fit_pairs(x, np.where(worth[i] > worth[j], i, j), np.where(worth[i] > worth[j], j, i))
    assert np.corrcoef(x @ w, worth)[0, 1] > 0.99


def test_awkward_texts_keep_their_columns(llm, docs):
    known = llm.createDataFrame([(i, "the cat is here and there", "en", 1) for i in range(20)]
                                + [(30 + i, "le chat est ici ou bien là", "fr", 0) for i in range(20)]
                                + [(60, None, "en", 1), (61, "x", None, None)],
                                "doc_id bigint, text string, lang string, quality int")
    model = language.fit(known)
    got = language.predict(docs, model).collect()
    assert len(got) == docs.count() and {"salt", "n", "ids"} <= set(got[0].asDict())
    for r in got:
        if not r.text or not any(map(str.isalpha, r.text)):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "fr") and 0 <= r.score <= 1
    marked = quality.score(docs, quality.fit(known)).collect()
    assert len(marked) == docs.count() and all(0 <= r.score <= 1 for r in marked)
    same = {r.text: r.score for r in marked}
    assert all(r.score == same[r.text] for r in marked)


def test_ambiguous_documents_are_flagged(llm):
    rows = [(i, "aaaa bbbb aaaa", "x") for i in range(9)] + [(20 + i, "cccc dddd cccc", "y") for i in range(9)]
    model = language.fit(llm.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert model.predict("aaaa bbbb")[0::2] == ("x", False)
    assert model.predict("zzzz")[2] or model.predict("zzzz")[1] < 0.75


@pytest.mark.parametrize("rows,want", [([], ("und", 0.0, False)), ([(1, "one", "en")], ("en", 1.0, False))])
def test_too_few_languages(llm, rows, want):
    model = language.fit(llm.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert model.predict("some text") == want


def test_too_few_labels_and_empty_tables(llm, docs, no_docs):
    one = llm.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 7)], "doc_id bigint, text string, quality int")
    assert {(r.score, r.predicted) for r in quality.score(docs, quality.fit(one)).collect()} == {(0.7, 1)}
    assert quality.score(no_docs, quality.fit(one)).count() == 0
    assert language.predict(no_docs, language.fit(one.withColumn("lang", F.lit("en")))).count() == 0


def sampled(llm, rows, most):
    h = features.row_hash("doc_id", "text").alias("h")
    df = llm.createDataFrame(rows, "y string, doc_id bigint, text string").select("y", h, "text").repartition(6)
    picked, counts = features.sample_by_class(df, "y", "h", most)
    return features.drawn(df, picked, "y", "h", "text").collect(), counts


def test_sample_is_bounded_and_even(llm):
    rows = [("a" if i % 20 == 0 else "b", i, f"t{i}") for i in range(8000)]
    got, counts = sampled(llm, rows, 1000)
    assert counts == {"a": 400, "b": 7600}
    assert {k: sum(r.y == k for r in got) for k in "ab"} == {"a": 400, "b": 500}


def test_sample_of_one_id(llm):
    """One id, or one row, on a third of all rows neither fills nor empties it."""
    rows = ([("en", 7, f"t{i}") for i in range(3000)] + [("fr", i, f"u{i}") for i in range(990)]
            + [("de", None, f"v{i}") for i in range(3000)] + [("it", 8, "same")] * 3000)
    got, _ = sampled(llm, rows, 400)
    assert {k: sum(r.y == k for r in got) for k in ("en", "fr", "de", "it")} == {"en": 100, "fr": 100, "de": 100, "it": 1}


def test_sample_of_many_classes(llm):
    rows = [(f"l{i % 1000}", i, f"t{i}") for i in range(5000)]
    got, _ = sampled(llm, rows, 2400)
    assert len(got) == 2000 and len({r.y for r in got}) == 1000
    got, _ = sampled(llm, rows, 300)
    assert len(got) == 1000 and len({r.y for r in got}) == 1000


def test_fitting_against_plain_gradients():
    """The fitted weights lie where the penalised loss is flat: its gradient,
    worked out row by row, all but vanishes."""
    rng = np.random.default_rng(3)
    x = np.stack([features.unit(rng.integers(1, 9, 4)) * rng.choice([-1, 1], 4) for _ in range(200)]).astype(np.float32)
    y = np.where(4 * x @ np.array([[1.0], [-2], [0.5], [0]]) + rng.normal(size=(200, 1)) > 0, 1, -1).astype(np.float32)
    w, b = language.fit_linear(x, y, np.ones(200))
    m = (y * (x @ w + b))[:, 0]
    g = sum(-y[i, 0] * x[i] / (1 + np.exp(m[i])) for i in range(200)) / 200 + language.PENALTY * w[:, 0]
    assert np.abs(g).max() < 5e-3
    good, bad = rng.integers(0, 200, (2, 500))
    good, bad = np.where(x[good, 0] > x[bad, 0], good, bad), np.where(x[good, 0] > x[bad, 0], bad, good)
    v = quality.fit_pairs(x + rng.normal(size=x.shape).astype(np.float32), good, bad)
    assert v[0] > 0 and v[0] > np.abs(v[1:]).max()


def test_clashing_names_pass_through(llm):
    rows = [(i, t, "p", 0.5, 7) for i, t in enumerate(["the cat", "le chat", None])]
    df = llm.createDataFrame(rows, "doc_id bigint, text string, prediction string, score double, worth int")
    known = llm.createDataFrame([(i, t, k, n) for i, (t, k, n) in enumerate(
        [("the cat is here", "en", 1), ("le chat est ici", "fr", 0)] * 9)], "doc_id bigint, text string, lang string, quality int")
    for out in (language.predict(df, language.fit(known)), quality.score(df, quality.fit(known))):
        got = out.collect()
        assert [(r.prediction, r.worth) for r in got] == [("p", 7)] * 3 and out.columns.count("score") == 1


def noisy(n):
    """(doc_id, text, quality): a label that the text tells in part."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.7)
        words = ["".join(rng.choice(list("abcXYZ019.,!"), rng.integers(2, 9))) for _ in range(12)]
        rows.append((i, " ".join(words + ["plain words here"] * int(rng.integers(0, 4) + y)), y))
    return rows


def test_quality_cut_is_the_quantile_of_all_labelled_rows(llm):
    """More rows than one block: as many are scored below the cut as have label 0."""
    rows = noisy(6500)
    df = llm.createDataFrame(rows, "doc_id bigint, text string, quality int").repartition(5)
    marked = quality.score(df, quality.fit(df)).collect()
    zeros = sum(y == 0 for *_, y in rows)
    assert abs(sum(r.predicted == 0 for r in marked) - zeros) <= 1
    again = quality.score(df, quality.fit(df.repartition(2))).collect()
    assert {r.doc_id: r.score for r in again} == {r.doc_id: r.score for r in marked}


def test_all_labelled_rows_are_dealt(llm, monkeypatch):
    """Every row is in a block, and both classes are in every block."""
    monkeypatch.setattr(quality, "BLOCK", 100)
    monkeypatch.setattr(quality, "LEAST", 5)
    hashes = np.random.default_rng(4).integers(-2 ** 63, 2 ** 63 - 1, 4000)
    rows = [(int(i % 500 > 0), int(h)) for i, h in enumerate(hashes)]
    df = llm.createDataFrame(rows, "y int, h bigint")
    got = quality.dealt(df, {0: 8, 1: 3992}).collect()
    assert {(r.y, r.h) for r in got} == set(rows)
    assert {r.block for r in got} == set(range(40))
    for k in range(40):
        assert {r.y for r in got if r.block == k} == {0, 1}
    assert len([r for r in got if r.y == 1]) == 3992 and len(got) <= 3992 + 8 * 40


@pytest.mark.parametrize("few", [0, 50])
def test_worth_at_a_rank(llm, monkeypatch, few):
    monkeypatch.setattr(quality, "FEW", few)
    monkeypatch.setattr(quality, "BINS", 16)
    rng = np.random.default_rng(2)
    worth = np.concatenate([rng.normal(size=500), np.full(40, 0.25), [1e6, -1e-300, 0.0]])
    rows = [(float(v), int(n)) for v, n in zip(worth, rng.integers(1, 4, len(worth)))]
    whole = sorted(v for v, n in rows for _ in range(n))
    df = llm.createDataFrame(rows, "worth double, n bigint")
    for k in (1, 2, 400, len(whole) // 2, len(whole)):
        assert quality.at_rank(df, k) == whole[k - 1]
    assert quality.at_rank(llm.createDataFrame([(3.0, 2)], "worth double, n bigint"), 2) == 3.0
