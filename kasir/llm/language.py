"""Language identification by error-correcting output codes.

Each language has a binary codeword. One linear classifier per bit, on hashed
byte n-grams of the whole text, predicts that bit. Decoding sums, over the bits,
the logistic loss of a codeword's bit, weighted by how well the bit's classifier
separates the training rows; the codeword with the least loss wins. Its share
of exp(-loss) is the score. A document is flagged ambiguous when the runner-up's
loss is within ``MARGIN`` of the best.

Up to six languages get the exhaustive code (all distinct splits); more get
random columns, as many as keep the codewords well apart. The classifiers are
fitted on a sample of at most ``SAMPLE`` distinct labelled rows, evenly by
language, drawn by a hash of id and text (of one row a language, if there are
more languages than that); every document is predicted from its whole text, which
goes to Python once and does not come back.

Defined results: a null text, or one without a letter, is ``und`` with score 0.
Rows with a null label train nothing. With one known language every document
with a letter gets it (score 1); with none, every document is ``und``. Null and
repeated ids are predicted row by row; a repeated row trains once. Texts of any
length are read whole, a megabyte at a time. Columns of ``docs`` named as the
results are replaced, all others pass through. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

from kasir.llm.common import name_clash_free
from kasir.llm.features import drawn, fold, language_features, row_hash, sample_by_class

SIZE = 8192             # n-gram buckets
SAMPLE = 2400           # labelled rows fitted on
STEPS = 200
RATE = 20.0
PENALTY = 1e-4
MARGIN = 0.2
UNKNOWN = "und"


def codewords(k: int) -> np.ndarray:
    """(k, bits) of -1 and 1."""
    if k <= 6:
        cols = [[1] + [1 if c >> i & 1 else -1 for i in range(k - 1)] for c in range(2 ** (k - 1) - 1)]
        return np.array(cols, dtype=np.float32).reshape(-1, k).T
    bits = max(15, int(np.ceil(10 * np.log2(k))))
    rng = np.random.default_rng(k)
    tries = [rng.choice([-1, 1], size=(k, bits)) for _ in range(50)]
    return max(tries, key=lambda m: np.min(bits - (m @ m.T) + 4 * bits * np.eye(k))).astype(np.float32)


def fit_linear(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regressions, one per column of ``y`` (-1, 1), by accelerated
    gradient steps. (weights, biases)."""
    w = np.zeros((x.shape[1], y.shape[1]), dtype=np.float32)
    b = np.zeros(y.shape[1], dtype=np.float32)
    ahead_w, ahead_b = w, b
    weight = (weight / weight.sum())[:, None].astype(np.float32)
    for t in range(STEPS):
        g = -y * weight / (1 + np.exp(np.clip(y * (x @ ahead_w + ahead_b), -30, 30)))
        new_w = ahead_w - RATE * (x.T @ g + PENALTY * ahead_w)
        new_b = ahead_b - RATE / 4 * g.sum(axis=0)
        m = t / (t + 3)
        ahead_w, ahead_b = new_w + m * (new_w - w), new_b + m * (new_b - b)
        w, b = new_w, new_b
    return w, b


class LanguageModel:
    def __init__(self, languages: list[str], code, weights, bias, trust, size: int):
        self.languages, self.code, self.weights = languages, code, weights
        self.bias, self.trust, self.size = bias, trust, size

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, ambiguous)."""
        if not self.languages or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        margin = language_features(text, self.size) @ self.weights + self.bias
        loss = np.logaddexp(0, -self.code * margin) @ self.trust
        order = np.argsort(loss, kind="stable")
        share = np.exp(loss[order[0]] - loss)
        score = float(1 / share.sum())
        return self.languages[order[0]], score, bool(loss[order[1]] - loss[order[0]] < MARGIN)


def fit(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
        size: int = SIZE, most: int = SAMPLE) -> LanguageModel:
    """Fit on a bounded sample of the rows of ``docs`` with a label."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), row_hash(id_col, text_col).alias("h"),
        F.col(text_col).cast("string").alias("text"))
    picked, _ = sample_by_class(known, "lang", "h", most)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array(langs, pa.string()),
                "x": pa.array([language_features(t, size).astype(np.float16).tobytes() for t in texts],
                              pa.binary())})

    # At most ``most`` rows, or one per language.
    rows = drawn(known, picked, "lang", "h", "text").mapInArrow(featured, "lang string, x binary").collect()
    languages = sorted({r["lang"] for r in rows})
    if len(languages) < 2:
        return LanguageModel(languages, None, None, None, None, size)
    rows = sorted(rows, key=lambda r: (r["lang"], bytes(r["x"])))
    x = np.stack([np.frombuffer(r["x"], dtype=np.float16).astype(np.float32) for r in rows])
    at = np.array([languages.index(r["lang"]) for r in rows])
    code = codewords(len(languages))
    per = np.bincount(at)
    y = code[at]
    w, b = fit_linear(x, y, 1.0 / per[at])
    # A bit counts by the mean margin's confidence on the training rows.
    trust = np.tanh(np.maximum((y * (x @ w + b)).mean(axis=0), 0.05))
    return LanguageModel(languages, code, w, b, (trust / trust.mean()).astype(np.float32), size)


PREDICTION = "lang string, score double, ambiguous boolean"


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text", out: str = "lang_pred") -> DataFrame:
    """``docs`` plus ``out``, ``score`` and ``ambiguous``. Only the texts go to
    Python, and only the predictions come back."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            got = [model.predict(t.as_py()) for t in b]
            langs, scores, unsure = zip(*got) if got else ((), (), ())
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(unsure, pa.bool_())],
                names=["lang", "score", "ambiguous"])

    # Not deterministic for the optimizer: a filter on the result must not run it again.
    udf = F.arrow_udf(run, PREDICTION, ArrowUDFType.SCALAR_ITER).asNondeterministic()
    got = name_clash_free(docs, "prediction")
    added = (out, "score", "ambiguous")
    own = [c for c in docs.columns if c.lower() not in {a.lower() for a in added}]
    marked = docs.withColumn(got, udf(F.col(text_col).cast("string")))
    return marked.select(*[F.col(f"`{c}`") for c in own], F.col(f"{got}.lang").alias(out),
                         F.col(f"{got}.score").alias("score"), F.col(f"{got}.ambiguous").alias("ambiguous"))


def held_out(id_col: str = "doc_id"):
    return fold(id_col, 3) == 1


def op6_language(spark, sf_dir: str) -> DataFrame:
    from kasir.llm.common import prepare, table
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out()))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")
