"""Byte-level BPE by tree reduction.

Encoded texts form a monoid: ``join`` turns the ids of two neighbouring strings
into those of the joined string. ``encode`` halves a text down to short leaves,
encodes the leaves and joins up the tree; ``decode`` halves the ids and
concatenates the leaves' bytes up the tree.

``join`` re-encodes a window around the seam and keeps every id outside it. The
window grows until both of its edges lie at a cut: a single ASCII space followed
by a character that is not white space. No match of the split pattern spans a
cut, whatever surrounds it (the space starts a new match, and a run of white
space before it gives the space up), so the ids left and right of a cut do not
depend on each other: outside the window they are provably final. Without a cut
the window reaches the end of its half.

Defined results: a null or empty text has no ids and decodes to no bytes. Very
long texts need memory in proportion to the text only. Null or repeated ids
pass through, row by row, as do extra columns in ``encode_table``.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kasir.llm.common import name_clash_free, text_or_empty

# Fixed value: the split pattern of the vocabulary.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
LEAF = 2048            # characters, ids
WINDOW = 64            # characters first tried on each side of a seam

_codecs: dict[tuple[str, int], "TreeCodec"] = {}


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def is_cut(text: str, i: int, end: int) -> bool:
    """No match spans position ``i``; judged by characters before ``end``."""
    return i + 1 < end and text[i] == " " and not text[i + 1].isspace()


class TreeCodec:
    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN, leaf: int = LEAF):
        import tiktoken
        base = tiktoken.Encoding("tree", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.base = base.encode_ordinary
        self.leaf = leaf
        self.token = {rank: token for token, rank in ranks.items()}
        self.width = {rank: len(token) for rank, token in self.token.items()}

    def left_edge(self, text: str, lo: int, mid: int) -> int:
        """The last cut before ``mid`` seen from a window that doubles."""
        size = WINDOW
        while True:
            start = max(lo, mid - size)
            i = text.rfind(" ", start, mid)
            while i >= 0:
                if is_cut(text, i, mid):
                    return i
                i = text.rfind(" ", start, i)
            if start == lo:
                return lo
            size *= 2

    def right_edge(self, text: str, mid: int, hi: int) -> int:
        """The first cut at or after ``mid``, likewise."""
        size = WINDOW
        while True:
            stop = min(hi, mid + size)
            i = text.find(" ", mid, stop)
            while i >= 0:
                if is_cut(text, i, hi):
                    return i
                i = text.find(" ", i + 1, stop)
            if stop == hi:
                return hi
            size *= 2

    def _drop_tail(self, ids: list[int], n_bytes: int) -> int:
        """How many ids stay when the last ``n_bytes`` bytes go."""
        at = len(ids)
        while n_bytes > 0:
            at -= 1
            n_bytes -= self.width[ids[at]]
        assert n_bytes == 0, "a cut lies between tokens"
        return at

    def _drop_head(self, ids: list[int], n_bytes: int) -> int:
        at = 0
        while n_bytes > 0:
            n_bytes -= self.width[ids[at]]
            at += 1
        assert n_bytes == 0, "a cut lies between tokens"
        return at

    def join(self, text: str, lo: int, mid: int, hi: int, left: list[int], right: list[int]) -> list[int]:
        """Ids of text[lo:hi] from those of text[lo:mid] and text[mid:hi]."""
        a, b = self.left_edge(text, lo, mid), self.right_edge(text, mid, hi)
        keep = self._drop_tail(left, len(text[a:mid].encode()))
        skip = self._drop_head(right, len(text[mid:b].encode()))
        return left[:keep] + self.base(text[a:b]) + right[skip:]

    def encode(self, text: str, lo: int = 0, hi: int | None = None) -> list[int]:
        hi = len(text) if hi is None else hi
        if hi - lo <= self.leaf:
            return self.base(text[lo:hi])
        mid = (lo + hi) // 2
        return self.join(text, lo, mid, hi, self.encode(text, lo, mid), self.encode(text, mid, hi))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= self.leaf:
            return b"".join([self.token[i] for i in ids])
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


def codec(path: str, leaf: int = LEAF) -> TreeCodec:
    """One codec per Python worker, vocabulary and leaf size."""
    if (path, leaf) not in _codecs:
        _codecs[path, leaf] = TreeCodec(load_ranks(path), leaf=leaf)
    return _codecs[path, leaf]


def _mapped(df: DataFrame, source, out: str, work) -> DataFrame:
    """``df`` plus a binary column ``out`` (replacing one of that name),
    worked out batch by batch."""
    given = name_clash_free(df, "__source")
    rows = df.withColumn(given, source).drop(out)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
                       + [f"`{out}` binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = pa.array([work(x.as_py()) for x in b.column(b.num_columns - 1)], pa.binary())
            cols = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, made], names=[*b.schema.names[:-1], out])

    return rows.mapInArrow(run, schema)


def encode_table(docs: DataFrame, ranks_path: str, text_col: str = "text", out: str = "ids",
                 leaf: int = LEAF) -> DataFrame:
    """``docs`` plus ``out``: the ids as little-endian unsigned 32-bit values."""
    return _mapped(docs, text_or_empty(text_col), out,
                   lambda t: np.array(codec(ranks_path, leaf).encode(t), dtype="<u4").tobytes())


def decode_table(tokens: DataFrame, ranks_path: str, ids_col: str = "ids", out: str = "decoded",
                 leaf: int = LEAF) -> DataFrame:
    """``tokens`` plus ``out``: the bytes that the ids stand for."""
    return _mapped(tokens, F.coalesce(F.col(ids_col), F.unhex(F.lit(""))), out,
                   lambda b: codec(ranks_path, leaf).decode(np.frombuffer(b, dtype="<u4").tolist()))


def op7_bpe_tree(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from kasir.llm.common import prepare, table
    prepare(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = encode_table(docs, path).drop("text")
    both = decode_table(ids, path)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
