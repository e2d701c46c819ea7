"""Token files, packing and tree BPE against the libraries themselves."""

import base64
import os
import random
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import SF_SMALL
from llm_fixtures import docs, llm, no_docs  # noqa: F401
from kasir.llm import bpe_tree, packing, pieces, token_store

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def lib():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


def le(ids):
    return np.array(ids, dtype="<u4").tobytes()


def random_texts(n, seed=1):
    rng = random.Random(seed)
    parts = ["a", "word", " ", "  ", "\n", "\n\n", "'s", "'", "é", "日", "!", "12", " the", "\x1c", "\u0085",
             " ", "ll", ".", ",\n", " \t", "<|endoftext|>", "ß", "I'LL", "\r\n"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_encoding_gives_its_memory_back():
    """A worker does not hold a batch's memory beside the work that follows."""
    code = """
import gc
from kasir.llm.pieces import PieceEncoder
def held():
    return int(open('/proc/self/statm').read().split()[1]) * 4 // 1024
enc = PieceEncoder(%r)
texts = [' '.join(f'w{i}x{j}' for j in range(60)) for i in range(10_000)]
before = held()
enc.encode_all(texts)
gc.collect()
print(held() - before)
""" % JSON
    root = os.path.dirname(os.path.dirname(os.path.dirname(pieces.__file__)))
    got = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True,
                         env={**os.environ, "PYTHONPATH": root})
    assert int(got.stdout) < 60


def test_pieces_encode_like_the_library(lib):
    texts = random_texts(3000) + ["", " ", "x" * 400, "don't we'll"]
    got = pieces.PieceEncoder(JSON, cut_bytes=3000, chunk=20).encode_all(texts)
    assert got == [le(lib(t)) for t in texts]


def test_token_files_round_trip(llm, docs, lib):
    manifest = token_store.write_tokens(docs, JSON, parts=3)
    got = sorted(((r.doc_id, r.start, bytes(r.ids)) for r in token_store.read_tokens(manifest).collect()),
                 key=lambda r: r[1])
    rows = sorted(docs.select("doc_id", "text").collect(),
                  key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    at, want = 0, []
    for r in rows:
        ids = lib(r.text or "") + [0]
        want.append((r.doc_id, at, le(ids)))
        at += len(ids)
    assert got == want


def test_lookup_reads_only_the_frames_asked_for(llm, docs, lib):
    manifest = token_store.write_tokens(docs, JSON, parts=3)
    wanted = llm.createDataFrame([(14,), (None,), (999,)], "doc_id bigint")
    got = {r.doc_id: bytes(r.ids) for r in token_store.find_tokens(manifest, wanted).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got == {i: le(lib(texts[i]) + [0]) for i in (14, None)}


def test_files_are_plain_zstandard_with_checksums(tmp_path):
    import zstandard
    path = str(tmp_path / "a.zst")
    w = token_store.PartWriter(path)
    data = {i: le(range(i, i + 50)) for i in range(5)}
    for i, d in data.items():
        w.add(i, d)
    w.close()
    raw = open(path, "rb").read()
    with zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True) as r:
        assert r.read() == b"".join(data.values())
    part = token_store.open_part(path)
    assert part.document(3) == data[3] and part.find([4, 9]) == [4]
    at = int(part.offsets[2])
    damaged = bytearray(raw)
    damaged[at + 12] ^= 0xFF
    open(path, "wb").write(bytes(damaged))
    part = token_store.open_part(path)
    assert part.document(1) == data[1]
    with pytest.raises(Exception):
        part.document(2)


def test_empty_table_of_tokens(llm, no_docs):
    manifest = token_store.write_tokens(no_docs, JSON, parts=2)
    assert manifest.count() == 0 and token_store.read_tokens(manifest).count() == 0


def check_packing(rows, capacity):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in sequences.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_packing_pieces_and_sequences(llm, docs, lib):
    cap = 64
    got = packing.pack_documents(docs, JSON, cap).collect()
    check_packing(got, cap)
    want = []
    for r in docs.collect():
        ids = lib(r.text or "") + [0]
        first = len(ids) % cap or cap
        cuts = [0, *range(first, len(ids) + 1, cap)]
        want += [(r.doc_id, k, a, b - a, zlib.crc32(le(ids[a:b]))) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    key = lambda t: tuple((x is None, x or 0) for x in t)
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got], key=key) == sorted(want, key=key)


def test_packed_sequences_hold_the_ids(llm, docs):
    from kasir.llm.common import staged
    rows = packing.pack(staged(packing.token_pieces(docs, JSON, 64), "p"), 64)
    total = sum(len(r.ids) for r in rows.collect())
    assert sum(len(r.ids) for r in packing.sequences(rows).collect()) == total


def test_clashing_piece_columns_pass_through(llm):
    rows = [(i, 0, 0, 1 + i % 5, "s", 7, "b", 9, "o") for i in range(20)]
    df = llm.createDataFrame(rows, "doc_id bigint, piece int, start bigint, length bigint, salt string, local int, "
                                   "base string, rank int, offset string")
    got = packing.pack(df, 10).collect()
    assert {(r.salt, r.local, r.base, r["rank"]) for r in got} == {("s", 7, "b", 9)} and len(got) == 20
    check_packing(got, 10)


def test_one_id_spreads_over_files(llm, lib):
    """Rows of one id, equal ones too, do not end up in one file."""
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, f"text {i}" if i % 2 else "same") for i in range(600)]
    manifest = token_store.write_tokens(llm.createDataFrame(rows, "doc_id bigint, text string"), JSON, parts=6)
    sizes = [r.n_docs for r in manifest.collect()]
    assert sum(sizes) == 600 and max(sizes) <= 200
    for wanted, n in ((None, 200), (5, 201)):
        got = token_store.find_tokens(manifest, llm.createDataFrame([(wanted,)], "doc_id bigint"))
        assert got.count() == n


def test_long_texts_are_read_in_batches(llm, lib, monkeypatch):
    monkeypatch.setattr(token_store, "READ_BYTES", 1000)
    rows = [(i, f"word{i} " * 300) for i in range(12)]
    manifest = token_store.write_tokens(llm.createDataFrame(rows, "doc_id bigint, text string"), JSON, parts=2)
    got = {r.doc_id: bytes(r.ids) for r in token_store.read_tokens(manifest).collect()}
    assert got == {i: le(lib(t) + [0]) for i, t in rows}


def test_packing_an_empty_table(llm, no_docs):
    assert packing.pack_documents(no_docs, JSON).count() == 0


def subset_sums(counts, room):
    best = {0}
    for length, n in counts.items():
        best = {s + length * k for s in best for k in range(n + 1) if s + length * k <= room}
    return max(best)


def test_fullest_combination_against_all_subsets():
    rng = random.Random(4)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 4) for _ in range(rng.randint(1, 6))}
        room = rng.randint(0, 60)
        mix = packing.fullest(counts, room)
        assert all(n <= counts[x] for x, n in mix.items())
        assert sum(x * n for x, n in mix.items()) == subset_sums(counts, room)


def used_up(hist):
    left, sequences = dict(hist), 0
    for times, mix in packing.plan(hist):
        assert sum(x * n for x, n in mix.items()) <= 2048
        sequences += times
        for x, n in mix.items():
            left[x] -= n * times
    assert not any(left.values())
    return sequences


def test_plan_uses_every_piece_and_few_sequences():
    rng = random.Random(5)
    hist = {x: rng.randint(1, 3000) for x in range(2, 2049)}
    assert used_up(hist) <= 1.01 * sum(x * n for x, n in hist.items()) / 2048
    # One length holds most pieces: two of them fill a sequence at best.
    assert used_up({700: 400_000, 648: 100, 5: 3}) <= 200_001
    assert used_up({2048: 10**9, 1: 1}) == 10**9 + 1
    assert packing.plan({}) == []


@pytest.fixture(scope="module")
def tiktoken_encode():
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={}).encode_ordinary


def test_tree_is_the_whole_text_encoding(tiktoken_encode):
    assert bpe_tree.PATTERN == public_tokenizers.PATTERN
    for leaf in (1, 4, 16):
        codec = bpe_tree.codec(RANKS, leaf)
        for t in random_texts(700, seed=leaf) + ["a" * 700, "!" * 300 + " " * 300 + "b"]:
            ids = codec.encode(t)
            assert ids == tiktoken_encode(t)
            assert codec.decode(ids) == t.encode()


def test_tree_over_a_table(llm, docs, tiktoken_encode):
    both = bpe_tree.decode_table(bpe_tree.encode_table(docs, RANKS, out="tokens", leaf=64), RANKS, "tokens", leaf=64)
    for r in both.collect():
        assert bytes(r.tokens) == le(tiktoken_encode(r.text or ""))
        assert bytes(r.decoded) == (r.text or "").encode()
    assert bpe_tree.encode_table(docs.limit(0), RANKS, out="tokens").count() == 0
    again = bpe_tree.encode_table(docs, RANKS)          # replaces a column of that name
    assert again.columns.count("ids") == 1


def test_literals_of_added_tokens_as_in_the_plain_library(llm, tmp_path):
    """The queries follow encode(text, add_special_tokens=False) of an
    unmodified tokenizer, also where a text holds an added token's literal."""
    plain = Tokenizer.from_file(JSON)
    ids = lambda s: plain.encode(s, add_special_tokens=False).ids
    assert ids("a <|endoftext|> b") == [64, 220, 50256, 275]
    texts = random_texts(2000, seed=9) + ["<|endoftext|>" * 3, "a <|endoftext|> b", " <|endoftext|>", "<|endoftext|"]
    got = pieces.PieceEncoder(JSON, True, cut_bytes=3000, chunk=20).encode_all(texts)
    assert got == [le(ids(t)) for t in texts]
    rows = list(enumerate(texts[-300:]))
    df = llm.createDataFrame(rows, "doc_id bigint, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    at, want = 0, []
    for i, t in rows:
        data = ids(t) + [0]
        want.append((i, at, len(data), zlib.crc32(le(data))))
        at += len(data)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32)
                  for r in token_store.op1_token_files(llm, str(tmp_path)).collect()) == want
    import corpus_pipeline
    for packed in (packing.op5_packing(llm, str(tmp_path)), corpus_pipeline.packing_stage(llm, df, str(tmp_path))):
        assert sorted((r.doc_id, r.length, r.ids_crc32) for r in packed.collect()) == [
            (i, n, crc) for i, _, n, crc in want]


def test_queries_against_the_libraries(llm, lib, tiktoken_encode):
    import hashlib

    import pyarrow.parquet as pq
    texts = {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()}
    at, want = 0, {}
    for i in sorted(texts):
        ids = lib(texts[i]) + [0]
        want[i] = (at, len(ids), zlib.crc32(le(ids)))
        at += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32)
            for r in token_store.op1_token_files(llm, SF_SMALL).collect()} == want
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256)
            for r in bpe_tree.op7_bpe_tree(llm, SF_SMALL).collect()} == {
        i: (len(e := tiktoken_encode(t)), sha(le(e)), sha(t.encode())) for i, t in texts.items()}
    got = packing.op5_packing(llm, SF_SMALL).collect()
    n = check_packing(got, 2048)
    assert sum(r.length for r in got) == at and n <= -(-at // 2048) + 2
