"""Exact byte-level BPE ids of many texts with the ``tokenizers`` library.

The pre-tokenizer's pattern never joins what stands before an ASCII space with
what follows, when the space is followed by a character that is not white
space: the space starts a new match, and no match before it can end later
(``\\s+(?!\\S)`` leaves a run's last space to the following word). A text cut
there can be encoded piece by piece, and pieces recur. So the texts of a batch
are cut by Arrow, each distinct piece of the batch is encoded once, and NumPy
puts the ids of all pieces together. Distinct pieces are encoded many at a time,
joined by their spaces: a token that starts with a space starts a piece. A piece of
letters and marks alone falls into its matches at sight, which the library's BPE
model then encodes without the pattern. The pieces of the last batches, ``KNOWN``
at most, are kept with their ids in a few arrays; so memory is bounded. What a call
freed goes back to the system: a Python worker outlives its tasks, and would hold
its largest batch's memory beside all later work.

Texts with other spaces (runs, or before white space or the end), and texts that
hold the literal of an added token, such as ``<|endoftext|>``, go through the
library's whole encoder, long ones in chunks cut as above. With ``added_tokens``
the literal gives that token's id, as in the library's plain ``encode``;
otherwise it is ordinary text.
"""

from __future__ import annotations

import ctypes
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A space that starts a word, and one that does not (Arrow's \s is ASCII only).
CUT = re.compile(r" (?=\S)")
LOOSE = (r" ([\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}"
         r"\x{3000}]|$)")
SPACE = "Ġ"                # how the vocabulary spells a space
# Characters whose class leaves no doubt: Latin letters, and ASCII punctuation
# but for the apostrophe, which can start a contraction with letters after it.
_LETTERS = r"A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}"
_MARKS = r"!-&(-/:-@\[-`{-~"
PLAIN = rf"\A(?:\n?[{_LETTERS}{_MARKS}])+\n?\z"
_PY = _LETTERS.replace(r"\x{24f}", "\u024f").replace(r"\x{", r"\x").replace("}", "")
MATCHES = re.compile(rf" ?[{_PY}]+| ?[{_MARKS}]+|\n")
# The vocabulary spells each byte as a printable character: itself where it is
# one, else the next code point from 256 on. NUL stays as the delimiter.
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
SYMBOLS = np.arange(256, dtype="<u2")
SYMBOLS[[b for b in range(256) if b not in _SHOWN]] = 256 + np.arange(256 - len(_SHOWN))
SYMBOLS[0] = 0
# Pieces kept from batch to batch, and characters of the longest one kept.
KNOWN = 100_000
KNOWN_CHARS = 64
# Texts cut at once, in bytes; characters of a chunk; pieces joined, and encoded
# in one call; pieces put together at once.
CUT_BYTES = 2 << 20
CHUNK = 1 << 20
JOINED = 256
CALLED = 1 << 13
WINDOW = 1 << 18

_encoders: dict[tuple[str, bool], "PieceEncoder"] = {}


def chunks(text: str, size: int) -> Iterator[str]:
    """``text`` in parts of at least ``size`` characters that can be encoded on
    their own (the last one may be shorter)."""
    at = 0
    while len(text) - at > size and (cut := CUT.search(text, at + size)):
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def release() -> None:
    """Give freed memory back to the system (glibc keeps it otherwise)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def gathered(data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The spans of ``data`` that start at ``begin``, one after the other."""
    ends = np.concatenate([[0], np.cumsum(length)])
    out = np.empty(ends[-1], dtype=data.dtype)
    for lo in range(0, len(begin), WINDOW):
        hi = min(lo + WINDOW, len(begin))
        at = np.repeat(begin[lo:hi] - ends[lo:hi], length[lo:hi]) + np.arange(ends[lo], ends[hi])
        out[ends[lo]:ends[hi]] = data[at]
    return out


class PieceEncoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, added_tokens: bool = False, cut_bytes: int = CUT_BYTES, chunk: int = CHUNK):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.lib = Tokenizer.from_file(path)
        self.matches = Tokenizer(self.lib.model)
        self.matches.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\0")
        self.lib.encode_special_tokens = not added_tokens
        added = self.lib.get_added_tokens_decoder()
        self.literals = [t.content for t in added.values()]
        if any(t.single_word or t.lstrip or t.rstrip or " " in t.content for t in added.values()):
            raise ValueError(f"added tokens of {path} depend on the text around them")
        self.cut_bytes, self.chunk = cut_bytes, chunk
        vocabulary = self.lib.get_vocab(with_added_tokens=True)
        self.starts = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.starts[[i for t, i in vocabulary.items() if t.startswith(SPACE)]] = True
        self.known = pa.array([], pa.string())
        self.known_ids, self.known_length = np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.lib.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4") for e in found]

    def _text(self, text: str) -> bytes:
        return b"".join([self._whole([c])[0].tobytes() for c in chunks(text, self.chunk)])

    def _new(self, pieces: list[str], plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each piece) of pieces, a space before each."""
        ids: list[np.ndarray] = []
        for lo in range(0, len(pieces), CALLED):
            part = pieces[lo:lo + CALLED]
            texts = [" " + " ".join(part[i:i + JOINED]) for i in range(0, len(part), JOINED)]
            if plain:
                texts = [SYMBOLS[np.frombuffer("\0".join(MATCHES.findall(t)).encode(), dtype="u1")]
                         .tobytes().decode("utf-16-le") for t in texts]
                ids += [np.array(e.ids, dtype="<u4")
                        for e in self.matches.encode_batch_fast(texts, add_special_tokens=False)]
            else:
                ids += self._whole(texts)
        data = np.concatenate(ids) if ids else np.zeros(0, dtype="<u4")
        first = np.flatnonzero(self.starts[data])
        if len(first) != len(pieces):
            raise ValueError("the vocabulary does not keep words apart at spaces")
        return data, np.diff(np.append(first, len(data)))

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each piece) of distinct pieces, a space before each."""
        at = pc.index_in(pieces, value_set=self.known)
        old = np.asarray(pc.is_valid(at))
        plain = np.asarray(pc.match_substring_regex(pieces, PLAIN)) & ~old
        length = np.zeros(len(pieces), dtype=np.int64)
        where = np.zeros(len(pieces), dtype=np.int64)
        place = np.asarray(pc.fill_null(at, 0)).astype(np.int64)[old]
        begin = np.cumsum(self.known_length) - self.known_length
        length[old], where[old] = self.known_length[place], begin[place]
        data, end = [self.known_ids], len(self.known_ids)
        for mask, easy in ((plain, True), (~plain & ~old, False)):
            ids, n = self._new(pieces.filter(pa.array(mask)).to_pylist(), easy)
            length[mask], where[mask] = n, end + np.cumsum(n) - n
            data.append(ids)
            end += len(ids)
        out = gathered(np.concatenate(data), where, length)
        self._keep(pieces, out, length)
        return out, length

    def _keep(self, pieces: pa.Array, ids: np.ndarray, length: np.ndarray) -> None:
        """Know these pieces from now on, and of the ones before what fits."""
        short = np.flatnonzero(np.asarray(pc.less_equal(pc.utf8_length(pieces), KNOWN_CHARS)))[:KNOWN]
        unseen = np.asarray(pc.is_null(pc.index_in(self.known, value_set=pieces)))
        older = np.flatnonzero(unseen)[:KNOWN - len(short)]
        begin, before = np.cumsum(length) - length, np.cumsum(self.known_length) - self.known_length
        self.known_ids = np.concatenate([gathered(ids, begin[short], length[short]),
                                         gathered(self.known_ids, before[older], self.known_length[older])])
        self.known_length = np.concatenate([length[short], self.known_length[older]])
        self.known = pa.concat_arrays([pieces.take(pa.array(short)), self.known.take(pa.array(older))])

    def encode_all(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Ids of each text; none may be null."""
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        part = np.cumsum(np.asarray(pc.binary_length(texts)).astype(np.int64)) // self.cut_bytes
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)] if len(texts) else [0]
        out = [ids for lo, hi in zip(cuts, cuts[1:]) for ids in self._encode_some(texts.slice(lo, hi - lo))]
        release()
        return out

    def _encode_some(self, texts: pa.Array) -> list[bytes]:
        odd = pc.or_(pc.match_substring_regex(texts, LOOSE), pc.equal(texts, ""))
        for literal in self.literals:
            odd = pc.or_(odd, pc.match_substring(texts, literal))
        odd = np.asarray(odd)
        out: list[bytes] = [b""] * len(texts)
        for i in np.flatnonzero(odd).tolist():
            out[i] = self._text(texts[i].as_py())
        even = np.flatnonzero(~odd)
        if not len(even):
            return out
        cut = pc.split_pattern(texts.take(pa.array(even)), " ")
        starts = np.asarray(cut.offsets).astype(np.int64)
        flat = cut.flatten()
        starts -= starts[0]
        # A text's first piece has no space before it, and may be empty.
        first = flat.take(pa.array(starts[:-1])).dictionary_encode()
        rest = np.ones(len(flat), dtype=bool)
        rest[starts[:-1]] = False
        coded = flat.filter(pa.array(rest)).dictionary_encode()
        del cut, flat
        data, length = self._pieces(coded.dictionary)
        alone = self._whole(first.dictionary.to_pylist())
        length = np.concatenate([length, [len(a) for a in alone]]).astype(np.int64)
        data = np.concatenate([data, *alone])
        which = np.empty(len(rest), dtype=np.int64)
        which[rest] = np.asarray(coded.indices)
        which[~rest] = np.asarray(first.indices).astype(np.int64) + len(coded.dictionary)

        begin = np.concatenate([[0], np.cumsum(length)])[:-1]
        joined = gathered(data, begin[which], length[which])
        ends = np.concatenate([[0], np.cumsum(length[which])])
        bounds = ends[starts].tolist()
        for i, a, b in zip(even.tolist(), bounds, bounds[1:]):
            out[i] = joined[a:b].tobytes()
        return out


def encoder(path: str, added_tokens: bool = False) -> PieceEncoder:
    """One encoder per Python worker, vocabulary file and way with literals."""
    key = (path, added_tokens)
    if key not in _encoders:
        _encoders[key] = PieceEncoder(path, added_tokens)
    return _encoders[key]
