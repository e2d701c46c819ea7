"""Best-fit packing of token pieces by minimum bin slack.

A document's ids, ended by ``end_id``, form one piece; a longer one is cut into
pieces of ``capacity`` ids, the first of which may be shorter. Only the number
of pieces per length matters for packing: a histogram of at most ``capacity``
entries, whatever the input's size. On it, ``plan`` fills one sequence after the
other: the largest piece left, plus the fullest feasible combination of the
other lengths, found by subset sums on a bitset. A combination stays the
fullest for as long as its pieces last, so it is taken that many times at once,
and the plan stays small (each step all but uses up a length).

Pieces then find their place on their own: a piece's rank among those of its
length selects the step, the sequence and the offset. Ranks are counted under
(length, salt) and shifted by the counts of smaller salts, so a length that a
third of all pieces share is spread over many tasks.

Defined results: a null text is empty and packs as its end id. Ids may be null
or repeat; each row is packed on its own. A text of any length is cut into pieces;
ids go back to Spark some megabytes at a time. ``token_pieces`` ignores extra
columns; ``pack`` passes them through, whatever their names, but for
``sequence_id`` and ``offset``, which it replaces. An empty table gives no rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kasir.llm.common import name_clash_free, slots, staged, text_or_empty
from kasir.llm.pieces import encoder

CAPACITY = 2048
HELD_BYTES = 1 << 24            # ids sent back at once
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text", added_tokens: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids) of every whole text.
    ``added_tokens``: see ``pieces``."""
    end = struct.pack("<I", end_id)
    width = 4 * capacity

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                          names=["doc_id", "piece", "start", "length", "ids"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, added_tokens)
        for b in batches:
            out: list[tuple] = []
            held = 0
            for doc, data in zip(b.column(0).to_pylist(), enc.encode_all(b.column(1))):
                data += end
                first = len(data) % width or width
                spans = [(0, first), *((s, s + width) for s in range(first, len(data), width))]
                out += [(doc, k, s // 4, (e - s) // 4, data[s:e]) for k, (s, e) in enumerate(spans)]
                held += len(data)
                if held > HELD_BYTES:           # long texts: several batches
                    yield batch(out)
                    out, held = [], 0
            if out:
                yield batch(out)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(cut, PIECES)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths (with multiples, at most ``counts``) whose sum is the largest
    possible one within ``room``; longer pieces are preferred. Bit s of the
    set is on when some combination of the lengths so far sums to s."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left = min(counts[length], room // length)
        steps.append((length, left, reach))
        take = 1
        while left > 0:                     # multiples by doubling
            take = min(take, left)
            reach |= (reach << (length * take)) & mask
            left -= take
            take *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, most, before in reversed(steps):
        n = next(n for n in range(most + 1) if n * length <= total and before >> (total - n * length) & 1)
        if n:
            chosen[length] = n
            total -= n * length
    return chosen


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Steps (sequences, {length: pieces per sequence}) that use up all pieces."""
    counts = {length: n for length, n in histogram.items() if n > 0}
    steps = []
    while counts:
        seed = max(counts)
        rest = dict(counts)
        rest[seed] -= 1
        if not rest[seed]:
            del rest[seed]
        mix = fullest(rest, capacity - seed)
        mix[seed] = mix.get(seed, 0) + 1
        times = min(counts[length] // n for length, n in mix.items())
        for length, n in mix.items():
            counts[length] -= n * times
            if not counts[length]:
                del counts[length]
        steps.append((times, mix))
    return steps


def placements(steps: list[tuple[int, dict[int, int]]], capacity: int) -> tuple[np.ndarray, ...]:
    """The plan by length and rank, sorted: key (length * 2^44 + first rank),
    pieces per sequence, first sequence, offset in the sequence."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for times, mix in steps:
        offset = 0
        for length in sorted(mix, reverse=True):
            n = mix[length]
            rows.append((length, used.get(length, 0), n, sequence, offset))
            used[length] = used.get(length, 0) + n * times
            offset += n * length
        sequence += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return tuple(np.ascontiguousarray(table[:, i]) for i in range(5))


RANK_BITS = 44                              # pieces of one length: below 2^44


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length, any others) plus sequence_id and
    offset. ``pieces`` is read twice, so pass a staged table."""
    spark = pieces.sparkSession
    n = slots(spark)
    # At most ``capacity`` rows: one per length.
    histogram = {r["length"]: r["n"] for r in
                 pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    length, first, per, sequence, offset = placements(plan(histogram, capacity), capacity)
    key = (length << RANK_BITS) + first

    salt, local, base, rank = (name_clash_free(pieces, c) for c in ("salt", "local", "base", "rank"))
    salted = pieces.withColumn(salt, F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(n)))
    sizes = salted.groupBy("length", salt).agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", salt, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(base))
    within = Window.partitionBy("length", salt).orderBy("doc_id", "piece")
    ranked = (salted.withColumn(local, F.row_number().over(within))
              .join(bases, ["length", salt])
              .withColumn(rank, F.col(base) + F.col(local) - 1))
    kept = [f for f in pieces.schema.fields if f.name.lower() not in ("sequence_id", "offset")]
    out_type = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
                         + ["sequence_id bigint", "offset bigint"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nth_of_length = np.asarray(b.column(rank))
            own = np.asarray(b.column("length"))
            at = np.searchsorted(key, (own << RANK_BITS) + nth_of_length, side="right") - 1
            nth = nth_of_length - first[at]
            seq = sequence[at] + nth // per[at]
            off = offset[at] + nth % per[at] * own
            yield pa.RecordBatch.from_arrays(
                [*(b.column(f.name) for f in kept), pa.array(seq), pa.array(off)],
                names=[*(f.name for f in kept), "sequence_id", "offset"])

    return ranked.select(*[F.col(f"`{f.name}`") for f in kept], rank).mapInArrow(place, out_type)


def sequences(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, from rows that
    carry ``ids``. A sequence has at most ``capacity`` ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.unhex(F.lit("")), lambda acc, p: F.concat(acc, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0,
                   added_tokens: bool = False) -> DataFrame:
    """Digest of the packing: the ids' checksum in place of the ids."""
    pieces = token_pieces(docs, tokenizer, capacity, end_id, added_tokens=added_tokens)
    rows = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(staged(rows, "pieces"), capacity)


def op5_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from kasir.llm.common import TEXT_ROWS, prepare, table
    prepare(spark, TEXT_ROWS)
    docs = table(spark, sf_dir, "documents")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), added_tokens=True)
