"""Token ids in seekable Zstandard files.

``write_tokens`` sorts documents by id over ranges, encodes every whole text and
writes one file per range into a shared folder. A file is a sequence of
independent Zstandard frames, one per document, each with its content checksum,
followed by two skippable frames: the document ids, then a seek table in the
public "Zstandard seekable format" layout (compressed size, uncompressed size
and XXH64-based checksum of every frame). Any Zstandard tool can decompress the
whole file; ``open_part`` reads the trailer and decompresses only the documents
asked for.

A task writes under a name of its own and reports it; the staged manifest of
those reports is the commit. A retried or speculative task leaves at most a file
that no manifest names.

Defined results: a null text is empty and holds only the end id. A null id sorts
first and is read back as null. Repeated ids are separate entries, ordered by a
hash of the text, and rows equal in both by their place in the input: an id that a
third of all rows share spreads over files. A text of any length is one frame;
frames are read some megabytes at a time. Extra columns are ignored. An empty
table gives an empty manifest.
"""

from __future__ import annotations

import struct
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kasir.llm.common import shared_path, slots, staged, text_or_empty
from kasir.llm.pieces import encoder

# Fixed values of the Zstandard frame and seekable formats.
SKIPPABLE_SEEK = 0x184D2A5E
SKIPPABLE_IDS = 0x184D2A50
SEEK_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

LEVEL = 3
READ_BYTES = 8 << 20            # ids sent back at once
MANIFEST = ("part int, file string, first_id bigint, last_id bigint, "
            "n_docs bigint, n_tokens bigint, n_bytes bigint")
ENTRY = "doc_id bigint, start bigint, ids binary"


def filesystem(path: str):
    """(filesystem, path) of a URI or of a plain path."""
    from pyarrow import fs
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class PartWriter:
    """Writes one file; ``add`` takes documents in their final order."""

    def __init__(self, path: str, level: int = LEVEL):
        import zstandard
        files, self.at = filesystem(path)
        files.create_dir(self.at.rsplit("/", 1)[0], recursive=True)
        self.out = files.open_output_stream(self.at, compression=None)
        self.zip = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.seek: list[bytes] = []
        self.ids: list[int | None] = []
        self.tokens = 0

    def add(self, doc_id: int | None, data: bytes) -> None:
        import xxhash
        frame = self.zip.compress(data)
        self.out.write(frame)
        self.seek.append(struct.pack("<III", len(frame), len(data),
                                     xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.ids.append(doc_id)
        self.tokens += len(data) // 4

    def close(self) -> int:
        keys = np.array([0 if i is None else i for i in self.ids], dtype="<i8")
        null = np.array([i is None for i in self.ids], dtype="u1")
        names = self.zip.compress(keys.tobytes() + null.tobytes())
        self.out.write(struct.pack("<II", SKIPPABLE_IDS, len(names)) + names)
        body = b"".join(self.seek) + struct.pack("<IBI", len(self.seek), CHECKSUM_FLAG, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(body)) + body)
        size = self.out.tell()
        self.out.close()
        return size


class open_part:
    """Random access to one file: reads the trailer, then single frames."""

    def __init__(self, path: str):
        import zstandard
        files, at = filesystem(path)
        self.file = files.open_input_file(at)
        self.unzip = zstandard.ZstdDecompressor()
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != SEEK_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError(f"{path}: no seek table with checksums")
        body = 12 * n + 9
        table = np.frombuffer(self._read(size - body, 12 * n), dtype="<u4").reshape(n, 3)
        self.sizes, self.lengths, self.sums = (table[:, i].astype(np.int64) for i in range(3))
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])
        names_at = int(self.offsets[-1])
        kind, length = struct.unpack("<II", self._read(names_at, 8))
        if kind != SKIPPABLE_IDS:
            raise ValueError(f"{path}: no document ids before the seek table")
        names = self.unzip.decompress(self._read(names_at + 8, length))
        self.null = np.frombuffer(names[8 * n:], dtype="u1").astype(bool)
        self.ids = np.frombuffer(names[:8 * n], dtype="<i8")
        # Ids of all documents before each one, within the file.
        self.starts = np.concatenate([[0], np.cumsum(self.lengths // 4)])

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def __len__(self) -> int:
        return len(self.ids)

    def doc_id(self, i: int) -> int | None:
        return None if self.null[i] else int(self.ids[i])

    def document(self, i: int) -> bytes:
        """Ids of the i-th document; raises if its bytes were damaged."""
        import xxhash
        data = self.unzip.decompress(self._read(int(self.offsets[i]), int(self.sizes[i])))
        if len(data) != self.lengths[i] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.sums[i]:
            raise ValueError(f"document {self.doc_id(i)}: checksum mismatch")
        return data

    def find(self, wanted) -> list[int]:
        """Positions of the documents whose id is in ``wanted``."""
        keys = {w for w in wanted if w is not None}
        hit = np.isin(self.ids, np.array(sorted(keys), dtype=np.int64)) & ~self.null
        if None in wanted:
            hit |= self.null
        return np.flatnonzero(hit).tolist()

    def entries(self, places, base: int) -> Iterator[pa.RecordBatch]:
        """The documents at ``places`` as batches of a bounded size."""
        at: list[int] = []
        ids: list[bytes] = []
        held = 0
        for i in places:
            at.append(i)
            ids.append(self.document(i))
            held += len(ids[-1])
            if held > READ_BYTES:
                yield self._batch(at, ids, base)
                at, ids, held = [], [], 0
        if at:
            yield self._batch(at, ids, base)

    def _batch(self, at: list[int], ids: list[bytes], base: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array([self.doc_id(i) for i in at], pa.int64()),
            "start": pa.array([base + int(self.starts[i]) for i in at], pa.int64()),
            "ids": pa.array(ids, pa.binary())})

    def close(self) -> None:
        self.file.close()


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = 0, folder: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text", parts: int | None = None,
                 added_tokens: bool = False) -> DataFrame:
    """Encode and write ``docs``; the manifest of the files, in id order.
    ``added_tokens``: see ``pieces``."""
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "tokens")
    end = struct.pack("<I", end_id)
    # The range's bounds come from a sample of keys, so the texts are sorted
    # before they are encoded, not after.
    text = text_or_empty(text_col)
    key = ("id", "h", "row")
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("h"),
                        F.monotonically_increasing_id().alias("row"))
            .repartitionByRange(parts or slots(spark), *key).sortWithinPartitions(*key).select("id", "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.zst"
        enc, out = encoder(tokenizer, added_tokens), None
        for b in batches:
            out = out or (PartWriter(path) if len(b) else None)
            for doc, data in zip(b.column(0).to_pylist(), enc.encode_all(b.column(1))):
                out.add(doc, data + end)
        if out is not None:
            size = out.close()
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "file": [path],
                "first_id": pa.array([out.ids[0]], pa.int64()),
                "last_id": pa.array([out.ids[-1]], pa.int64()),
                "n_docs": [len(out.ids)], "n_tokens": [out.tokens], "n_bytes": [size]})

    return staged(rows.mapInArrow(write, MANIFEST), "token-manifest")


def with_bases(manifest: DataFrame) -> DataFrame:
    """Manifest plus ``base``, the ids in all files before. One row per file."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Every document of the files: doc_id, start (ids before it), ids."""
    n = slots(manifest.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                part = open_part(path)
                yield from part.entries(range(len(part)), base)
                part.close()

    return with_bases(manifest).select("file", "base").repartition(n).mapInArrow(read, ENTRY)


def find_tokens(manifest: DataFrame, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Only the documents whose id is in ``wanted``: each id goes to the files
    whose range holds it, found by bisection of the manifest, and only its frames
    are decompressed. The manifest has one row per file, a bound set by the
    writer's ``parts``."""
    files = sorted(with_bases(manifest).collect(), key=lambda r: r["part"])
    below = -(1 << 63) - 1              # where a null id sorts
    order = lambda i: below if i is None else i
    first, last = [order(r["first_id"]) for r in files], [order(r["last_id"]) for r in files]
    places = [(r["file"], r["base"]) for r in files]

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(*places[p], w) for w in b.column(0).to_pylist()
                    for p in range(bisect_left(last, order(w)), bisect_right(first, order(w)))]
            yield pa.RecordBatch.from_pydict({
                "file": pa.array([r[0] for r in rows], pa.string()),
                "base": pa.array([r[1] for r in rows], pa.int64()),
                "want": pa.array([r[2] for r in rows], pa.int64())})

    keys = wanted.select(F.col(id_col).cast("long").alias("want")).distinct()
    asked = keys.mapInArrow(locate, "file string, base bigint, want bigint")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by_file: dict = {}
            for f, base, w in zip(*(b.column(i).to_pylist() for i in range(3))):
                by_file.setdefault((f, base), []).append(w)
            for (f, base), want in by_file.items():
                part = open_part(f)
                yield from part.entries(part.find(want), base)
                part.close()

    return asked.repartition("file").sortWithinPartitions("file").mapInArrow(read, ENTRY)


def op1_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from kasir.llm.common import TEXT_ROWS, prepare, table
    prepare(spark, TEXT_ROWS)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), added_tokens=True)
    entries = read_tokens(manifest)
    return entries.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.crc32("ids").alias("ids_crc32"))
