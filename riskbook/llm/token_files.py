"""Token files: every id in the fewest bits that hold the vocabulary.

A file holds whole documents in ascending doc_id order (null ids first):

    offset 0    8 bytes  magic
    offset 8    6 x u64  bits per id, ids per block, number of ids, documents, blocks, bytes of the body
    then        documents x (i64 doc_id, u64 null flag << 63 | number of ids)
    then        (blocks + 1) x u64 byte offset of each block within the body
    then        body: blocks of ids, each id ``bits`` wide, little-endian bit order, blocks byte-aligned

All integers are little-endian. Any id is found from its position alone: block
``i // block_ids``, bit ``(i % block_ids) * bits`` of it; numpy unpacks a whole
block at once. The width is bit_length(vocabulary size - 1).

:func:`write_token_files` sorts the documents by range (one shuffle), encodes
them in the tasks, and each task writes its files through pyarrow's file
systems below the shared folder, under a temporary name and then renamed, so
a repeated task writes the same file again. It returns the manifest (one row
per file, with the global position of its first id). :func:`read_token_files`
reads them back. A file is closed at the end of the document with which it
reaches ``file_ids`` ids, so memory is bounded by that plus one document.

Null text counts as empty (its only id is the end id); documents without rows
give an empty manifest; repeated doc_ids are kept, in order of a hash of their text.
Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskbook.llm.bpe import encoder
from riskbook.llm.common import stored
from riskbook.llm.text_arrays import runs_within, slices
from riskbook.session import scratch_path

MAGIC = b"TOKBITS1"
BLOCK_IDS = 1 << 16
FILE_IDS = 4 << 20
#: Bytes of text encoded at a time.
ENCODE_BYTES = 4 << 20
END_ID = 0
MANIFEST = "part int, seq int, path string, n_docs long, n_ids long"


def width_of(vocab_size: int) -> int:
    return max(1, int(vocab_size - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """The ids, ``width`` bits each, in little-endian bit order."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(body: bytes | np.ndarray, width: int, first: int, n: int) -> np.ndarray:
    """n ids from position ``first`` of a packed block, without touching the others."""
    raw = np.frombuffer(body, np.uint8) if not isinstance(body, np.ndarray) else body
    if width in (8, 16, 32):
        size = width // 8
        return np.frombuffer(raw, f"<u{size}", n, first * size).astype(np.uint32)
    bit = (first + np.arange(n, dtype=np.int64)) * width
    padded = np.append(raw[bit[0] >> 3 : (bit[-1] >> 3) + 8] if n else raw[:0], np.zeros(8, np.uint8))
    at = (bit >> 3) - (bit[0] >> 3 if n else 0)
    window = np.zeros(n, dtype=np.uint64)
    for k in range((width + 14) // 8):  # the bytes that can hold one id
        window |= padded[at + k].astype(np.uint64) << np.uint64(8 * k)
    return ((window >> (bit & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)).astype(np.uint32)


def to_file(doc_ids: np.ndarray, is_null: np.ndarray, counts: np.ndarray, ids: np.ndarray, width: int, block_ids: int = BLOCK_IDS) -> bytes:
    blocks = [pack(ids[i : i + block_ids], width) for i in range(0, len(ids), block_ids)]
    ends = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    head = np.array([width, block_ids, len(ids), len(doc_ids), len(blocks), ends[-1]], dtype="<u8")
    docs = np.empty((len(doc_ids), 2), dtype="<u8")
    docs[:, 0] = np.where(is_null, 0, doc_ids).astype("<i8").view("<u8")
    docs[:, 1] = counts.astype("<u8") | (is_null.astype("<u8") << np.uint64(63))
    return b"".join((MAGIC, head.tobytes(), docs.tobytes(), ends.tobytes(), *blocks))


class TokenFile:
    """One token file in memory: its documents, and ids by position."""

    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not a token file")
        self.width, self.block_ids, self.n_ids, n_docs, n_blocks, size = np.frombuffer(raw, "<u8", 6, 8).astype(int).tolist()
        docs = np.frombuffer(raw, "<u8", 2 * n_docs, 56).reshape(-1, 2)
        self.is_null = (docs[:, 1] >> np.uint64(63)).astype(bool)
        self.doc_ids = docs[:, 0].view("<i8") if n_docs else np.zeros(0, np.int64)
        self.counts = (docs[:, 1] & np.uint64((1 << 63) - 1)).astype(np.int64)
        at = 56 + 16 * n_docs
        self.ends = np.frombuffer(raw, "<u8", n_blocks + 1, at).astype(np.int64)
        self.body = np.frombuffer(raw, np.uint8, size, at + 8 * (n_blocks + 1))

    def ids(self, first: int, n: int) -> np.ndarray:
        """Ids at positions first .. first+n-1; only their blocks are unpacked."""
        parts = [np.zeros(0, np.uint32)]
        while n > 0:
            block, offset = divmod(first, self.block_ids)
            take = min(n, self.block_ids - offset)
            parts.append(unpack(self.body[self.ends[block] : self.ends[block + 1]], self.width, offset, take))
            first, n = first + take, n - take
        return np.concatenate(parts)


def with_end(ids: np.ndarray, at: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each row's, and the rows' numbers of ids."""
    counts = np.diff(at) + 1
    out = np.full(len(ids) + len(counts), end_id, dtype=np.uint32)
    first = np.cumsum(counts) - counts
    out[np.repeat(first, counts - 1) + runs_within(counts - 1)] = ids
    return out, counts


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or an absolute local path."""
    scheme, colon, rest = path.partition(":")
    if colon and scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(path)


def write_token_files(docs: DataFrame, vocabulary: str, end_id: int = END_ID, file_ids: int = FILE_IDS, folder: str | None = None) -> DataFrame:
    """Write all documents as token files; returns the manifest with columns part,
    seq, path, n_docs, n_ids, start (ids in all files before this one)."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-files")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        width = width_of(max(enc.vocab_size, end_id + 1))
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        system, root = file_system(folder)
        system.create_dir(root, recursive=True)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        seq = size = 0

        def flush() -> pa.RecordBatch:
            name = f"{root}/{part:06d}-{seq:06d}.tid"
            doc_ids, is_null, counts, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            with system.open_output_stream(f"{name}.{attempt}") as out:
                out.write(to_file(doc_ids, is_null, counts, ids, width))
            system.move(f"{name}.{attempt}", name)
            uri = f"{folder.rstrip('/')}/{part:06d}-{seq:06d}.tid"
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([uri]), pa.array([len(counts)], pa.int64()), pa.array([len(ids)], pa.int64())],
                names=["part", "seq", "path", "n_docs", "n_ids"],
            )

        for batch in batches:
            for run in slices(batch, limit=ENCODE_BYTES):
                ids, counts = with_end(*enc.encode(run.column(1)), end_id)
                doc_ids = run.column(0)
                is_null = np.asarray(doc_ids.is_null().to_numpy(zero_copy_only=False))
                own = doc_ids.fill_null(0).to_numpy(zero_copy_only=False)
                ends = np.cumsum(counts)
                row = 0
                while row < len(counts):  # a file ends with the document that fills it
                    done = ends[row - 1] if row else 0
                    stop = min(len(counts), int(np.searchsorted(ends, done + file_ids - size, "left")) + 1)
                    held.append((own[row:stop], is_null[row:stop], counts[row:stop], ids[done : ends[stop - 1]]))
                    size += int(ends[stop - 1] - done)
                    row = stop
                    if size >= file_ids:
                        yield flush()
                        held, size, seq = [], 0, seq + 1
        if held:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # One id (or none) may hold a third of the rows: ranges also split by text, and equal rows, which are
    # interchangeable, by any number.
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("_text"), F.monotonically_increasing_id().alias("_any"))
    rows = rows.repartitionByRange("doc_id", "_text", "_any").sortWithinPartitions("doc_id", "_text", "_any")
    manifest = stored(rows.mapInArrow(write, MANIFEST), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.join(parts, "part").withColumn("start", F.col("part_start") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).drop("part_start")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                system, name = file_system(path)
                with system.open_input_file(name) as f:
                    tokens = TokenFile(f.read())
                ends = np.cumsum(tokens.counts)
                raw = tokens.ids(0, tokens.n_ids).astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), tokens.counts.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens.doc_ids, pa.int64(), mask=tokens.is_null), pa.array(start + ends - tokens.counts), pa.array(tokens.counts), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # A task per file: the rows of the manifest are small, what they name is not.
    files = max(1, manifest.count())
    return manifest.select("path", "start").repartition(files).mapInArrow(read, schema)
