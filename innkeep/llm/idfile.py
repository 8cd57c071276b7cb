"""Token ids in binary files: Simple-8b blocks, read back by vectorised decoding.

File: ``MAGIC``, blocks, index, length of the index (8 bytes), ``MAGIC``.
Block: 64-bit little-endian words, each a selector in the top 4 bits and 60 bits of
data that hold ``COUNT[s]`` ids of ``WIDTH[s]`` bits, lowest first; then the
escapes, ids of more than 60 bits, as pairs (position in the block, id); at the
position of an escape the words hold zero.
Index: the number of ids, words and escapes of each block and its offset, and the
doc_id (with a null mark) and number of ids of each document.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from innkeep.llm.chunks import encoder
from innkeep.llm.common import arrow_map, batches, sliced, texts, written
from innkeep.session import scratch_path

MAGIC = b"SIMPLE8B"
COUNT = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTH = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
_ABOVE = np.array([1 << int(w) for w in WIDTH[:-1]], np.uint64)  # the ids too wide for each
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 24  # a file is closed after the document that reaches this
MEMO_PIECES = 400_000  # whose ids a worker keeps

_FILES = pa.schema([
    ("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("n_ids", pa.int64()), ("n_docs", pa.int64()),
])
_ROWS = pa.schema([
    ("part", pa.int32()), ("seq", pa.int32()), ("doc_id", pa.int64()),
    ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
])


# ---- words ----------------------------------------------------------------------


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, and the positions and values of the escapes, of unsigned 64-bit ids."""
    n = len(ids)
    ids = ids.astype(np.uint64)
    escapes = np.flatnonzero(ids >> np.uint64(60))
    escaped = ids[escapes]
    if len(escapes):
        ids = ids.copy()
        ids[escapes] = 0
    # Of each position, the selector of most ids whose ids all fit: a word of n ids
    # needs the largest width among n positions, which two runs of a power of two
    # cover. Beyond the end are zeros.
    width = np.searchsorted(_ABOVE, ids, side="right").astype(np.uint8)  # the index of the narrowest width
    spans = [np.concatenate([width, np.zeros(COUNT[0], np.uint8)])]
    while 2 << len(spans) - 1 <= COUNT[0]:
        last, half = spans[-1], 1 << len(spans) - 1
        spans.append(np.maximum(last[:-half], last[half:]))
    choice = np.full(n, len(COUNT) - 1, np.uint8)
    for s in range(len(COUNT) - 2, -1, -1):
        span = int(COUNT[s]).bit_length() - 1
        off = int(COUNT[s]) - (1 << span)
        widest = np.maximum(spans[span][:n], spans[span][off:off + n])
        choice[widest <= s] = s
    step = COUNT[choice].tolist()
    at, starts = 0, []
    while at < n:
        starts.append(at)
        at += step[at]
    starts = np.array(starts, np.int64)
    selectors = choice[starts]
    padded = np.concatenate([ids, np.zeros(COUNT[0], np.uint64)])
    words = selectors.astype(np.uint64) << np.uint64(60)
    for s in np.unique(selectors):
        rows = np.flatnonzero(selectors == s)
        for k in range(COUNT[s]):
            words[rows] |= padded[starts[rows] + k] << np.uint64(k * WIDTH[s])
    return words, escapes, escaped


def unpack(words: np.ndarray, n: int, escapes: np.ndarray, escaped: np.ndarray) -> np.ndarray:
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNT[selectors]
    starts = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s in np.unique(selectors):
        rows = np.flatnonzero(selectors == s)
        shifts = np.arange(COUNT[s], dtype=np.uint64) * np.uint64(WIDTH[s])
        values = (words[rows][:, None] >> shifts) & np.uint64((1 << int(WIDTH[s])) - 1)
        out[starts[rows][:, None] + np.arange(COUNT[s])] = values
    out = out[:n]
    out[escapes] = escaped
    return out


# ---- files ----------------------------------------------------------------------


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class IdWriter:
    """One file; keeps one block of ids and sixteen bytes a document in memory."""

    def __init__(self, path: str) -> None:
        self.path = path
        files, at = _place(path)
        files.create_dir(at.rsplit("/", 1)[0], recursive=True)
        self.out = files.open_output_stream(at)
        self.out.write(MAGIC)
        self.offset = len(MAGIC)
        self.waiting: list[np.ndarray] = []
        self.held = self.n_ids = 0
        self.blocks: list[tuple[int, int, int, int]] = []
        self.docs: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id or 0, doc_id is None, len(ids)))
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK_IDS:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint64)
        stop = len(ids) if last else len(ids) // BLOCK_IDS * BLOCK_IDS
        for at in range(0, stop, BLOCK_IDS):
            block = ids[at:min(at + BLOCK_IDS, stop)]
            words, escapes, escaped = pack(block)
            self.blocks.append((len(block), len(words), len(escapes), self.offset))
            data = words.astype("<u8").tobytes() + escapes.astype("<u8").tobytes() + escaped.astype("<u8").tobytes()
            self.out.write(data)
            self.offset += len(data)
        self.waiting, self.held = [ids[stop:]], len(ids) - stop

    def close(self) -> None:
        self._flush(last=True)
        index = struct.pack("<QQ", len(self.blocks), len(self.docs))
        index += np.array(self.blocks, "<i8").tobytes() + np.array(self.docs, "<i8").tobytes()
        self.out.write(index + struct.pack("<Q", len(index)) + MAGIC)
        self.out.close()


def read_file(path: str) -> Iterator[tuple[int | None, np.ndarray | None, int]]:
    """``(doc_id, ids, n)`` in order; a document's ids come in parts, the last of
    them with its number of ids, the others with -1."""
    files, at = _place(path)
    with files.open_input_file(at) as f:
        size = f.size()
        tail = f.read_at(16, size - 16)
        length = struct.unpack("<Q", tail[:8])[0]
        if tail[8:] != MAGIC or f.read_at(8, 0) != MAGIC:
            raise ValueError(f"not an id file: {path}")
        index = f.read_at(length, size - 16 - length)
        n_blocks, n_docs = struct.unpack("<QQ", index[:16])
        blocks = np.frombuffer(index, "<i8", n_blocks * 4, 16).reshape(-1, 4).tolist()
        docs = np.frombuffer(index, "<i8", n_docs * 3, 16 + n_blocks * 32).reshape(-1, 3).tolist()
        turn = iter(blocks)
        ids, pos = np.zeros(0, np.uint64), 0
        for doc_id, no_id, n in docs:
            name, left = None if no_id else doc_id, n
            while left > len(ids) - pos:
                if pos < len(ids):
                    yield name, ids[pos:], -1
                    left -= len(ids) - pos
                count, words, escapes, offset = next(turn)
                data = np.frombuffer(f.read_at(8 * (words + 2 * escapes), offset), "<u8")
                ids, pos = unpack(data[:words], count, data[words:words + escapes], data[words + escapes:]), 0
            yield name, ids[pos:pos + left], n
            pos += left


# ---- jobs -----------------------------------------------------------------------


def write_ids(docs: DataFrame, folder: str, vocabulary: str, end_id: int) -> DataFrame:
    """Encode the documents and write id files in ascending doc_id; the list of files.

    Rows are ranged by doc_id, equal ids by a hash of the text, rows without one first. A task
    writes its range to files of its own, named anew in each attempt, and returns
    their names with its result; only the files of attempts that count are listed.
    """

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seq, out, listed = encoder(vocabulary, MEMO_PIECES).encode, TaskContext.get().partitionId(), 0, None, []

        def close() -> None:
            out.close()
            listed.append((part, seq, out.path, out.n_ids, len(out.docs)))

        for batch in stream:
            for piece in sliced(batch):
                coded = encode(piece.column("text"))
                for doc_id, ids in zip(piece.column("doc_id").to_pylist(), coded):
                    if out is None:
                        out = IdWriter(f"{folder}/ids-{part:06d}-{seq:04d}-{uuid.uuid4().hex}.s8b")
                    out.add(doc_id, np.append(np.frombuffer(ids, "<u4"), np.uint32(end_id)))
                    if out.n_ids >= FILE_IDS:
                        close()
                        out, seq = None, seq + 1
        if out is not None:
            close()
        yield batches(dict(zip(_FILES.names, map(list, zip(*listed)) if listed else [[]] * len(_FILES))), _FILES)

    # The hash of the text lets rows of one doc_id be ranged too; the driver, which
    # gets a sample of the keys to find the ranges, gets no texts.
    order = [F.asc_nulls_first("doc_id"), F.asc("h")]
    rows = texts(docs).withColumn("h", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    return arrow_map(rows, task, "part int, seq int, path string, n_ids long, n_docs long")


def read_ids(files: DataFrame) -> DataFrame:
    """One row per document: its place in its file, its number of ids and their CRC32."""

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for f in batch.to_pylist():
                rows, start, crc = [], 0, 0
                for doc_id, ids, n in read_file(f["path"]):
                    crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                    if n >= 0:
                        rows.append((f["part"], f["seq"], doc_id, start, n, crc))
                        start, crc = start + n, 0
                    if len(rows) == 50_000:
                        yield batches(dict(zip(_ROWS.names, map(list, zip(*rows)))), _ROWS)
                        rows = []
                if rows:
                    yield batches(dict(zip(_ROWS.names, map(list, zip(*rows)))), _ROWS)

    # Few rows, much work for each: one file a task, as near as hashing comes to it.
    spread = files.select("part", "seq", "path").repartition(max(1, files.count()), "part", "seq")
    return arrow_map(
        spread, task, "part int, seq int, doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def file_offsets(files: DataFrame) -> DataFrame:
    """``part, seq, base``: the ids in all files before each one.

    Files are summed within groups of 1024 tasks, then the groups, so no task
    gets the list of all files.
    """
    grouped = files.select("part", "seq", "n_ids", (F.col("part") / 1024).cast("int").alias("g"))
    before = Window.partitionBy("g").orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    within = grouped.withColumn("inside", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    groups = grouped.groupBy("g").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    bases = groups.select("g", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("outside"))
    return within.join(bases, "g").selectExpr("part", "seq", "inside + outside as base")


def token_id_output(docs: DataFrame, vocabulary: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Write the documents' ids to files below ``folder`` and report what the files hold.

    ``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` (with the end
    id), ``ids_crc32``. A null or empty text has the end id alone; rows without
    doc_id come first; repeated doc_ids and rows each have an entry; an empty table
    gives no files and no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "ids")
    files = written(write_ids(docs, folder, vocabulary, end_id), "id-files")
    # The rows look as few as the files to the optimizer; it must not broadcast them.
    rows = read_ids(files).hint("merge").join(file_offsets(files), ["part", "seq"])
    return rows.selectExpr("doc_id", "base + start as start", "n_tokens", "ids_crc32")
