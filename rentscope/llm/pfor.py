"""Token-id output as patched frame-of-reference blocks (operator 1).

A file is a row of segments, each closed by a line feed (the text writer's
row end, so that Spark's commit protocol covers the binary files and any
Hadoop file system will do).  A segment holds whole documents:

    header    magic "PFB1", segment bytes, documents, ids, blocks, exceptions
    documents id, null flag, ids before it in the part, number of ids
    blocks    minimum, width, exceptions, start of its packed bits
    packed    BLOCK values minus the minimum, ``width`` bits each
    patches   position in the block, value minus the minimum

A block's width is the one among the widths of its PERCENTILES that takes the
fewest bytes; values that do not fit are patched from the exception list.  The
block starts allow reading any block alone (``read_block``).

A task closes a file after FILE_SEGMENTS segments, so files stay small enough to
be read in one piece whatever a task holds; the files of a task share its part
number and count on.  Parts follow one another in ascending document id; a
document's ``start`` is its place in its part plus the ids of the parts before.

Defined results: null text is empty (only the end id); null ids come first;
rows with equal ids keep one order (by text) and each get their own place; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rentscope.llm import pieces
from rentscope.llm.tables import kept, sliced, table
from rentscope.session import scratch_path

BLOCK = 256
FILE_SEGMENTS = 256  # of about 1 MB of text, or one longer text
PERCENTILES = (75, 90, 95, 99, 100)
END_ID = 0
MAGIC = b"PFB1"
_HEAD = struct.Struct("<4sIIIII")
_DOC = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("start", "<u8"), ("n", "<u4")])
_BLK = np.dtype([("min", "<u4"), ("width", "u1"), ("exceptions", "<u2"), ("at", "<u4")])


def _width(x: np.ndarray) -> np.ndarray:
    """Bits that the largest value needs."""
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.int64)


def pack(ids: np.ndarray) -> tuple[np.ndarray, bytes, np.ndarray, np.ndarray]:
    """Block table, packed bytes, exception positions and values."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    table = np.zeros(blocks, _BLK)
    if not n:
        return table, b"", np.empty(0, np.uint8), np.empty(0, "<u4")
    values = np.concatenate([ids, np.full(blocks * BLOCK - n, ids[-1], ids.dtype)]).reshape(blocks, BLOCK)
    low = values.min(axis=1)
    rest = values - low[:, None]
    order = np.sort(rest, axis=1)
    best = np.full(blocks, np.iinfo(np.int64).max)
    width = np.zeros(blocks, np.int64)
    for p in PERCENTILES:
        w = _width(order[:, (BLOCK - 1) * p // 100])
        # the number of values over a width is read off the sorted block
        over = (order >= (np.int64(1) << w)[:, None]).sum(axis=1)
        cost = w * (BLOCK // 8) + 5 * over
        width = np.where(cost < best, w, width)
        best = np.minimum(cost, best)
    out_of = rest >= (np.int64(1) << width)[:, None]
    size = width * (BLOCK // 8)
    at = np.cumsum(size) - size
    table["min"], table["width"], table["exceptions"], table["at"] = low, width, out_of.sum(axis=1), at
    packed = np.zeros(int(size.sum()), np.uint8)
    for w in np.unique(width[width > 0]).tolist():
        own = np.flatnonzero(width == w)
        bits = ((rest[own][:, :, None] >> np.arange(w, dtype=rest.dtype)) & 1).astype(np.uint8)
        packed[at[own][:, None] + np.arange(w * (BLOCK // 8))] = np.packbits(
            bits.reshape(len(own), BLOCK * w), axis=1, bitorder="little")
    where = np.nonzero(out_of)
    return table, packed.tobytes(), where[1].astype(np.uint8), rest[where].astype("<u4")


def unpack(table: np.ndarray, packed: np.ndarray, positions: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((len(table), BLOCK), np.uint32)
    for w in np.unique(table["width"][table["width"] > 0]).tolist():
        own = np.flatnonzero(table["width"] == w)
        raw = packed[table["at"][own].astype(np.int64)[:, None] + np.arange(w * (BLOCK // 8))]
        bits = np.unpackbits(raw, axis=1, bitorder="little").reshape(len(own), BLOCK, w)
        part = np.zeros((len(own), BLOCK), np.uint32)
        for k in range(w):
            part |= bits[:, :, k].astype(np.uint32) << np.uint32(k)
        out[own] = part
    out[np.repeat(np.arange(len(table)), table["exceptions"]), positions] = values
    return (out + table["min"][:, None]).reshape(-1)[:n]


def write_segment(doc_ids: list, starts: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    docs = np.zeros(len(doc_ids), _DOC)
    docs["doc_id"] = [x or 0 for x in doc_ids]
    docs["null"] = [x is None for x in doc_ids]
    docs["start"], docs["n"] = starts, lengths
    table, packed, positions, values = pack(ids)
    body = b"".join([docs.tobytes(), table.tobytes(), packed, positions.tobytes(), values.tobytes()])
    return _HEAD.pack(MAGIC, _HEAD.size + len(body), len(docs), len(ids), len(table), len(values)) + body


class Segment:
    """A segment inside a file's bytes; nothing is unpacked until asked for."""

    def __init__(self, data, at: int):
        magic, self.size, n_docs, self.n_ids, n_blocks, n_out = _HEAD.unpack_from(data, at)
        if magic != MAGIC:
            raise ValueError(f"no segment at byte {at}")
        at += _HEAD.size
        end = at - _HEAD.size + self.size
        self.docs = np.frombuffer(data, _DOC, n_docs, at)
        at += self.docs.nbytes
        self.blocks = np.frombuffer(data, _BLK, n_blocks, at)
        at += self.blocks.nbytes
        self.packed = np.frombuffer(data, np.uint8, end - at - 5 * n_out, at)
        self.positions = np.frombuffer(data, np.uint8, n_out, end - 5 * n_out)
        self.values = np.frombuffer(data, "<u4", n_out, end - 4 * n_out)

    def ids(self) -> np.ndarray:
        return unpack(self.blocks, self.packed, self.positions, self.values, self.n_ids)

    def read_block(self, i: int) -> np.ndarray:
        """The ids of block i, read from its start alone."""
        before = int(self.blocks["exceptions"][:i].sum())
        own = slice(before, before + int(self.blocks["exceptions"][i]))
        return unpack(self.blocks[i:i + 1], self.packed, self.positions[own], self.values[own],
                      min(BLOCK, self.n_ids - i * BLOCK))


def segments(data) -> Iterator[Segment]:
    at = 0
    while at < len(data):
        s = Segment(data, at)
        yield s
        at += s.size + 1  # the line feed


def write_token_files(df: DataFrame, path: str, tokenizer: str, text: str = "text", key: str = "doc_id",
                      end_id: int = END_ID) -> None:
    """Encode every text, append ``end_id`` and write the files in key order."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        enc, before = pieces.encoder(tokenizer), 0
        for batch in sliced(batches, text, 1 << 20):
            flat, at = enc.encode(*pieces.text_bytes(batch.column(text)))
            n = np.diff(at) + 1
            ids = np.insert(flat, at[1:], np.uint32(end_id))
            start = before + np.cumsum(n) - n
            before += int(n.sum())
            yield pa.record_batch([pa.array([write_segment(batch.column(key).to_pylist(), start, n, ids)],
                                            pa.binary())], ["segment"])
    (df.select(key, text).repartitionByRange(F.col(key)).sortWithinPartitions(key, text)
     .mapInArrow(run, "segment binary")
     .select(F.col("segment").cast("string")).write.option("lineSep", "\n")
     .option("maxRecordsPerFile", FILE_SEGMENTS).text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    part = F.regexp_extract("path", r"part-([0-9]+)[^/]*$", 1).cast("long")
    return spark.read.format("binaryFile").load(path).select(part.alias("part"), "content")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(part, doc_id, local_start, n_tokens, ids) from the files."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, content in zip(batch.column("part").to_pylist(), batch.column("content")):
                for s in segments(content.as_buffer()):
                    docs, ids = s.docs, s.ids().astype("<u4")
                    at = np.append(0, np.cumsum(docs["n"].astype(np.int64))) * 4
                    yield pa.record_batch([
                        pa.array([part] * len(docs), pa.int64()),
                        pa.array(docs["doc_id"], pa.int64(), mask=docs["null"].astype(bool)),
                        pa.array(docs["start"].astype(np.int64)), pa.array(docs["n"].astype(np.int64)),
                        pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(docs), [
                            None, pa.py_buffer(at.tobytes()), pa.py_buffer(ids)]).cast(pa.binary())],
                        ["part", "doc_id", "local_start", "n_tokens", "ids"])
    return _files(spark, path).mapInArrow(
        run, "part long, doc_id long, local_start long, n_tokens long, ids binary")


def with_start(docs: DataFrame) -> DataFrame:
    """``start`` over all parts; one row per part is ordered in one task."""
    files = docs.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = files.select("part", (F.sum("_n").over(Window.orderBy("part")) - F.col("_n")).alias("_before"))
    return docs.join(before, "part").withColumn("start", F.col("_before") + F.col("local_start"))


def query(spark: SparkSession, sf_dir: str, tokenizer: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, tokenizer)
    read = read_documents(spark, path).select("part", "doc_id", "local_start", "n_tokens",
                                              F.crc32("ids").alias("ids_crc32"))
    return with_start(kept(read, "token-digests")).select("doc_id", "start", "n_tokens", "ids_crc32")
