"""BPE encoding and decoding with content-defined chunk reuse (operator 8).

Documents are dealt out by the smallest hash of their lines, so copies and
near copies become neighbours in one partition; a range partitioning on
(hash, id) splits a hot group instead of sending it to one task.  A rolling
hash over the last 16 bytes cuts every text into chunks that depend on
content only.  A task encodes each distinct chunk once and reuses its ids
wherever the chunk occurs.

A chunk edge may fall inside a token of the whole text.  Every join is
therefore re-encoded: the window around it grows, left and right, to the
nearest positions where the pre-tokenizer cuts regardless of context, and goes
on growing until both neighbours have a token border at its ends.  Outside the
windows the chunk's ids are those of the whole text, so the result is exact.

Defined results: null text is empty; an empty text has no ids; repeated rows
and rows with equal keys each give a row; an empty table gives an empty one;
other columns are carried along (a column named like an output is replaced).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentscope.llm import pieces
from rentscope.llm.tables import sliced, table, text_or_empty, whole_row

ROLL = 16          # bytes under the rolling hash
MEAN_CHUNK = 512   # expected bytes between two cuts
MAX_CHUNK = 8192   # a longer stretch without a cut is cut here
MEMO_BYTES = 32 << 20


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Start of every chunk: text borders, and where the rolling hash says so."""
    n = len(data)
    mark = np.zeros(n + 1, bool)
    if n > ROLL:
        sums, shift, prime = pieces.prefix_hashes(data)
        h = (sums[ROLL:] - sums[:-ROLL]) % prime * shift[:n + 1 - ROLL] % prime
        mark[ROLL:] = h < prime // np.uint64(MEAN_CHUNK)
    mark[offsets] = True
    at = np.flatnonzero(mark)
    gaps = np.diff(at)
    long = np.flatnonzero(gaps > MAX_CHUNK)
    for i in long:
        mark[np.arange(at[i] + MAX_CHUNK, at[i + 1], MAX_CHUNK)] = True
    at = np.flatnonzero(mark[:n])
    while True:  # never inside a character
        inside = (data[at] & 0xC0) == 0x80
        if not inside.any():
            return np.unique(at)
        at = np.where(inside, at + 1, at)
        at = at[at < n]


class ChunkEncoder:
    def __init__(self, path: str):
        self.base = pieces.encoder(path)
        self.memo: dict[bytes, np.ndarray] = {}
        self.memo_bytes = 0
        self.chunks = self.encoded = self.repairs = 0

    def _chunk_ids(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """ids of all chunks, one after another; each distinct one encoded once."""
        ends = np.append(starts[1:], len(data))
        first, number = pieces.equal_spans(data, starts)
        raw = data.tobytes()
        keys = [raw[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist())]
        found = [self.memo.get(k) for k in keys]
        new = [i for i, ids in enumerate(found) if ids is None]
        self.chunks += len(starts)
        self.encoded += len(new)
        if new:
            texts = [keys[i] for i in new]
            offsets = np.cumsum([0, *map(len, texts)])
            ids, at = self.base.encode(np.frombuffer(b"".join(texts), np.uint8), offsets)
            if self.memo_bytes > MEMO_BYTES:
                self.memo, self.memo_bytes = {}, 0
            for j, i in enumerate(new):
                found[i] = self.memo[keys[i]] = ids[at[j]:at[j + 1]].copy()
                self.memo_bytes += len(keys[i]) + 4 * len(found[i]) + 200
        lengths = np.array([len(x) for x in found], np.int64)
        begin = np.cumsum(lengths) - lengths
        return pieces.ragged(np.concatenate(found), begin[number], lengths[number])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(data) == 0:
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        if not self.base.by_pieces:
            return self.base.encode(data, offsets)
        starts = chunk_starts(data, offsets)
        ids = self._chunk_ids(data, starts)
        begin = np.cumsum(self.base.token_len[ids]) - self.base.token_len[ids]
        sure = np.zeros(len(data) + 1, bool)
        sure[pieces.safe_cuts(data)] = True
        sure[offsets] = True
        sure = np.flatnonzero(sure)
        joins = starts[~np.isin(starts, sure, assume_unique=True)]
        if len(joins):
            left = np.searchsorted(sure, joins) - 1
            right = left + 1
            edges = np.append(begin, len(data))
            while True:  # grow until both neighbours have a token border there
                open_left = edges[np.searchsorted(edges, sure[left])] != sure[left]
                open_right = edges[np.searchsorted(edges, sure[right])] != sure[right]
                if not (open_left.any() or open_right.any()):
                    break
                left, right = left - open_left, right + open_right
            a, b = sure[left], sure[right]
            a, keep = np.unique(a, return_index=True)
            b = b[keep]
            apart = np.append(True, a[1:] >= np.maximum.accumulate(b)[:-1])  # windows that meet become one
            a, b = a[apart], np.maximum.reduceat(b, np.flatnonzero(apart))
            self.repairs += len(a)
            sizes = b - a
            new, _ = self.base.encode(pieces.ragged(data, a, sizes), np.append(0, np.cumsum(sizes)))
            new_at = np.repeat(a - (np.cumsum(sizes) - sizes), sizes)  # shift of each byte of the windows
            new_begin = np.cumsum(self.base.token_len[new]) - self.base.token_len[new]
            new_begin = new_begin + new_at[new_begin]
            window = np.searchsorted(a, begin, side="right") - 1
            outside = (window < 0) | (begin >= b[window])
            ids, begin = ids[outside], begin[outside]
            where = np.searchsorted(begin, new_begin)
            ids, begin = np.insert(ids, where, new), np.insert(begin, where, new_begin)
        return ids, np.searchsorted(begin, offsets)


_ENCODERS: dict[str, ChunkEncoder] = {}


def chunk_encoder(path: str) -> ChunkEncoder:
    """One encoder per Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def _binary(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(flat, "<u4")
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer((offsets.astype(np.int64) * flat.itemsize).tobytes()), pa.py_buffer(flat)]).cast(pa.binary())


def _with(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    i = batch.schema.get_field_index(name)
    return (batch.append_column(pa.field(name, column.type), column) if i < 0
            else batch.set_column(i, pa.field(name, column.type), column))


def _schema(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])


def dealt_by_content(df: DataFrame, text: str, key: str) -> DataFrame:
    """Copies and near copies next to each other, hot groups split by key."""
    near = F.array_min(F.transform(F.split(text_or_empty(text), "\n"), lambda x: F.xxhash64(x)))
    return (df.select(whole_row(df).alias("row"), near.alias("near"))
            .repartitionByRange(F.col("near"), F.col("row")[key]).sortWithinPartitions("near", F.col("row")[key])
            .select("row.*"))


def encode_documents(df: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id",
                     ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """All columns, and ``ids``: the text's token ids as little-endian unsigned
    32-bit integers.  ``decoded`` names a further column for the text that the
    ids decode to, for a check in the same pass."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        enc = chunk_encoder(tokenizer)
        for batch in sliced(batches, text, 1 << 20):
            data, offsets = pieces.text_bytes(batch.column(text))
            flat, at = enc.encode(data, offsets)
            batch = _with(batch, ids, _binary(flat, at))
            if decoded:
                batch = _with(batch, decoded, pa.array(
                    [enc.base.decode(flat[a:b]).decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:])], pa.string()))
            yield batch
    schema = _schema(df, ids, T.BinaryType())
    if decoded:
        schema = T.StructType([f for f in schema.fields if f.name != decoded] + [T.StructField(decoded, T.StringType())])
    return dealt_by_content(df.drop(ids, *[decoded] if decoded else []), text, key).mapInArrow(run, schema)


def decode_documents(df: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns, and ``text``: what the ids say.  Bytes that are no UTF-8
    (ids cut inside a character) become U+FFFD.  Null ids give an empty text."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        enc = pieces.encoder(tokenizer)
        for batch in sliced(batches, ids):
            out = [enc.decode(np.frombuffer(x or b"", "<u4")).decode("utf-8", "replace")
                   for x in batch.column(ids).to_pylist()]
            yield _with(batch, text, pa.array(out, pa.string()))
    df = df.drop(text)
    return df.mapInArrow(run, _schema(df, text, T.StringType()))


def digests(decoded: DataFrame) -> DataFrame:
    return decoded.select("doc_id", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2(F.col("ids"), 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def query(spark: SparkSession, sf_dir: str, tokenizer: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(encode_documents(docs, tokenizer, decoded="decoded"))
