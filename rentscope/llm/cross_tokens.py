"""Cross-tokenizer alignment with an identity-map fast path (operator 11).

A text with a space before it is cut into tokens twice: by a byte-level BPE
file of the tokenizers library (A) and by a SentencePiece BPE model (B).  The
byte offsets where tokens of both end cut the two token rows into groups;
every A token of a group is linked with every B token of it.  A pair of ids
counts how many documents hold it linked.

Most groups are one token on either side.  An array made beforehand maps every
A id to the B id of the same bytes; a group that agrees with it is an id of
that array, and its documents are counted in one vector of A's vocabulary's
length a task.  Only the other (irregular) groups make pairs, which are
combined per document and per task before they are shuffled.  A group of many
tokens is combined by distinct ids first, so a long run without a common end
costs its distinct pairs.

The counts go back to the documents by the same two ways: the vector (never
longer than the vocabulary) to every task, the pairs by a join, which is a
broadcast only while the measured table of pairs has at most BROADCAST_PAIRS
rows.  The pairs are read from a written table, so a pair that stands in every
document is split by AQE's skew join.

Both encoders give each distinct piece to the library once; B's pieces are a
run of spaces and the word after it, over whose end no token of the model
reaches (checked when the model is loaded).

Defined results: a null or empty text, and one whose tokens' bytes are not the
text with its space (a literal U+2581), has no tokens: zeros and an empty group
string; special tokens' strings are plain text; repeated rows and rows of one
id count as documents of their own; an empty table gives no rows; other
columns are not read.  One text is aligned in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentscope.llm import pieces
from rentscope.llm.tables import kept, sliced, table

BROADCAST_PAIRS = 2_000_000
MEMO = 150_000     # pieces that each encoder of a worker remembers
SLICE = 1 << 19    # bytes of text that are aligned at once
LARGE_GROUP = 256  # pairs; a larger group is combined by distinct ids
_PROBES = ("a", " a  b ", "A\t\né　 x", "ﬁ ① Å", "<s> </s> <0x0A>")
ROWS = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "same_ids array<int>, same_n array<long>, pair_ids array<long>, pair_n array<long>")


class SentencePieces(pieces.PieceEncoder):
    """A SentencePiece BPE model behind the piece cache.  Texts must come with
    the space that the model puts in front of them."""

    def __init__(self, path: str, max_entries: int = MEMO):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n, space = self.model.get_piece_size(), "\u2581"
        names = [self.model.id_to_piece(i) for i in range(n)]
        if sum(map(self.model.is_byte, range(n))) != 256 or any(
                self.model.normalize(p) != space + p.replace(" ", space) for p in _PROBES):
            raise ValueError("a model that keeps its input, with byte fallback, is needed")
        if any(space in p.lstrip(space) for p in names):
            raise ValueError("a piece goes over a word's end")
        self._set_tokens([bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(space, " ").encode()
                          for i, p in enumerate(names)])
        self.by_pieces, self.max_entries, self.library_pieces = True, max_entries, 0
        self._clear()

    def cuts(self, data: np.ndarray) -> np.ndarray:
        space = data == 0x20
        return np.flatnonzero(space[1:] & ~space[:-1]) + 1

    def _library(self, found: list[bytes]) -> list[list[int]]:
        self.library_pieces += len(found)
        ids = self.model.encode([p[1:].decode() for p in found], num_threads=1)
        # an empty text gets no space in front
        return [x if x else [self.model.piece_to_id("\u2581")] for x in ids]


class Pair(NamedTuple):
    a: pieces.PieceEncoder
    b: SentencePieces
    same: np.ndarray    # A id -> B id of the same bytes, or -1
    digits: np.ndarray  # id -> its decimal digits and a place for a sign
    n_digits: np.ndarray


@lru_cache(maxsize=2)
def encoders(path_a: str, path_b: str) -> Pair:
    a, b = pieces.PieceEncoder(path_a, MEMO, plain=True), SentencePieces(path_b)
    by_bytes: dict[bytes, int] = {}
    for i in range(len(b.token_bytes)):
        if not b.model.is_control(i) and not b.model.is_unknown(i):
            old = by_bytes.setdefault(b.token_bytes[i], i)
            if b.model.is_byte(old):  # a piece of its own is what the model prefers
                by_bytes[b.token_bytes[i]] = i
    size = max(len(a.token_bytes), len(b.token_bytes))
    names = [str(i).encode() for i in range(size)]
    width = len(names[-1]) + 1
    digits = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in names), np.uint8).reshape(size, width)
    return Pair(a, b, np.array([by_bytes.get(t, -1) for t in a.token_bytes], np.int64), digits,
                np.array([len(x) for x in names], np.int64))


def added(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of the weights of each."""
    if not len(keys):
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(weights, first)


class Alignment:
    """The groups of a batch of texts (concatenated UTF-8 at ``offsets``)."""

    def __init__(self, pair: Pair, data: np.ndarray, offsets: np.ndarray):
        self.pair, self.n = pair, len(offsets) - 1
        some = np.diff(offsets) > 0
        data = np.insert(data, offsets[:-1][some], 0x20)
        offsets = offsets + np.append(0, np.cumsum(some))
        size = np.diff(offsets)
        sides, fits = [], some
        for enc in (pair.a, pair.b):
            ids, at = enc.encode(data, offsets)
            text = np.repeat(np.arange(self.n), np.diff(at))
            length = enc.token_len[ids]
            fits = fits & (np.bincount(text, length, self.n) == size)
            sides.append((enc, ids.astype(np.int64), text, length))
        # texts of equal length are compared byte by byte
        of_byte = np.repeat(np.arange(self.n), size)
        own, wrong = fits[of_byte], np.zeros(self.n, bool)
        for enc, ids, text, _ in sides:
            wrong[of_byte[own][enc.joined(ids[fits[text]]) != data[own]]] = True
        fits &= ~wrong
        (self.a, self.text_a, la), (self.b, self.text_b, lb) = (
            [x[fits[text]] for x in (ids, text, length)] for _, ids, text, length in sides)
        end_a, end_b = np.cumsum(la), np.cumsum(lb)
        marks = np.zeros(int(size[fits].sum()) + 1, np.int8)
        marks[end_a] += 1
        marks[end_b] += 1
        before = np.cumsum(marks == 2)
        group_a, group_b = before[end_a - 1], before[end_b - 1]
        groups = int(before[-1])
        self.group_a, self.group_b = group_a, group_b
        self.na, self.nb = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        self.first_a, self.first_b = np.cumsum(self.na) - self.na, np.cumsum(self.nb) - self.nb
        self.text = self.text_a[self.first_a]

    def strings(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of every text."""
        pos_a = np.arange(len(self.a)) + self.first_b[self.group_a]
        pos_b = np.arange(len(self.b)) + (self.first_a + self.na)[self.group_b]
        n = len(pos_a) + len(pos_b)
        ids, sign = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
        ids[pos_a], ids[pos_b] = self.a, self.b
        sign[pos_a[self.first_a + self.na - 1]] = ord("|")
        last = pos_b[self.first_b + self.nb - 1]
        sign[last] = ord(";")
        per_text = np.bincount(self.text_a, minlength=self.n) + np.bincount(self.text_b, minlength=self.n)
        sign[np.cumsum(per_text)[per_text > 0] - 1] = 0
        width = self.pair.n_digits[ids]
        cells = self.pair.digits[ids]
        cells[np.arange(n), width] = sign
        flat = cells.reshape(-1)
        flat = flat[flat != 0].tobytes()
        size = np.append(0, np.cumsum(width + (sign != 0)))[np.append(0, np.cumsum(per_text))]
        return [flat[s:e] for s, e in zip(size[:-1].tolist(), size[1:].tolist())]

    def links(self) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Distinct (text, A id) of identity links, and distinct (text, A id, B
        id) of the others, as numbers; with each how often it is linked."""
        same, va, vb = self.pair.same, len(self.pair.same), len(self.pair.b.token_bytes)
        single = (self.na == 1) & (self.nb == 1)
        one_a, one_b = self.a[self.first_a[single]], self.b[self.first_b[single]]
        regular = same[one_a] == one_b
        fast = self.text[single][regular] * va + one_a[regular]
        rest = ~single
        rest[np.flatnonzero(single)[~regular]] = True
        rest = np.flatnonzero(rest)
        number = self.na[rest] * self.nb[rest]
        large = rest[number > LARGE_GROUP]
        rest, number = rest[number <= LARGE_GROUP], number[number <= LARGE_GROUP]
        of = np.repeat(rest, number)
        k = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number)
        a = self.a[self.first_a[of] + k // self.nb[of]]
        b = self.b[self.first_b[of] + k % self.nb[of]]
        keys, weights = [(self.text[of] * va + a) * vb + b], [np.ones(len(of), np.int64)]
        for g in large.tolist():
            x, nx = np.unique(self.a[self.first_a[g]:self.first_a[g] + self.na[g]], return_counts=True)
            y, ny = np.unique(self.b[self.first_b[g]:self.first_b[g] + self.nb[g]], return_counts=True)
            keys.append((((self.text[g] * va + x) * vb)[:, None] + y).reshape(-1))
            weights.append((nx[:, None] * ny).reshape(-1))
        keys, weights = added(np.concatenate(keys), np.concatenate(weights))
        alike = same[keys // vb % va] == keys % vb
        fast = added(np.concatenate([fast, keys[alike] // vb]),
                     np.concatenate([np.ones(len(fast), np.int64), weights[alike]]))
        return fast, (keys[~alike], weights[~alike])


def _lists(text: np.ndarray, values: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    at = np.searchsorted(text, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values, kind))


def aligned(df: DataFrame, path_a: str, path_b: str, text: str = "text", key: str = "doc_id",
            with_groups: bool = False) -> DataFrame:
    """A row per row: counts, digest of the groups (``with_groups``: and the
    groups), the identity links (``same_ids``) and the other pairs
    (``pair_ids``: A id times B's vocabulary plus B id), each with its number."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        pair = encoders(path_a, path_b)
        va, vb = len(pair.same), len(pair.b.token_bytes)
        for batch in sliced(batches, text, SLICE):
            found = Alignment(pair, *pieces.text_bytes(batch.column(text)))
            n = found.n
            strings = found.strings()
            (fast, fast_n), (pairs, pairs_n) = found.links()
            links = np.bincount(found.text, found.na * found.nb, n).astype(np.int64)
            columns = [batch.column("row"), batch.column(key).cast(pa.int64()),
                       np.bincount(found.text_a, minlength=n), np.bincount(found.text_b, minlength=n),
                       np.bincount(found.text, minlength=n), links,
                       [hashlib.sha256(s).hexdigest() if s else "" for s in strings],
                       _lists(fast // va, fast % va, n, pa.int32()), _lists(fast // va, fast_n, n, pa.int64()),
                       _lists(pairs // (va * vb), pairs % (va * vb), n, pa.int64()),
                       _lists(pairs // (va * vb), pairs_n, n, pa.int64())]
            names = [x.split()[0] for x in ROWS.split(", ")]
            if with_groups:
                columns.append([s.decode() for s in strings])
                names.append("groups")
            yield pa.record_batch([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], names)
    return (df.select(F.monotonically_increasing_id().alias("row"), key, text)
            .mapInArrow(run, ROWS + (", groups string" if with_groups else "")))


def same_counts(rows: DataFrame, size: int) -> DataFrame:
    """(a, n): documents of every identity link, summed in a vector a task."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        found = np.flatnonzero(total)
        yield pa.record_batch([pa.array(found, pa.int64()), pa.array(total[found])], ["a", "n"])
    return rows.select("same_ids").mapInArrow(run, "a long, n long").groupBy("a").agg(F.sum("n").alias("n"))


def counted(rows: DataFrame, size_a: int, size_b: int) -> tuple[DataFrame, DataFrame]:
    """Written tables of the corpus: (a, n, best) of the identity links, at most
    the vocabulary's number of rows, and (pair_id, n, best) of the other pairs.
    ``n`` documents hold the pair; ``best``: no pair of its A id has more."""
    same = kept(same_counts(rows, size_a), "same-counts")
    pairs = kept(rows.select(F.explode("pair_ids").alias("pair_id")).groupBy("pair_id").agg(F.count("*").alias("n")),
                 "pair-counts").withColumn("a", F.expr(f"pair_id div {size_b}"))
    top = kept(same.unionByName(pairs.select("a", "n")).groupBy("a").agg(F.max("n").alias("top")), "top-counts")

    def marked(df: DataFrame) -> DataFrame:
        # a row per A id at most
        return df.join(F.broadcast(top), "a").withColumn("best", F.col("n") == F.col("top")).drop("top")
    return kept(marked(same), "same-marked"), kept(marked(pairs).drop("a"), "pairs-marked")


def scored(rows: DataFrame, same: DataFrame, pairs: DataFrame, size_a: int) -> DataFrame:
    """The rows' counts with ``n_best`` and ``count_sum``."""
    n, best = np.zeros(size_a, np.int64), np.zeros(size_a, np.int64)
    vector = same.toArrow()  # no more rows than the vocabulary has
    at = vector.column("a").to_numpy()
    n[at], best[at] = vector.column("n").to_numpy(), vector.column("best").to_numpy(zero_copy_only=False)
    head = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, number = (batch.column(c).flatten().to_numpy() for c in ("same_ids", "same_n"))
            size = batch.column("same_ids").value_lengths().to_numpy()
            end = np.cumsum(size)
            sums = [np.append(0, np.cumsum(number * of[ids])) for of in (best, n)]
            yield pa.record_batch([*(batch.column(c) for c in head), *(pa.array(x[end] - x[end - size]) for x in sums)],
                                  [*head, "n_best", "count_sum"])
    regular = rows.select(*head, "same_ids", "same_n").mapInArrow(
        run, ", ".join(x for x in ROWS.split(", ") if x.split()[0] in head) + ", n_best long, count_sum long")
    few = pairs.count() <= BROADCAST_PAIRS
    irregular = (rows.select("row", F.explode(F.arrays_zip("pair_ids", "pair_n")).alias("x"))
                 .select("row", F.col("x.pair_ids").alias("pair_id"), F.col("x.pair_n").alias("links"))
                 .join(F.broadcast(pairs) if few else pairs, "pair_id").groupBy("row")
                 .agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"),
                      F.sum(F.col("links") * F.col("n")).alias("more_sum")))
    return regular.join(irregular, "row", "left").withColumns({
        "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
        "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))}).drop("row", "more_best", "more_sum")


def cross_counts(df: DataFrame, path_a: str, path_b: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Aligned documents with the corpus-wide counts of their links."""
    pair = encoders(path_a, path_b)
    size_a, size_b = len(pair.same), len(pair.b.token_bytes)
    rows = kept(aligned(df, path_a, path_b, text, key), "aligned")
    return scored(rows, *counted(rows, size_a, size_b), size_a)


def query(spark: SparkSession, sf_dir: str, path_a: str, path_b: str) -> DataFrame:
    return cross_counts(table(spark, sf_dir, "documents"), path_a, path_b).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
