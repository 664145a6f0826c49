"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment
(operator 4).

Words are runs of letters and digits (and any non-ASCII), lower-cased, so case
and punctuation do not matter.  An item's seeds are its runs of four words, of
three or two if it is short (SEED_WORDS).  The seeds of the benchmark make a
bit map of fixed size that goes to every task; one pass over the corpus emits
the places whose run is in it, and the words around where enough of them lie
close together (a region).  Everything later works on these few rows: a join
with the benchmark's seeds finds the items, and document frequencies over the
whole corpus say which seeds are rare.

A region and an item become a candidate with MIN_SEEDS seeds, however frequent
they are (the leaked copies themselves make a seed frequent).  Rarity decides
the work alone: with MIN_SEEDS rare seeds a candidate is aligned at once,
otherwise only if the words in common allow a score of LEAST in any order
(``can_reach``, an upper bound).  A candidate is aligned word by word (match +2,
mismatch and gap -1); its score is the best local alignment over that of a
full copy, and LEAST of it is a leak.  So reworded, shortened or extended
copies are found, while a short shared phrase is not.

Defined results: null or empty text has no words and leaks nothing; items of
fewer than two words cannot be found; an edited copy is found if MIN_SEEDS
seeds of it are unchanged (one, if the item has up to LONE); items with equal words are each reported; repeated rows and rows of one id are each
searched, and a row is reported once per item with its best region (ties: the
first); empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentscope.llm import pieces, shingles
from rentscope.llm.tables import kept, sliced, table, text_or_empty, whole_row

SEED_WORDS = {16: 2, 32: 3, None: 4}    # an item of up to so many words: words a seed
SLOT_BITS = 21      # the bit map has 2^21 bits, whatever the benchmark's size
MIN_SEEDS = 2
LONE = 4            # an item of up to so many distinct seeds needs one
RARE_DOCS, RARE_SHARE = 5, 0.001
LEAST = 0.5


def _words(batch: pa.RecordBatch, text: str):
    lower = pc.utf8_lower(pc.fill_null(batch.column(text), ""))
    h, _, _, first = shingles.words(*pieces.text_bytes(lower), between=shingles.SIGNS)
    return h, first


def seed_words(n: int) -> int:
    """How many words a seed of an item of n words has."""
    return next(k for most, k in SEED_WORDS.items() if most is None or n <= most)


def item_words(items: DataFrame, text: str = "text", key: str = "item_id") -> DataFrame:
    """(item_id, words, grams): the word hashes and the seeds' hashes in order."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text, 1 << 20):
            h, first = _words(batch, text)
            rows = [h[a:b] for a, b in zip(first[:-1], first[1:])]
            yield pa.record_batch([batch.column(key).cast(pa.int64()),
                                   pa.array([r.view(np.int64) for r in rows], pa.list_(pa.int64())),
                                   pa.array([shingles.runs(r, seed_words(len(r))).view(np.int64) for r in rows],
                                            pa.list_(pa.int64()))], ["item_id", "words", "grams"])
    return items.select(key, text).mapInArrow(run, "item_id long, words array<long>, grams array<long>")


def bit_map(grams: DataFrame) -> np.ndarray:
    """Which of the 2^SLOT_BITS slots hold a gram; at most that many rows come."""
    slots = grams.select(F.shiftrightunsigned("gram", 64 - SLOT_BITS).alias("slot")).distinct().toArrow()
    out = np.zeros(1 << SLOT_BITS, bool)
    out[slots.column("slot").to_numpy()] = True
    return np.packbits(out)


def regions(docs: DataFrame, slots: np.ndarray, sizes: list[int], enough: int, reach: int,
            text: str, key: str) -> DataFrame:
    """(row, doc_id, text_hash, region, start, words, grams): the corpus around its hits of
    seeds of ``sizes`` words; ``words`` is null where fewer than ``enough`` stand."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(slots).astype(bool)
        for batch in sliced(batches, text, 1 << 20):
            h, first = _words(batch, text)
            hits, seeds = [], []
            for size in sizes:
                g = shingles.runs(h, size)
                hit = np.flatnonzero(known[(g >> np.uint64(64 - SLOT_BITS)).astype(np.int64)])
                hit = hit[hit + size <= first[np.searchsorted(first, hit, side="right")]]
                hits.append(hit)
                seeds.append(g[hit])
            hit, seed = np.concatenate(hits), np.concatenate(seeds)
            order = np.argsort(hit, kind="stable")
            hit, seed = hit[order], seed[order]
            doc = np.searchsorted(first, hit, side="right") - 1
            if not len(hit):
                continue
            new = np.append(True, (np.diff(doc) > 0) | (np.diff(hit) > reach))
            begin = np.flatnonzero(new)
            n = np.diff(np.append(begin, len(hit)))
            doc = doc[begin]
            low = np.maximum(hit[begin] - reach, first[doc])
            high = np.minimum(hit[begin + n - 1] + max(sizes) + reach, first[doc + 1])
            alone = n < enough
            size = np.where(alone, 0, high - low)
            flat = pieces.ragged(h, low, size)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()),
                                             pa.array(flat.view(np.int64)), mask=pa.array(alone))
            grams = pa.ListArray.from_arrays(pa.array(np.append(begin, len(hit)), pa.int32()),
                                             pa.array(seed.view(np.int64)))
            at = pa.array(doc)
            yield pa.record_batch([batch.column("_row").take(at), batch.column(key).take(at).cast(pa.int64()),
                                   batch.column("_hash").take(at),
                                   pa.array(np.arange(len(begin)), pa.int64()), pa.array(low - first[doc], pa.int64()),
                                   lists, grams], ["row", "doc_id", "text_hash", "region", "start", "words", "grams"])
    return (docs.select(F.monotonically_increasing_id().alias("_row"), key, text, F.xxhash64(text_or_empty(text)).alias("_hash"))
            .mapInArrow(run, "row long, doc_id long, text_hash long, region long, start long, words array<long>, grams array<long>")
            .withColumn("region", F.struct("row", "start")))


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    flat, at = column.values.to_numpy(), column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(at[:-1], at[1:])]


def can_reach(item: np.ndarray, words: np.ndarray, least: float) -> bool:
    """Whether a score of ``least`` is possible: an alignment gains 2 at most for
    each word in common, no more than both hold of it, and loses 1 for every
    other word that it passes."""
    own, n = np.unique(item, return_counts=True)
    at = np.minimum(np.searchsorted(own, words), len(own) - 1)
    common = own[at] == words
    if np.minimum(n, np.bincount(at[common], minlength=len(own))).sum() < least * len(item):
        return False
    total = np.append(0, np.cumsum(np.where(common, 2, -1)))
    return (total - np.minimum.accumulate(total)).max() >= 2 * least * len(item)


def align(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int, int]:
    """Best local alignment: score, its first and last word, the item's last."""
    down = np.arange(len(words) + 1)

    def best(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
        row, top = np.zeros(len(b) + 1, np.int64), (0, 0, 0)
        for i, w in enumerate(a):
            step = np.maximum(row - 1, 0)
            step[1:] = np.maximum(step[1:], row[:-1] + np.where(b == w, 2, -1))
            row = np.maximum.accumulate(step + down[:len(b) + 1]) - down[:len(b) + 1]
            k = int(row.argmax())
            if row[k] > top[0]:
                top = (int(row[k]), i, k - 1)
        return top
    score, i, end = best(item, words)
    back = best(item[:i + 1][::-1], words[:end + 1][::-1])
    return score, end - back[2], end, i


def leaks(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id",
          least: float = LEAST) -> DataFrame:
    """(row, doc_id, text_hash, item_id, score, seeds, first_word, last_word)."""
    bench = kept(item_words(items), "items").withColumn("of", F.size(F.array_distinct("grams")))
    # at most a row for each number of words a seed can have
    kinds = {r["size"]: r for r in bench.filter(F.size("grams") > 0)
             .groupBy((F.size("words") - F.size("grams") + 1).alias("size"))
             .agg(F.max(F.size("words")).alias("most"), F.min("of").alias("fewest")).collect()}
    reach = max((r["most"] for r in kinds.values()), default=0)
    enough = 1 if any(r["fewest"] <= LONE for r in kinds.values()) else MIN_SEEDS
    needs = F.when(F.col("of") <= LONE, 1).otherwise(MIN_SEEDS)
    seeds = kept(bench.select("item_id", needs.alias("needs"), F.explode(F.array_distinct("grams")).alias("gram")), "seeds")
    sizes = sorted(kinds) or [max(SEED_WORDS.values())]
    found = kept(regions(docs, bit_map(seeds), sizes, enough, max(reach, max(sizes)), text, key), "regions")
    n_docs = docs.count()

    grams = found.select("row", "region", F.col("words").isNotNull().alias("close"),
                         F.explode(F.array_distinct("grams")).alias("gram"))
    wanted = seeds.groupBy("gram").agg(F.count("*").alias("items"))
    grams = kept(grams.join(wanted, "gram"), "hits")  # without the bit map's false hits
    rare_to = max(RARE_DOCS, int(RARE_SHARE * n_docs))
    # a row's regions lie apart, so a gram counts once a region; rows of one text add up to it at most
    rare = (grams.groupBy("gram").agg(F.count("*").alias("df"))
            .select("gram", (F.col("df") <= rare_to).alias("rare")))
    pairs = (grams.filter("close").select("region", "gram").join(rare, "gram").join(seeds, "gram")
             .groupBy("region", "item_id").agg(F.count("*").alias("seeds"), F.count_if("rare").alias("rare"),
                                               F.first("needs").alias("needs"))
             .filter("seeds >= needs").withColumn("rare", F.col("rare") >= MIN_SEEDS))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = list(zip(_lists(batch.column("item")), _lists(batch.column("words"))))
            possible = [r or can_reach(a, b, least) for r, (a, b) in zip(batch.column("rare").to_pylist(), words)]
            batch = batch.filter(pa.array(possible, pa.bool_()))
            out = [align(a, b) for ok, (a, b) in zip(possible, words) if ok]
            start = batch.column("start").to_numpy()
            n = np.array([len(a) for a in batch.column("item")], np.int64)
            got = np.array(out, np.int64).reshape(-1, 4)
            yield pa.record_batch([*(batch.column(c) for c in ("row", "doc_id", "text_hash", "item_id")),
                                   pa.array(got[:, 0] / (2 * n)), batch.column("seeds"),
                                   pa.array(got[:, 1] + start), pa.array(got[:, 2] + start)],
                                  ["row", "doc_id", "text_hash", "item_id", "score", "seeds", "first_word", "last_word"])
    aligned = (pairs.join(found.filter("words IS NOT NULL").select("row", "doc_id", "text_hash", "region", "start", "words"), "region")
               .join(bench.select("item_id", F.col("words").alias("item")), "item_id")
               .select("row", "doc_id", "text_hash", "item_id", "seeds", "rare", "start", "words", "item")
               .mapInArrow(run, "row long, doc_id long, text_hash long, item_id long, score double, seeds long, "
                                "first_word long, last_word long"))
    best = (aligned.filter(F.col("score") >= least).groupBy("row", "doc_id", "text_hash", "item_id")
            .agg(F.max(F.struct("score", -F.col("first_word"), "seeds", "last_word")).alias("b")))
    return best.select("row", "doc_id", "text_hash", "item_id", "b.score", "b.seeds",
                       (-F.col("b").getField("col2")).alias("first_word"), "b.last_word")


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All columns of the rows that leak no item.  A row goes by its id (null is
    an id as well) and its text, so other texts of the same id stay."""
    gone = kept(leaks(docs, items, text, key).select(F.struct("doc_id", "text_hash").alias("gone")).distinct(), "leaks")
    own = F.struct(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text_or_empty(text)).alias("text_hash"))
    return (docs.select(whole_row(docs).alias("row"), own.alias("own"))
            .join(gone, F.col("own").eqNullSafe(F.col("gone")), "left_anti").select("row.*"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row", "text_hash")
