"""Near-duplicate groups by b-bit MinHash (operator 5).

Every text gets HASHES minima over its distinct word shingles.  They serve
twice: BANDS groups of ROWS minima are hashed to bucket keys, and the low BITS
bits of every minimum are packed into a signature.  Two signatures agree in a
share ``s + (1 - s) / 2^BITS`` of their places for texts of similarity s;
solved for s this is the collision-corrected estimate, and it takes a few bit
counts.  A pair that shares a bucket and whose estimate is not far (five
standard deviations) below the threshold is confirmed on the full sets.

All pairs of a bucket are never emitted.  Texts with the same set are one class
from the start.  Then:

1. every class is compared with the most central class of each of its buckets
   (the one with the most bucket mates), which is linear in the bucket sizes;
   links make components;
2. what is left are buckets with several components.  Their members of
   different components are compared, each pair once (in its first common
   bucket), if the estimate passes and if the pair can reach the threshold at
   all: what two texts share is at most the part of either that stands in any
   other open text, and at most what both share with the bucket's centre and
   what the fewer shares beyond it.  So copies with many edits of their own are
   out without being compared.  Members of one component are never compared.  Both conditions
   are exact bounds or five standard deviations wide, so no link between
   different texts is lost.

A text of similarity 0.8 to another misses all common buckets with a
probability of (1 - 0.8^ROWS)^BANDS = 5e-8.

Defined results: null or empty text, or one without words, has no shingles and
is linked with nothing; rows with the same id count as one document with
several texts; a null id is linked with nothing (component null) and kept;
repeated texts are linked; an empty table gives no rows; other columns are not
read by the query and pass through ``keep_first``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rentscope.llm import pieces, shingles
from rentscope.llm.tables import kept, sliced, table

HASHES, ROWS, BITS = 128, 4, 4
BANDS = HASHES // ROWS
PLACES = 64 // BITS
LONGS = HASHES // PLACES
_RANDOM = np.random.default_rng(97)
_XOR = _RANDOM.integers(0, 2**32, HASHES, dtype=np.uint32)
_TIMES = _RANDOM.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def minima(keys: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, HASHES) minima; rows of texts without shingles are 0."""
    full = np.flatnonzero(np.diff(offsets))
    out = np.zeros((len(offsets) - 1, HASHES), np.uint32)
    if len(full):
        short = (keys >> np.uint64(32)).astype(np.uint32)
        starts = offsets[:-1][full]
        for k in range(HASHES):
            out[full, k] = np.minimum.reduceat((short ^ _XOR[k]) * _TIMES[k], starts)
    return out


def signatures(df: DataFrame, words: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, bands, packed) of every row."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text, 1 << 20):
            h, at = shingles.shingles(*pieces.text_bytes(batch.column(text)), words)
            n = np.diff(at)
            sums = [set_sum(x, at) for x in (h, shingles.mixed(h ^ np.uint64(0x5BD1E995)))]
            low = minima(h, at)
            bands = np.zeros((len(n), BANDS), np.uint64)
            for r in range(ROWS):
                bands = shingles.mixed(bands ^ low[:, r::ROWS].astype(np.uint64))
            bands = shingles.mixed(bands + np.arange(1, BANDS + 1, dtype=np.uint64))
            nibbles = shingles.mixed(low.astype(np.uint64)) & np.uint64((1 << BITS) - 1)
            shifts = np.arange(PLACES, dtype=np.uint64) * np.uint64(BITS)
            packed = (nibbles.reshape(len(n), LONGS, PLACES) << shifts).sum(axis=2, dtype=np.uint64)

            def lists(x):
                return pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32),
                                                pa.array(x.reshape(-1).view(np.int64)))
            yield pa.record_batch([batch.column(key).cast(pa.int64()), pa.array(n, pa.int64()), *map(pa.array, sums),
                                   lists(bands), lists(packed)],
                                  ["doc_id", "n_shingles", "set_a", "set_b", "bands", "packed"])
    return df.select(key, text).mapInArrow(
        run, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, packed array<long>")


def estimate(a: Column, b: Column) -> Column:
    """Collision-corrected similarity of two packed signatures by bit counts."""
    ones = sum(1 << (BITS * k) for k in range(PLACES))
    ones -= (1 << 64) if ones >> 63 else 0

    def differing(k: int) -> Column:
        x = a[k].bitwiseXOR(b[k])
        for step in range(1, BITS):
            x = x.bitwiseOR(F.shiftrightunsigned(a[k].bitwiseXOR(b[k]), step))
        return F.bit_count(x.bitwiseAND(F.lit(ones)))
    agree = 1 - reduce(lambda x, y: x + y, [differing(k) for k in range(LONGS)]) / HASHES
    chance = 2.0 ** -BITS
    return (agree - chance) / (1 - chance)


def least_estimate(percent: int) -> float:
    s, chance = percent / 100, 2.0 ** -BITS
    p = s + (1 - s) * chance
    return s - 5 * (p * (1 - p) / HASHES) ** 0.5 / (1 - chance)


def set_sum(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at) - 1, np.uint64)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        out[full] = np.add.reduceat(h, at[:-1][full])
    return out.view(np.int64)


def sets_of(df: DataFrame, words: int, text: str, key: str) -> DataFrame:
    """(id, set_a, full): the full shingle set as sorted 64-bit integers."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text, 1 << 20):
            h, at = shingles.shingles(*pieces.text_bytes(batch.column(text)), words)
            own = h.view(np.int64).copy()
            for a, b in zip(at[:-1], at[1:]):
                own[a:b].sort()
            yield pa.record_batch([batch.column(key).cast(pa.int64()), pa.array(set_sum(h, at)), pa.ListArray.from_arrays(
                pa.array(at, pa.int32()), pa.array(own))], ["id", "set_a", "full"])
    return df.select(key, text).mapInArrow(run, "id long, set_a long, full array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b in zip(batch.column("full_a"), batch.column("full_b")):
                x, y = a.values.to_numpy(), b.values.to_numpy()
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                both = int((x[at] == y).sum()) if len(x) else 0
                out.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.record_batch([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(out, pa.bool_()))
    return (pairs.join(sets.select(F.col("id").alias("a"), F.col("full").alias("full_a")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("full").alias("full_b")), "b")
            .select("a", "b", "full_a", "full_b").mapInArrow(run, "a long, b long"))


def against_centres(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Per (text, centre): which of the centre's shingles the text has, as
    bits, and how many of its shared shingles lie beyond the centre.  What two
    texts share is at most their common bits and the fewer of those beyond."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, beyond = [], []
            for a, c, shared in zip(batch.column("full"), batch.column("full_c"), batch.column("shared").to_pylist()):
                x, centre = a.values.to_numpy(), c.values.to_numpy()
                at = np.minimum(np.searchsorted(x, centre), len(x) - 1)
                has = np.zeros(-(-len(centre) // 64) * 64, np.uint8)
                has[:len(centre)] = x[at] == centre
                bits.append(np.packbits(has, bitorder="little").view(np.int64))
                beyond.append(max(0, shared - int(has.sum())))
            yield pa.record_batch([*(batch.column(n) for n in ("id", "set_a", "centre", "centre_a")),
                                   pa.array(bits, pa.list_(pa.int64())), pa.array(beyond, pa.int64())],
                                  ["id", "set_a", "centre", "centre_a", "bits", "beyond"])
    of_centre = sets.select(F.col("id").alias("centre"), F.col("set_a").alias("centre_a"), F.col("full").alias("full_c"))
    return (rows.join(sets, ["id", "set_a"]).join(of_centre, ["centre", "centre_a"])
            .select("id", "set_a", "centre", "centre_a", "shared", "full", "full_c")
            .mapInArrow(run, "id long, set_a long, centre long, centre_a long, bits array<long>, beyond long"))


def components(links: DataFrame) -> DataFrame:
    """(id, label) of every linked id: the smallest id that can be reached.
    Large stars and small stars in turn; each round is written, and counted
    and hashed while it is written."""
    def written(edges: DataFrame) -> tuple[DataFrame, dict]:
        seen = Observation()
        return kept(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(
            F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))).alias("h")), "edges"), seen.get

    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges if not large else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        near = both.join(least, "u")
        if large:
            return near.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        out = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        return out.filter("u <> v").distinct()

    edges, before = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                            .filter("u <> v").distinct())
    while before["n"]:
        edges, now = written(star(star(edges, True), False))
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("label"))


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after further links: only the components they meet are relabelled."""
    met = links
    for side in ("a", "b"):
        own = labels.select(F.col("id").alias(side), F.col("label").alias("_label"))
        met = met.join(own, side, "left").withColumn(side, F.coalesce("_label", side)).drop("_label")
    new = kept(components(met), "labels").select(F.col("id").alias("_old"), F.col("label").alias("_new"))
    moved = (labels.join(new, F.col("label") == F.col("_old"), "left")
             .select("id", F.coalesce("_new", "label").alias("label")))
    # components of one text have no label of their own yet
    return moved.unionByName(new.select(F.col("_old").alias("id"), F.col("_new").alias("label"))
                             .join(labels, "id", "left_anti"))


def labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("label", F.col("id"))
    return rows.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))


def groups(df: DataFrame, words: int, percent: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    signed = kept(signatures(df, words, text, key), "signatures")
    same = ["set_a", "set_b", "n_shingles"]
    usable = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = kept(usable.groupBy(*same).agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands"),
                                             F.first("packed").alias("packed")), "classes")
    member = kept(usable.select("doc_id", *same).join(classes.select("id", *same), same)
                  .select("doc_id", "id", *same), "members")

    # buckets of two classes or more, and how central each of their classes is
    rows = classes.select("id", F.explode("bands").alias("bucket"))
    mates = rows.groupBy("bucket").agg(F.count("*").alias("mates")).filter("mates > 1")
    rows = kept(rows.join(mates, "bucket").select("bucket", "id", "mates"), "bucket-mates")
    central = kept(rows.groupBy("id").agg(F.sum("mates").alias("central")), "central")
    rows = kept(rows.select("bucket", "id").join(central, "id"), "bucket-rows")
    signs = kept(classes.select("id", "set_a", "n_shingles", "bands", "packed")
                 .join(central.select("id"), "id", "left_semi"), "signs")
    sets = kept(sets_of(df.select(key, text).join(central.select(F.col("id").alias(key)), key, "left_semi"),
                        words, text, key), "sets")
    passes = estimate(F.col("pa"), F.col("pb")) >= F.lit(least_estimate(percent))

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    # 1. every class and the centres of its buckets
    centre = rows.groupBy("bucket").agg(F.max(F.struct("central", (-F.col("id")).alias("minus")))["minus"].alias("minus"))
    pairs = ordered(rows.join(centre, "bucket").filter("id <> -minus").select(F.col("id").alias("a"), (-F.col("minus")).alias("b")))
    pairs = (pairs.join(signs.select(F.col("id").alias("a"), F.col("packed").alias("pa")), "a")
             .join(signs.select(F.col("id").alias("b"), F.col("packed").alias("pb")), "b").filter(passes).select("a", "b"))
    links = kept(confirmed(pairs.distinct(), sets, percent), "links")
    # a document with several texts is one document
    of_one = member.groupBy("doc_id").agg(F.min("id").alias("b"), F.max("id").alias("z")).filter("b < z")
    links = links.unionByName(member.join(of_one, "doc_id").filter("id <> b").select(F.col("id").alias("a"), "b"))
    labels = kept(components(links), "labels")

    # 2. members of different components in the buckets that hold several
    now = labelled(rows, labels)
    several = now.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y")
    now = kept(now.join(several.select("bucket"), "bucket", "left_semi"), "several-rows")
    ids = now.select("id").distinct()
    alone = (sets.join(ids, "id", "left_semi").select("id", "set_a", F.explode("full").alias("g"))
             .groupBy("g").agg(F.count("*").alias("n"), F.min(F.struct("id", "set_a")).alias("of"))
             .filter("n = 1").groupBy("of.id", "of.set_a").agg(F.count("*").alias("alone")))
    signs = kept(signs.join(ids, "id", "left_semi").join(alone, ["id", "set_a"], "left")
                 .withColumn("shared", F.col("n_shingles") - F.coalesce("alone", F.lit(0))), "open-signs")
    # a text that none of its bucket can reach takes no part, nor do buckets of one component
    now = kept(now.join(signs.select("id", "set_a", "n_shingles", "shared", "packed", "bands"), "id")
               .select("bucket", "id", "set_a", "label", "central", "n_shingles", "shared", "packed", "bands"), "open-rows")
    least = now.groupBy("bucket").agg(F.min("n_shingles").alias("least"))
    now = now.join(least, "bucket").filter(
        (100 + percent) * F.col("shared") >= percent * (F.col("n_shingles") + F.col("least")))
    held = now.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.max(F.struct(
        "central", "label", "id", "set_a")).alias("c")).filter("lo < hi").select(
            "bucket", F.col("c.label").alias("main"), F.col("c.id").alias("centre"), F.col("c.set_a").alias("centre_a"))
    now = kept(now.drop("least", "central").join(held, "bucket"), "open-rows")
    seen = against_centres(now.select("id", "set_a", "shared", "centre", "centre_a").distinct(), sets)
    now = kept(now.join(kept(seen, "seen"), ["id", "set_a", "centre", "centre_a"]).select(
        "bucket", "id", "label", "main", "n_shingles", "shared", "packed", "bands", "bits", "beyond"), "open-rows")
    # members outside the component of the bucket's centre, and all members
    x = now.filter("label <> main").drop("main").toDF("bucket", "a", "la", "na", "sa", "pa", "ba", "ca", "oa")
    y = now.toDF("bucket", "b", "lb", "main", "nb", "sb", "pb", "bb", "cb", "ob")

    def reach(both) -> Column:
        return (100 + percent) * both >= percent * (F.col("na") + F.col("nb"))
    first = F.array_min(F.array_intersect("ba", "bb")) == F.col("bucket")
    within = F.aggregate(F.zip_with("ca", "cb", lambda p, q: F.bit_count(p.bitwiseAND(q))), F.lit(0), lambda n, k: n + k)
    pairs = ordered(x.join(y, "bucket").filter(
        (F.col("la") != F.col("lb")) & ((F.col("lb") == F.col("main")) | (F.col("a") < F.col("b")))
        & reach(F.least("sa", "sb")) & passes & first & reach(within + F.least("oa", "ob"))))
    more = kept(confirmed(pairs, sets, percent), "links")
    if not more.isEmpty():
        labels = kept(joined(labels, more), "labels")

    found = (labelled(member.select("doc_id", *same, "id"), labels)
             .groupBy("doc_id", *same).agg(F.min("label").alias("component_id")))
    return (signed.select("doc_id", *same).join(found, ["doc_id", *same], "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4-word shingles, similarity of 0.8 or more."""
    found = groups(table(spark, sf_dir, "documents"), words=4, percent=80)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_first(df: DataFrame, words: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All columns of the documents that are the first (smallest id) of their
    group; of rows with one id all stay."""
    gone = (groups(df, words, percent, text, key).filter("doc_id <> component_id")
            .select(F.col("doc_id").alias(key)).distinct())
    return df.join(gone, key, "left_anti").select(*df.columns)


def oracle(words: int = 4, percent: int = 80) -> str:
    """The query in DuckDB's SQL: all pairs that share a shingle, and what is
    reachable over the links (for small tables)."""
    return f"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - {words - 2}), lambda i: array_to_string(w[i:i + {words - 1}], ' '))) END AS s FROM w),
same AS (SELECT s, len(s) AS n, min(doc_id) AS u FROM (SELECT doc_id, list_sort(s) AS s FROM s) GROUP BY s),
e AS (SELECT u, n, unnest(s) AS g FROM same),
pairs AS (SELECT a.u, b.u AS v, a.n + b.n AS n, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.u < b.u GROUP BY ALL),
links AS (SELECT u, v FROM pairs WHERE 100 * c >= {percent} * (n - c) UNION SELECT v, u FROM pairs WHERE 100 * c >= {percent} * (n - c)),
reach(u, v) AS (SELECT u, u FROM same WHERE n > 0 UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u),
least AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u)
SELECT doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       doc_id = coalesce(component_id, doc_id) AS kept
FROM s LEFT JOIN same ON len(s.s) > 0 AND list_sort(s.s) = same.s LEFT JOIN least USING (u)"""
