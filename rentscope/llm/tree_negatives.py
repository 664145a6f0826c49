"""Hard negatives by spanning-tree bounds between anchors (operator 13).

Vectors become whole numbers (``floor(256 * x)``), a row's score is its inner
product with the anchor.  An anchor's positives are the best other rows of its
label; for each positive the best rows of other labels are wanted whose score
lies in a window below the positive's.

Anchors are put in blocks of like ones (by the signs of projections) and every
block gets a minimum spanning tree.  Rows come in blocks as well, and a task
takes a block of rows against a block of anchors.  It scores the tree's root
and walks down: for a child at distance d from its parent, every row's score
is the parent's, or its bounds, plus or minus d times the row's norm.  Only rows
whose bounds meet one of the child's windows are scored for the child; the
others keep their bounds for the next level.  A window is closed from below
by its first TOP rows as soon as there are as many, so it shrinks as rows
come.  Positives are found in the same way with an open window and the
anchor's own label.

Blocks bound what a task holds, whatever the tables' sizes; rows are dealt to
blocks by a hash of their number, so no value of any column makes a block
large.  What a task returns is at most TOP rows an anchor and window.

Defined results: rows with a null label or vector, or with a null or non-finite
component, take no part; a null id is no anchor and comes last among equal
scores; rows of one id are rows of their own, also as anchors; vectors of
unlike length are filled up with zeros; an anchor without positives, or with a
negative positive score (its window is empty), has no negatives; scores beyond
64 bits are the largest or smallest such number; empty tables give no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rentscope.llm.tables import kept, table
from rentscope.operators.keys import dense_ids

SCALE = 256
TOP, POSITIVES = 5, 5
LEAST_PERCENT, MOST_PERCENT = 80, 100
ROWS, ANCHORS = 8192, 1024     # in a block
CHUNK = 2048                   # rows that are bounded at once
DENSE = 0.25                   # a child with more rows to score than this share scores all at once
SIGNS, SEED = 16, 20
_EXACT = 2.0 ** 50             # products of norms below it: doubles hold every sum exactly
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def usable(df: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label") -> DataFrame:
    """(row, id, label, vector) of the rows that take part, written."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    return kept(df.filter(F.col(label).isNotNull() & F.col(vector).isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"), F.col(vector).alias("v")), "vectors")


def numbers(column, dim: int) -> np.ndarray:
    """Whole numbers of an Arrow list column as a matrix of doubles, zeros where
    a vector ends early."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    out = np.zeros((len(column), dim))
    size = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(size) and (size == dim).all():
        out[:] = flat.reshape(len(size), dim)
    else:
        out[np.arange(dim) < size[:, None]] = flat
    return np.clip(np.floor(SCALE * out), -2.0 ** 63, 2.0 ** 63)


def products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products, as doubles where they hold them, else as integers."""
    if _norms(a).max(initial=0) * _norms(x).max(initial=0) < _EXACT:
        return a @ x.T
    big = np.vectorize(lambda f: min(max(int(f), _LOW), _HIGH), otypes=[object])
    return np.clip(big(a) @ big(x).T if a.size and x.size else np.zeros((len(a), len(x)), object), _LOW, _HIGH)


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prim's tree over the rows of ``x``: order of visit, and for each place in
    it the place of the parent (-1 for the root) and the distance to it."""
    n = len(x)
    near = np.full(n, np.inf)
    parent = np.full(n, -1)
    order, place = np.empty(n, np.int64), np.empty(n, np.int64)
    rest = np.ones(n, bool)
    current = 0
    for k in range(n):
        order[k], place[current], rest[current] = current, k, False
        d = np.sqrt(((x - x[current]) ** 2).sum(axis=1))
        closer = rest & (d < near)
        near[closer], parent[closer] = d[closer], current
        current = int(np.where(rest, near, np.inf).argmin())
    near[0] = 0
    return order, np.where(parent[order] < 0, -1, place[parent[order]]), near[order]


def planted(anchors: DataFrame, dim: int) -> DataFrame:
    """(block, node, parent, edge, row, id, label, v): anchors in blocks of like
    ones and every block's tree, written; a parent stands before its children."""
    directions = np.random.default_rng(SEED).standard_normal((dim, SIGNS))

    def signed(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = numbers(batch.column("v"), dim) @ directions > 0
            place = np.packbits(bits, axis=1).astype(np.int64) @ (256 ** np.arange(SIGNS // 8 - 1, -1, -1))
            yield batch.append_column("place", pa.array(place, pa.int64()))

    def tree(group: pa.Table) -> pa.Table:
        order, parent, edge = spanning_tree(numbers(group.column("v"), dim))
        group = group.take(pa.array(order))
        return pa.table([group.column("block"), pa.array(np.arange(len(order))), pa.array(parent), pa.array(edge),
                         *(group.column(c) for c in ("row", "id", "label", "v"))],
                        ["block", "node", "parent", "edge", "row", "id", "label", "v"])
    kind = anchors.schema["v"].dataType.simpleString()
    placed = anchors.mapInArrow(signed, f"row long, id long, label long, v {kind}, place long")
    numbered = dense_ids(placed.withColumn("_order", F.struct("place", "row")), "_order", "number")
    return kept(numbered.select(F.expr(f"(number - 1) div {ANCHORS}").alias("block"), "row", "id", "label", "v")
                .groupBy("block").applyInArrow(tree, f"block long, node long, parent long, edge double, row long, id long, "
                                                     f"label long, v {kind}"), "trees")


class Best:
    """The first TOP rows of each window of one anchor."""

    def __init__(self, windows: list[tuple[float, float]]):
        self.low = [a for a, _ in windows]
        self.high = [b for _, b in windows]
        self.rows = [np.empty((0, 3), object)] * len(windows)

    def bounds(self) -> tuple[float, float]:
        return min(self.low, default=np.inf), max(self.high, default=-np.inf)

    def add(self, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """``ids``: null as the largest number."""
        for k, (a, b) in enumerate(zip(self.low, self.high)):
            own = np.flatnonzero((score >= a) & (score <= b))
            if not len(own):
                continue
            if len(own) > TOP:  # only what can be among the first
                own = own[score[own] >= np.sort(score[own])[-TOP]]
            found = [*zip((-score[own]).tolist(), ids[own].tolist(), rows[own].tolist()), *map(tuple, self.rows[k])]
            self.rows[k] = sorted(found)[:TOP]
            if len(self.rows[k]) == TOP:
                self.low[k] = max(a, -self.rows[k][-1][0])


class Counter:
    """Pairs of anchors and rows, and how many of them were scored."""

    def __init__(self):
        self.pairs = self.scored = 0


def search(x: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, nodes: np.ndarray,
           parents: np.ndarray, edges: np.ndarray, own_rows: np.ndarray, own_labels: np.ndarray,
           best: list[Best], same: bool, count: Counter | None = None) -> None:
    """Fills ``best`` of every node of a tree from a block of rows; ``same``:
    other rows of the node's label, else rows of other labels."""
    count = count or Counter()
    level = np.zeros(len(nodes), np.int64)
    for k in range(1, len(nodes)):
        level[k] = level[parents[k]] + 1
    for at in range(0, len(x), CHUNK):
        part, norm = x[at:at + CHUNK], _norms(x[at:at + CHUNK]) * (1 + 1e-9)
        part_ids, part_labels, part_rows = ids[at:at + CHUNK], labels[at:at + CHUNK], rows[at:at + CHUNK]
        low, high = np.full((len(nodes), len(part)), -np.inf), np.full((len(nodes), len(part)), np.inf)
        for depth in range(int(level.max(initial=-1)) + 1):
            own = np.flatnonzero(level == depth)
            wide = np.array([best[k].bounds() for k in own])
            if depth:
                below, above = low[parents[own]], high[parents[own]]
                # a little more than the bound, for rounding
                room = edges[own][:, None] * (1 + 1e-9) * norm + 1 + 1e-9 * (np.abs(below) + np.abs(above))
                low[own], high[own] = below - room, above + room
            fits = (high[own] >= wide[:, :1]) & (low[own] <= wide[:, 1:])
            alike = own_labels[own][:, None] == part_labels
            wanted = fits & (alike & (own_rows[own][:, None] != part_rows) if same else ~alike)
            dense = (wanted.mean(axis=1) > DENSE) | (depth == 0)
            count.pairs += wanted.size
            scores = products(nodes[own[dense]], part)
            count.scored += scores.size
            low[own[dense]] = high[own[dense]] = scores.astype(np.float64)
            for k, s, ok in zip(own[dense], scores, wanted[dense]):
                best[k].add(s[ok], part_ids[ok], part_rows[ok])
            for k, ok in zip(own[~dense], wanted[~dense]):
                if ok.any():
                    s = products(nodes[k:k + 1], part[ok])[0]
                    count.scored += len(s)
                    low[k, ok] = high[k, ok] = s.astype(np.float64)
                    best[k].add(s, part_ids[ok], part_rows[ok])


def met(rows: DataFrame, trees: DataFrame, n_rows: int, n_blocks: int, dim: int, same: bool) -> DataFrame:
    """(anchor, k, score, id, row): what every block of rows has for the
    windows of every anchor.  ``trees`` has them as ``scores``: those of the
    positives; for positives themselves one open window."""
    row_blocks = max(1, -(-n_rows // ROWS))
    groups = row_blocks * n_blocks

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.take(pa.array(np.argsort(left.column("row").to_numpy())))
        right = right.take(pa.array(np.argsort(right.column("node").to_numpy())))
        ids = left.column("id").fill_null(_HIGH).to_numpy()
        windows = [[(-np.inf, np.inf)] if same else
                   [(-(-LEAST_PERCENT * s // 100), MOST_PERCENT * s // 100) for s in of or []]
                   for of in (right.column("scores").to_pylist() if not same else [None] * len(right))]
        best = [Best(w) for w in windows]
        search(numbers(left.column("v"), dim), ids, left.column("label").to_numpy(), left.column("row").to_numpy(),
               numbers(right.column("v"), dim), right.column("parent").to_numpy(), right.column("edge").to_numpy(),
               right.column("row").to_numpy(), right.column("label").to_numpy(), best, same)
        out = [(anchor, k, int(-score), None if i == _HIGH else i, row)
               for anchor, b in zip(right.column("row").to_pylist(), best)
               for k, found in enumerate(b.rows) for score, i, row in found]
        return pa.table(list(map(list, zip(*out))) or [[]] * 5,
                        pa.schema([(c, pa.int64()) for c in ("anchor", "k", "score", "id", "row")]))
    left = rows.withColumn("group", F.explode(F.expr(
        f"transform(sequence(0, {n_blocks - 1}), b -> b * {row_blocks} + pmod(xxhash64(row), {row_blocks}))")))
    right = trees.withColumn("group", F.explode(F.expr(
        f"transform(sequence(0, {row_blocks - 1}), r -> block * {row_blocks} + r)")))
    parts = min(2 * groups, 20_000)
    return (left.repartition(parts, "group").groupBy("group").cogroup(right.repartition(parts, "group").groupBy("group"))
            .applyInArrow(run, "anchor long, k long, score long, id long, row long"))


def first(found: DataFrame, number: int, *by: str) -> DataFrame:
    """The first ``number`` of each group, ranked from 1."""
    w = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= number)


def mined(rows: DataFrame, is_anchor) -> DataFrame:
    """Hard negatives of the ``usable`` rows that ``is_anchor`` (a condition on
    ``id``) makes anchors."""
    spark = rows.sparkSession
    n_rows = rows.count()
    dim = rows.agg(F.max(F.size("v"))).first()[0] or 0
    trees = planted(rows.filter(is_anchor), dim)
    n_blocks = (trees.agg(F.max("block")).first()[0] or 0) + 1
    # as many positives as TOP come from every block
    positives = kept(first(met(rows, trees, n_rows, n_blocks, dim, True), POSITIVES, "anchor"), "positives")
    scores = positives.groupBy("anchor").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("scores"))
    windows = kept(trees.join(scores, trees["row"] == scores["anchor"], "left").drop("anchor"), "windows")
    found = first(met(rows, windows, n_rows, n_blocks, dim, False), TOP, "anchor", "k")
    of = positives.select("anchor", (F.col("rank") - 1).cast("long").alias("k"), F.col("id").alias("positive_id"),
                          F.col("score").alias("positive_score"))
    names = trees.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return (found.join(of, ["anchor", "k"]).join(names, "anchor")
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    relabelled = table(spark, sf_dir, "embeddings").withColumn("label", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mined(usable(relabelled), F.col("id") % 100 == 0)


def oracle() -> str:
    """The query in DuckDB's SQL."""
    return f"""
WITH q AS (SELECT row_number() OVER () AS r, vec_id,
      (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
      list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT a.r AS a, a.vec_id AS anchor_id, x.r AS x, x.vec_id AS id, a.label = x.label AS alike,
      list_sum(list_transform(list_zip(a.v, x.v), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM q a JOIN q x ON a.vec_id % 100 = 0 AND a.r <> x.r),
p AS (SELECT a, anchor_id, x, id AS positive_id, score AS positive_score FROM s WHERE alike
    QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id, x) <= {POSITIVES})
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.a, p.x ORDER BY score DESC, s.id, s.x)::INTEGER AS rank,
       s.id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.a = s.a AND NOT alike
WHERE {LEAST_PERCENT} * positive_score <= 100 * score AND 100 * score <= {MOST_PERCENT} * positive_score
QUALIFY row_number() OVER (PARTITION BY p.a, p.x ORDER BY score DESC, s.id, s.x) <= {TOP}"""
