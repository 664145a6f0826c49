"""Operator 13 against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentscope.llm import tree_negatives as tree


def brute(rows, every=100):
    """Rows as (id, label, vector); sorted tuples as the query gives them."""
    use = [(i, label, [math.floor(tree.SCALE * x) for x in v]) for i, label, v in rows
           if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []

    def order(found):
        return sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0, f[2]))
    for a, (i, label, v) in enumerate(use):
        if i is None or i % every:
            continue
        scores = [(sum(p * q for p, q in zip(v, x)), j, b) for b, (j, _, x) in enumerate(use) if b != a]
        positives = order(s for s in scores if use[s[2]][1] == label)[:tree.POSITIVES]
        for score, j, _ in positives:
            fits = order(s for s in scores if use[s[2]][1] != label and 80 * score <= 100 * s[0] <= 100 * score)
            out += [(i, j, r, k, score, s) for r, (s, k, _) in enumerate(fits[:tree.TOP], 1)]
    return sorted(out, key=repr)


def clouds(n, dim, clusters, spread, seed, every):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(clusters)]
    rows = []
    for i in range(n):
        c = r.randrange(clusters)
        rows.append((i, r.randrange(4) if r.random() < .7 else c % 4, [x + r.gauss(0, spread) for x in centres[c]]))
    return rows


def mined(spark, rows, every=100):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, label int, embedding array<double>, id string, row string")
    return tree.mined(tree.usable(df.repartition(3)), F.col("id") % every == 0)


@pytest.mark.parametrize("blocks", ["one", "many"])
def test_matches_brute_force(spark, monkeypatch, blocks):
    if blocks == "many":
        monkeypatch.setattr(tree, "ROWS", 60)
        monkeypatch.setattr(tree, "ANCHORS", 7)
        monkeypatch.setattr(tree, "CHUNK", 16)
        monkeypatch.setattr(tree, "DENSE", 0.5)
    rows = clouds(300, 6, 12, 0.1, 4, 10)
    rows += [(i + 300, 1, rows[7][2]) for i in range(60)] + [(40, 2, rows[40][2]), (40, 2, rows[40][2]), (40, 3, rows[41][2])]
    rows += [(None, 1, rows[7][2]), (None, 0, rows[7][2]), (1000, None, rows[0][2]), (1010, 1, None), (1020, 1, [1.0, None]),
             (1030, 1, [float("nan")] * 6), (1040, 1, [float("inf")] * 6), (1050, 1, [0.5, 1.5]), (1060, 2, []),
             (1070, 9, rows[3][2]), (-20, 0, [0.0] * 6)]
    got = [tuple(r) for r in mined(spark, rows, 10).collect()]
    assert sorted(got, key=repr) == brute(rows, 10) and len(got) > 300


def test_bounds_save_scores():
    """Blocks of like anchors: most pairs are never scored, and nothing is lost."""
    rows = clouds(3000, 16, 60, 0.01, 5, 1)
    x = np.floor(tree.SCALE * np.array([v for *_, v in rows]))
    labels, number = np.array([c for _, c, _ in rows]), np.arange(len(rows))
    own = number[::10]
    order, parent, edge = tree.spanning_tree(x[own])
    own = own[order]
    assert all(parent[1:] < np.arange(1, len(own))) and parent[0] == -1
    assert edge[1:] == pytest.approx([np.linalg.norm(x[own[k]] - x[own[parent[k]]]) for k in range(1, len(own))])
    scores = x[own] @ x.T
    best = [tree.Best([(0.97 * s.max(), s.max())]) for s in scores]
    count = tree.Counter()
    tree.search(x, number, labels, number, x[own], parent, edge, own, labels[own], best, False, count)
    assert count.scored < 0.4 * count.pairs
    for k, b in enumerate(best):
        fits = [(-s, int(i), int(i)) for i, s in enumerate(scores[k])
                if labels[i] != labels[own[k]] and 0.97 * scores[k].max() <= s]
        assert b.rows[0] == sorted(fits)[:tree.TOP] or (len(b.rows[0]) == 0 and not fits)


def test_spanning_tree_is_minimal():
    x = np.random.default_rng(3).standard_normal((7, 3))
    _, _, edge = tree.spanning_tree(x)
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    pairs, parts, total = sorted((d[i, j], i, j) for i in range(7) for j in range(i)), list(range(7)), 0
    for w, i, j in pairs:  # Kruskal
        if parts[i] != parts[j]:
            total += w
            parts = [parts[i] if p == parts[j] else p for p in parts]
    assert edge.sum() == pytest.approx(total)


def test_large_components_stay_exact(spark):
    r = random.Random(6)
    rows = [(i, i % 2, [r.choice([-1, 1]) * r.random() * 2.0 ** 22 for _ in range(5)]) for i in range(60)]
    assert sorted(map(tuple, mined(spark, rows, 10).collect()), key=repr) == brute(rows, 10)
    mined(spark, [(0, 1, [1e300, 1.0]), (1, 1, [1e300, 2.0]), (2, 0, [-1e300, 1e300])], 1).collect()


def test_empty_tables(spark):
    schema = "vec_id long, label int, embedding array<float>"
    for rows in ([], [(1, 1, [1.0])], [(100, 1, [1.0])], [(100, 1, []), (200, 1, []), (3, 2, [])]):
        got = tree.mined(tree.usable(spark.createDataFrame(rows, schema)), F.col("id") % 100 == 0).collect()
        assert sorted(map(tuple, got)) == brute(rows)
