"""Operators 4 and 5 against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rentscope.llm import bbit_minhash as near
from rentscope.llm import decontaminate, pieces, shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def word_set(text, n):
    w = WORD.findall(lower(text))
    if len(w) < n:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1))


def brute_components(rows, n):
    sets = [(i, word_set(t, n)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}


def copies(seed=5, groups=6, size=25):
    """Groups around a text: some members link, some only through others, some not."""
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows, i = [], 0
    for _ in range(groups):
        base = [r.choice(vocabulary) for _ in range(r.choice([12, 60, 140]))]
        for _ in range(size):
            text = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 3, 4, 5])):
                text[r.randrange(len(text))] = r.choice(vocabulary)
            rows.append((i, " ".join(text).upper() if r.random() < .2 else " \t".join(text)))
            i += 1
    r.shuffle(rows)
    return rows + [(i, None), (i + 1, ""), (i + 2, " \n"), (i + 3, "two words"), (i + 4, "Two  words"),
                   (i + 5, "words two"), (i + 6, "é" * 5000)]


@pytest.mark.parametrize("n", [4, 5])
def test_groups_match_brute_force(spark, n):
    rows = copies()
    df = spark.createDataFrame([(*r, 1, "b") for r in rows], "doc_id long, text string, id int, bucket string")
    got = {r.doc_id: r for r in near.groups(df, n, 80).collect()}
    assert {i: r.component_id for i, r in got.items()} == brute_components(rows, n)
    assert all(got[i].n_shingles == len(word_set(t, n)) for i, t in rows)


def test_repeated_rows_null_ids_and_extra_columns(spark):
    a, b = " ".join(map(str, range(30))), " ".join(map(str, range(50, 90)))
    rows = [(3, a, "x"), (3, a, "y"), (2, a, "z"), (4, b, "u"), (3, b, "v"), (None, a, "n"), (None, None, "m"), (9, None, "o")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = {(r.doc_id, r.n_shingles): r.component_id for r in near.groups(df, 5, 80).collect()}
    assert {got[k] for k in ((3, 26), (2, 26), (4, 36), (3, 36))} == {2}  # id 3 has both texts
    assert got[(None, 26)] is None and got[(9, 0)] == 9
    kept = near.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r.component_id for r in kept.collect()) == ["m", "n", "o", "z"]
    assert near.groups(df.limit(0), 5, 80).count() == 0


def test_estimate_is_collision_corrected(spark):
    r = random.Random(1)
    words = [f"v{k}" for k in range(3000)]
    a = [r.choice(words) for _ in range(1500)]
    rows = [(0, " ".join(a))]
    for k in (1, 2, 3):
        rows.append((k, " ".join(a[:1500 - 300 * k] + [r.choice(words) for _ in range(300 * k)])))
    signed = near.signatures(spark.createDataFrame(rows, "doc_id long, text string"), 4)
    first = signed.filter("doc_id = 0").first()["packed"]
    with_first = signed.select("doc_id", "packed", F.array(*map(F.lit, first)).alias("first"))
    got = with_first.select("doc_id", near.estimate(F.col("first"), F.col("packed")).alias("s")).collect()
    for g in got:
        x, y = word_set(rows[0][1], 4), word_set(rows[g.doc_id][1], 4)
        assert abs(g.s - len(x & y) / len(x | y)) < 0.2


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(8, 30)] + [(50, 50)]
    got = dict(near.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert set(got.values()) == {100, 7} and got[140] == 100 and got[29] == 7
    assert near.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words_do_not_depend_on_windows():
    texts = ["One two", "", "  three\tFOUR\x0bfive ", "é" * 50, "six", "seven eight"]
    data, offsets = pieces.text_bytes(pa.array(texts))
    whole = shingles.words(data, offsets)
    for window in (1, 5, 13):
        for x, y in zip(whole, shingles.words(data, offsets, window=window)):
            assert x.tolist() == y.tolist()
    assert np.diff(whole[3]).tolist() == [len(WORD.findall(t)) for t in texts]


def test_words_of_equal_structure_differ(spark):
    """Thue-Morse words collide under every polynomial hash modulo 2^64."""
    bits = np.zeros(1, np.uint8)
    while len(bits) < 1 << 12:
        bits = np.concatenate([bits, 1 - bits])
    a, b = bytes(bits + 97).decode(), bytes(98 - bits).decode()
    h, *_ = shingles.words(*pieces.text_bytes(pa.array([f"{a} {b}"])))
    assert h[0] != h[1]
    rows = [(1, " ".join([a] * 3 + [b] * 2 + [a, b])), (2, " ".join([b] * 3 + [a] * 2 + [b, a]))]
    got = near.groups(spark.createDataFrame(rows, "doc_id long, text string"), 4, 80).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 2}


# decontamination

def items(seed=2, n=12, size=40):
    r = random.Random(seed)
    return [(k, " ".join(f"{r.choice('abcdefgh')}{r.randrange(200)}" for _ in range(size))) for k in range(n)]


def brute_score(item, text):
    """Smith-Waterman over words, by the definition."""
    a, b = (re.findall(r"[^\W_]+", x.lower()) for x in (item, text))
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(len(a)):
        for j in range(len(b)):
            h[i + 1, j + 1] = max(0, h[i, j] + (2 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
    return h.max() / (2 * len(a))


def test_leaks_match_alignment_of_everything(spark):
    r = random.Random(6)
    bench = items()
    noise = [f"n{k}" for k in range(3000)]
    rows = []
    for k in range(80):
        text = [r.choice(noise) for _ in range(r.randrange(0, 150))]
        if k % 2:
            words = bench[r.randrange(len(bench))][1].split()
            share = r.choice([1, 1, .7, .4, .15])
            words = words[:int(len(words) * share)]
            words = [w for w in words if r.random() > .05]
            words = [r.choice(noise) if r.random() < r.choice([0, .1, .2]) else w.upper() + r.choice(["", ",", "!"]) for w in words]
            at = r.randrange(len(text) + 1)
            text[at:at] = words
        rows.append((k, " ".join(text)))
    rows += [(100, None), (101, "")]
    df = spark.createDataFrame([(*x, 0) for x in rows], "doc_id long, text string, score int")
    bench_df = spark.createDataFrame([(*x, "t") for x in bench] + [(90, None, "e"), (91, "too short", "e")],
                                     "item_id long, text string, words string")
    got = {(g.doc_id, g.item_id): g.score for g in decontaminate.leaks(df, bench_df).collect()}
    want = {(i, j): s for i, t in rows for j, x in bench if (s := brute_score(x, t or "")) >= decontaminate.LEAST}
    assert got == pytest.approx(want) and len(want) > 20
    left = decontaminate.without_leaks(df, bench_df)
    assert left.columns == df.columns
    assert {x.doc_id for x in left.collect()} == {i for i, _ in rows} - {i for i, _ in want}


def test_a_passage_in_a_third_of_all_documents_is_still_found(spark):
    bench = items(n=3)
    rows = [(k, f"start {k} " + (bench[1][1] if k % 3 == 0 else "other words here only")) for k in range(300)]
    got = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"),
                              spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert {(g.doc_id, g.item_id) for g in got} == {(k, 1) for k in range(0, 300, 3)}
    assert all(g.score == 1 and g.first_word == 2 and g.last_word == 41 for g in got)


def test_edited_copies_of_frequent_passages_are_found(spark):
    r = random.Random(8)
    bench = [(n, " ".join(f"{n}w{k}" for k in range(n))) for n in (12, 20, 40)]
    rows = []
    for k in range(360):
        words = [w if k % 2 or r.random() > .25 else f"x{r.randrange(10**6)}" for w in bench[k % 3][1].split()]
        rows.append((k, " ".join([f"start{k}", *words])))
    got = {(g.doc_id, g.item_id): g.score for g in decontaminate.leaks(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(bench, "item_id long, text string")).collect()}
    want = {(i, j): s for i, t in rows for j, x in bench if (s := brute_score(x, t)) >= decontaminate.LEAST}
    assert got == pytest.approx(want) and len(want) > 300


def test_leaking_rows_go_by_id_and_text(spark):
    bench = items(n=1)
    rows = [(None, "x " + bench[0][1]), (None, "clean"), (1, bench[0][1]), (1, "clean too"), (2, None)]
    left = decontaminate.without_leaks(spark.createDataFrame(rows, "doc_id long, text string"),
                                       spark.createDataFrame(bench, "item_id long, text string"))
    assert {(x.doc_id, x.text) for x in left.collect()} == {(None, "clean"), (1, "clean too"), (2, None)}


def test_bound_of_the_score(spark):
    r = random.Random(9)
    for _ in range(300):
        item, text = (np.array([r.randrange(12) for _ in range(r.randrange(2, n))]) for n in (14, 30))
        score = decontaminate.align(item, text)[0] / (2 * len(item))
        assert score == brute_score(*(" ".join(map(str, x)) for x in (item, text)))
        assert decontaminate.can_reach(item, text, score)


def test_short_items_need_one_seed(spark):
    bench = [(4, "alpha beta gamma delta"), (6, "one two three four five six"), (9, "la la la la la la la la")]
    rows = [(1, "so Alpha beta, gamma delta it"), (2, "one two x four five six"), (3, "one two three other"),
            (4, "alpha beta y z"), (5, "la la la la la la la la"), (6, "alpha and six")]
    got = {(g.doc_id, g.item_id): g.score for g in decontaminate.leaks(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(bench, "item_id long, text string")).collect()}
    want = {(i, j): s for i, t in rows for j, x in bench if (s := brute_score(x, t)) >= decontaminate.LEAST}
    assert got == pytest.approx(want) and set(want) == {(1, 4), (2, 6), (3, 6), (4, 4), (5, 9)}


def test_repeated_rows_case_beyond_ascii_and_empty_tables(spark):
    text = "Éa ôb Çc Üd èe êf ñg íh"
    df = spark.createDataFrame([(1, text.lower()), (1, text.lower())], "doc_id long, text string")
    bench = spark.createDataFrame([(5, text), (6, text)], "item_id long, text string")
    got = decontaminate.leaks(df, bench).collect()
    assert sorted(g.item_id for g in got) == [5, 5, 6, 6]  # every row, every item
    assert decontaminate.leaks(df.limit(0), bench).count() == 0
    assert decontaminate.leaks(df, bench.limit(0)).count() == 0


def test_rows_without_leaks_keep_columns_of_any_name(spark):
    it = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(20)))], "item_id long, text string")
    names = ["_id", "_of", "gone", "own", "row"]
    df = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(25)), *names), (2, "clean text", *names)],
                               ["doc_id", "text", *names])
    out = decontaminate.without_leaks(df, it)
    assert out.columns == df.columns and [list(r) for r in out.collect()] == [[2, "clean text", *names]]
