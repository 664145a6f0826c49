"""Operator 12 against a plain reading of its definition."""

import random
import re
from math import floor, log

import pytest

from rentscope.llm import licences

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def places(w, phrase):
    p = words(phrase)
    return [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]


def brute(rows, base=licences.BASE, notices=licences.NOTICES):
    docs = [words(t) for _, t in rows]
    known = {w for p in [*base, *(x for _, t, must in notices for x in [t, *must])] for w in words(p)}
    weight = {w: floor(1000 * log((len(docs) + 1) / (sum(w in set(d) for d in docs) + 1))) + 1 for w in known}
    rare = []
    for _, text, _ in notices:
        w = words(text)
        best = sorted(set(w), key=lambda x: (-weight[x], w.index(x)))[:licences.RARE]
        rare.append([(k, x) for k, x in enumerate(w) if x in best])
    out = []
    for (i, _), d in zip(rows, docs):
        of_base = [(s, label) for phrase, label in base.items() for s in places(d, phrase)]
        labels, score = {label for _, label in of_base}, 1.0 if of_base else 0.0
        for (label, text, must), index in zip(notices, rare):
            votes = sorted((k - p, p) for k, x in enumerate(d) for p, y in index if x == y)
            groups = []
            for v in votes:
                if not groups or v[0] - groups[-1][-1][0] > licences.DRIFT:
                    groups.append([])
                groups[-1].append(v)
            total = sum(weight[x] for _, x in index)
            for g in groups:
                found = {p for _, p in g}
                share = sum(weight[x] for p, x in index if p in found) / total
                low, high = g[0][0] - licences.DRIFT, g[-1][0] + len(words(text)) + licences.DRIFT
                if share >= licences.LEAST and all(any(low <= s <= high for s in places(d, m)) for m in must):
                    labels.add(label)
                    score = max(score, share)
        at = [s for s, _ in of_base]
        out.append((i, len(d), len(at), min(at, default=None), max(at, default=None),
                    ",".join(sorted({label for _, label in of_base})), ",".join(sorted(labels)), score))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


def mixture(r):
    notices = [t for _, t, _ in licences.NOTICES] + list(licences.BASE)
    fill = ["the", "of", "licence", "work", "mit", "Ünder", "apache", "Haus", "version", "is", "nc", "cc", "by", "3", "und"]
    out = []
    for _ in range(r.randint(0, 5)):
        out += [r.choice(fill) for _ in range(r.randint(0, 15))]
        w = r.choice(notices).split()
        for _ in range(r.choice([0, 0, 1, 2, 6])):  # edits
            k = r.randrange(len(w))
            w[k:k + 1] = r.choice([[], [w[k], r.choice(fill)], [r.choice(fill)]])
        out += w
    return r.choice([" ", "\n", " - ", "  "]).join(out)


def test_matches_brute_force(spark):
    r = random.Random(4)
    rows = [(i, mixture(r)) for i in range(300)]
    rows += [(300, None), (301, ""), (302, "!!"), (303, "under the MIT license " * 3000), (304, "mit " * 5000), (5, rows[6][1]),
             (5, rows[5][1]), (None, rows[7][1]), (305, "x" * 50000 + " CC-BY-NC"), (306, "cc by nc by nc cc by"),
             (307, " ".join(t for _, t, _ in licences.NOTICES))]
    df = spark.createDataFrame([(*x, "a", 1) for x in rows], "doc_id long, text string, row string, w int")
    got = licences.labelled(*licences.scan(df.repartition(4)))
    want = brute(rows)
    assert ordered(map(tuple, got.collect())) == ordered(want)
    assert len({w[6] for w in want}) > 30 and any(0 < w[7] < 1 for w in want)


@pytest.mark.parametrize("text, labels", [
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
    ("this work is now licensed (again) under the GNU General Public License version 3 or so", "gpl-3"),
    ("Licensed under CC BY-SA 4.0.", "cc-by-sa"), ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
    ("the general public may license a version", ""), ("GNU tools, a public work under general license of version 3", "")])
def test_notices_need_their_phrases(spark, text, labels):
    df = spark.createDataFrame([(1, text), (2, "other words of the day")], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licences.labelled(*licences.scan(df)).collect()}
    assert got == {1: labels, 2: ""}


def test_own_phrases_and_empty_tables(spark):
    index = licences.Index({"house rules": "house"}, [("club", "members only house rules apply", ["members only"])])
    df = spark.createDataFrame([(1, "Members only: house rules apply!"), (2, "house rules")], "doc_id long, text string")
    got = licences.labelled(*licences.scan(df, index=index), base=index.base).collect()
    assert sorted((r.doc_id, r.base_labels, r.labels) for r in got) == [(1, "house", "club,house"), (2, "house", "house")]
    assert licences.labelled(*licences.scan(df.limit(0))).count() == 0


def test_native_plans(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plans = [x._jdf.queryExecution().executedPlan().toString() for x in (
        licences.licence_words(df, licences.Index()), licences.labelled(*licences.scan(df)))]
    assert not any(w in p for p in plans for w in ("Python", "InArrow", "InPandas", "CartesianProduct", "NestedLoop"))
