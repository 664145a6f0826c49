"""Operator 11 against the two libraries and plain counting."""

import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")

from rentscope.llm import cross_tokens, pieces  # noqa: E402

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
PARTS = ["a", "don't", " ", "  ", "\n", "\n\n", "\t", "é", "×", "1", "23", ".", ",", "***", "<|endoftext|>", "<s>",
         "世界", "\xa0", " ", "🎉", "the ", " ing", "²", "ünge", " lichkeit", "<0x0A>", "ﬁ", "é", "\x00"]


def texts(n=250, size=60, seed=8):
    r = random.Random(seed)
    out = ["".join(r.choice(PARTS) for _ in range(r.randint(1, size))) for _ in range(n)]
    return [None, "", " ", "▁", "a ▁ b", *out, out[0], "a" * 3000, " " * 900, "日本" * 700, "x▁y" + out[1], "one two, three. " * 500]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    s = sentencepiece.SentencePieceProcessor(model_file=B)
    back = {c: b for b, c in pieces.byte_alphabet().items()}
    names = {i: bytes(back[c] for c in x) for x, i in t.get_vocab(with_added_tokens=False).items()}

    def both(text):
        a = t.encode(" " + text, add_special_tokens=False).ids
        b = s.encode(text)
        of_b = [bytes([int(x[3:5], 16)]) if s.is_byte(i) else x.replace("▁", " ").encode()
                for i, x in zip(b, map(s.id_to_piece, b))]
        return list(zip(a, (names[i] for i in a))), list(zip(b, of_b))
    return both


def groups(a, b):
    """[(A ids, B ids)]: cut where tokens of both end."""
    out, ends = [], []
    for side in (a, b):
        at, places = 0, []
        for _, x in side:
            at += len(x)
            places.append(at)
        ends.append(places)
    i = j = 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        i2, j2 = ends[0].index(cut, i) + 1, ends[1].index(cut, j) + 1
        out.append(([x for x, _ in a[i:i2]], [x for x, _ in b[j:j2]]))
        i, j = i2, j2
    return out


def brute(rows, both):
    docs = []
    for i, text in rows:
        a, b = both(text) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if not text or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            a, b = [], []
        g = groups(a, b)
        links = Counter()
        for x, y in g:
            cx, cy = Counter(x), Counter(y)
            for p in cx:
                for q in cy:
                    links[p, q] += cx[p] * cy[q]
        docs.append((i, len(a), len(b), g, links))
    count = Counter(p for d in docs for p in d[4])
    top = Counter()
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    out = []
    for i, na, nb, g, links in docs:
        s = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((i, na, nb, len(g), sum(links.values()), sum(n for p, n in links.items() if count[p] == top[p[0]]),
                    sum(n * count[p] for p, n in links.items()), hashlib.sha256(s.encode()).hexdigest() if s else "", s))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("join", ["broadcast", "shuffle"])
def test_counts_match_brute_force(spark, libraries, monkeypatch, join):
    if join == "shuffle":
        monkeypatch.setattr(cross_tokens, "BROADCAST_PAIRS", 0)
        monkeypatch.setattr(cross_tokens, "LARGE_GROUP", 3)
    rows = [(i, t) for i, t in enumerate(texts())] + [(7, texts()[7]), (None, texts()[8]), (9, "other")]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "doc_id long, text string, n_a int, row string, n string")
    got = cross_tokens.cross_counts(df.repartition(5), A, B)
    want = brute(rows, libraries)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert order(tuple(r) for r in got.select(names).collect()) == order(w[:-1] for w in want)
    assert any(w[1] == 0 and r[1] for w, r in zip(want, rows))  # a text that B changes has no tokens


def test_groups_of_a_batch(spark, libraries):
    rows = list(enumerate(texts(60, 30, 2)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.groups for r in cross_tokens.aligned(df, A, B, with_groups=True).collect()}
    assert got == {w[0]: w[-1] for w in brute(rows, libraries)}
    data, offsets = pieces.text_bytes(pa.array([t for _, t in rows], pa.string()))
    found = cross_tokens.Alignment(cross_tokens.encoders(A, B), data, offsets)
    assert [s.decode() for s in found.strings()] == [got[i] for i, _ in rows]


def test_the_fast_path_carries_most_links(spark):
    df = spark.createDataFrame([(1, "The house and the garden, and the river.")], "doc_id long, text string")
    row = cross_tokens.aligned(df, A, B).first()
    assert sum(row.same_n) >= 0.8 * row.n_links and row.n_links == sum(row.same_n) + sum(row.pair_n)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert cross_tokens.cross_counts(df, A, B).count() == 0
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [tuple(r)[1:] for r in cross_tokens.cross_counts(df, A, B).collect()] == [(0, 0, 0, 0, "", 0, 0)] * 2
