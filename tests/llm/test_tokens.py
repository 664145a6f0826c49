"""Operators 1, 8 and 9 against the tokenizer libraries."""

import hashlib
import json
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")

from rentscope.llm import chunk_bpe, pfor, pieces, token_transducer  # noqa: E402
from rentscope.session import scratch_path  # noqa: E402

BPE, SP = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
PARTS = ["a", "b", "don't", "'s", " ", "  ", "\n", "\n\n", "\t", "é", "Ê", "×", "1", "23", ".", ",", "!", "***",
         "<|endoftext|>", "<|", "|>", "<s>", "世界", "\xa0", " ", "\x1c", "🎉", "the ", "ing", "²", "▁", "<0x0A>"]


def mixtures(n, size, seed):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(1, size))) for _ in range(n)]


TEXTS = [None, "", "x", " ", *mixtures(300, 150, 3), "a" * 30000, " " * 9000, "é" * 9000, "one two, three. " * 2000]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(BPE)
    return [t.encode(x or "", add_special_tokens=False).ids for x in TEXTS]


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i if i % 40 else None, t, "k") for i, t in enumerate(TEXTS)] + [(7, TEXTS[7], "again")]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


def test_pieces_and_chunks_agree_with_the_library(library, monkeypatch):
    monkeypatch.setattr(chunk_bpe, "MEAN_CHUNK", 24)
    monkeypatch.setattr(pieces, "WINDOW", 1 << 12)
    data, offsets = pieces.text_bytes(pa.array(TEXTS, pa.string()))
    enc = chunk_bpe.ChunkEncoder(BPE)
    for e in (pieces.PieceEncoder(BPE, max_entries=50), enc):
        ids, at = e.encode(data, offsets)
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == library
    assert enc.repairs > 100  # joins were cut inside tokens and mended
    assert enc.encoded < enc.chunks  # and shared chunks were encoded once


def thue_morse(n):
    """Two words of n letters that collide under every polynomial hash modulo 2^64."""
    bits = np.zeros(1, np.uint8)
    while len(bits) < n:
        bits = np.concatenate([bits, 1 - bits])
    return bytes(bits + 97).decode(), bytes(98 - bits).decode()


def test_unlike_pieces_never_share_ids(monkeypatch):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(BPE)
    texts = [f" {a} {b}" for a, b in map(thue_morse, (1 << 10, 1 << 11, 1 << 12, 1 << 13))]
    data, offsets = pieces.text_bytes(pa.array([*texts, *TEXTS[4:60]], pa.string()))
    want = [t.encode(x, add_special_tokens=False).ids for x in [*texts, *TEXTS[4:60]]]
    for collide in (False, True):
        if collide:  # even where all hashes are alike
            monkeypatch.setattr(pieces, "quick_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
        for e in (pieces.PieceEncoder(BPE), chunk_bpe.ChunkEncoder(BPE)):
            ids, at = e.encode(data, offsets)
            assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want


def test_encoding_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(2, "b", "x", "y"), (1, "a", "z", None)], "doc_id long, text string, _near string, row string")
    out = chunk_bpe.encode_documents(df, BPE)
    assert out.columns == [*df.columns, "ids"]
    assert sorted((r.doc_id, r._near, r.row) for r in out.collect()) == [(1, "z", None), (2, "x", "y")]


def test_encode_and_decode_documents(spark, documents, library):
    rows = chunk_bpe.decode_documents(chunk_bpe.encode_documents(documents, BPE), BPE).collect()
    assert len(rows) == len(TEXTS) + 1
    assert sorted((r.text or "", np.frombuffer(r.ids, "<u4").tolist()) for r in rows) == sorted(
        (t or "", i) for t, i in [*zip(TEXTS, library), (TEXTS[7], library[7])])
    assert all(r.decoded == (r.text or "") for r in rows)
    empty = chunk_bpe.encode_documents(documents.limit(0), BPE)
    assert empty.count() == 0 and set(empty.columns) == {"doc_id", "text", "ids"}
    cut = spark.createDataFrame([(1, bytes(np.array([x], "<u4")[:1].tobytes())) for x in library[5][:1]] + [(2, None)],
                                "doc_id long, ids binary")
    assert chunk_bpe.decode_documents(cut, BPE).count() == 2


def test_token_files(spark, documents, library):
    path = scratch_path(spark, "t-pfor")
    pfor.write_token_files(documents, path, BPE)
    got = pfor.with_start(pfor.read_documents(spark, path)).collect()
    order = sorted([(i if i % 40 else None, t or "", x) for i, (t, x) in enumerate(zip(TEXTS, library))]
                   + [(7, TEXTS[7], library[7])], key=lambda r: (r[0] is not None, r[0] or 0))
    assert sum(r.n_tokens for r in got) == sum(len(x) + 1 for *_, x in order)
    start = {}
    at = 0
    for i, _, x in order:
        start.setdefault(i, at)
        at += len(x) + 1
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids[-1] == 0 and len(ids) == r.n_tokens
        if r.doc_id not in (None, 7):
            assert ids[:-1] == library[r.doc_id] and r.start == start[r.doc_id]
    begins = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(begins, begins[1:]))
    path = scratch_path(spark, "t-pfor")
    pfor.write_token_files(documents.limit(0), path, BPE)
    assert pfor.with_start(pfor.read_documents(spark, path)).count() == 0


def test_token_files_are_closed_in_time(spark, library, monkeypatch):
    monkeypatch.setattr(pfor, "FILE_SEGMENTS", 2)
    rows = [(i, t) for i, t in enumerate(TEXTS[:120])]
    path = scratch_path(spark, "t-pfor")
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")  # a segment each
    try:
        pfor.write_token_files(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), path, BPE)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    files = spark.read.format("binaryFile").load(path).select("content").collect()
    assert len(files) > 8 and all(len(list(pfor.segments(f.content))) <= 2 for f in files)
    got = {r.doc_id: r for r in pfor.with_start(pfor.read_documents(spark, path)).collect()}
    at = 0
    for i, _ in rows:
        assert got[i].start == at and np.frombuffer(got[i].ids, "<u4").tolist() == [*library[i], 0]
        at += got[i].n_tokens


@pytest.mark.parametrize("ids", [
    [], [5], [0] * 1000, list(range(1000)), [3] * 300 + [2**32 - 1] + [4] * 300,
    np.random.default_rng(1).integers(0, 2**32, 3000).tolist(),
    [int(x) if x < 900 else 60000 for x in np.random.default_rng(2).integers(0, 1000, 5000)]])
def test_blocks_round_trip(ids):
    ids = np.array(ids, np.uint32)
    data = pfor.write_segment([1], np.array([0]), np.array([len(ids)]), ids)
    s = pfor.Segment(b"?" * 3 + data, 3)
    assert s.ids().tolist() == ids.tolist() and s.size == len(data)
    for i in range(len(s.blocks)):
        assert s.read_block(i).tolist() == ids[i * pfor.BLOCK:(i + 1) * pfor.BLOCK].tolist()


def test_outliers_are_patched():
    ids = np.array([7] * 250 + [50000] * 6, np.uint32)
    table, packed, positions, values = pfor.pack(ids)
    assert table["width"][0] == 0 and len(positions) == 6 and not packed
    assert values.tolist() == [49993] * 6


def test_segment_of_other_bytes():
    with pytest.raises(ValueError):
        pfor.Segment(b"x" * 100, 0)


@pytest.fixture(scope="module")
def pieces_of():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=SP)


def test_transducer_counts(pieces_of, monkeypatch):
    machine = token_transducer.Transducer(SP)
    monkeypatch.setattr(token_transducer, "MAX_STATES", 500)  # states are dropped on the way
    texts = [t or "" for t in TEXTS if len(t or "") < 3000]
    for t, want in zip(texts, pieces_of.encode(texts)):
        for size in (1, 3, 17, 10**6):
            parts = [t[i:i + size] for i in range(0, len(t), size)] or [""]
            assert machine.total([machine.chunk_map(p) for p in parts]) == len(want), (t, size)


def test_state_maps_compose_in_any_grouping():
    machine = token_transducer.Transducer(SP)
    a, b, c = (machine.chunk_map(x) for x in ("one tw", "o three fo", "ur five"))
    assert machine.join(machine.join(a, b), c) == machine.join(a, machine.join(b, c))


def test_state_maps_of_texts_without_borders(pieces_of, monkeypatch):
    """Chunks without a space: maps hold a short head, other workers' states are
    understood, and what cannot be told from the heads is not."""
    monkeypatch.setattr(token_transducer, "SYNC_CHARS", 40)
    one, two = token_transducer.Transducer(SP), token_transducer.Transducer(SP)
    two.count("another text that this worker has met before" * 20)
    r = random.Random(4)
    told = 0
    for parts in (["the", "ing", "er", "ation", "con", "un", "able", "s", "e", "t"], ["ab", "ba", "a"], ["世", "界", "日", "本", "x"],
                  ["=", "-"], list("0123456789"), ["tion"]):
        for _ in range(6):
            text = "".join(r.choice(parts) for _ in range(400))
            size = r.choice([60, 150, 333])
            maps = [(one, two)[k % 2].chunk_map(text[i:i + size]) for k, i in enumerate(range(0, len(text), size))]
            assert all(len(m[0]) <= 40 for m in maps)
            maps = [(h, n, token_transducer._key(json.dumps(k)) if k else None, c) for h, n, k, c in maps]
            got = (one, two)[r.random() < .5].total(maps)
            assert got in (None, len(pieces_of.encode(text))), (text, size)
            told += got is not None
    assert told >= 24
    assert one.border("日本", 1) == 1 and one.border("the", 1) == -1


def test_long_texts_without_spaces(spark, pieces_of, monkeypatch):
    monkeypatch.setattr(token_transducer, "CHUNK_CHARS", 500)
    monkeypatch.setattr(token_transducer, "SYNC_CHARS", 60)
    r = random.Random(5)
    texts = ["".join(r.choice(["the", "ing", "er", "con", "able", "s"]) for _ in range(3000)), "a" * 7001, "=" * 5000 + "x", "世界" * 3000,
             "ab" * 2500, "no border" + "a" * 1200 + " and one"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[1]), (1, texts[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = token_transducer.count_tokens(df, SP).collect()
    assert sorted((r.n_bytes, r.n_tokens) for r in got) == sorted((len(t.encode()), len(pieces_of.encode(t))) for _, t in rows)
    assert sum(r.doc_id is None for r in got) == 1


def test_transducer_refuses_other_models():
    with pytest.raises(Exception):
        token_transducer.Transducer(BPE)


def test_count_tokens(spark, documents, pieces_of, monkeypatch):
    monkeypatch.setattr(token_transducer, "CHUNK_CHARS", 50)
    got = token_transducer.count_tokens(documents, SP).collect()
    assert sorted((r.n_bytes, r.n_tokens) for r in got) == sorted(
        (len((t or "").encode()), len(pieces_of.encode(t or ""))) for t in [*TEXTS, TEXTS[7]])
    assert token_transducer.count_tokens(documents.limit(0), SP).count() == 0


def test_queries(spark, tmp_path, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in chunk_bpe.query(spark, str(tmp_path), BPE).collect()}
    for i, x in enumerate(library):
        raw = np.array(x, "<u4").tobytes()
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(x), hashlib.sha256(raw).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256((TEXTS[i] or "").encode()).hexdigest()
    at = 0
    got = {r.doc_id: r for r in pfor.query(spark, str(tmp_path), BPE).collect()}
    for i, x in enumerate(library):
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (
            at, len(x) + 1, zlib.crc32(np.array([*x, 0], "<u4").tobytes()))
        at += len(x) + 1
    counts = token_transducer.query(spark, str(tmp_path), SP)
    assert counts.filter(F.col("over_limit") != (F.col("n_tokens") > 4096)).count() == 0
