"""Operators 3 and 6 by round trips, and the pipeline by its effects."""

import hashlib
import io
import json
import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from rentscope.llm import chat_prefix as chat
from rentscope.llm import zip_warc as warc
from rentscope.session import scratch_path


def test_rendering_is_reversible():
    r = random.Random(1)
    parts = ["\\", "<", "[", "</s>", "[INST]", " [/INST]", "<s>", "<<", "<</", ">>", "\n", " ", "a", "é", ""]
    for _ in range(5000):
        role = r.choice(["user", "assistant", "system", "to>>ol", "<<\\", "", ">"])
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 9)))
        turn, a, b = chat.rendered(role, text)
        assert chat.parsed(turn) == (role, text) and chat.unescaped(turn[a:b]) == text
    with pytest.raises(ValueError):
        chat.parsed("plain text")


def test_prefix_targets(spark):
    rows = [(1, 1, "assistant", "A1"), (1, 0, "user", "U0 </s>"), (1, 2, "user", "U2"), (1, 3, "assistant", "A3"), (1, 4, "user", "U4"),
            (2, 0, "system", "S"), (3, 0, "assistant", None), (None, 0, "user", "n"), (None, 1, "assistant", "m"),
            (4, 0, None, "x"), (5, 0, "user", "same"), (5, 0, "user", "same"), (5, 0, "assistant", "r")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, start int")
    turns, found = chat.formatted(df, scratch_path(spark, "t-chat"))
    assert turns.count() == len(rows)
    assert {(r.conv_id, r.example, r.context_turns) for r in found.collect()} == {
        (1, 0, 1), (1, 1, 3), (3, 0, 0), (None, 0, 1), (5, 0, 0)}
    got = {(r.conv_id, r.example): r for r in chat.expanded(turns, found).collect()}
    assert set(got) == {(1, 0), (1, 1), (3, 0), (None, 0), (5, 0)}
    whole = "".join(chat.rendered(role, text)[0] for role, text in [("user", "U0 </s>"), ("assistant", "A1"), ("user", "U2"), ("assistant", "A3")])
    assert got[(1, 1)].text == whole and got[(1, 0)].text == whole[:len(got[(1, 0)].text)]
    for (_, _), r in got.items():
        assert r.text[r.loss_end:] == chat.END  # nothing follows the reply
    assert [got[(1, k)].text[got[(1, k)].loss_start:got[(1, k)].loss_end] for k in (0, 1)] == ["A1", "A3"]
    d = {r.conv_id: r for r in chat.digests(turns, found).collect()}
    assert d[1].n_turns == 5 and d[1].loss_chars == 4 and d[2].n_examples == 0 and d[5].n_turns == 3
    assert d[1].turns_sha256 == hashlib.sha256(b"user\nU0 </s>\nassistant\nA1\nuser\nU2\nassistant\nA3\nuser\nU4\n").hexdigest()
    assert d[1].expanded_chars == sum(len(r.text) for (c, _), r in got.items() if c == 1)
    assert d[4].turns_sha256 == hashlib.sha256(b"\nx\n").hexdigest()
    assert chat.digests(*chat.formatted(df.limit(0), scratch_path(spark, "t-chat"))).count() == 0


def brute_examples(rows):
    """(conversation, example) -> text and trainable part, one after another."""
    out, convs = {}, {}
    for c, _, role, text in sorted(rows, key=lambda r: (r[0], r[1], r[2] or "", r[3] or "")):
        done, n = convs.get(c, ("", 0))
        turn, a, b = chat.rendered(role or "", text or "")
        if role == "assistant":
            out[c, n] = done + turn, len(done) + a, len(done) + b
        convs[c] = done + turn, n + (role == "assistant")
    return out


def test_a_long_conversation_is_spread_over_tasks(spark):
    r = random.Random(3)
    rows = [(c, t, r.choice(["user", "assistant", "tool"]), "x<[" * r.randrange(5)) for c in [7] * 6 + list(range(7)) + [9]
            for t in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    path = scratch_path(spark, "t-chat")
    with_parts = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns, found = chat.formatted(df, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", with_parts)
    assert spark.read.parquet(f"{path}/turns").filter("conv_id = 7").select("part").distinct().count() > 1
    got = {(x.conv_id, x.example): (x.text, x.loss_start, x.loss_end) for x in chat.expanded(turns, found).collect()}
    assert got == brute_examples(rows)
    assert [x.at for x in turns.filter("conv_id = 7").orderBy("at").collect()] == list(range(240))


def test_examples_that_lost_their_turn_are_refused(spark):
    df = spark.createDataFrame([(1, 0, "user", "u"), (1, 1, "assistant", "a")], "conv_id long, turn long, role string, text string")
    turns, found = chat.formatted(df, scratch_path(spark, "t-chat"))
    with pytest.raises(Exception, match="does not end at its turn"):
        chat.digests(turns, found.withColumn("end", F.col("end") + 1)).collect()


def test_written_examples_hold_their_whole_context(spark):
    say = [("user", "é" * 5000), ("assistant", "<[" * 6000), ("system", "s"), ("user", "x\n" * 9000), ("assistant", "ok"),
           ("assistant", ""), ("user", "left")]
    rows = [(c, n, role, text) for c in (1, None) for n, (role, text) in enumerate(say)]
    path = scratch_path(spark, "t-chat")
    turns, found = chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), path)
    got = {}
    for x in spark.read.parquet(f"{path}/examples").orderBy("piece").collect():
        assert 0 < len(x.text) <= chat.PIECE
        text, *_ = got.get((x.conv_id, x.example), ("",))
        got[x.conv_id, x.example] = text + x.text, x.loss_start, x.loss_end
    assert got == {(c, k): x for c in (1, None) for (_, k), x in brute_examples(rows[:len(say)]).items()} and len(got) == 6
    assert {(x.conv_id, x.example): (x.text, x.loss_start, x.loss_end) for x in chat.expanded(turns, found).collect()} == got
    d = {x.conv_id: x for x in chat.digests(turns, found).collect()}
    said = "".join(text for role, text in say if role == "assistant")
    assert all(d[c].loss_sha256 == hashlib.sha256(said.encode()).hexdigest() and d[c].loss_chars == len(said)
               and d[c].n_examples == 3 and d[c].expanded_chars == sum(len(got[c, k][0]) for k in range(3)) for c in (1, None))
    # a changed context and a lost piece are found on reading
    changed = F.when(F.col("example") == 2, F.expr("concat('x', substr(text, 2))")).otherwise(F.col("text"))
    for broken in (found.withColumn("text", changed), found.filter("NOT (example = 1 AND piece = 1)")):
        with pytest.raises(Exception, match="differs from its turns"):
            chat.digests(turns, broken).collect()


def test_long_conversation_is_stored_once(spark):
    df = spark.range(4000).selectExpr("1L conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') role", "repeat('x', 50) text")
    r = chat.digests(*chat.formatted(df, scratch_path(spark, "t-chat"))).first()
    assert r.n_examples == 2000 and r.formatted_chars < 4000 * 70 < r.expanded_chars


def reader(data):
    return warc.Package(lambda at, n: data[at:at + n], len(data))


@pytest.mark.parametrize("zip64", [False, True])
def test_package_is_a_zip(zip64):
    w = warc.PackageWriter(gap=1, zip64=zip64)
    record = warc.gzip.compress(warc.warc_record(1, "http://a/\r\nb", b"pay\r\n\r\nload", "d", "response", None))
    index = json.dumps({"filename": "archive/é.warc.gz", "offset": 0, "length": len(record)}).encode()
    data = b"\n".join([w.member("archive/é.warc.gz", record), w.member("indexes/i.cdxj", b"1 " + index), w.member("empty", b""),
                       w.close()]) + b"\n"
    z = zipfile.ZipFile(io.BytesIO(data))
    assert z.testzip() is None and z.read("archive/é.warc.gz") == record and z.comment == b"\n"
    p = reader(data)
    assert set(p.members) == set(z.namelist()) and p.range("archive/é.warc.gz", 3, 4) == record[3:7]
    [(fields, payload)] = p.records()
    assert payload == b"pay\r\n\r\nload" and fields["warc-target-uri"] == "http://a/%0D%0Ab"
    with pytest.raises(ValueError):
        p.range("empty", 0, 1)


def test_reading_packages_of_others():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("archive/a.warc.gz", b"0123456789")
        z.writestr("pages/p", b"x" * 100, zipfile.ZIP_DEFLATED)
        with z.open(zipfile.ZipInfo("archive/large"), "w", force_zip64=True) as f:
            f.write(b"abc")
        z.comment = b"PK\5\6 in the comment"
    p = reader(out.getvalue())
    assert p.range("archive/a.warc.gz", 2, 3) == b"234" and p.range("archive/large") == b"abc"
    with pytest.raises(ValueError):
        p.range("pages/p")
    for broken in (b"", b"no zip" * 10):
        with pytest.raises(ValueError):
            reader(broken)


def test_members_without_an_index_are_refused():
    w = warc.PackageWriter()
    data = b"\n".join([w.member("archive/a.warc.gz", b"0123"), w.member("indexes/i.cdxj", b""), w.close()]) + b"\n"
    with pytest.raises(ValueError, match="archive/a.warc.gz"):
        list(reader(data).records())


def test_pages_round_trip(spark):
    rows = ([(i, f"u{i}" if i % 3 else None, None if i % 5 == 0 else "é" * (i % 7 * 40)) for i in range(100)]
            + [(3, "u", "y" * 200), (3, "v", "y" * 200), (8, "w", "y" * 200), (None, "u", "z" * 300), (None, "u", "z" * 300),
               (None, "u", "y" * 200), (200, "x", "L" * 3_000_000)])
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload_bytes int")
    path = scratch_path(spark, "t-warc")
    warc.write_packages(warc.decided(df), path)
    got = warc.read_packages(spark, path).collect()
    first = {}
    for i, _, h in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        first.setdefault((h or ""), i)
    want = []
    for i, u, h in rows:
        raw = (h or "").encode()
        of = first.get(h or "") if len(raw) >= 100 else None
        again = of is not None and of != i
        want.append((i, u or "", len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response",
                     of if again else None, None if again else (h or "")))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)
    path = scratch_path(spark, "t-warc")
    warc.write_packages(warc.decided(df.limit(0)), path)
    assert warc.read_packages(spark, path).count() == 0


def test_pipeline_effects(spark, tmp_path):
    import corpus_pipeline
    r = random.Random(4)

    def prose(n):
        return " ".join(f"w{r.randrange(5000)}" for _ in range(n))
    item, base = prose(30), prose(120)
    rows = [(i, prose(80)) for i in range(30)]
    rows += [(100, base), (101, base), (102, base.replace("w1", "w1", 1) + " more"),   # copies
             (110, prose(40) + " " + item + " " + prose(40)),                          # a leak
             (120, prose(50) + " mail a.b@c.de " + prose(20)),                         # personal data
             (130, "too short"), (131, "one two three four five " * 40), (132, None)]  # rejected
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "e") for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, ids string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        out = scratch_path(spark, "t-stage")
        stage(spark, now, str(tmp_path)).write.parquet(out)
        now = spark.read.parquet(out)
        seen[name] = {x.doc_id for x in now.collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert now.columns == docs.columns
            if name == "PII":
                text = {x.doc_id: x for x in now.collect()}
    everything = {i for i, _ in rows}
    assert seen["quality rules"] == everything - {130, 131, 132}
    assert seen["MinHash near-dedup"] == seen["quality rules"] - {101, 102}
    assert seen["benchmark decontamination"] == seen["MinHash near-dedup"] - {110}
    assert "[EMAIL]" in text[120].text and text[120].n_chars == len(text[120].text)
    assert all(text[i].text == t for i, t in rows if i < 100)
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert {x.doc_id for x in whole.collect()} == seen["BPE encoding"] == seen["PII"]


def test_ranges_of_a_package_beyond_32_bits(spark):
    """A sparse package with a member after 5 GB: only ranges can read it."""
    path = scratch_path(spark, "t-sparse").removeprefix("file:")
    os.makedirs(path)
    w, payloads = warc.PackageWriter(gap=1), {1: b"first payload", 2: b"second payload"}
    records = {k: warc.gzip.compress(warc.warc_record(k, "u", p, hashlib.sha256(p).hexdigest(), "response", None))
               for k, p in payloads.items()}
    with open(f"{path}/part-0.zip", "wb") as fh:
        fh.write(w.member("archive/a.warc.gz", records[1]) + b"\n")
        w.at = 5 << 30
        fh.seek(w.at)
        fh.write(w.member("archive/b.warc.gz", records[2]) + b"\n")
        index = [json.dumps({"filename": f"archive/{n}.warc.gz", "offset": 0, "length": len(records[k])}) for k, n in ((1, "a"), (2, "b"))]
        fh.write(w.member("indexes/i.cdxj", "\n".join(f"x {i}" for i in index).encode()) + b"\n" + w.close() + b"\n")
    assert os.path.getsize(f"{path}/part-0.zip") > 5 << 30
    got = warc.read_packages(spark, path).collect()
    assert sorted((r.page_id, r.html) for r in got) == [(1, "first payload"), (2, "second payload")]


def test_packages_are_closed_in_time(spark, monkeypatch):
    monkeypatch.setattr(warc, "MEMBER_BYTES", 2000)
    monkeypatch.setattr(warc, "MEMBERS", 3)
    monkeypatch.setattr(warc, "RANGE_BYTES", 900)
    rows = [(i, f"u{i}", "".join(random.Random(i).choices("abcdefgh", k=900))) for i in range(120)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = scratch_path(spark, "t-closed")
    warc.write_packages(warc.decided(df).coalesce(1), path)
    files = spark.read.format("binaryFile").load(path).collect()
    assert len(files) > 5
    for f in files:
        names = zipfile.ZipFile(io.BytesIO(f.content)).namelist()
        assert names[-1] == "indexes/index.cdxj" and 1 <= len(names) - 1 <= 3
    assert sorted((r.page_id, r.html) for r in warc.read_packages(spark, path).collect()) == [(i, h) for i, _, h in rows]
    monkeypatch.setattr(warc.Ranges, "can", classmethod(lambda *_: False))  # a store that only Spark opens
    assert warc.read_packages(spark, path).count() == 120
    spread = warc.ranges(spark.read.format("binaryFile").load(path).select("path", "length")).collect()
    assert len(spread) > len(files) and sum(len(r.sizes) for r in spread) == 120
