"""Chat formatting with prefix-target expansion (operator 3).

Turns are rendered as

    user       <s>[INST] text [/INST]
    assistant  <s>text</s>
    others     <s><<role>>text<</role>>

and one after another make the conversation's text.  Every control string
begins with ``<`` or ``[``; in texts and roles these and the backslash get a
backslash in front, so no control string can come from a text and the text is
read back exactly.

Every assistant turn is exploded into an example of its own: all turns before
it are its context and only its reply is trainable.  ``examples`` finds them: a
row per assistant turn with the number of turns and characters of its context
and the reply's place (``loss_start`` to ``loss_end``; the example ends at
``end``).  ``pieces`` writes every example out in full, context and reply, in
rows of at most PIECE characters, and these rows are what is written and read
back.  Written text grows with the square of a conversation's length; as each
piece of a conversation stands next to its copies in the later examples, and
Parquet's delta encoding stores what a value adds to the one before it, the
files grow with the conversation.  Pieces also bound what a reader holds at once
and spread a long conversation over tasks.  ``expanded`` joins them to a row per
example, as a training job takes them; ``digests`` checks every piece against
the stored turns and takes what is trained on from the examples.

Turns are rendered in ranges of (conversation, turn), so a long conversation is
spread over tasks; each range counts its own places, and what stands before it
in the same conversation is added on reading (a row per range at most).  Only
what needs a whole conversation in order, its text and hash, is one sequence,
which one task reads as a sorted stream, so memory does not grow with it.

Defined results: null text or role is empty; turns of equal number are ordered
by role and text; repeated rows are repeated turns; a null conversation id is
a conversation; one without assistant turn has no example; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rentscope.llm.tables import table
from rentscope.session import scratch_path

# fixed values of the template
BEGIN, END, USER_OPEN, USER_CLOSE = "<s>", "</s>", "[INST] ", " [/INST]"
_RAW, _NAME = r"(?:[^\\<\[]|\\.)*", r"(?:[^\\<\[>]|\\.)*"
_TURN = re.compile(rf"<s>(?:\[INST\]\x20(?P<user>{_RAW})\[/INST\]|<<(?P<role>{_NAME})>>(?P<other>{_RAW})<</"
                   rf"|(?P<assistant>{_RAW})</s>)", re.S)
# places and numbers count from the range's first turn of the conversation
RENDERED = ("part long, conv_id long, at long, rendered string, start long, end long, example long, "
            "loss_start long, loss_end long")


def escaped(text: str) -> str:
    return re.sub(r"[\\<\[]", r"\\\g<0>", text)


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def rendered(role: str, text: str) -> tuple[str, int, int]:
    """The turn, and where its escaped text stands in it."""
    body = escaped(text)
    if role == "user":
        before, after = BEGIN + USER_OPEN, USER_CLOSE
    elif role == "assistant":
        before, after = BEGIN, END
    else:
        # ">" ends the role's mark, so it is spelled apart
        name = escaped(role).replace(">", "\\>")
        before, after = f"{BEGIN}<<{name}>>", f"<</{name}>>"
    return before + body + after, len(before), len(before) + len(body)


def parsed(turn: str) -> tuple[str, str]:
    """Role and text of a rendered turn."""
    m = _TURN.match(turn)
    if m is None:
        raise ValueError("not a rendered turn")
    if m["user"] is not None:
        return "user", unescaped(m["user"][:-1])
    if m["assistant"] is not None:
        return "assistant", unescaped(m["assistant"])
    return unescaped(m["role"]), unescaped(m["other"])


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1000, chars: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += sum(len(x) for x in row if isinstance(x, str))
        if len(held) >= size or weight >= chars:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _arrow(fields: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in fields.split(", "))])


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            yield from zip(*(c.to_pylist() for c in batch.slice(i, 256).columns))


def write_turns(conversations: DataFrame, path: str) -> None:
    """Render all turns, in ranges, and write them."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        def rows():
            conv, at, place, example = object(), 0, 0, 0
            for part, c, role, text in _rows(batches):
                if c != conv:
                    conv, at, place, example = c, 0, 0, 0
                turn, a, b = rendered(role, text)
                target = role == "assistant"
                yield (part, c, at, turn, place, place + len(turn),
                       *((example, place + a, place + b) if target else (None,) * 3))
                at, place, example = at + 1, place + len(turn), example + target
        yield from _batches(rows(), _arrow(RENDERED))
    plain = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
                                 F.coalesce("text", F.lit("")).alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    (plain.repartitionByRange(*map(F.col, order)).sortWithinPartitions(*order)
     .select(F.spark_partition_id().cast("long").alias("part"), "conv_id", "role", "text")
     .mapInArrow(run, RENDERED).write.parquet(path))


def read_turns(spark: SparkSession, path: str) -> DataFrame:
    """(conv_id, at, rendered, start, end, example, loss_start, loss_end): the
    stored turns with their places in the whole conversation."""
    rows = spark.read.parquet(path)
    sums = rows.groupBy("conv_id", "part").agg(F.count("*").alias("turns"), F.max("end").alias("chars"),
                                               F.count("example").alias("examples"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a range goes on with one conversation at most, so there are no more rows than ranges
    ahead = sums.select(F.struct("conv_id", "part").alias("of"), *(F.sum(c).over(before).alias(c) for c in (
        "turns", "chars", "examples"))).filter("turns IS NOT NULL")
    rows = rows.withColumn("own", F.struct("conv_id", "part")).join(
        F.broadcast(ahead), F.col("own").eqNullSafe(F.col("of")), "left")
    add = {"at": "turns", "start": "chars", "end": "chars", "example": "examples", "loss_start": "chars", "loss_end": "chars"}
    return rows.select("conv_id", "rendered", *((F.col(c) + F.coalesce(n, F.lit(0))).alias(c) for c, n in add.items()))


def examples(turns: DataFrame) -> DataFrame:
    """The place of every assistant turn's example: (conv_id, example, context_turns,
    context_end, loss_start, loss_end, end)."""
    return turns.filter("example IS NOT NULL").select(
        "conv_id", "example", F.col("at").alias("context_turns"), F.col("start").alias("context_end"), "loss_start", "loss_end", "end")


PIECE = 8192
PIECES = ("conv_id long, example long, context_turns long, context_end long, loss_start long, loss_end long, end long, "
          "piece long, text string")
# the files keep what a text adds to the row before it
DELTA = {"parquet.writer.version": "v2", "parquet.enable.dictionary": "false", "compression": "zstd"}


def pieces(turns: DataFrame, found: DataFrame) -> DataFrame:
    """Every example in full: its text in rows of PIECE characters (the last
    may be shorter), numbered by ``piece``."""
    def numbers(start: str, end: str):
        return F.explode(F.expr(f"sequence({start} div {PIECE}, ({end} - 1) div {PIECE})")).alias("piece")

    def none(kind: str):
        return F.lit(None).cast(kind)
    chunk = F.when(F.col("end") - F.col("start") > PIECE, F.regexp_extract_all("rendered", F.lit(f"(?s).{{1,{PIECE}}}"), 0))
    cut = (turns.select("conv_id", "start", F.posexplode(chunk.otherwise(F.array("rendered"))).alias("nth", "chunk"))
           .select("conv_id", (F.col("start") + F.col("nth") * PIECE).alias("start"), "chunk")
           .withColumn("end", F.col("start") + F.char_length("chunk")))
    cut = (cut.select("*", numbers("start", "end"))
           .withColumn("from", F.greatest("start", F.col("piece") * PIECE))
           .withColumn("size", F.least("end", (F.col("piece") + 1) * PIECE) - F.col("from"))
           .withColumn("part", F.substring("chunk", (F.col("from") - F.col("start") + 1).cast("int"), F.col("size").cast("int"))))
    places = [f.split()[0] for f in PIECES.split(", ")[1:-2]]
    both = cut.select("conv_id", "piece", "from", "part", *(none("long").alias(c) for c in places)).unionByName(
        found.select("conv_id", numbers("0", "end"), none("long").alias("from"), none("string").alias("part"), *places))

    def run(batches) -> Iterator[pa.RecordBatch]:
        def rows():
            key, parts = None, []
            for c, piece, _, part, example, *place in _rows(batches):
                if (c, piece) != key:
                    key, parts = (c, piece), []
                if example is None:
                    parts.append(part)
                else:
                    parts = ["".join(parts)]
                    yield c, example, *place, piece, parts[0][:place[-1] - piece * PIECE]
        yield from _batches(rows(), _arrow(PIECES))
    return (both.repartition("conv_id", "piece").sortWithinPartitions("conv_id", "piece", F.asc_nulls_first("example"), "from")
            .mapInArrow(run, PIECES))


def expanded(turns: DataFrame, found: DataFrame) -> DataFrame:
    """One row per example with its whole text and the trainable part: the
    written pieces ``found``, joined."""
    return (found.groupBy("conv_id", "example", "loss_start", "loss_end")
            .agg(F.sort_array(F.collect_list(F.struct("piece", "text"))).alias("pieces"))
            .select("conv_id", "example", F.array_join("pieces.text", "").alias("text"), "loss_start", "loss_end"))


STREAM = "conv_id long, at long, rendered string, example long, piece long, chars long, crc long, loss string, end long"


def in_order(turns: DataFrame, found: DataFrame) -> DataFrame:
    """Turns in order, the pieces of each example right after its last turn:
    their length, checksum and trainable part."""
    def none(kind: str):
        return F.lit(None).cast(kind)
    begin, chars = F.col("piece") * PIECE, F.char_length("text").cast("long")
    a = F.greatest(F.col("loss_start") - begin, F.lit(0))
    b = F.least(F.col("loss_end") - begin, chars)
    loss = F.when(b > a, F.substring("text", (a + 1).cast("int"), (b - a).cast("int"))).otherwise("")
    read = found.select("conv_id", F.col("context_turns").alias("at"), none("string").alias("rendered"), "example", "piece",
                        chars.alias("chars"), F.crc32("text").alias("crc"), loss.alias("loss"), "end")
    kinds = dict(f.split() for f in STREAM.split(", "))
    both = turns.select("conv_id", "at", "rendered", *(none(kinds[c]).alias(c) for c in read.columns[3:])).unionByName(read)
    return (both.repartition("conv_id").sortWithinPartitions("conv_id", "at", F.asc_nulls_first("example"), "piece")
            .select(*kinds))


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, n_examples long, expanded_chars long")


class _Conversation:
    """What is known of a conversation, turn by turn and example by example."""

    def __init__(self, conv):
        self.conv, self.turns, self.chars, self.at = conv, 0, 0, None
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()
        self.loss_chars = self.examples = self.expanded = 0
        self.crcs, self.example = [0], None  # of the pieces so far, the last still growing

    def turn(self, at: int, turn: str) -> None:
        self.close()
        role, text = parsed(turn)
        self.said.update(f"{role}\n{text}\n".encode())
        i = 0
        while i < len(turn):
            part = turn[i:i + PIECE - self.chars % PIECE]
            if self.chars % PIECE == 0 and self.chars:
                self.crcs.append(0)
            self.crcs[-1] = zlib.crc32(part.encode(), self.crcs[-1])
            i, self.chars = i + len(part), self.chars + len(part)
        self.at, self.turns = at, self.turns + 1

    def piece(self, at: int, example: int, piece: int, chars: int, crc: int, loss: str, end: int) -> None:
        if example != self.example:
            self.close()
            self.example, self.read, self.parts, self.end = example, 0, [], end
            self.examples += 1
        if at != self.at or piece * PIECE != self.read or piece >= len(self.crcs) or crc != self.crcs[piece]:
            raise ValueError(f"example {example} of conversation {self.conv} differs from its turns")
        self.read += chars
        self.parts.append(loss)

    def close(self) -> None:
        if self.example is None:
            return
        if self.read != self.end or self.end != self.chars:
            raise ValueError(f"example {self.example} of conversation {self.conv} does not end at its turn")
        loss = unescaped("".join(self.parts))
        self.loss.update(loss.encode())
        self.loss_chars, self.expanded, self.example = self.loss_chars + len(loss), self.expanded + self.read, None

    def row(self) -> tuple:
        self.close()
        return (self.conv, self.turns, self.said.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
                self.examples, self.expanded)


def digests(turns: DataFrame, found: DataFrame) -> DataFrame:
    """Per conversation: what the stored turns say, what is under the written
    examples' loss masks, and the characters stored and written out."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        def convs():
            conv = None
            for c, at, turn, example, *piece in _rows(batches):
                if conv is None or c != conv.conv:
                    if conv is not None:
                        yield conv.row()
                    conv = _Conversation(c)
                if example is None:
                    conv.turn(at, turn)
                else:
                    conv.piece(at, example, *piece)
            if conv is not None:
                yield conv.row()
        yield from _batches(convs(), _arrow(DIGESTS))
    return in_order(turns, found).mapInArrow(run, DIGESTS)


def formatted(conversations: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Write turns and examples, in full, below ``path`` and read both back."""
    spark = conversations.sparkSession
    write_turns(conversations, f"{path}/turns")
    turns = read_turns(spark, f"{path}/turns")
    pieces(turns, examples(turns)).write.options(**DELTA).parquet(f"{path}/examples")
    return turns, spark.read.parquet(f"{path}/examples")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    spoken = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", spoken), (-1, 1, "assistant", spoken)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return digests(*formatted(rows, scratch_path(spark, "chat")))


def oracle() -> str:
    """The query in DuckDB's SQL, from the conversations alone: lengths of the
    rendered turns are computed, nothing is rendered."""
    def sized(column: str, signs: str) -> str:
        return f"(length({column}) + length(regexp_replace({column}, '[^{signs}]', '', 'g')))"
    body, name = sized("text", r"\\<\["), sized("role", r"\\<\[>")
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS x(t, r)),
t AS (SELECT *, {body} + CASE role WHEN 'user' THEN {len(BEGIN + USER_OPEN + USER_CLOSE)} WHEN 'assistant' THEN {len(BEGIN + END)}
        ELSE {len(BEGIN + "<<" + ">>" + "<</" + ">>")} + 2 * {name} END AS size FROM c),
o AS (SELECT *, sum(size) OVER w AS done, row_number() OVER w AS nth FROM t
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(size)::BIGINT AS formatted_chars, (count(*) FILTER (WHERE role = 'assistant'))::BIGINT AS n_examples,
       coalesce(sum(done) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS expanded_chars
FROM o GROUP BY conv_id"""
