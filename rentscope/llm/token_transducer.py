"""Token counts from a compiled finite-state tokenizer (operator 9).

A BPE segmentation is fixed by its neighbouring pairs: ``t1 .. tn`` is the
segmentation of its text exactly if every ``ti ti+1`` is the segmentation of
its own two-token text.  So the last token of every prefix follows from the
last tokens of shorter prefixes, and a left-to-right machine needs to remember
only those prefixes from which a longer token may still come: the ends of the
text that begin some token, each with the last token before it.  Of that token only those
right-hand parts matter that could still have merged with what follows, and
between which scores they stood at its end; tokens alike in this share a state.
These are the states; a transition carries the change of the number of tokens.  States are
made when first reached and kept (all are dropped when there are
``MAX_STATES``, which changes no count).

Between two characters that stand side by side in no token, such as a letter and
the space after it, every segmentation has a border, and what follows is read
from the start state.  Long texts are cut into chunks, and every chunk has a state
map (head, count, exit state): whatever state a chunk is entered in, it runs over
the head up to the first border, and what follows has the same count and exit.
A chunk without a border has the count and exit of a run from the start state,
and its first SYNC_CHARS characters: from another entry state a second run goes
beside the first until both are in one state, from where on they agree, so the
difference of their counts is known.  Maps hold no more text than that; two are
composed by entering the second in the first's exit state, and the maps of a text
are combined by a balanced scan.  Where two runs do not meet within the head (a
long run of one character, whose phase is never forgotten), the text is counted
as one sequence in a further pass over such texts alone.

Defined results: null text is empty (0 bytes, 0 tokens, not over the limit);
repeated rows and equal ids each give a row; an empty table gives no rows;
other columns are not read.  Only models that keep their input as it is (no
normalization besides the space sign, a space put in front, byte fallback) are
taken; any other is refused with ValueError.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentscope.llm.tables import kept, table, text_or_empty

SPACE = "▁"
MAX_STATES = 200_000
CHUNK_CHARS = 1 << 16
SYNC_CHARS = 1 << 12
LIMIT = 4096
NEVER = float("-inf")
_PROBES = ("a", " a  b ", "A\t\né　 x", "ﬁ ① Å", "<s> </s> <0x0A>")


class State(dict):
    """Transitions met so far: character -> (next state, change of the count)."""

    __slots__ = ("machine", "context", "open")

    def __init__(self, machine: "Transducer", context: str, open_: tuple):
        super().__init__()
        self.machine, self.context, self.open = machine, context, open_

    def __missing__(self, ch: str):
        found = self[ch] = self.machine.step(self, ch)
        return found


class Transducer:
    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        if not all(model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or not model.is_unused(i)
                   for i in range(n)) or sum(map(model.is_byte, range(n))) != 256:
            raise ValueError("a model without unused pieces and with byte fallback is needed")
        for p in _PROBES:
            if model.normalize(p) != SPACE + p.replace(" ", SPACE):
                raise ValueError("the model changes its input")
        self.score = {model.id_to_piece(i): model.get_score(i) for i in range(n)
                      if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
        if any(SPACE in p.lstrip(SPACE) for p in self.score):
            raise ValueError("a piece goes over a word's end")
        self.neighbours = {p[k - 1:k + 1] for p in self.score for k in range(1, len(p))}
        self.begins = {p[:k] for p in self.score for k in range(1, len(p))}
        self.whole = lru_cache(maxsize=1 << 16)(lambda p: p in self.score and self.merged(p) == [p])
        self.right_end = lru_cache(maxsize=1 << 16)(self._right_end)
        self.alike: dict[tuple, str] = {}
        self.side_by_side = lru_cache(maxsize=1 << 16)(lambda a, b: self.merged(a + b) == [a, b])
        self.clear()

    def clear(self) -> None:
        self.states: dict[tuple, State] = {}
        self.alike.clear()
        self.start = self.state("", ((0, None, 0),))

    def state(self, context: str, open_: tuple) -> State:
        key = (context, open_)
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = State(self, context, open_)
        return found

    def merges(self, text: str) -> Iterator[tuple[list[str], float]]:
        """The parts before every merge, with its score: the best-scored
        neighbours first, the leftmost of equals.  At the end -inf."""
        parts = list(text)
        while True:
            scores = [self.score.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
            best = max(scores, default=NEVER)
            yield parts, best
            if best == NEVER:
                return
            k = scores.index(best)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]

    def merged(self, text: str) -> list[str]:
        for parts, _ in self.merges(text):
            pass
        return parts

    def _right_end(self, token: str) -> list[tuple[str, float, float]]:
        """Each part that stood at the token's right end: the lowest score
        merged before it came, and the lowest merged while it stood."""
        out, lowest = [], float("inf")
        for parts, score in self.merges(token):
            if out and out[-1][0] == parts[-1]:
                out[-1] = (*out[-1][:2], min(out[-1][2], score))
            else:
                out.append((parts[-1], lowest, score))
            lowest = min(lowest, score)
        return out

    def reduced(self, last: str | None, since: str) -> str | None:
        """A token that joins, or not, with what begins with ``since`` as
        ``last`` does; None if nothing can join."""
        if last is None:
            return None
        live = tuple(x for x in self.right_end(last) if x[0] + since in self.begins
                     or any(x[0] + since[:k] in self.score for k in range(1, len(since) + 1)))
        return self.alike.setdefault((since, live), last) if live else None

    def step(self, state: State, ch: str) -> tuple[State, int]:
        ch = SPACE if ch == " " else ch
        if ch not in self.score:  # one token for each byte, and nothing joins it
            return self.start, len(ch.encode())
        context = state.context + ch
        open_ = [(n + 1, last, count) for n, last, count in state.open]
        for n, last, count in open_:
            token = context[-n:]
            if self.whole(token) and (last is None or self.side_by_side(last, token)):
                break
        else:
            raise AssertionError("some token always ends here")
        change = count + 1
        left = tuple((n, self.reduced(last, context[-n:]), k - change)
                     for n, last, k in open_ if context[-n:] in self.begins)
        return self.state(context[-left[0][0]:] if left else "", (*left, (0, token, 0))), change

    def run(self, state: State, text: str) -> tuple[State, int]:
        """The state after ``text``, and the tokens that it adds."""
        if len(self.states) > MAX_STATES:
            self.clear()
        total = 0
        for ch in text:
            state, change = state[ch]
            total += change
        return state, total

    def count(self, text: str) -> int:
        """Tokens of ``text`` read from the start state."""
        return self.run(self.start, text)[1]

    def border(self, text: str, start: int) -> int:
        """A place from ``start`` on that no token reaches over, or -1."""
        at = _border(text, start)
        if at >= 0:
            return at
        plain = text.replace(" ", SPACE)
        return next((k for k in range(max(start, 1), len(plain)) if plain[k - 1:k + 1] not in self.neighbours), -1)

    # state maps: (text, None, None, False) for a short text without a border,
    # (head, count after it, exit, True) with a border after the head, and
    # (head, count from the start state, exit, False) for a long text without one
    def chunk_map(self, text: str) -> tuple[str, int | None, tuple | None, bool]:
        at = self.border(text, 1)
        if at < 0 and len(text) <= SYNC_CHARS:
            return text, None, None, False
        state, n = self.run(self.start, text[max(at, 0):])
        return text[:at if at >= 0 else SYNC_CHARS], n, (state.context, state.open), at >= 0

    def entered(self, key: tuple) -> State:
        """The state that another worker calls ``key``."""
        context, open_ = key
        return self.state(context, tuple((n, self.reduced(last, context[-n:]) if n else last, k) for n, last, k in open_))

    def through(self, state: State, m: tuple) -> tuple[int, tuple] | None:
        """Tokens and exit of a map entered in ``state``; None if that cannot
        be told from its head."""
        head, rest, out, closed = m
        if rest is None or closed:
            after, n = self.run(state, head)
            return (n, (after.context, after.open)) if rest is None else (n + rest, out)
        other, difference = self.start, 0
        for ch in ["", *head]:
            if ch:
                state, x = state[ch]
                other, y = other[ch]
                difference += x - y
            if state is other or (state.context, state.open) == (other.context, other.open):
                return rest + difference, out
        return None

    def join(self, a: tuple | None, b: tuple | None) -> tuple | None:
        """The map of a's text followed by b's; None if it cannot be told."""
        if a is None or b is None:
            return None
        if a[1] is not None:
            found = self.through(self.entered(a[2]), b)
            return None if found is None else (a[0], a[1] + found[0], found[1], a[3])
        if b[1] is None:
            return self.chunk_map(a[0] + b[0])
        if b[3]:
            return a[0] + b[0], *b[1:]
        state, n = self.run(self.start, a[0])
        found = self.through(state, b)
        return None if found is None else (a[0] + b[0], n + found[0], found[1], False)

    def total(self, maps: list[tuple]) -> int | None:
        """Tokens of the text whose chunks have these maps."""
        if all(m[0] == "" and m[1] is None for m in maps):
            return 0
        maps = [(SPACE, None, None, False), *maps]
        while len(maps) > 1:  # neighbours first: a balanced tree
            maps = [self.join(*maps[k:k + 2]) if k + 1 < len(maps) else maps[k] for k in range(0, len(maps), 2)]
        if maps[0] is None:
            return None
        found = self.through(self.start, maps[0])
        return None if found is None else found[0]

    def counted(self, text: str) -> int:
        """Tokens of a text, read as one sequence."""
        return self.count(SPACE + text) if text else 0


def _border(text: str, start: int) -> int:
    """First space from ``start`` on that follows another character, or -1."""
    at = text.find(" ", start)
    while at > 0 and text[at - 1] in (" ", SPACE):
        at = text.find(" ", at + 1)
    return at


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """One machine per Python worker."""
    return Transducer(path)


def count_tokens(df: DataFrame, model: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, n_tokens) of every row."""
    def maps(batches) -> Iterator[pa.RecordBatch]:
        machine = transducer(model)
        for batch in batches:
            parts, of = batch.column("part").to_pylist(), batch.column("parts").to_pylist()
            # a text of one chunk is counted at once
            found = [("", machine.counted(t), None, True) if n == 1 else machine.chunk_map(t) for t, n in zip(parts, of)]
            yield pa.record_batch([*(batch.column(n) for n in ("row", "key", "hash", "bytes", "at")),
                                   pa.array([m[0] for m in found], pa.string()),
                                   pa.array([m[1] for m in found], pa.int64()),
                                   pa.array([m[2] and json.dumps(m[2]) for m in found], pa.string()),
                                   pa.array([m[3] for m in found], pa.bool_())],
                                  ["row", "key", "hash", "bytes", "at", "head", "count", "exit", "closed"])

    def totals(batches) -> Iterator[pa.RecordBatch]:
        machine = transducer(model)

        def one(row: list[dict]) -> int | None:
            if len(row) == 1:
                return row[0]["count"]
            return machine.total([(m["head"], m["count"], m["exit"] and _key(m["exit"]), m["closed"]) for m in row])
        for batch in batches:
            n = [one(row) for row in batch.column("maps").to_pylist()]
            yield pa.record_batch([*(batch.column(c) for c in ("key", "hash", "n_bytes")), pa.array(n, pa.int64())],
                                  ["key", "hash", "n_bytes", "n_tokens"])

    def sequence(batches) -> Iterator[pa.RecordBatch]:
        machine = transducer(model)
        for batch in batches:
            yield pa.record_batch([batch.column("of"), pa.array([machine.counted(t) for t in batch.column("text").to_pylist()],
                                                                pa.int64())], ["of", "n"])
    kind = df.schema[key].dataType.simpleString()
    texts = df.select(F.col(key).alias("key"), text_or_empty(text).alias("text")).withColumn("hash", F.xxhash64("text"))
    parts = (texts.select(F.monotonically_increasing_id().alias("row"), "key", "hash",
                          F.octet_length("text").cast("long").alias("bytes"),
                          F.when(F.char_length("text") <= CHUNK_CHARS, F.array("text"))
                          .otherwise(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CHUNK_CHARS}}}"), 0)).alias("texts"))
             .select("row", "key", "hash", "bytes", F.size("texts").alias("parts"), F.posexplode("texts").alias("at", "part")))
    found = parts.mapInArrow(maps, f"row long, key {kind}, hash long, bytes long, at int, head string, count long, exit string, "
                                   "closed boolean")
    rows = found.groupBy("row").agg(
        F.first("key").alias("key"), F.first("hash").alias("hash"), F.first("bytes").alias("n_bytes"),
        F.sort_array(F.collect_list(F.struct("at", "head", "count", "exit", "closed"))).alias("maps"))
    counted = kept(rows.mapInArrow(totals, f"key {kind}, hash long, n_bytes long, n_tokens long"), "token-counts")
    open_ = counted.filter("n_tokens IS NULL").select(F.struct("key", "hash").alias("of")).distinct()
    if not open_.isEmpty():
        own = texts.select(F.struct("key", "hash").alias("own"), "text").join(open_, F.col("own").eqNullSafe(F.col("of")), "left_semi")
        again = kept(own.withColumnRenamed("own", "of").dropDuplicates(["of"]).select("of", "text")
                     .mapInArrow(sequence, f"of struct<key:{kind},hash:bigint>, n long"), "token-sequences")
        counted = (counted.withColumn("own", F.struct("key", "hash")).join(again, F.col("own").eqNullSafe(F.col("of")), "left")
                   .withColumn("n_tokens", F.coalesce("n_tokens", "n")))
    return counted.select(F.col("key").alias(key), "n_bytes", "n_tokens")


def _key(text: str) -> tuple:
    context, open_ = json.loads(text)
    return context, tuple(map(tuple, open_))


def query(spark: SparkSession, sf_dir: str, model: str) -> DataFrame:
    return (count_tokens(table(spark, sf_dir, "documents"), model)
            .withColumn("over_limit", F.col("n_tokens") > LIMIT))
