"""Fast exact encoding with a byte-level BPE file of the tokenizers library.

A text is cut only where the byte-level pre-tokenizer always cuts as well:
before a space or line feed that follows a printable character, after a line
feed between a printable character and a letter, and between a letter and an
ASCII digit or sign.  Such pieces encode on their own exactly as inside
their text, so every distinct piece is given to the library once and its ids
are reused.  Finding the pieces of a whole Arrow batch is numpy work over the
concatenated UTF-8 bytes; the library only sees pieces not met before.

The cache is a cache: it is emptied when it reaches ``max_entries``, which
changes no id.  A tokenizer file of another shape (normalizer, other
pre-tokenizer, added tokens that contain a cut) is used without pieces.
"""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np

WINDOW = 1 << 20

_WS, _PRINT, _LETTER, _LEAD2, _CONT, _STOP, _LEAD_C3 = 1, 2, 4, 8, 16, 32, 64


# at most one space, then Latin letters: one word of the pre-tokenizer
_ONE_WORD = re.compile(rb" ?(?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+")


def _classes() -> np.ndarray:
    c = np.zeros(256, np.uint8)
    c[[0x20, 0x0A]] |= _WS
    c[0x21:0x7F] |= _PRINT
    c[ord("A"):ord("Z") + 1] |= _LETTER
    c[ord("a"):ord("z") + 1] |= _LETTER
    c[0xC3:0xE0] |= _LEAD2
    c[0x80:0xC0] |= _CONT
    c[[b for b in range(0x21, 0x7F) if not chr(b).isalpha() and chr(b) not in "<|>"]] |= _STOP
    c[0xC3] |= _LEAD_C3
    return c


CLASSES = _classes()
_NOT_LETTER_TAIL = (0x97, 0xB7)  # U+00D7 and U+00F7 are signs, not letters
BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**64 - 1, 256, dtype=np.uint64)
_ODD = 0x9E3779B97F4A7C15
# two prime fields, a fixed random base in each
FIELDS = ((2147483647, 1318699273), (2147483629, 1736542831))
_EXACT = 1 << 23    # so many terms below 2^40 add up below 2^63


_POWERS: dict[tuple[int, int], np.ndarray] = {}


def _powers(size: int, prime: int, base: int) -> np.ndarray:
    """At least ``size`` powers of the base; a longer table replaces a shorter one."""
    have = _POWERS.get((prime, base))
    if have is None or len(have) < size:
        out = np.ones(max(size, WINDOW + 1), np.uint32)
        done = 1
        while done < len(out):  # doubled: the known part times the next power
            n = min(done, len(out) - done)
            out[done:done + n] = out[:n] * np.uint64(pow(base, done, prime)) % np.uint64(prime)
            done += n
        have = _POWERS[prime, base] = out
    return have


def prefix_hashes(data: np.ndarray, field: int = 0) -> tuple[np.ndarray, np.ndarray, np.uint64]:
    """Running sums of the polynomial hash, the powers that shift a span to
    place 0, and the prime: the hash of ``data[a:b]`` is
    ``(sums[b] - sums[a]) % prime * shift[a] % prime``."""
    prime, base = FIELDS[field]
    up, shift = (_powers(len(data) + 1, prime, x) for x in (base, pow(base, -1, prime)))
    terms = (data.astype(np.uint64) + np.uint64(1)) * up[:len(data)]
    if len(data) > _EXACT:
        terms %= np.uint64(prime)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(terms, out=sums[1:])
    return sums, shift, np.uint64(prime)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each ``data[starts[i]:ends[i]]``: polynomials over two prime
    fields, 62 bits in all, and the length."""
    out = (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(len(FIELDS)):
        sums, shift, prime = prefix_hashes(data, k)
        out += ((sums[ends] - sums[starts]) % prime * shift[starts] % prime) << np.uint64(32 * k)
    return out


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``values[starts[i]:starts[i] + lengths[i]]``."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return values[np.repeat(starts - before, lengths) + np.arange(total)]


def grouped(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One position per distinct value, and each value's number."""
    order = np.argsort(h)
    sorted_h = h[order]
    new = np.ones(len(h), bool)
    new[1:] = sorted_h[1:] != sorted_h[:-1]
    number = np.empty(len(h), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


@functools.lru_cache(maxsize=1)
def _wrapping_powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def of(x: int) -> np.ndarray:
        out = np.full(size, x, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)
    return of(_ODD), of(pow(_ODD, -1, 1 << 64))


def quick_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomials modulo 2^64: cheap, but there are long spans that collide
    whatever the base, so only for spans that are compared afterwards."""
    up, down = _wrapping_powers(WINDOW + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * up[:len(data)], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)


def equal_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the spans that ``starts`` cuts all of ``data`` into: one of each
    distinct content, and each span's content.  Found by hash and then compared
    byte by byte, so unlike spans are never taken for one."""
    ends = np.append(starts[1:], len(data))
    if len(data) <= WINDOW:  # longer: there is a span beyond the usual windows
        first, number = grouped(quick_hashes(data, starts, ends))
        like, size = first[number], ends - starts
        if np.array_equal(size[like], size) and np.array_equal(ragged(data, starts[like], size), data):
            return first, number
    raw, seen = data.tobytes(), {}
    number = np.array([seen.setdefault(raw[s:e], len(seen)) for s, e in zip(starts.tolist(), ends.tolist())], np.int64)
    return np.unique(number, return_index=True)[1], number


def safe_cuts(data: np.ndarray) -> np.ndarray:
    """Positions > 0 where the pre-tokenizer cuts whatever stands around."""
    if len(data) < 2:
        return np.empty(0, np.int64)
    c = CLASSES[data]
    before = c[:-1]
    lead = np.zeros(len(before), np.uint8)
    lead[1:] = c[:-2]
    tail = (before & _CONT) != 0
    word_end = ((before & _PRINT) != 0) | (tail & ((lead & _LEAD2) != 0))
    sign = (data[:-1] == _NOT_LETTER_TAIL[0]) | (data[:-1] == _NOT_LETTER_TAIL[1])
    letter = ((before & _LETTER) != 0) | (tail & ((lead & _LEAD_C3) != 0) & ~sign)
    here = c[1:]
    cut = (((here & _WS) != 0) & word_end) | (((here & _STOP) != 0) & letter)
    cut[1:] |= (data[1:-1] == 0x0A) & word_end[:-1] & ((here[1:] & _LETTER) != 0)
    return np.flatnonzero(cut) + 1


def byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the rest
    are numbered from U+0100 in byte order."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PieceEncoder:
    """``plain``: the special tokens' strings inside texts are plain text."""

    def __init__(self, path: str, max_entries: int = 400_000, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = plain
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, added = spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
        self.by_pieces = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and spec.get("normalizer") is None and not any(
                a.get("lstrip") or a.get("rstrip") or a.get("single_word")
                or len(safe_cuts(np.frombuffer(b"x" + a["content"].encode(), np.uint8))) for a in added))
        self.max_entries = max_entries
        self.library_pieces = 0  # pieces the library has encoded so far
        alphabet = byte_alphabet()
        self._alphabet = "".join(alphabet[b] for b in range(256))
        back = {v: k for k, v in alphabet.items()}
        specials = {a["id"]: a["content"].encode() for a in added}
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        table = [b""] * size
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            table[i] = specials.get(i) or bytes(back[ch] for ch in token)
        self._set_tokens(table)
        self._clear()

    def _set_tokens(self, table: list[bytes]) -> None:
        self.token_bytes = table
        self.token_len = np.array([len(t) for t in table], np.int64)
        self._token_start = np.cumsum(self.token_len) - self.token_len
        self._token_data = np.frombuffer(b"".join(table), np.uint8)

    def cuts(self, data: np.ndarray) -> np.ndarray:
        return safe_cuts(data)

    def _clear(self) -> None:
        self.memo: dict[bytes, int] = {}
        self.data = np.empty(1 << 16, np.uint32)
        self.used = 0
        self.start = np.empty(1 << 14, np.int64)
        self.length = np.empty(1 << 14, np.int64)

    def _library(self, pieces: list[bytes]) -> list[list[int]]:
        self.library_pieces += len(pieces)
        model, a, word = self.tokenizer.model, self._alphabet, _ONE_WORD.fullmatch
        out: list = [None] * len(pieces)
        rest = []
        for i, p in enumerate(pieces):
            if p.isalpha():
                out[i] = [t.id for t in model.tokenize(p.decode())]
            elif word(p):
                out[i] = [t.id for t in model.tokenize(p.decode("latin-1").translate(a))]
            else:
                rest.append(i)
        if rest:
            found = self.tokenizer.encode_batch_fast([pieces[i].decode() for i in rest], add_special_tokens=False)
            for i, e in zip(rest, found):
                out[i] = e.ids
        return out

    def _learn(self, pieces: list[bytes]) -> None:
        ids = self._library(pieces)
        n, first = len(pieces), len(self.memo)
        lengths = np.fromiter(map(len, ids), np.int64, n)
        flat = np.fromiter((x for p in ids for x in p), np.uint32, int(lengths.sum()))
        while self.used + len(flat) > len(self.data):
            self.data = np.concatenate([self.data, np.empty_like(self.data)])
        while first + n > len(self.start):
            self.start = np.concatenate([self.start, np.empty_like(self.start)])
            self.length = np.concatenate([self.length, np.empty_like(self.length)])
        self.data[self.used:self.used + len(flat)] = flat
        self.start[first:first + n] = self.used + np.cumsum(lengths) - lengths
        self.length[first:first + n] = lengths
        self.used += len(flat)
        self.memo.update(zip(pieces, range(first, first + n)))

    def _window(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of ``data`` cut at ``starts`` and the number of ids of each piece."""
        if len(self.memo) > self.max_entries:
            self._clear()
        ends = np.append(starts[1:], len(data))
        first, number = equal_spans(data, starts)
        raw = data.tobytes()
        keys = [raw[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist())]
        get = self.memo.get
        at = [get(k, -1) for k in keys]
        missing = [k for k, i in zip(keys, at) if i < 0]
        if missing:
            self._learn(missing)
            at = [get(k) for k in keys]
        entry = np.array(at, np.int64)[number]
        lengths = self.length[entry]
        return ragged(self.data, self.start[entry], lengths), lengths

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``data``: concatenated UTF-8 texts, text i at ``offsets[i]:offsets[i + 1]``.
        Returns all ids (uint32) and the offsets of each text's ids."""
        offsets = np.asarray(offsets, np.int64)
        if not self.by_pieces:
            texts = [bytes(data[a:b]).decode() for a, b in zip(offsets[:-1], offsets[1:])]
            ids = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
            lengths = np.array([0, *map(len, ids)], np.int64)
            return np.array([x for p in ids for x in p], np.uint32), np.cumsum(lengths)
        at, end = int(offsets[0]), int(offsets[-1])
        parts, piece_at, piece_n = [], [], []
        borders = offsets[:-1]
        while at < end:
            size = WINDOW
            while True:
                stop = min(at + size, end)
                part = data[at:stop]
                own = borders[np.searchsorted(borders, at):np.searchsorted(borders, stop)] - at
                here = np.zeros(len(part), bool)
                here[0] = here[own] = here[self.cuts(part)] = True
                cut = np.flatnonzero(here)
                if stop == end or len(cut) > 1:
                    break
                size *= 2  # one piece longer than the window
            if stop < end:  # the last piece may go on
                stop, cut = at + int(cut[-1]), cut[:-1]
                part = data[at:stop]
            ids, n = self._window(part, cut)
            parts.append(ids)
            piece_at.append(cut + at)
            piece_n.append(n)
            at = stop
        if not parts:
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        total = np.concatenate([[0], np.cumsum(np.concatenate(piece_n))])
        return np.concatenate(parts), total[np.searchsorted(np.concatenate(piece_at), offsets)]

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens, one after another."""
        return ragged(self._token_data, self._token_start[ids], self.token_len[ids])

    def decode(self, ids: np.ndarray) -> bytes:
        return self.joined(ids).tobytes()


@functools.lru_cache(maxsize=2)
def encoder(path: str, plain: bool = False) -> PieceEncoder:
    """One encoder per Python worker; it keeps its cache from task to task."""
    return PieceEncoder(path, plain=plain)


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of an Arrow string column; null is empty."""
    import pyarrow as pa
    import pyarrow.compute as pc
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    n, shift = len(column), column.offset
    _, offsets, data = column.buffers()
    if n == 0 or data is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, np.int64)[shift:shift + n + 1]
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]
