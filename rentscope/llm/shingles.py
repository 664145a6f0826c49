"""Words and word shingles of whole Arrow batches as 64-bit hashes (numpy).

Words are runs of anything but space and the bytes 09-0D; A-Z is lower-cased.
"""

from __future__ import annotations

import numpy as np

from rentscope.llm import pieces

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
# all of ASCII but letters and digits: words without their punctuation
SIGNS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE,
          window: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end (bytes) of every word of the texts at ``offsets``,
    and the number of the first word of each text (one more at the end)."""
    out, at, end = [], int(offsets[0]), int(offsets[-1])
    while at < end:
        size = window
        while True:  # a window ends before a space or a text's start, or it grows
            stop = min(at + size, end)
            if stop < end:
                k = int(offsets[np.searchsorted(offsets, stop, side="right") - 1])
                spaces = np.flatnonzero(between[data[at:stop]])
                best = max(k if k > at else -1, at + int(spaces[-1]) if len(spaces) else -1)
                if best <= at:
                    size *= 2
                    continue
                stop = best
            break
        part = data[at:stop]
        inside = np.zeros(len(part) + 2, bool)
        inside[1:-1] = ~between[part]
        edge = inside[1:] != inside[:-1]
        own = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, stop)] - at
        touching = own[(own > 0)]
        touching = touching[inside[touching] & inside[touching + 1]]  # two texts meet without a space
        marks = np.flatnonzero(edge)
        starts, ends = marks[::2], marks[1::2]
        if len(touching):
            starts, ends = np.sort(np.append(starts, touching)), np.sort(np.append(ends, touching))
        out.append((mixed(pieces.span_hashes(_LOWER[part], starts, ends)), starts + at, ends + at))
        at = stop
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    h, s, e = (np.concatenate(x) for x in zip(*out))
    return h, s, e, np.searchsorted(s, offsets)


_WEIGHTS = np.random.default_rng(7).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def runs(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on (the last n - 1 are missing)."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    total = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        total += h[k:len(h) - n + 1 + k] * _WEIGHTS[k]
    return mixed(total)


def shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingles of each text, in order, and the offsets of each
    text's; a text of fewer words has its whole sequence as the only one, a text
    without words none."""
    h, _, _, first = words(data, offsets)
    count = np.diff(first)
    texts = np.arange(len(count))
    full = runs(h, n)
    long = count >= n
    number = np.where(long, count - n + 1, 0)
    at = pieces.ragged(np.arange(len(h)), first[:-1], number)
    doc = np.repeat(texts, number)
    key = full[at] if len(at) else np.empty(0, np.uint64)
    short = np.flatnonzero((count > 0) & ~long)
    if len(short):
        own = []
        for i in short.tolist():
            w = h[first[i]:first[i + 1]]
            own.append((w * _WEIGHTS[32:32 + len(w)]).sum(dtype=np.uint64) + np.uint64(len(w)))
        doc, key = np.append(doc, short), np.append(key, mixed(np.array(own, np.uint64)))
        order = np.argsort(doc, kind="stable")
        doc, key = doc[order], key[order]
    if not len(key):
        return key, np.zeros(len(offsets), np.int64)
    once, _ = pieces.grouped(key + mixed(doc.astype(np.uint64) + np.uint64(1)))
    keep = np.zeros(len(key), bool)
    keep[once] = True
    doc, key = doc[keep], key[keep]
    return key, np.searchsorted(doc, np.arange(len(count) + 1))
