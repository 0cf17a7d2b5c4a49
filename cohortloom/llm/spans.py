"""Words of many texts at once: their places and 64-bit hashes in numpy arrays."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

#: Bytes of text handled at once; the arrays take about 40 times as much.
CHUNK = 1 << 20
ASCII_BLANK = np.zeros(256, bool)
ASCII_BLANK[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True
#: A word that starts behind a single space: a text may be cut at the space.
CUT = re.compile(rb"[^\t-\r ] (?=[^\t-\r ])")

STEP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)
#: One odd number per byte value, and the powers of STEP as far as they were needed.
BYTES = np.random.default_rng(1).integers(0, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global POWERS
    if len(POWERS) < n:
        steps = np.full(2 * n, STEP, np.uint64)
        steps[0] = 1
        POWERS = np.cumprod(steps, dtype=np.uint64)
    return POWERS


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of bytes that follow each other without overlap."""
    if not len(starts):
        return np.empty(0, np.uint64)
    inside = np.zeros(len(data), np.int32)
    inside[starts] = starts
    inside = np.arange(len(data), dtype=np.int32) - np.maximum.accumulate(inside)
    values = np.zeros(len(data) + 1, np.uint64)
    lengths = ends - starts
    # Bytes between spans count from the last start; they are summed apart and left out.
    values[:-1] = powers(int(inside.max()) + 1)[inside]
    values[:-1] *= BYTES[data]
    bounds = np.empty(2 * len(starts), np.int64)
    bounds[::2], bounds[1::2] = starts, ends
    # Where a span ends as the next starts, the sum between them is one value, unused.
    out = np.add.reduceat(values, bounds)[::2] ^ lengths.astype(np.uint64)
    out ^= out >> np.uint64(32)
    out *= MIX
    return out ^ (out >> np.uint64(29))


def chunks(texts: list[bytes]) -> Iterator[list[tuple[int, bytes]]]:
    """(number of the text, part of it), about CHUNK bytes at a time, in order. Long texts
    are cut in front of a word behind a single space, if there is one."""
    held, size = [], 0
    for number, text in enumerate(texts):
        start = 0
        while start < len(text):
            found = CUT.search(text, start + CHUNK - size) if len(text) - start > CHUNK - size else None
            end = found.start() + 1 if found else len(text)
            held.append((number, text[start:end]))
            size += end - start
            start = end
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


def word_codes(texts: list[bytes | None]) -> list[np.ndarray]:
    """Per text the hashes of its words between ASCII white space, A-Z in lower case."""
    rows: list[list[np.ndarray]] = [[] for _ in texts]
    for parts in chunks([t or b"" for t in texts]):
        data = np.frombuffer(b" ".join(p for _, p in parts).lower(), np.uint8)
        word = np.zeros(len(data) + 2, np.int8)
        word[1:-1] = ~ASCII_BLANK[data]
        turn = np.diff(word)
        starts, ends = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
        codes = span_hashes(data, starts, ends)
        at = np.cumsum([0, *(len(p) + 1 for _, p in parts)])
        bounds = np.searchsorted(starts, at)
        for (number, _), a, b in zip(parts, bounds[:-1], bounds[1:], strict=True):
            rows[number].append(codes[a:b])
    none = np.empty(0, np.uint64)
    return [own[0] if len(own) == 1 else np.concatenate(own) if own else none for own in rows]
