"""Words and word shingles of texts as 64-bit hashes, over whole Arrow batches.

A word is a run of bytes other than 0x20 and 0x09-0x0D, with A-Z lower-cased.
UTF-8 never holds these bytes inside a longer character, so working on bytes
is exact. A word's hash is a polynomial over its bytes modulo 2**64, taken
from running sums, so no word is handled on its own.
"""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
BYTE = np.random.Generator(np.random.PCG64(11)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_LOWER = BYTE[LOWER]
BASE = 0x9E3779B97F4A7C15
#: Bytes that are hashed at a time; a longer text is cut at white space.
SEGMENT = 1 << 20
SHINGLE = 5

_powers: dict[str, np.ndarray] = {"p": np.ones(1, np.uint64), "i": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse, i < n, modulo 2**64."""
    if len(_powers["p"]) < n:
        n2 = max(n, SEGMENT + 1)
        for name, base in (("p", BASE), ("i", pow(BASE, -1, 2**64))):
            steps = np.full(n2, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["p"][:n], _powers["i"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of a 64-bit value over all of them."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def segments(data: np.ndarray, edges: np.ndarray, gap: np.ndarray = SPACE):
    """(start, end) pieces of ``data`` of about SEGMENT bytes that end at a row's
    edge or behind a byte of ``gap``, so that no word is cut."""
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + SEGMENT)
        if end < n:
            edge = edges[np.searchsorted(edges, end, "right") - 1]
            if edge > at:
                end = int(edge)
            else:
                back = np.flatnonzero(gap[data[at:end]])
                if len(back):
                    end = at + int(back[-1]) + 1
                else:  # one very long word: up to the next white space or edge
                    stop = int(edges[np.searchsorted(edges, end, "left")])
                    while end < stop and not gap[data[end]]:
                        ahead = np.flatnonzero(gap[data[end : min(stop, end + SEGMENT)]])
                        end = end + int(ahead[0]) if len(ahead) else min(stop, end + SEGMENT)
        yield at, end
        at = end


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the row that each is in; bytes of ``gap`` separate words."""
    table, hashes, rows = (BYTE_LOWER if lower else BYTE), [], []
    for at, end in segments(data, offsets, gap):
        part = data[at:end]
        space = gap[part]
        edge = np.zeros(len(part) + 1, bool)
        inside = offsets[np.searchsorted(offsets, at, "left") : np.searchsorted(offsets, end, "right")] - at
        edge[inside] = True
        edge[0] = edge[-1] = True
        before = np.empty(len(part), bool)
        before[0] = True
        before[1:] = space[:-1]
        after = np.empty(len(part), bool)
        after[-1] = True
        after[:-1] = space[1:]
        starts = np.flatnonzero(~space & (before | edge[:-1]))
        ends = np.flatnonzero(~space & (after | edge[1:])) + 1
        p, inv = powers(len(part))
        run = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(table[part] * p, out=run[1:])
        hashes.append(mix((run[ends] - run[starts]) * inv[starts] + (ends - starts).astype(np.uint64)))
        rows.append(np.searchsorted(offsets, starts + at, "right") - 1)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(rows)


STEP = np.random.Generator(np.random.PCG64(12)).integers(1, 2**63, 2 * SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Each row's sorted distinct shingle hashes: of every five words in a row, or
    of the whole sequence where there are fewer. No words: an empty set."""
    words, rows = word_hashes(data, offsets)
    n = len(offsets) - 1
    cuts = np.searchsorted(rows, np.arange(n + 1))
    whole = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
    for j in range(SHINGLE if len(whole) else 0):
        whole += words[j : j + len(whole)] * STEP[j]
    whole = mix(whole)
    out = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b - a >= SHINGLE:
            out.append(np.unique(whole[a : b - SHINGLE + 1]))
        elif b > a:
            out.append(mix((words[a:b] * STEP[: b - a]).sum(dtype=np.uint64, keepdims=True) + STEP[SHINGLE + b - a - 1]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
