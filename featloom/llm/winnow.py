"""Winnowing over sequences of 64-bit symbols, many documents at a time.

A window is ``length`` consecutive symbols; its anchor is the k-gram in it with
the smallest hash, the rightmost of equal ones.  The anchor depends on nothing
outside the window, so equal windows have equal anchors at equal offsets.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from featloom.llm.common import mix

BASE = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))  # inverse of BASE modulo 2**64
PLACE = np.uint64(2**24 - 1)  # low bits of a key hold the position
PIECE = 2**20  # window starts looked at together; a longer document is gone through piece by piece
POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, count: int) -> np.ndarray:
    have = POWERS.get(int(base))
    if have is None or len(have) < count:
        factors = np.full(max(count, 2**16), base, np.uint64)
        factors[0] = 1
        have = POWERS[int(base)] = np.multiply.accumulate(factors)
    return have[:count]


def rolling(symbols: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive symbols, by doubling."""
    n = len(symbols) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    done, out, block, width = 0, None, symbols, 1
    while True:
        if k & width:
            if out is None:
                out = block[:n].copy()
            else:
                out = out * powers(BASE, width + 1)[width] + block[done : done + n]
            done += width
        if done == k:
            return mix(out)
        block = block[: len(block) - width] * powers(BASE, width + 1)[width] + block[width:]
        width *= 2


def window_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive keys."""
    n = len(keys) - width + 1
    block, size = keys, 1
    while size * 2 <= width:
        block = np.minimum(block[: len(block) - size], block[size:])
        size *= 2
    return np.minimum(block[:n], block[width - size : width - size + n])


@dataclass
class Runs:
    """Consecutive windows of one document with one anchor; starts count from the document's first symbol."""

    doc: np.ndarray
    first: np.ndarray
    last: np.ndarray
    offset: np.ndarray  # of the anchor from the first start
    anchor: np.ndarray  # hash of the anchor's k-gram
    context: np.ndarray  # hash of all symbols of the run's windows and of the anchor's place in them


def span_hash(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of symbols[start:stop] from prefix sums, not yet mixed."""
    return (prefix[stop] - prefix[start]) * powers(BACK, len(prefix))[start]


def prefix_sums(symbols: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(symbols * powers(BASE, len(symbols)), dtype=np.uint64)))


def _piece(symbols: np.ndarray, offsets: np.ndarray, length: int, k: int) -> Runs | None:
    n = len(symbols) - length + 1
    if n <= 0:
        return None
    grams = rolling(symbols, k)
    keys = (grams & ~PLACE) | (PLACE - np.arange(len(grams), dtype=np.uint64))
    place = (PLACE - (window_min(keys, length - k + 1) & PLACE)).astype(np.int64)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    start = np.flatnonzero(np.arange(n) + length <= offsets[1:][doc])
    if not len(start):
        return None
    at, of = place[start], doc[start]
    new = np.concatenate(([True], (np.diff(at) != 0) | (np.diff(of) != 0)))
    begin = np.flatnonzero(new)
    stop = np.append(begin[1:], len(start)) - 1
    first, last, at, of = start[begin], start[stop], at[begin], of[begin]
    shape = mix(((at - first).astype(np.uint64) << np.uint64(32)) | (last - first).astype(np.uint64))
    context = mix(span_hash(prefix_sums(symbols), first, last + length) ^ shape)
    return Runs(of, first - offsets[of], last - offsets[of], at - first, grams[at], context)


def find_runs(parts: list[np.ndarray], length: int, k: int) -> Runs:
    """Runs of the windows of every document in ``parts``."""
    found: list[Runs] = []
    group, group_at, size = [], 0, 0

    def flush(upto: int) -> None:
        nonlocal group, size
        if group:
            offsets = np.concatenate(([0], np.cumsum([len(p) for p in group])))
            runs = _piece(np.concatenate(group), offsets, length, k)
            if runs is not None:
                runs.doc = runs.doc + (upto - len(group))
                found.append(runs)
        group, size = [], 0

    for i, part in enumerate(parts):
        if len(part) > PIECE:
            flush(i)
            for base in range(0, len(part) - length + 1, PIECE):
                runs = _piece(part[base : base + PIECE + length - 1], np.array([0, len(part[base : base + PIECE + length - 1])]), length, k)
                runs.doc, runs.first, runs.last = runs.doc + i, runs.first + base, runs.last + base
                found.append(runs)
            continue
        if size + len(part) > PIECE:
            flush(i)
        group.append(part)
        size += len(part)
    flush(len(parts))
    if not found:
        zero = np.zeros(0, np.int64)
        return Runs(zero, zero, zero, zero, zero.astype(np.uint64), zero.astype(np.uint64))
    return Runs(*(np.concatenate([getattr(r, f) for r in found]) for f in ("doc", "first", "last", "offset", "anchor", "context")))
