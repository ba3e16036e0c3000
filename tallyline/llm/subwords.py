"""Hashed words and character n-grams of many byte strings at once."""

from __future__ import annotations

import numpy as np

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def finish(hashes: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    hashes = (hashes ^ (hashes >> np.uint64(31))) * _MIX[1]
    return hashes ^ (hashes >> np.uint64(29))


def grams(data: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` bytes that begin at each position; shorter by ``order - 1``."""
    total = len(data) - order + 1
    if total <= 0:
        return np.zeros(0, np.uint64)
    hashes = np.full(total, np.uint64(order), np.uint64)
    for step in range(order):
        hashes = hashes * _MIX[0] + data[step : step + total]
    return finish(hashes)


def bags(words: list[bytes], orders: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word's n-grams, marked at both ends; and where each word's begin.

    A word has one gram at least: the whole marked word counts as one too.
    """
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    data = np.frombuffer(b"<" + b"><".join(words) + b">", np.uint8).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(lengths) - lengths
    found, owner = [whole(data, starts, lengths)], [np.arange(len(words))]
    word_of = np.repeat(np.arange(len(words)), lengths)
    for order in orders:
        hashes = grams(data, order)
        inside = np.flatnonzero(word_of[: len(hashes)] == word_of[order - 1 :]) if len(hashes) else np.zeros(0, np.int64)
        found.append(hashes[inside])
        owner.append(word_of[inside])
    owner = np.concatenate(owner)
    order_of = np.argsort(owner, kind="stable")
    ids = (np.concatenate(found)[order_of] % np.uint64(buckets)).astype(np.int64)
    return ids, np.searchsorted(owner[order_of], np.arange(len(words)))


def whole(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """One polynomial hash per marked word."""
    hashes = np.zeros(len(starts), np.uint64)
    left = np.arange(len(starts))
    step = 0
    while len(left):
        hashes[left] = hashes[left] * _MIX[2] + data[starts[left] + step]
        step += 1
        left = left[lengths[left] > step]
    return finish(hashes)
