"""A byte-context trie as one sorted list of grams, cut into ranges.

A gram is ``ORDER`` bytes of context, the nearest first, then the byte that followed. In the order of
that number every shorter context is a range too, so one sort serves all orders: a range of grams
holds the counts, escapes and exclusions of every context inside it. The few contexts that a bound
cuts, at most ``ORDER`` for each bound, are summed over the ranges and sent to those that need them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard

ORDER = 5


def pack(numbers: np.ndarray) -> bytes:
    """Sorted whole numbers as compressed steps; other arrays do no harm but take more room."""
    steps = np.diff(numbers.astype(np.int64), prepend=0)
    return zstandard.ZstdCompressor(level=1).compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view(np.int64).ravel())


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their numbers."""
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def shorten(keys: np.ndarray) -> np.ndarray:
    """The grams without their farthest context byte."""
    return ((keys >> 16) << 8) | (keys & 255)


def cut_contexts(bounds: list[int], bucket: int, size: int) -> list[int]:
    """The contexts of ``size`` bytes that the bounds of a range (whole contexts) may cut."""
    own = bounds[max(bucket - 1, 0): bucket + 1]
    return sorted({b >> 8 * (ORDER - size) for b in own})


def edges(keys: np.ndarray, bounds: list[int], bucket: int) -> list[tuple[int, int, int, int, int]]:
    """What a range knows of the contexts cut by its bounds: (size, context, byte, child, n).

    ``n`` counts the longer contexts that the byte follows. A longer context that is cut itself
    is named as ``child``, because other ranges may name it too; for all others together it is -1.
    """
    found = []
    for size in range(ORDER - 1, -1, -1):
        below = np.unique(((keys >> 8) >> 8 * (ORDER - size - 1)) << 8 | (keys & 255))
        torn = cut_contexts(bounds, bucket, size + 1) if size + 1 < ORDER else []
        for context in cut_contexts(bounds, bucket, size):
            own = below[(below >> 16) == context]
            split = np.isin(own >> 8, torn)
            found.extend((size, context, int(k & 255), int(k >> 8), 1) for k in own[split])
            symbols, n = np.unique(own[~split] & 255, return_counts=True)
            found.extend((size, context, int(s), -1, int(c)) for s, c in zip(symbols, n))
    return found


def log_chances(keys: np.ndarray, n: np.ndarray, tops: pa.Table) -> np.ndarray:
    """log10 probability of each gram's last byte.

    ``keys`` are all grams of a range in order and ``n`` their training counts, 0 for grams only asked
    for. ``tops`` (size, prefix, symbol, n) has the whole counts of contexts that the range's bounds cut.
    """
    taught = n > 0
    followers = {ORDER: (keys[taught], n[taught])}
    sizes, prefix, symbol, counts = (tops[c].to_numpy() for c in ("size", "prefix", "symbol", "n"))
    for size in range(ORDER - 1, -1, -1):
        grams, number = np.unique(shorten(followers[size + 1][0]), return_counts=True)
        own = sizes == size
        whole = ~np.isin(grams >> 8, prefix[own])
        grams = np.concatenate([grams[whole], prefix[own] << 8 | symbol[own]]).astype(np.int64)
        order = np.argsort(grams)
        followers[size] = grams[order], np.concatenate([number[whole], counts[own]])[order]

    score, found = np.zeros(len(keys)), np.zeros(len(keys), bool)
    ruled, out = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    for size in range(ORDER, -1, -1):
        grams, number = followers[size]
        if not len(grams):
            continue
        nodes, first = np.unique(grams >> 8, return_index=True)
        total, kinds = np.add.reduceat(number, first), np.diff(first, append=len(grams))
        following = np.zeros(len(nodes), np.int64)
        if size:  # what the shorter context has for the followers of this one
            short, there = followers[size - 1]
            following = np.add.reduceat(there[np.searchsorted(short, shorten(grams))], first)
        node = (keys >> 8) >> 8 * (ORDER - size)
        at = np.searchsorted(nodes, node).clip(max=len(nodes) - 1)
        has = nodes[at] == node
        asked = node << 8 | (keys & 255)
        place = np.searchsorted(grams, asked).clip(max=len(grams) - 1)
        hit = has & (grams[place] == asked)
        left = np.where(has, kinds[at] - out, 0)
        part = ~found & (left > 0)
        share = np.where(hit, number[place] - 0.5, 0.5 * left)[part]
        score[part] += np.log10(share) - np.log10((total[at] - ruled)[part])
        found |= hit
        ruled, out = np.where(has, following[at], ruled), np.where(has, kinds[at], out)
    return np.where(found, score, score - np.log10(np.maximum(1, 256 - out)))
