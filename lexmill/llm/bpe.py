"""Byte-pair encoding from a public rank file, exact for any text."""

from __future__ import annotations

import base64
import functools
import heapq
import re

import regex

#: Fixed value: the split pattern that belongs to the byte-level vocabularies.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_EXACT = regex.compile(SPLIT)
# The same pattern in the classes of ``re``, which is faster but holds only
# where both libraries put every character into the same class.
_FAST = re.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+""")


# Blocks of common letters and signs; what both libraries class alike in them needs no closer look.
_COMMON = ((0x00, 0x24F), (0x370, 0x52F), (0x5D0, 0x5EA), (0x1E00, 0x1FFF), (0x2010, 0x2027), (0x2030, 0x205E), (0x20A0, 0x20BF))


def _classed_apart(points: list[str]) -> set[str]:
    every, apart = "".join(points), set()
    for fast, exact in ((r"[^\W\d_]", r"\p{L}"), (r"\d", r"\p{N}"), (r"\s", r"\s")):
        apart |= set(re.findall(fast, every)) ^ set(regex.findall(exact, every))
    return apart


@functools.cache
def _uncommon() -> re.Pattern:
    """Characters outside of the common blocks, or classed differently; made on first use."""
    points = [chr(i) for a, b in _COMMON for i in range(a, b + 1)]
    safe = sorted(set(points) - _classed_apart(points))
    return re.compile("[^" + "".join(map(re.escape, safe)) + "]")


def split_words(text: str) -> list[str]:
    """The pieces that merges never cross."""
    if not _uncommon().search(text):
        return _FAST.findall(text)
    return _EXACT.findall(text)


@functools.lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the pair of lowest rank is merged until none has a rank.

    A heap over a linked list keeps this at O(n log n), so that a run of a
    million equal letters ends as well.
    """
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    parts: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        left = parts[i]
        if left is None or (j := after[i]) >= n or len(left) + len(parts[j]) != size:
            continue
        parts[i], parts[j] = left + parts[j], None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            both = parts[i] + parts[k]
            if (r := ranks.get(both)) is not None:
                heapq.heappush(heap, (r, i, len(both)))
        if (h := before[i]) >= 0:
            both = parts[h] + parts[i]
            if (r := ranks.get(both)) is not None:
                heapq.heappush(heap, (r, h, len(both)))
    return [ranks[p] for p in parts if p is not None]
