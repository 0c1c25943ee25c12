"""A minimal acyclic transducer from byte strings to lists of ids, kept in flat arrays.

States with equal right languages are shared (so words share their suffixes as
well as their prefixes). Outputs sit on the path as counts of the words that
sort before it: their sum is the word's rank, and the rank names its ids.
"""

from __future__ import annotations

import os

import numpy as np

ARRAYS = ("keys", "goto", "skip", "final", "first", "ids")


def compile_transducer(entries: list[tuple[bytes, list[int]]]) -> dict[str, np.ndarray]:
    """``entries``: distinct words with their ids, in any order."""
    entries = sorted(entries)
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    path: list[list] = [[False, []]]  # of the current word: [is final, [(byte, state)]]

    def freeze(depth: int) -> None:
        while len(path) - 1 > depth:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            state = register.get(key)
            if state is None:
                state = register[key] = len(states)
                states.append(key)
            path[-1][1][-1] = (path[-1][1][-1][0], state)

    last = b""
    for word, _ in entries:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        freeze(common)
        for b in word[common:]:
            path[-1][1].append((b, -1))
            path.append([False, []])
        path[-1][0] = True
        last = word
    freeze(0)
    states.append((path[0][0], tuple(path[0][1])))
    n = len(states)  # the start is the last one; a state comes after those it leads to
    words = np.zeros(n, np.int64)
    keys, goto, skip = [], [], []
    for s, (final, arcs) in enumerate(states):
        seen = int(final)
        for b, t in arcs:
            keys.append(s * 256 + b)
            goto.append(t)
            skip.append(seen)
            seen += int(words[t])
        words[s] = seen
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    sizes = np.array([len(x) for _, x in entries], np.int64)
    return {
        "keys": np.array(keys, np.int64)[order], "goto": np.array(goto, np.int32)[order], "skip": np.array(skip, np.int32)[order],
        "final": np.array([f for f, _ in states], np.bool_), "first": np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
        "ids": np.array([i for _, x in entries for i in x], np.int32),
    }


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    """A line with the lengths, then the arrays, each at a multiple of 64 bytes."""
    out = bytearray(",".join(f"{k}:{arrays[k].dtype.str}:{len(arrays[k])}" for k in ARRAYS).encode().ljust(1024, b" "))
    for k in ARRAYS:
        out += b"\0" * (-len(out) % 64)
        out += np.ascontiguousarray(arrays[k]).tobytes()
    return bytes(out)


class Transducer:
    """Looks up many words at once, each step for all of them together."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            head = f.read(1024).decode().strip()
        at, size = 1024, os.path.getsize(path)
        for part in head.split(","):
            name, kind, length = part.split(":")
            at += -at % 64
            length = int(length)
            nbytes = np.dtype(kind).itemsize * length
            assert at + nbytes <= size
            setattr(self, name, np.memmap(path, np.dtype(kind), "r", at, (length,)).view(np.ndarray) if length else np.zeros(0, kind))
            at += nbytes

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """The rank of each word, -1 where the lexicon lacks it."""
        n = len(words)
        if not n:
            return np.zeros(0, np.int64)
        lengths = np.fromiter(map(len, words), np.int64, n)
        data = np.frombuffer(b"".join(words), np.uint8)
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        state = np.full(n, len(self.final) - 1, np.int64)
        rank = np.zeros(n, np.int64)
        live = np.flatnonzero(lengths)
        step = 0
        if not len(self.keys):
            state[live], live = -1, live[:0]
        while len(live):
            want = state[live] * 256 + data[first[live] + step]
            found = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            ok = self.keys[found] == want
            state[live[~ok]] = -1
            live, found = live[ok], found[ok]
            rank[live] += self.skip[found]
            state[live] = self.goto[found]
            step += 1
            live = live[lengths[live] > step]
        good = state >= 0
        good[good] = self.final[state[good]]
        return np.where(good, rank, -1)

    def outputs(self, rank: int) -> np.ndarray:
        return self.ids[self.first[rank] : self.first[rank + 1]]
