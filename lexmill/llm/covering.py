"""Near-duplicate texts by covering locality-sensitive hashing.

A text is the set of its words. Two sets whose Jaccard similarity is at least
``s`` differ in at most ``(|A| + |B|) (1 - s) / (1 + s)`` words, and so do their
512-bit parity sketches in bits. The bits are split into parts so that at least
one part has at most one difference, and each part is covered by three masks of
which one avoids that difference: every pair within the radius agrees in all
bits of some mask. No pair of sets of at most LONG words is missed; candidates
found under some mask are checked on their whole word sets.

The parts are as many as the radius asks for, so sets are hashed by the radius
classes their possible partners fall into. Buckets that many sets share are
split by a second, independent family of masks instead of being paired: hot
ones before the shuffle, others within their task.

A mask holds five or so words of a set, whatever its size, and in long texts
those are mostly common ones. Longer sets are therefore hashed by their rarest
words: two similar ones share one of the first ``n - s n + 1``, which loses no
pair either. A word that very many sets are hashed by is split into cells.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.components import seed_forest
from lexmill.operators.skew import hot_keys_of, salted_join
from lexmill.session import durable

#: Sets of more words are hashed by their rarest words instead of by the bits of their sketches.
LONG = 56
#: Bits of a sketch that the masks look at; folded to 128 they tell sets apart.
WIDTH = 512
#: The largest radius of each class: an odd one, as two differences cost one more part.
RADII = (1, 3, 5, 9, 13, 19, 29, 43, 65, 97)
#: Sets of one bucket that are compared with each other without splitting it further.
PAIRED = 1024
#: Levels of independent masks.
LEVELS = 4
#: Bytes of entries that one task takes.
TASK_BYTES = 16 << 20
#: Sets looked at to find buckets that must be split before the shuffle; what it misses is split later.
SAMPLE = 20_000
#: A bucket with more than this share of the sample is split before the shuffle.
HOT = 1 / 200
#: Counters of words of long sets; words that share one only look more frequent.
COUNTERS = 1 << 18
#: Long sets under one word that one task compares with each other; more are split into cells.
CELL = 8192

WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """The distinct words of a text: longest runs of letters and digits, in lower case."""
    return sorted(set(WORD.findall(text.lower()))) if text else []


def word_hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def radius(a: int, b: int, s: float) -> int:
    """Most words by which sets of ``a`` and ``b`` words with similarity ``s`` or more can differ."""
    return math.floor((a + b) * (1 - s) / (1 + s) + 1e-9)


def short_limit(s: float) -> int:
    """The largest sets that are hashed by the bits of their sketches: LONG, or fewer words where a low ``s`` needs more parts than the classes have."""
    return next((n for n in range(LONG, 0, -1) if radius(n, n, s) <= RADII[-1]), 0)


def long_from(s: float) -> int:
    """The smallest sets that are hashed by their words: those with a possible partner over the limit of the short ones, so that pairs across it meet too."""
    limit = short_limit(s)
    return next(n for n in range(1, limit + 2) if math.floor(n / s + 1e-9) > limit)


_masks: dict[tuple[int, int, int], np.ndarray] = {}


def masks(parts: int, level: int, width: int = 128) -> np.ndarray:
    """The masks (one row of 64-bit lanes each) of a family: for each of ``parts`` parts of the bits, two of three thirds of it, in the three ways."""
    key = (parts, level, width)
    if key not in _masks:
        order = np.random.Generator(np.random.PCG64([parts, level, width])).permutation(width)
        out = np.zeros((3 * parts, width // 64), np.uint64)
        for place, bit in enumerate(order.tolist()):
            part, third = place % parts, place // parts % 3
            for v in range(3):
                if v != third:
                    out[3 * part + v, bit // 64] |= np.uint64(1 << bit % 64)
        _masks[key] = out
    return _masks[key]


def _mix(lo: np.ndarray, hi: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = lo * np.uint64(0x9E3779B97F4A7C15) ^ (hi + np.uint64(seed)) * np.uint64(0xC2B2AE3D27D4EB4F)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def _mix_wide(lanes: np.ndarray, seed: int) -> np.ndarray:
    """One hash of the lanes [lane, set]."""
    out = np.full(lanes.shape[1], seed, np.uint64)
    with np.errstate(over="ignore"):
        for lane in lanes:
            out = (out ^ lane) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(32)
    return out


# An entry: what is left of the bucket's hash beside the task, the parts, the size (LONG bounds both) and the folded sketch.
ENTRY = np.dtype([("key", "u4"), ("parts", "u1"), ("n", "u1"), ("lo", "u8"), ("hi", "u8")])
# Of long sets: the word or cell, the size and the whole sketch, which tells sets of up to a thousand words apart.
LONG_ENTRY = np.dtype([("key", "u8"), ("n", "u4"), ("wide", "u8", (WIDTH // 64,))])


def fold_lanes(wide: np.ndarray, to: int) -> np.ndarray:
    """A sketch [lane, set] of fewer lanes: lanes at a distance of ``to`` are added; sets differ in no more bits than before."""
    out = wide[:to].copy()
    for k in range(to, len(wide), to):
        out ^= wide[k : k + to]
    return out


def short_classes(n: np.ndarray, s: float) -> Iterator[tuple[int, np.ndarray]]:
    """(parts, which sets): a set is in each class that its radius with some partner of at most ``short_limit`` words falls into."""
    limit = short_limit(s)
    by: dict[int, list[int]] = {}
    for x in np.unique(n).tolist():
        least, most = radius(x, math.ceil(x * s - 1e-9), s), radius(x, max(x, min(limit, math.floor(x / s + 1e-9))), s)
        below = -1
        for top in RADII:
            if below < most and least <= top:
                by.setdefault((top + 1) // 2, []).append(x)
            below = top
    for parts, group in sorted(by.items()):
        yield parts, np.flatnonzero(np.isin(n, group))


def entries(n: np.ndarray, wide: np.ndarray, s: float, hot: set[tuple[int, int, int]]) -> Iterator[tuple[tuple[int, int], np.ndarray, np.ndarray]]:
    """((parts, table), bucket hashes, entries) of short sets. Sets of a ``hot`` bucket go to the buckets of the second level instead."""
    lo, hi = fold_lanes(wide, 2)
    split: dict[tuple[int, int], list[int]] = {}
    for p, u, h in hot:
        split.setdefault((p, u), []).append(h)
    for parts, which in short_classes(n, s):
        of, size, a, b = wide[:, which], n[which], lo[which], hi[which]
        for t, mask in enumerate(masks(parts, 0, WIDTH)):
            bucket = _mix_wide(of & mask[:, None], parts * 1024 + t)
            if (parts, t) not in split:
                yield (parts, t), bucket, _pack(parts, bucket, size, a, b)
                continue
            w = np.isin(bucket, np.array(split[parts, t], np.uint64))
            yield (parts, t), bucket[~w], _pack(parts, bucket[~w], size[~w], a[~w], b[~w])
            for u, second in enumerate(masks(parts, 1, WIDTH)):
                below = _mix_wide(of[:, w] & second[:, None], parts * 1024 + u + 512) ^ bucket[w]
                yield (parts, t), below, _pack(parts, below, size[w], a[w], b[w])


def _pack(parts: int, bucket: np.ndarray, n: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    out = np.empty(len(n), ENTRY)
    for name, value in zip(ENTRY.names, (bucket >> np.uint64(32), parts, n, lo, hi)):
        out[name] = value
    return out


def rare_words(words: list[str], counts: np.ndarray, s: float) -> np.ndarray:
    """Hashes of a long set's rarest words, as many as hold one of any similar set's; ``counts`` by the hash modulo COUNTERS order them, then the hash."""
    hashes = np.array([word_hash(w) for w in words], np.uint64)
    order = np.lexsort((hashes, counts[(hashes % np.uint64(COUNTERS)).astype(np.int64)]))
    return hashes[order[: len(words) - math.ceil(len(words) * s - 1e-9) + 1]]


def long_keys(words: list[str], own: int, counts: np.ndarray, s: float) -> np.ndarray:
    """The keys of a long set: its rare words; of one in over CELL sets those cells, by pairs of blocks, that its own block (by ``own``) is in."""
    out = []
    for h in rare_words(words, counts, s).tolist():
        blocks = -(-int(counts[h % COUNTERS]) // CELL)
        if blocks < 2:
            out.append(h)
        else:
            mine = own % blocks
            out += [(h + (min(mine, j) * blocks + max(mine, j) + 1) * 0x9E3779B97F4A7C15) % (1 << 64) for j in range(blocks)]
    return np.array(out, np.uint64)


class Sets(NamedTuple):
    """Columns of entries that are compared."""

    lo: np.ndarray
    hi: np.ndarray
    n: np.ndarray
    parts: np.ndarray

    def at(self, index: np.ndarray) -> Sets:
        return Sets(*(c[index] for c in self))


def _near(lanes: list[np.ndarray], n: np.ndarray, size: np.ndarray, s: float) -> Iterator[np.ndarray]:
    """Compares all members of each bucket, step by step for all buckets together; buckets lie one after the other, ``size`` long.

    Gives the folded sketches of pairs whose ``lanes`` are within the radius and whose sizes allow the similarity.
    """
    last = np.repeat(np.cumsum(size), size)
    at = np.flatnonzero(np.repeat(size > 1, size))
    lo, hi = fold_lanes(np.stack(lanes), 2)
    factor = (1 - s) / (1 + s)
    step = 1
    while len(at):
        at = at[at + step < last[at]]
        if not len(at):
            break
        b = at + step
        apart = sum(np.bitwise_count(x[at] ^ x[b]).astype(np.int64) for x in lanes)
        near = np.flatnonzero((apart <= (n[at] + n[b]) * factor + 1e-9) & (np.minimum(n[at], n[b]) >= np.maximum(n[at], n[b]) * s - 1e-9))
        if len(near):
            x, y = at[near], b[near]
            ok = (lo[x] != lo[y]) | (hi[x] != hi[y])
            x, y = x[ok], y[ok]
            yield np.stack([lo[x], hi[x], lo[y], hi[y]], 1)
        step += 1


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, sizes) of the runs of equal keys."""
    order = np.argsort(key)
    key = key[order]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return order, np.diff(np.append(start, len(key)))


def bucket_pairs(e: Sets, key: np.ndarray, s: float, level: int) -> Iterator[np.ndarray]:
    """The near pairs of each bucket (equal ``key``); buckets over PAIRED are split by the masks of the next level."""
    order, size = _groups(key)
    e = e.at(order)
    large = (size > PAIRED) & (level < LEVELS)
    if not large.any():
        yield from _near([e.lo, e.hi], e.n, size, s)
        return
    within = np.repeat(large, size)
    rest = e.at(~within)
    yield from _near([rest.lo, rest.hi], rest.n, size[~large], s)
    e, group = e.at(within), np.repeat(np.arange(large.sum(), dtype=np.uint64), size[large])
    for parts in np.unique(e.parts).tolist():
        at = e.parts == parts
        x, g = e.at(at), group[at]
        for t, (mlo, mhi) in enumerate(masks(parts, level)):
            yield from bucket_pairs(x, _mix(x.lo & mlo, (x.hi & mhi) ^ g * np.uint64(0x9E3779B97F4A7C15), t), s, level + 1)


def local_pairs(short: np.ndarray, long: np.ndarray, s: float) -> Iterator[np.ndarray]:
    """Near pairs among the entries of one task, in portions of bounded size: columns lo, hi of the one and of the other.

    Buckets are told apart by 32 or 64 bits of their hashes; a clash only adds a comparison.
    """

    def found() -> Iterator[np.ndarray]:
        for parts in np.unique(short["parts"]).tolist():
            of = short[short["parts"] == parts]
            yield from bucket_pairs(Sets(of["lo"].copy(), of["hi"].copy(), of["n"].astype(np.float64), of["parts"].copy()), of["key"].copy(), s, 1)
        if len(long):
            order, size = _groups(long["key"])
            wide = long["wide"][order]
            yield from _near([np.ascontiguousarray(wide[:, i]) for i in range(WIDTH // 64)], long["n"][order].astype(np.float64), size, s)

    held: list[np.ndarray] = []
    for pairs in found():
        held.append(pairs)
        if sum(map(len, held)) > 1 << 18:
            yield _ordered(np.concatenate(held))
            held = []
    if held:
        yield _ordered(np.concatenate(held))


def _ordered(pairs: np.ndarray) -> np.ndarray:
    swap = (pairs[:, 0] > pairs[:, 2]) | ((pairs[:, 0] == pairs[:, 2]) & (pairs[:, 1] > pairs[:, 3]))
    pairs[swap] = pairs[swap][:, [2, 3, 0, 1]]
    return np.unique(pairs, axis=0)


def lanes_of(column: pa.Array) -> np.ndarray:
    """A column of sketches as [lane, set]."""
    data = np.frombuffer(b"".join(column.to_pylist()), np.uint64)
    return np.ascontiguousarray(data.reshape(-1, WIDTH // 64).T)


def sketch_texts(texts: DataFrame) -> DataFrame:
    """``id lo hi n wide words`` of ``id text``: the sketch, also folded, and the sorted words joined by blanks. Texts without words are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: dict[str, int] = {}
        for batch in batches:
            for k in range(0, batch.num_rows, 2000):
                part = batch.slice(k, 2000)
                sets = [words_of(t) for t in part.column(1).to_pylist()]
                keep = np.array([i for i, w in enumerate(sets) if w], np.int64)
                if not len(keep):
                    continue
                if len(hashes) > 300_000:
                    hashes.clear()
                for ws in sets:
                    for w in ws:
                        if w not in hashes:
                            hashes[w] = word_hash(w) % WIDTH
                bits = np.array([hashes[w] for ws in sets for w in ws], np.int64)
                n = np.array([len(ws) for ws in sets], np.int64)[keep]
                wide = np.zeros(len(keep) * (WIDTH // 64), np.uint64)
                np.bitwise_xor.at(wide, np.repeat(np.arange(len(keep)), n) * (WIDTH // 64) + (bits >> 6), np.uint64(1) << (bits & 63).astype(np.uint64))
                wide = wide.reshape(len(keep), -1)
                lo, hi = fold_lanes(np.ascontiguousarray(wide.T), 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(keep)), pa.array(lo.view(np.int64)), pa.array(hi.view(np.int64)), pa.array(n, pa.int32()),
                        pa.array([row.tobytes() for row in wide], pa.binary()), pa.array([" ".join(sets[i]) for i in keep.tolist()]),
                    ],
                    ["id", "lo", "hi", "n", "wide", "words"],
                )

    kind = texts.schema["id"].dataType.simpleString()
    return texts.where("id is not null").select("id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"id {kind}, lo long, hi long, n int, wide binary, words string")


def _hot_buckets(sets: DataFrame, s: float, total: int) -> set[tuple[int, int, int]]:
    """Buckets that hold more than HOT of a bounded sample of the sets; only how the work is split depends on it."""
    if total < 100_000:
        return set()
    rows = sets.where(F.col("n") <= short_limit(s)).where(F.pmod(F.xxhash64("lo", "hi"), F.lit(max(1, total // SAMPLE))) == 0).limit(2 * SAMPLE).select("n", "wide").collect()
    if not rows:
        return set()
    n, wide = np.array([r.n for r in rows], np.int64), lanes_of(pa.array([bytes(r.wide) for r in rows], pa.binary()))
    hot: set[tuple[int, int, int]] = set()
    for (parts, table), bucket, _ in entries(n, wide, s, set()):
        value, count = np.unique(bucket, return_counts=True)
        hot |= {(parts, table, int(v)) for v in value[count > max(50, HOT * len(rows))]}
    return hot


def word_counts(long: DataFrame) -> np.ndarray:
    """In how many sets of ``words`` the words of each counter are, over all of them; summed per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            hashes = np.array([word_hash(w) for ws in batch.column(0).to_pylist() for w in ws.split(" ")], np.uint64)
            np.add.at(seen, (hashes % np.uint64(COUNTERS)).astype(np.int64), 1)
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(seen[used])], ["at", "n"])

    out = np.zeros(COUNTERS, np.int64)
    for r in long.select("words").mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r[0]] = r[1]
    return out


def near_sketches(sets: DataFrame, s: float) -> DataFrame:
    """``lo1 hi1 lo2 hi2``: distinct pairs of different sketches that may belong to similar sets; none is missed.

    ``sets``: ``lo hi n wide words`` (``words`` is only read for sets of ``long_from`` words or more).
    """
    limit, by_words = short_limit(s), long_from(s)
    sizes = sets.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("n") >= by_words).alias("long"), F.coalesce(F.sum(F.when(F.col("n") >= by_words, F.col("n"))), F.lit(0)).alias("words")).first()
    hot = _hot_buckets(sets, s, sizes.n)
    context = sets.sparkSession.sparkContext
    counted = context.broadcast(word_counts(sets.where(F.col("n") >= by_words)) if sizes.long else None)  # COUNTERS bounds it
    size = sizes.n * 24 * ENTRY.itemsize + int(sizes.words * (1 - s) + sizes.long) * LONG_ENTRY.itemsize
    tasks = max(context.defaultParallelism, math.ceil(size / TASK_BYTES))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blobs(kind: str, tables: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            if not tables:
                return
            to = np.concatenate([b for b, _ in tables]) % np.uint64(tasks)
            e = np.concatenate([x for _, x in tables])
            order = np.argsort(to, kind="stable")
            to, e = to[order], e[order]
            ids, first = np.unique(to, return_index=True)
            ends = np.append(first[1:], len(e))
            data = [e[a:b].tobytes() for a, b in zip(first.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), pa.array([kind] * len(ids)), pa.array(data, pa.binary())], ["task", "kind", "data"])

        for batch in batches:
            n = batch.column(2).to_numpy().astype(np.int64)
            wide = lanes_of(batch.column(3))
            short = n <= limit
            yield from blobs("short", [(b, e) for _, b, e in entries(n[short], wide[:, short], s, hot)])
            long = np.flatnonzero(n >= by_words)
            own = fold_lanes(wide[:, long], 1)[0]
            tables = []
            for at, i in enumerate(long.tolist()):
                key = long_keys(batch.column(4)[i].as_py().split(" "), int(own[at]), counted.value, s)
                e = np.empty(len(key), LONG_ENTRY)
                e["key"], e["n"], e["wide"] = key, n[i], wide[:, i]
                tables.append((_mix(key, key, 0), e))
            yield from blobs("long", tables)

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {"short": [], "long": []}
        for batch in batches:
            for kind, data in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                held[kind].append(data)
        for pairs in local_pairs(np.frombuffer(b"".join(held["short"]), ENTRY), np.frombuffer(b"".join(held["long"]), LONG_ENTRY), s):
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, i]).view(np.int64)) for i in range(4)], ["lo1", "hi1", "lo2", "hi2"])

    slim = sets.select("lo", "hi", "n", "wide", F.when(F.col("n") >= by_words, F.col("words")).alias("words"))
    sent = slim.mapInArrow(spread, "task int, kind string, data binary").repartitionById(tasks, "task")
    return sent.mapInArrow(pair, "lo1 long, hi1 long, lo2 long, hi2 long").distinct()


def similar_sets(sketched: DataFrame, s: float) -> DataFrame:
    """``lo1 hi1 w1 lo2 hi2 w2``: pairs of different word sets with similarity ``s`` or more (``w``: hash of the words)."""
    sets = sketched.select("lo", "hi", "n", "words")
    # what is hashed by its words or by more bits than the folded ones stays apart by them
    kept = sketched.select("lo", "hi", "n", "wide", F.when(F.col("n") >= long_from(s), F.col("words")).alias("words"), F.xxhash64("words").alias("w"))
    one = durable(kept.groupBy("lo", "hi", "n", "wide", "words").agg(F.min("w").alias("w"), (F.min("w") != F.max("w")).alias("several")), "sets")
    pairs = durable(near_sketches(one, s), "pairs")
    # sketches whose sets differ nevertheless, in size or not, are pairs with themselves
    twins = one.groupBy("lo", "hi").agg((F.max("several") | (F.min("w") != F.max("w"))).alias("several")).where("several")
    twins = twins.select(F.col("lo").alias("lo1"), F.col("hi").alias("hi1"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    asked = pairs.union(twins.distinct())
    needed = asked.select(F.col("lo1").alias("lo"), F.col("hi1").alias("hi")).union(asked.select("lo2", "hi2")).distinct()
    words = durable(sets.join(needed, ["lo", "hi"], "left_semi").distinct(), "words")
    side = lambda k: words.select(F.col("lo").alias(f"lo{k}"), F.col("hi").alias(f"hi{k}"), F.col("n").alias(f"n{k}"), F.col("words").alias(f"words{k}"))
    both = asked.join(side(1), ["lo1", "hi1"]).join(side(2), ["lo2", "hi2"]).where("words1 != words2")
    both = both.where(F.least("n1", "n2") >= F.greatest("n1", "n2") * s - F.lit(1e-9))
    common = F.size(F.array_intersect(F.split("words1", " "), F.split("words2", " ")))
    union = F.size(F.split("words1", " ")) + F.size(F.split("words2", " ")) - common
    alike = both.where(common >= union * s - F.lit(1e-9))
    return alike.select("lo1", "hi1", F.xxhash64("words1").alias("w1"), "lo2", "hi2", F.xxhash64("words2").alias("w2"))


def record_texts(staged: DataFrame) -> DataFrame:
    """``id text``: both texts of each staged record, each once."""
    own = staged.select("id", "text").union(staged.select("id", F.col("imported.text")))
    return own.where("id is not null and text is not null").distinct()


def similar_pairs(texts: DataFrame, s: float = 0.8) -> DataFrame:
    """``id_a id_b`` with ``id_a < id_b``: ids one of whose texts is similar to one of the other's, each pair once.

    ``texts`` has ``id text``, several rows per id allowed. Similarity: distinct
    words in both by words in either, ``s`` or more. Null texts, and texts
    without a word, are similar to nothing; null ids are left out; repeated rows
    count once; texts of any length are compared whole; an empty table gives an
    empty result; other columns are ignored. Equal texts are expanded to all
    their pairs here; :func:`similar_groups` is the form without that.
    """
    sketched = durable(sketch_texts(texts), "sketched")
    sets = similar_sets(sketched, s)
    owners = sketched.select("id", "lo", "hi", F.xxhash64("words").alias("w")).distinct()
    side = lambda k: owners.select(F.col("id").alias(f"id{k}"), F.col("lo").alias(f"lo{k}"), F.col("hi").alias(f"hi{k}"), F.col("w").alias(f"w{k}"))
    apart = sets.join(side(1), ["lo1", "hi1", "w1"]).join(side(2), ["lo2", "hi2", "w2"]).select("id1", "id2")
    same = side(1).join(side(2), [F.col("lo1") == F.col("lo2"), F.col("hi1") == F.col("hi2"), F.col("w1") == F.col("w2")]).where("id1 < id2").select("id1", "id2")
    pairs = apart.where("id1 != id2").union(same)
    return pairs.select(F.least("id1", "id2").alias("id_a"), F.greatest("id1", "id2").alias("id_b")).distinct()


def similar_groups(texts: DataFrame, s: float = 0.8) -> DataFrame:
    """``group_id id n_links``: each id in a group of two or more; ``n_links`` counts the different other word sets it is similar to.

    Copies hang on their common word set, so their number costs nothing but
    their rows. Nulls, empty texts and repeats as in :func:`similar_pairs`.
    """
    sketched = durable(sketch_texts(texts), "sketched")
    sets = durable(similar_sets(sketched, s), "similar")
    name = lambda k="": F.unhex(F.md5(F.concat_ws("/", f"lo{k}", f"hi{k}", F.col("w" + k) if k else F.xxhash64("words"))))
    links = sets.select(name("1").alias("a"), name("2").alias("b"))
    counts = links.union(links.select("b", "a")).groupBy("a").agg(F.countDistinct("b").alias("n")).withColumnRenamed("a", "set")
    owners = durable(sketched.select("id", name().alias("set")).distinct(), "owners")
    # Sets are the vertices; the sets of one id belong together, and only those in some link or of such an id are on the way.
    several = owners.groupBy("id").agg(F.min("set").alias("v"), F.max("set").alias("top")).where("v != top")
    own = owners.join(several, "id").where("set != v").select(F.col("set").alias("u"), "v")
    roots = seed_forest(links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(own))
    of = owners.join(roots.withColumnRenamed("node", "set"), "set", "left").select(F.coalesce("root", "set").alias("root"), "id").distinct()
    of = durable(of, "of")
    groups = of.groupBy("root").agg(F.min("id").alias("group_id"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    grouped = salted_join(of, groups, "root", "id", hot_keys_of(of, "root")).select("group_id", "id")
    degree = owners.join(counts, "set").groupBy("id").agg(F.sum("n").alias("n_links"))
    return grouped.join(degree, "id", "left").select("group_id", "id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
