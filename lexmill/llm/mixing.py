"""Mixing sources to target weights by Poisson replication.

Each text gets a uniform number from a seeded hash; the inverse of the Poisson
distribution with the rate of its source turns it into a number of copies, cut
off at the cap. Rates are solved from a bounded histogram of the hash numbers
by source, so that the tokens drawn, not only those expected, meet the targets;
the number at which the last copies begin is then looked up in finer and finer
histograms of the one bin it is in, so that a source misses its share by no
more than one document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.encoding import token_counts
from lexmill.session import durable

#: Bins of a histogram, and how often a bin is divided again into as many.
BINS = 4096
DEPTH = 4


def copies_at(u: float, rate: float, cap: int) -> int:
    """The inverse Poisson distribution at ``u``, at most ``cap``."""
    if math.isinf(rate):
        return cap
    p = total = math.exp(-rate)
    k = 0
    while u > total and k < cap:
        k += 1
        p *= rate / k
        total += p
    return k


def starts_at(rate: float, cap: int) -> list[int]:
    """The bins at which each further copy begins; a bin counts at its middle."""
    starts: list[int] = []
    for k in range(1, cap + 1):
        lo, hi = 0, BINS  # the first bin with k copies or more
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if copies_at((mid + 0.5) / BINS, rate, cap) >= k else (mid + 1, hi)
        starts.append(lo)
    return starts


def drawn(histogram: dict[int, int], starts: list[int]) -> int:
    """Tokens that a source gives."""
    return sum(n * sum(b >= x for x in starts) for b, n in histogram.items())


def solve_rate(histogram: dict[int, int], want: float, cap: int) -> tuple[float, float]:
    """Two neighbouring rates between which a source's drawn tokens pass ``want``; infinite where every copy is needed."""
    size = sum(histogram.values())
    if want >= size * cap * (1 - 1e-9):
        return math.inf, math.inf
    given = lambda rate: drawn(histogram, starts_at(rate, cap))
    lo, hi = 0.0, 1.0
    while given(hi) < want and hi < 64 * cap + 64:
        hi *= 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if given(mid) < want else (lo, mid)
    return lo, hi


def fill(histogram: dict[int, int], top: int, least: int, need: float) -> tuple[int, float]:
    """(bin, rest): bins from ``top`` - 1 down to ``least`` fit into ``need`` as far as the returned one, exclusive; what is left of it."""
    at = top
    while at > least and histogram.get(at - 1, 0) <= need:
        at -= 1
        need -= histogram.get(at, 0)
    return at, need


class Source:
    """Where the copies of a source begin: whole bins first, then one that is looked into."""

    def __init__(self, histogram: dict[int, int], want: float, cap: int):
        self.open: tuple[int, int, float] | None = None  # copy, number of the bin looked into, tokens wanted of it
        low, high = solve_rate(histogram, want, cap)
        self.starts, ends = starts_at(low, cap), starts_at(high, cap)
        need = want - drawn(histogram, self.starts)
        for k, least in enumerate(ends):
            if self.open is None and self.starts[k] > least:
                self.starts[k], need = fill(histogram, self.starts[k], least, need)
                if self.starts[k] > least:
                    self.open = (k, self.starts[k] - 1, need)

    def refine(self, histogram: dict[int, int], texts: dict[int, int], last: bool) -> None:
        """One histogram further: all starts become numbers of its bins."""
        self.starts = [x * BINS for x in self.starts]
        if self.open is None:
            return
        k, bin_, need = self.open
        inner, need = fill(histogram, BINS, 0, need)
        if inner and need > 0 and (last or texts.get(inner - 1, 0) == 1):  # nothing to divide: the nearer of both
            inner, need = (inner - 1, 0.0) if histogram.get(inner - 1, 0) < 2 * need else (inner, 0.0)
        self.starts[k] = bin_ * BINS + inner
        self.open = (k, self.starts[k] - 1, need) if inner and need > 0 else None


def copies_column(number: Column, starts: dict[str, list[int]], source: Column) -> Column:
    """Copies of a text by its number."""
    out = F.lit(0)
    for name, places in sorted(starts.items()):
        n = F.lit(0)
        for b in places:
            n = n + (number >= F.lit(b).cast("long")).cast("int")
        out = F.when(source == name, n).otherwise(out)
    return out


def solve_starts(texts: DataFrame, goals: dict[str, tuple[float, int]], histograms: dict[str, dict[int, int]]) -> dict[str, list[int]]:
    """Per source the numbers from which on each further copy is drawn; ``goals``: tokens wanted and cap."""
    sources = {s: Source(h, *goals[s]) for s, h in histograms.items()}
    for depth in range(1, DEPTH):
        inside = F.lit(False)
        width = BINS ** (DEPTH - depth)
        for s, x in sources.items():
            if x.open is not None:  # a range of numbers, which the scan can use
                inside |= (F.col("source") == s) & F.col("number").between(x.open[1] * width, (x.open[1] + 1) * width - 1)
        finer: dict[str, dict[int, int]] = {}
        counts: dict[str, dict[int, int]] = {}
        if any(x.open is not None for x in sources.values()):
            at = F.pmod(F.shiftright("number", 12 * (DEPTH - 1 - depth)), F.lit(BINS)).cast("int")
            for r in texts.where(inside).groupBy("source", at.alias("bin")).agg(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("texts")).collect():
                finer.setdefault(r.source, {})[r.bin] = r.n
                counts.setdefault(r.source, {})[r.bin] = r.texts
        for s, x in sources.items():
            x.refine(finer.get(s, {}), counts.get(s, {}), depth == DEPTH - 1)
    return {s: x.starts for s, x in sources.items()}


def mix(docs: DataFrame, targets: DataFrame, seed: int = 42, total_tokens: int | None = None, ranks_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(chosen, shares).

    ``docs``: ``doc_id source text``; ``targets``: ``source target_share
    max_repeats``, a bounded table with one row per source. ``chosen`` has
    ``doc_id source copy_no n_tokens`` in a global random order, ``shares`` one
    row per target: ``source target_share actual_share tokens texts copies
    max_repeats``.

    Without ``total_tokens`` the mixture is as large as the scarcest source
    allows at its cap. With more than that, scarce sources stay at their caps
    and their actual shares below the targets. A text that occurs under several
    ids counts once, under its smallest id, so that no text is used more than
    ``max_repeats`` times. Null, empty and token-less texts, null ids, and
    sources that are null or no target, are not used. Targets without a text
    get the share 0, and the others share in proportion. Nulls and negative
    numbers in targets count as 0; of targets given twice the first by share
    counts. Other columns are ignored.
    """
    spark = docs.sparkSession
    goals: dict[str, tuple[float, int]] = {}
    for r in targets.select("source", "target_share", "max_repeats").orderBy("source", "target_share").collect():
        if r.source is not None:
            goals.setdefault(r.source, (max(0.0, r.target_share or 0.0), max(0, r.max_repeats or 0)))
    known = docs.where(F.col("doc_id").isNotNull() & F.col("source").isin(sorted(goals)) & (F.length("text") > 0))
    slim = known.select("doc_id", "source", F.col("text").cast("string").alias("text"))
    sized = token_counts(slim.withColumn("h", F.unhex(F.md5("text"))), "text", "n_tokens", ranks_path)
    # one row per distinct text, found by its hash: only ids, hashes and sizes are shuffled
    texts = sized.groupBy("h").agg(F.min(F.struct("doc_id", "source", "n_tokens")).alias("t")).where("t.n_tokens > 0")
    number = F.pmod(F.xxhash64(F.col("h"), F.lit(seed)), F.lit(BINS**DEPTH).cast("long"))
    texts = durable(texts.select("t.doc_id", "t.source", "t.n_tokens", number.alias("number")), "sized")
    bins = texts.groupBy("source", F.shiftright("number", 12 * (DEPTH - 1)).cast("int").alias("bin")).agg(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("texts")).collect()
    histograms: dict[str, dict[int, int]] = {}
    counts: dict[str, int] = {}
    for r in bins:
        histograms.setdefault(r.source, {})[r.bin] = r.n
        counts[r.source] = counts.get(r.source, 0) + r.texts
    usable = {s: h for s, h in histograms.items() if goals[s][0] > 0 and goals[s][1] > 0}
    whole = sum(goals[s][0] for s in usable)
    if total_tokens is None:
        total_tokens = min((goals[s][1] * sum(h.values()) / (goals[s][0] / whole) for s, h in usable.items()), default=0)
    starts = solve_starts(texts, {s: (total_tokens * goals[s][0] / whole, goals[s][1]) for s in usable}, usable)
    counted = texts.withColumn("copies", copies_column(F.col("number"), starts, F.col("source"))).where("copies > 0")
    chosen = counted.select("doc_id", "source", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy_no"), "n_tokens")
    chosen = chosen.orderBy(F.xxhash64("doc_id", "copy_no", F.lit(seed)), "doc_id", "copy_no")
    got = counted.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.count(F.lit(1)).alias("texts"), F.sum("copies").alias("copies")).collect()
    tokens = {r.source: (r.tokens, r.texts, r.copies) for r in got}
    every = sum(t[0] for t in tokens.values())
    rows = [(s, share, tokens.get(s, (0, 0, 0))[0] / every if every else 0.0, *tokens.get(s, (0, 0, 0)), cap) for s, (share, cap) in sorted(goals.items())]
    shares = spark.createDataFrame(rows, "source string, target_share double, actual_share double, tokens long, texts long, copies long, max_repeats int")
    return chosen, shares
