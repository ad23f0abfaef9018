"""Periodic runs of words by internal pattern matching.

A run is a stretch of words with smallest period p, at least ``repeats`` * p
and ``least`` words long, that no neighbouring word extends. Texts of a task
are searched in groups, as one array of word numbers with bounds between them.

Let B be the power of two with p <= B < 2p. A run of four periods or more
holds a whole dyadic block of B words (one that starts at a multiple of B), and
on one side of it there's room for a period more. As the block is no shorter
than the period, its nearest occurrence on that side is p words away, and its
occurrences go on in steps of p. So it's enough to ask, for every dyadic block,
for the nearest occurrence in the window of B words before it and behind it.

Occurrences of a block are a range of the suffix array; the nearest one is a
range successor or predecessor in a wavelet tree over that array. The ranks of
all dyadic substrings, from which the suffix array is built, also give common
extensions to the left and right, so each candidate is extended to its run.

Before that, stretches that can't hold a run are left out: in a run, each word
but those of the last period comes again within B words. That loses no run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagframe.llm.common import map_columns, pick

REPEATS = 4          # periods of a run, at least; the method needs four
LEAST_WORDS = 6      # words of a run, at least
GROUP_WORDS = 1 << 18    # words searched at once; a longer text is searched alone
RUN_SCHEMA = ("doc_id long, n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, "
              "collapsed string")


def ranked(keys: np.ndarray) -> np.ndarray:
    """Dense ranks of the keys."""
    order = np.argsort(keys, kind="stable")
    new = np.empty(len(keys), dtype=np.int32)
    new[0] = 0
    sorted_keys = keys[order]
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    out = np.empty(len(keys), dtype=np.int32)
    out[order] = np.cumsum(new, dtype=np.int32)
    return out


class DyadicRanks:
    """Ranks of all substrings whose length is a power of two, and the suffix array.

    The words must end in one that occurs nowhere else.
    """

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.ranks = [ranked(words)]
        while int(self.ranks[-1].max()) < n - 1:
            known, step = self.ranks[-1].astype(np.int64), 1 << len(self.ranks) - 1
            behind = np.zeros(n, dtype=np.int64)
            behind[:n - step] = known[step:] + 1
            self.ranks.append(ranked(known * (n + 1) + behind))
        self.suffixes = np.argsort(self.ranks[-1]).astype(np.int32)

    def rank(self, order: int) -> np.ndarray:
        return self.ranks[min(order, len(self.ranks) - 1)]

    def occurrences(self, order: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of the suffix array that open with the substrings of 2^order words at ``at``."""
        ranks = self.rank(order)
        sorted_ranks = ranks[self.suffixes]
        return np.searchsorted(sorted_ranks, ranks[at], "left"), np.searchsorted(sorted_ranks, ranks[at], "right")

    def common(self, a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
        """Words that agree from ``a`` and ``b`` on, or before them, where a < b."""
        a, b, n = a.copy(), b.copy(), len(self.suffixes)
        out = np.zeros(len(a), dtype=np.int64)
        for order in range(len(self.ranks) - 1, -1, -1):
            ranks, step = self.ranks[order], 1 << order
            x, y = (a, b) if forward else (a - step, b - step)
            inside = (y < n) if forward else (x >= 0)
            same = inside & (ranks[np.where(inside, x, 0)] == ranks[np.where(inside, y, 0)])
            moved = np.where(same, step, 0)
            out += moved
            a, b = (a + moved, b + moved) if forward else (a - moved, b - moved)
        return out


class WaveletTree:
    """A permutation of 0..n-1, split level by level by the bits of its values."""

    def __init__(self, values: np.ndarray):
        self.levels: list[tuple[int, np.ndarray]] = []     # (bit, zeros before each place)
        for bit in range(max(1, int(len(values) - 1).bit_length()) - 1, -1, -1):
            zero = (values >> bit & 1) == 0
            self.levels.append((bit, np.concatenate([[0], np.cumsum(zero)]).astype(np.int32)))
            values = np.concatenate([values[zero], values[~zero]])

    def below(self, left: np.ndarray, right: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of the places left to right - 1 are under ``bound``."""
        out = np.zeros(len(left), dtype=np.int64)
        for bit, zeros in self.levels:
            l0, r0, all0 = zeros[left], zeros[right], int(zeros[-1])
            one = (bound >> bit & 1).astype(bool)
            out += np.where(one, r0 - l0, 0)
            left, right = np.where(one, all0 + left - l0, l0), np.where(one, all0 + right - r0, r0)
        return out

    def kth(self, left: np.ndarray, right: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th least value (from 0) of the places left to right - 1."""
        out = np.zeros(len(left), dtype=np.int64)
        k = k.copy()
        for bit, zeros in self.levels:
            l0, r0, all0 = zeros[left], zeros[right], int(zeros[-1])
            one = k >= r0 - l0
            k -= np.where(one, r0 - l0, 0)
            out += np.where(one, 1 << bit, 0)
            left, right = np.where(one, all0 + left - l0, l0), np.where(one, all0 + right - r0, r0)
        return out


def recurring_stretches(words: np.ndarray, repeats: int, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(order, starts, ends) of the stretches that may hold runs of period 2^order / 2 < p <= 2^order."""
    n = len(words)
    order = np.argsort(words, kind="stable")
    again = words[order[1:]] == words[order[:-1]]
    ahead = np.full(n, n + 1, dtype=np.int64)
    ahead[order[:-1][again]] = (order[1:] - order[:-1])[again]
    for k in range(n.bit_length()):
        block = 1 << k
        period = block // 2 + 1
        if repeats * period > n:
            break
        edges = np.flatnonzero(np.diff(np.concatenate([[False], ahead <= block, [False]]).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        kept = ends - starts >= max(repeats * period, least) - period
        if kept.any():
            yield k, starts[kept], np.minimum(ends[kept] + block, n)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of stretches, as disjoint ones in order."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate([[True], starts[1:] > ends[:-1]])
    return starts[first], ends[np.concatenate([np.flatnonzero(first)[1:] - 1, [len(ends) - 1]])]


def block_candidates(ranks: DyadicRanks, tree: WaveletTree, order: int, starts: np.ndarray,
                     ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of neighbouring occurrences of the dyadic blocks in the stretches."""
    block = 1 << order
    first, last = -(-starts // block), ends // block - 1
    count = np.maximum(last - first + 1, 0)
    at = (np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())) * block
    left, right = ranks.occurrences(order, at)
    several = right - left > 1
    at, left, right = at[several], left[several], right[several]
    before = tree.below(left, right, at)
    has_next, has_last = before + 1 < right - left, before > 0
    following = tree.kth(left[has_next], right[has_next], before[has_next] + 1)
    previous = tree.kth(left[has_last], right[has_last], before[has_last] - 1)
    place = np.concatenate([at[has_next], previous])
    distance = np.concatenate([following - at[has_next], at[has_last] - previous])
    near = (2 * distance > block) & (distance <= block)
    return place[near], distance[near]


def find_runs(words: np.ndarray, repeats: int = REPEATS, least: int = LEAST_WORDS) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start, then period.

    Bounds between texts are numbers that occur once. ``repeats`` is four or more.
    """
    if repeats < 4:
        raise ValueError("dyadic blocks find runs of four periods or more")
    none = np.empty((0, 3), dtype=np.int64)
    found = list(recurring_stretches(words, repeats, least)) if len(words) else []
    if not found:
        return none
    starts, ends = merged(np.concatenate([s for _, s, _ in found]), np.concatenate([e for _, _, e in found]))
    # only the stretches themselves are indexed, one behind the other with a bound of its own behind each
    sizes = ends - starts + 1
    shift = starts - np.cumsum(sizes) + sizes
    source = np.repeat(shift, sizes) + np.arange(sizes.sum())
    bound = np.cumsum(sizes) - 1
    source[bound] = 0
    text = words[source].astype(np.int64)
    text[bound] = int(words.max()) + 1 + np.arange(len(bound))
    ranks = DyadicRanks(text)
    tree = WaveletTree(ranks.suffixes)
    runs = [none]
    for order, s, e in recurring_stretches(text, repeats, least):
        place, period = block_candidates(ranks, tree, order, s, e)
        if len(place):
            place, period = np.unique(np.stack([place, period]), axis=1)
            start = place - ranks.common(place, place + period, forward=False)
            end = place + period + ranks.common(place, place + period, forward=True)
            long = end - start >= np.maximum(repeats * period, least)
            runs.append(np.unique(np.stack([start, end, period], axis=1)[long], axis=0))
    runs = np.concatenate(runs)
    # a multiple of the period is a period of the same stretch; the least one is the run's
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    runs = runs[np.concatenate([[True], (np.diff(runs[:, :2], axis=0) != 0).any(axis=1)])[:len(runs)]]
    back = shift[np.searchsorted(bound, runs[:, 0])]
    runs[:, 0] += back
    runs[:, 1] += back
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def runs_of_texts(texts: list[list[bytes]], repeats: int, least: int) -> list[np.ndarray]:
    """The runs of each list of words, as rows (start, end, period)."""
    number: dict[bytes, int] = {}
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    first = np.cumsum(sizes + 1) - sizes - 1
    words = np.empty(int(sizes.sum()) + len(texts), dtype=np.int64)
    for at, n, text in zip(first.tolist(), sizes.tolist(), texts, strict=True):
        words[at:at + n] = [number.setdefault(w, len(number)) for w in text]
    words[first + sizes] = len(number) + np.arange(len(texts))
    runs = find_runs(words, repeats, least)
    of = np.searchsorted(first, runs[:, 0], "right") - 1
    runs[:, :2] -= first[of][:, None]
    cuts = np.searchsorted(of, np.arange(len(texts) + 1))
    return [runs[a:b] for a, b in zip(cuts, cuts[1:])]


def without_repeats(words: list[bytes], runs: np.ndarray) -> str:
    """The words that no run contains after its first period, joined by spaces."""
    if len(runs):
        step = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(step, runs[:, 0] + runs[:, 2], 1)
        np.add.at(step, runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()]
    return b" ".join(words).decode()


def periodic_runs(docs: DataFrame, repeats: int = REPEATS, least: int = LEAST_WORDS,
                  rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, n_words, runs and collapsed text of every document.

    Words are what lies between spaces and the ASCII controls 9 to 13, of
    the whole text; ``rewrite`` may change a document's words before the search.
    ``runs`` lists start, length and period by start, then period;
    ``collapsed`` holds the words left once every run is cut back to its first
    period. Null, empty and wordless texts have no runs and an empty collapsed text.
    Repeated rows and null doc_ids give a row each; an empty table gives none.
    Nothing is shuffled. A task holds a group of texts; the index grows with the
    longest stretch of recurring words, not with the text.
    """

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            texts = [(t or "").encode().split() for t in batch["text"]]
            if rewrite:
                texts = [rewrite(d, w) for d, w in zip(batch["doc_id"], texts, strict=True)]
            group, size = 0, 0
            found: list[np.ndarray] = []
            for i, text in enumerate(texts):
                if size and size + len(text) > GROUP_WORDS:
                    found += runs_of_texts(texts[group:i], repeats, least)
                    group, size = i, 0
                size += len(text)
            found += runs_of_texts(texts[group:], repeats, least)
            yield {"doc_id": batch["doc_id"], "n_words": [len(t) for t in texts],
                   "runs": [[{"start": s, "length": e - s, "period": p} for s, e, p in r.tolist()] for r in found],
                   "collapsed": [without_repeats(t, r) for t, r in zip(texts, found, strict=True)]}

    return map_columns(pick(docs, "doc_id", "text"), work, RUN_SCHEMA)


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the run of greatest exact exponent, and digests of the runs and of the collapsed text.

    Ties of the exponent go to the smallest start, then period; without a run its four columns are null.
    """
    best = F.expr("""aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), (b, r) ->
        if(b is null or r.length * b.period > b.length * r.period, r, b))""")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                    F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))
