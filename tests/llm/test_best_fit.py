"""Bulk-synchronous best fit against plain best fit and plain sweeps."""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from lagframe.llm import best_fit, tokens

DOCS = "doc_id long, text string, TEXT string, sequence_id long, length string"
TOKENS = 256


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(tokens.tokenizer_path())
    t.encode_special_tokens = True
    return lambda text: np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")


def text(rng, n):
    return " ".join(f"w{rng.randint(0, 99)}" for _ in range(n))


def plain_best_fit(sizes, capacity):
    """Number of sequences that best fit decreasing opens."""
    rooms = []
    for s in sorted(sizes, reverse=True):
        i = bisect_left(rooms, s)
        room = rooms.pop(i) if i < len(rooms) else capacity
        opened = i >= len(rooms) and room == capacity
        if room - s:
            insort(rooms, room - s)
        yield int(opened)


def check(rows, docs, plain, capacity):
    """Every id once, sequences gapless and within capacity, only longer documents cut."""
    ids = [(d, plain(t)) for d, t in docs]
    sequences, pieces = defaultdict(list), Counter()
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)] += 1
    expected = Counter()
    for d, x in ids:
        head = (len(x) - 1) % capacity + 1
        bounds = [0, *range(head, len(x) + 1, capacity)]
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            expected[(d, i, a, b - a, zlib.crc32(x[a:b].tobytes()))] += 1
    assert pieces == expected
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(sequences), [k[3] for k in expected.elements()]


def test_packs_all_awkward_rows(spark, plain):
    rng = random.Random(1)
    texts = [None, "", " \n", "one"] + [text(rng, n) for n in (3000, 120, 60, 60, 60, 5, 5, 5)] + ["a"] * 40
    rows = [(i, t, "x", 7, "y") for i, t in enumerate(texts)] + [(7, texts[7], "x", 7, "y"), (None, "here", None, None, None)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    found = best_fit.pack_best_fit(docs, tokens.tokenizer_path(), TOKENS).collect()
    check(found, [r[:2] for r in rows], plain, TOKENS)
    assert not best_fit.pack_best_fit(docs.limit(0), tokens.tokenizer_path(), TOKENS).collect()


@pytest.mark.parametrize("kind", ["prose", "small", "equal"])
def test_as_few_sequences_as_plain_best_fit(spark, plain, kind):
    """Small documents only, or a third of equal ones, need no more sequences to speak of."""
    rng = random.Random(2)
    sizes = {"prose": [int(rng.lognormvariate(3.2, 1.2)) + 1 for _ in range(900)],
             "small": [rng.randint(1, 9) for _ in range(2500)],
             "equal": [27] * 300 + [rng.randint(1, 60) for _ in range(600)]}[kind]
    rows = [(i, text(rng, n), None, None, None) for i, n in enumerate(sizes)]
    found = best_fit.pack_best_fit(spark.createDataFrame(rows, DOCS).repartition(5), tokens.tokenizer_path(), TOKENS).collect()
    n, lengths = check(found, [r[:2] for r in rows], plain, TOKENS)
    best = max(-(-sum(lengths) // TOKENS), sum(plain_best_fit(lengths, TOKENS)))
    assert n <= 1.02 * best + 2, (kind, n, best)


def plain_sweep(is_gap):
    stack, pairs, alone = [], [], []
    for i, gap in enumerate(is_gap):
        if gap:
            stack.append(i)
        elif stack:
            pairs.append((i, stack.pop()))
        else:
            alone.append(i)
    return sorted(pairs), alone, stack


def test_sweep_within_and_across_ranges():
    rng = np.random.default_rng(3)
    for share in (0.2, 0.5, 0.8):
        for _ in range(40):
            is_gap = rng.random(rng.integers(1, 60)) < share
            expected = plain_sweep(is_gap)
            p, g, alone, left = best_fit.nearest_open(is_gap)
            assert sorted(zip(p.tolist(), g.tolist())) == expected[0]
            assert alone.tolist() == expected[1] and left.tolist() == expected[2]
            pairs, pieces, gaps, at = [], {}, {}, 0
            for part, chunk in enumerate(np.array_split(is_gap, 7)):
                if len(chunk):
                    p, g, alone, left = best_fit.nearest_open(chunk)
                    pairs += zip((p + at).tolist(), (g + at).tolist())
                    pieces[part], gaps[part] = (alone + at).tolist(), (left + at).tolist()
                    at += len(chunk)
            for part, first, n, gap_part, top in best_fit.across([(k, len(pieces[k]), len(gaps[k])) for k in pieces]):
                pairs += [(pieces[part][first + i], gaps[gap_part][top - i]) for i in range(n)]
            assert sorted(pairs) == expected[0]


def test_slots_suffice_without_excess():
    rooms = {3: 5, 10: 4, 25: 1000}
    slots = best_fit.offered_slots(rooms, 50, 5)
    assert [slots[r] for r in rooms] == [0, 2, 1]
    slots = best_fit.offered_slots(rooms, 5 * 1000 + 9, 5)
    assert [slots[r] for r in rooms] == [0, 2, 5]


def test_counts_foretell_the_sweep():
    rng = np.random.default_rng(4)
    for _ in range(60):
        sizes = rng.integers(20, 41, rng.integers(1, 60))
        widths = rng.integers(20, 41, rng.integers(1, 60))
        order = sorted([(-w, 0) for w in widths.tolist()] + [(-s, 1) for s in sizes.tolist()])
        alone = plain_sweep(np.array([kind == 0 for _, kind in order]))[1]
        expected = Counter(-order[i][0] for i in alone)
        assert best_fit.left_behind(Counter(sizes.tolist()), Counter(widths.tolist())) == dict(expected)
