"""Collocations against plain counting, and the sort against sorting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lagframe.llm import collocations

DOCS = "doc_id long, text string, lang string, Lang2 string, PHRASE string, n long"


def plain(rows, top, least, max_words, percent):
    counts, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            ws = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(ws)
            for k in range(1, max_words + 1):
                for i in range(len(ws) - k + 1):
                    counts[lang][tuple(ws[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        found = []
        for p, a in candidates.items():
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            inside = any(len(q) > len(p) and 100 * b >= percent * a
                         and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in candidates.items())
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def table():
    rng = random.Random(5)
    vocabulary = ["The", "of", "a", "é", "ÉTÉ", "x'y", "w\x01", "\x1cz", "日本"] + [f"w{i}" for i in range(25)]
    texts = [None, "", " \t\r", ".,;", "one"]
    for _ in range(160):
        ws = []
        for _ in range(rng.randint(1, 60)):
            ws += rng.choice([["The"], ["the", "of", "a"], ["New", "York"], ["w1", "w2", "w3", "w4"], [rng.choice(vocabulary)]])
        texts.append("".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b"]) for w in ws))
    texts.append("a " * 3000)
    langs = ["en", "fr", None, "und", ""]
    rows = [(i, t, langs[i % 7 % 5], "x", "y", 1) for i, t in enumerate(texts)]
    return rows + [rows[9], (None, texts[20], None, None, None, None)]


@pytest.mark.parametrize("parts,max_words,held", [(1000, 3, 300_000), (20, 3, 50), (2, 4, 50), (100_000, 2, 7)])
def test_equals_plain_counting(spark, monkeypatch, parts, max_words, held):
    """Few and many heavy prefixes, full and early sending, sorts of a part of a task."""
    monkeypatch.setattr(collocations, "LEAST_PARTS", parts)
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 20 * held)
    monkeypatch.setattr(collocations, "SMALL_PART", held)
    monkeypatch.setattr(collocations, "ROUTED_BATCH_ROWS", 5 + held // 100)
    monkeypatch.setattr(collocations, "SORTED_POINTERS", 10 * held)
    rows = table()
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    found = collocations.collocations(docs, top=40, least=4, max_words=max_words).collect()
    assert sorted(map(tuple, found)) == plain(rows, 40, 4, max_words, 50)


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert not collocations.collocations(docs).collect()


@pytest.mark.parametrize("small", [0, 7, 4096])
def test_three_way_sort_counts_prefixes(monkeypatch, small):
    monkeypatch.setattr(collocations, "SMALL_PART", small)
    rng = np.random.default_rng(6)
    words = rng.integers(0, 6, (500, 3)).astype(np.int32)
    words[rng.random(500) < 0.2, 2] = -1
    weights = rng.integers(1, 4, 500)
    found = {tuple(words[at, :d]): n for d, at, n in collocations.three_way(words, weights, np.arange(500), 9)}
    expected = Counter()
    for row, w in zip(words.tolist(), weights.tolist()):
        for d in (1, 2, 3):
            if -1 not in row[:d]:
                expected[tuple(row[:d])] += w
    assert found == {k: n for k, n in expected.items() if n >= 9}


def test_scores_are_exact_beyond_64_bits(spark):
    n = 10 ** 14
    rows = [("en", "a", 3 * n + 1), ("en", "b", 7 * n + 3), ("en", "a b", n + 7)]
    (r,) = collocations.scored(spark.createDataFrame(rows, "lang string, phrase string, n long")).collect()
    assert r.score == 1000000 * (n + 7) ** 2 // ((3 * n + 1) * (7 * n + 3))


def test_words_and_followers_of_a_chunk():
    data = b"".join(map(collocations.cleaned, ["B a,a  c\td!", None, ".", "e"]))
    coded = collocations.Coded(data, 3)
    names = coded.names.to_pylist()
    rows = [[None if c < 0 else names[c] for c in column] for column in coded.columns]
    assert rows == [["b", "a", "a", "c", "d", "e"], ["a", None, "c", "d", None, None], [None, None, "d", None, None, None]]
    at = np.arange(6)
    assert coded.phrases(at, 0, 2).to_pylist() == ["b a", "a", "a c", "c d", "d", "e"]
    assert coded.phrases(at, np.array([1, 1, 2, 1, 1, 1]), 3).to_pylist() == ["a", "", "d", "d", "", ""]
    assert coded.holds(at, 2, 0, {b"a c", b"c x", b"d e"}).tolist() == [False, False, True, False, False, False]
    assert coded.holds(at, 1, 1, {b"a", b"d"}).tolist() == [True, False, False, True, False, False]


def test_chunks_end_behind_pieces():
    data = b"ab\nc\n\nlonger piece\nd"
    for size in (1, 2, 5, 100):
        parts = list(collocations.chunks(data, size))
        assert b"".join(parts) == data and all(p.endswith(b"\n") for p in parts[:-1])


def test_prefixes_route_suffixes(spark):
    """Heavy words by two words, heavy pairs by three; what is counted already isn't sent."""
    docs = spark.createDataFrame([("en", "a b e. a b e. a b. c d e. a d e. a. c d")], "lang string, text string")
    rows = collocations.route_suffixes(docs, {"en": {b"a", b"a b"}}, 3).collect()
    found = sorted((r.prefix, r.weight, line) for r in rows for line in r.tails.split("\n"))
    assert found == sorted([("a b e", 2, ""), ("a d", 1, "e"), ("b", 2, "e"), ("c", 1, "d e"), ("c", 1, "d"), ("d", 2, "e")])
