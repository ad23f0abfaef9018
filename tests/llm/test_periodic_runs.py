"""Periodic runs against a search of all periods."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from lagframe.llm import periodic_runs, queries


def plain_runs(words, repeats=4, least=6):
    out = []
    for p in range(1, len(words) // repeats + 1):
        at = 0
        while at + p < len(words):
            end = at
            while end + p < len(words) and words[end] == words[end + p]:
                end += 1
            length = end - at + p
            if end > at and length >= max(least, repeats * p):
                smaller = any(all(words[t] == words[t + q] for t in range(at, at + length - q)) for q in range(1, p))
                if not smaller:
                    out.append((at, at + length, p))
            at = max(end, at + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rng):
    """Words of a small alphabet with planted repetitions, some nested."""
    words = [rng.choice("abc") for _ in range(rng.randint(0, 30))]
    for _ in range(rng.randint(0, 4)):
        unit = [rng.choice("abcdefgh") for _ in range(rng.randint(1, 12))]
        if rng.random() < 0.3:
            unit = unit * 4 + [rng.choice("xy")]
        n = rng.randint(2, 6) * len(unit) + rng.randint(0, len(unit))
        at = rng.randint(0, len(words))
        words[at:at] = (unit * 7)[:n]
    return words


def test_runs_equal_all_periods():
    rng = random.Random(1)
    texts = [random_words(rng) for _ in range(400)] + [[], ["a"], ["a"] * 6, ["a"] * 5, list("ab") * 4, ["a"] * 1000,
                                                      ([*"aab"] * 20 + ["c"]) * 5, list("abcd") * 3]
    found = periodic_runs.runs_of_texts([[w.encode() for w in t] for t in texts], 4, 6)
    for text, runs in zip(texts, found, strict=True):
        assert [tuple(r) for r in runs.tolist()] == plain_runs(text), text


def test_other_bounds_and_single_texts():
    rng = random.Random(2)
    for _ in range(150):
        text = random_words(rng)
        for repeats, least in ((4, 1), (5, 12)):
            (found,) = periodic_runs.runs_of_texts([[w.encode() for w in text]], repeats, least)
            assert [tuple(r) for r in found.tolist()] == plain_runs(text, repeats, least)
    with pytest.raises(ValueError):
        periodic_runs.find_runs(np.arange(5), repeats=3)


def test_wavelet_tree_equals_sorting():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 64, 100):
        values = rng.permutation(n).astype(np.int32)
        tree = periodic_runs.WaveletTree(values)
        left = rng.integers(0, n, 200)
        right = np.array([rng.integers(a + 1, n + 1) for a in left])
        bound, k = rng.integers(0, n, 200), np.array([rng.integers(0, b - a) for a, b in zip(left, right)])
        assert tree.below(left, right, bound).tolist() == [int((values[a:b] < x).sum()) for a, b, x in zip(left, right, bound)]
        assert tree.kth(left, right, k).tolist() == [int(np.sort(values[a:b])[x]) for a, b, x in zip(left, right, k)]


def expected_row(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    dropped = {i for s, e, p in runs for i in range(s + p, e)}
    best = max(runs, key=lambda r: ((r[1] - r[0]) / r[2], -r[0]), default=None)
    lines = "".join(f"{s},{e - s},{p}\n" for s, e, p in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    four = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *four, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_columns_on_awkward_rows(spark):
    rng = random.Random(4)
    texts = [None, "", " \x0b\n ", "one"] + [" ".join(random_words(rng)) for _ in range(120)] + ["é " * 9 + "\x1c b"]
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(50, texts[50], "x", 2), (None, "a b " * 5, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Runs string, start int").repartition(3)
    found = queries.runs_of_documents(docs).collect()
    key = str
    assert sorted(map(tuple, found), key=key) == sorted((expected_row(r[0], r[1]) for r in rows), key=key)
    assert queries.runs_of_documents(docs.limit(0)).count() == 0


def test_query_equals_all_periods_on_whole_table(spark):
    found = {r.doc_id: tuple(r) for r in queries.op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(rows) and sum(r[1] for r in found.values()) > 10
    for r in rows:
        if len((r.text or "").split()) < 600:
            assert found[r.doc_id] == expected_row(r.doc_id, r.text)
