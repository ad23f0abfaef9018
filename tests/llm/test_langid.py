"""Language identification: rejection by score."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lagframe.llm import langid


@pytest.mark.parametrize("unlearned", ["fr", "de"])
def test_texts_of_an_unlearned_language_are_rejected(spark, unlearned):
    real = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 3000")
    model = langid.fit_languages(real.where(F.col("lang") != unlearned))
    assert unlearned not in model.languages and 0 < model.threshold < 1
    out = langid.predict_languages(real.select("doc_id", langid.held_out().alias("h"), "text", "lang"), model,
                                   ["doc_id", "h", "lang"]).collect()
    strange = [r for r in out if r.lang == unlearned]
    known = [r for r in out if r.h and r.lang != unlearned]
    print(unlearned, model.threshold, sum(not r.accepted for r in strange), len(strange),
          sum(not r.accepted for r in known), len(known))
    assert sum(r.accepted for r in strange) <= .2 * len(strange)
    assert sum(r.accepted for r in known) >= .95 * len(known)
    rng = random.Random(1)
    gibberish = ["".join(rng.choice("qxzjkwvy ") for _ in range(400)) for _ in range(50)]
    assert sum(model.predict(t)[2] for t in gibberish) <= 10


def test_low_score_is_an_exact_bound():
    for n in (10, 149, 500, 2000):
        scores = np.random.default_rng(n).permutation(np.arange(1, n + 1)) / (n + 1)
        under = sum(s < langid.low_score(scores) for s in scores)
        p = langid.MAX_FALSE_REJECTION

        def at_most(k):
            return sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))

        assert not under or at_most(under) <= langid.MISTAKE_PROBABILITY < at_most(under + 1)
    assert langid.low_score(np.array([])) == 1.0


def plain_buckets(text):
    """Bucket of every subword, window by window."""
    data = ("".join(c if c.isalpha() else " " for c in text.lower())).encode()
    data, word = b" " + data + b" ", 1 << 32
    out = []
    for order in (2, 3, 4):
        for i in range(len(data) - order + 1):
            window = data[i:i + order]
            if window == b"  " or 32 in window[1:-1]:
                continue
            value = window[0] + 1
            for byte in window[1:]:
                value = (value * 257 + byte) % word
            mixed = (value * 0x9E3779B1 + order * 0x85EBCA6B) % word * 0xC2B2AE35 % word
            out.append(mixed >> (33 - langid.BUCKETS.bit_length()))
    return out


@pytest.mark.parametrize("chunk", [1 << 20, 64, 7])
def test_subwords_equal_plain_windows(monkeypatch, chunk):
    monkeypatch.setattr(langid, "CHUNK", chunk)
    rng = random.Random(3)
    for _ in range(60):
        text = "".join(rng.choice(["a", "B", "é", "ß", "日", " ", "  ", ".", "½", "…", "9", "\n", "́"]) for _ in range(rng.randint(0, 300)))
        assert langid.subword_counts(text).tolist() == np.bincount(plain_buckets(text), minlength=langid.BUCKETS).tolist()


def test_predictions_equal_a_plain_model(spark):
    """The registered query's model and rows against averaging subword by subword."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit_languages(docs)
    found = langid.predict_languages(docs, model, ["doc_id"]).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(found) == len(texts) and len(model.languages) == 4
    for r in found:
        text = texts[r.doc_id]
        if not any(c.isalpha() for c in text or ""):
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
            continue
        rows = model.table[plain_buckets(text)]
        z = rows.mean(axis=0) / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert r.lang_pred == model.languages[int(p.argmax())] and abs(r.score - p.max()) < 1e-9
        assert r.accepted == (r.score >= model.threshold)


def test_whole_texts_and_all_languages_are_learnt(spark):
    """A language that shows only late in its texts, and more languages than rows of the sample."""
    rng = random.Random(5)
    rows = []
    for i in range(400):
        tail = " ".join(rng.choice(["zua", "kwe", "xyo"] if i % 2 else ["the", "and", "ing"]) for _ in range(1500))
        rows.append((i, "lorem ipsum dolor " * 120 + tail, "zz" if i % 2 else "en"))
    model = langid.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {model.predict(t)[0] == lang for _, t, lang in rows[:60]} == {True}
    many = [(i, f"abc {i} def", f"l{i % 300:03d}") for i in range(3000)]
    model = langid.fit_languages(spark.createDataFrame(many, "doc_id long, text string, lang string"))
    assert len(model.languages) == 300


def test_sample_is_bounded_and_counts_equal_rows_once(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_ROWS", 20)
    rows = [(7, "the same text", "en")] * 500 + [(i, f"text {chr(97 + i % 26)}{i}", "en" if i % 3 else "fr") for i in range(300)]
    sample = langid.training_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4))
    assert len(sample) == 20 and sorted(lang for lang, _, _ in sample) == ["en"] * 10 + ["fr"] * 10


def test_letters_decide_and_clashing_columns_do_not(spark):
    rows = [(1, "½ ² Ⅳ 12", "x"), (2, "a", "x"), (3, None, "x"), (4, "日本", "x")]
    model = langid.LanguageModel(["en"], np.ones((langid.BUCKETS, 1)), 1.0, 0.0)
    docs = spark.createDataFrame(rows, "doc_id long, text string, TEXT string")
    found = {r.doc_id: r.lang_pred for r in langid.predict_languages(docs, model, ["doc_id"]).collect()}
    assert found == {1: "und", 2: "en", 3: "und", 4: "en"}
    assert sorted(r[0] for r in langid.keep_identified(docs, model).collect()) == [2, 4]
