"""The stages of corpus_pipeline against brute force."""

from __future__ import annotations

import random
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lagframe.llm import langid, mixing, packing, quality_rules, tokens
from lagframe.llm.common import stage
from tests.llm.test_operators import jaccard_components


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    for name in ("documents", "labels"):
        (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet").where("doc_id < 250").repartition(3)
         .write.parquet(f"{path}/{name}.parquet"))
    return path


@pytest.fixture(scope="module")
def staged(spark, sf_dir):
    """What each stage but the last returns, written and read again."""
    out = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for name, step in corpus_pipeline.STAGES[:-1]:
        out.append(stage(step(spark, out[-1], sf_dir), "test"))
    return out


def ids_of(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


@cache
def tokenizer():
    t = Tokenizer.from_file(tokens.tokenizer_path())
    t.encode_special_tokens = True
    return t


def encoded(text):
    return np.array([*tokenizer().encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")


def test_stages_match_brute_force(staged):
    raw, good, identified, single, mixed = staged
    names = list(quality_rules.COUNT_NAMES)
    kept = []
    for r in raw.collect():
        c = dict(zip(names, quality_rules.text_counts(r.text)))
        if c["n_words"] >= 20 and 100 * c["n_repeat_words"] <= 30 * c["n_words"]:
            kept.append(r.doc_id)
    assert ids_of(good) == sorted(kept)  # too few labels to certify any cutoff
    model = langid.fit_languages(good)
    assert ids_of(identified) == sorted(r.doc_id for r in good.collect() if model.predict(r.text)[2])
    component = jaccard_components(identified.collect(), 5)[1]
    assert ids_of(single) == sorted(d for d, c in component.items() if d == c)
    taken = {r.doc_id: r for r in mixing.taken_words(single).collect()}
    words, first = Counter(), {}
    text = {r.doc_id: r.text.split() for r in single.collect()}
    for r in mixed.collect():
        found = r.text.split()
        assert found == text[r.doc_id][:len(found)]
        words[r.doc_id] += len(found)
        first[r.doc_id] = min(first.get(r.doc_id, 2), r.mix_due)
    assert words == {d: r.taken for d, r in taken.items() if r.taken}
    assert first == {d: pytest.approx(r.first_due) for d, r in taken.items() if r.taken}


def test_run_packs_every_copy(spark, sf_dir, staged):
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    covered = Counter()
    for r in pieces:
        covered[r.doc_id] += r.length
    assert len({(r.sequence_id, r.offset) for r in pieces}) == len(pieces)
    expect = Counter()
    for r in staged[-1].collect():
        expect[r.doc_id] += len(encoded(r.text))
    assert covered == expect


def test_sequences_follow_the_curriculum_after_the_reread(spark, sf_dir, staged):
    rows = sorted(staged[-1].collect(), key=lambda r: (r.mix_due, r.mix_hash, r.mix_copy))
    # each copy gets its number in the curriculum as doc_id, and the files any order
    numbered = [r.asDict() | {"doc_id": i} for i, r in enumerate(rows)]
    random.Random(5).shuffle(numbered)
    small = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k"}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        frame = stage(spark.createDataFrame(numbered, staged[-1].schema).repartition(7), "test")
        pieces = corpus_pipeline.STAGES[-1][1](spark, frame, sf_dir).collect()
    finally:
        for key in small:
            spark.conf.unset(key)
    tasks = {}
    for r in pieces:
        tasks.setdefault(r.sequence_id >> packing.SEQUENCE_BITS, set()).add(r.doc_id)
        ids = encoded(rows[r.doc_id].text)[r.start:r.start + r.length]
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32
    assert len(tasks) > 2 and set().union(*tasks.values()) == set(range(len(rows)))
    ordered = [tasks[t] for t in sorted(tasks)]
    assert all(max(a) < min(b) for a, b in zip(ordered, ordered[1:]))


AWKWARD = "doc_id long, text string, lang string, source string, n_chars long, Extra string, sequence_id string, kept int"


def awkward_rows():
    rng = np.random.default_rng(5)
    bank = {"en": ["the", "and", "of", "with"], "xx": ["zu", "qua", "vel", "rux"]}

    def text(lang, n):
        return " ".join(str(rng.choice(bank[lang])) + chr(97 + int(rng.integers(26))) + chr(97 + int(rng.integers(26))) for _ in range(n))

    rows = [(i, text("en" if i % 2 else "xx", 60), "en" if i % 2 else "xx", ["a", "b", None][i % 3], 1, "e", "s", 0) for i in range(300)]
    long = text("en", 40_000)
    rows += [(1000, None, "en", "a", None, None, None, None), (1001, "", "en", "a", 0, "", "", 1), (1002, " \n\t ", None, None, 0, "", "", 1),
             (1003, "1 2 3 ½ " * 10, "en", "a", 0, "", "", 1), (1004, long, "en", "b", 1, "e", "s", 0),
             (1005, text("en", 60), None, "c", 1, None, None, None), (None, text("en", 60), "en", "c", 1, None, None, None),
             rows[7], (7, text("xx", 60), "xx", "a", 1, "other text", "s", 0)]
    return rows


def test_stages_on_awkward_rows(spark, tmp_path):
    """Nulls, empty and very long texts, repeated rows and doc_ids, extra columns, an empty table."""
    rows = awkward_rows()
    spark.createDataFrame([(r[0], 1, 0) for r in rows if r[0] is not None and r[0] < 300], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{tmp_path}/labels.parquet")
    for name, docs in (("rows", spark.createDataFrame(rows, AWKWARD).repartition(3)), ("none", spark.createDataFrame([], AWKWARD))):
        kept = []
        for stage_name, step in corpus_pipeline.STAGES:
            docs = stage(step(spark, docs, str(tmp_path)), f"awkward-{name}")
            kept.append(docs)
        assert all(d.columns[:8] == [c.split()[0] for c in AWKWARD.split(", ")] for d in kept[:-1])
        if name == "none":
            assert all(d.count() == 0 for d in kept)
            continue
        quality, language, single, mixed, packed = ([r.asDict() for r in d.collect()] for d in kept)
        base = Counter((r[0], r[1]) for r in rows if len((r[1] or "").split()) >= 20)
        assert not {1000, 1001, 1002} & {r["doc_id"] for r in quality}
        assert all(n <= base[k] for k, n in Counter((r["doc_id"], r["text"]) for r in quality).items())
        assert sum(r["doc_id"] == 7 for r in quality) == 3
        assert 1003 not in {r["doc_id"] for r in language} and len(language) >= 0.9 * len(quality) - 5
        assert sorted(r["text"] for r in single if r["doc_id"] == 7) == sorted({r["text"] for r in language if r["doc_id"] == 7})
        assert len({(r["doc_id"], r["text"]) for r in language}) == len(single)
        assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in single} and mixed
        words = {r["doc_id"]: Counter() for r in single}
        assert sum(r["length"] for r in packed) == sum(len(encoded(r["text"])) for r in mixed)
        assert words.keys() >= {r["doc_id"] for r in packed}
