"""What a worker and an executor hold at once, beside what they return."""

from __future__ import annotations

import random

from tokenizers import Tokenizer

from lagframe.llm import common, packing, tokens


class Recording:
    """A tokenizer that notes the characters of each call."""

    def __init__(self, tokenizer):
        self.tokenizer, self.calls = tokenizer, []

    def encode_batch_fast(self, texts, **how):
        self.calls.append([len(t) for t in texts])
        return self.tokenizer.encode_batch_fast(texts, **how)


def texts_of(n):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 9)))
    cut = [" ".join(word() for _ in range(60)) for _ in range(n)]
    whole = ["  ".join(word() for _ in range(60)) + " " for _ in range(n)]  # runs of spaces: never cut
    return [*cut, *whole, "  ".join(word() for _ in range(900)), None, ""]


def expected(texts):
    t = Tokenizer.from_file(tokens.tokenizer_path())
    return [t.encode(x or "", add_special_tokens=False).ids + [1] for x in texts]


def test_the_tokenizer_gets_a_bounded_number_of_characters(monkeypatch):
    monkeypatch.setattr(tokens, "CALL_CHARS", 3000, raising=False)
    monkeypatch.setattr(tokens, "STRING_PIECES", 50)
    code, texts = tokens.Encoder(tokens.tokenizer_path()), texts_of(40)
    code.tokenizer = Recording(code.tokenizer)
    assert [x.tolist() for x in code.encode(texts, 1)] == expected(texts)
    assert all(sum(c) <= 3000 or len(c) == 1 for c in code.tokenizer.calls)
    assert max(map(max, filter(None, code.tokenizer.calls))) > 3000


def test_a_lean_encoder_holds_less_and_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_PIECES", 1600)
    monkeypatch.setattr(tokens, "GROUP_CHARS", 8000)
    texts = texts_of(60)
    held = []
    for lean in (False, True):
        with tokens.encoder(tokens.tokenizer_path(), lean=lean) as code:
            assert [x.tolist() for x in code.encode(texts, 1)] == expected(texts)
            held.append(len(code.memo) + len(code.old))
    assert held[1] < held[0] / 2


def test_lean_packing_gives_the_same_pieces(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts_of(30))], "doc_id long, text string").coalesce(1)
    rows = [sorted(packing.pack_documents(docs, tokens.tokenizer_path(), 256, lean=lean).collect())
            for lean in (False, True)]
    assert rows[0] == rows[1]


def test_parquet_is_read_without_vectored_reads_unless_asked_for(spark):
    key = "parquet.hadoop.vectored.io.enabled"
    session = spark.newSession()
    common.stage(session.range(3).toDF("id"), "vectored")
    assert session.conf.get(key) == "false"
    session = spark.newSession()
    session.conf.set(key, "true")
    assert common.stage(session.range(3).toDF("id"), "vectored").count() == 3
    assert session.conf.get(key) == "true"
