"""How the encoder cuts texts and keeps the pieces."""

from __future__ import annotations

import random
import re
import sys

import numpy as np
from tokenizers import Tokenizer

from lagframe.llm import best_fit, tokens

LETTER = "[A-Za-zÀ-ÖØ-öø-ÿ]"
# behind a run of letters at ASCII, before a space, and behind a line feed between what is visible and a letter
CUT = re.compile(f"(?<={LETTER})(?=[\x01-\x1f!-@\\[-`{{-\x7f])|(?= )|(?<=[!-~]\n)(?={LETTER})|(?<={LETTER}\n)(?={LETTER})")


def distinct_words(n):
    rng = random.Random(4)
    return sorted({"".join(rng.choices("abcdefghij", k=9)) for _ in range(n)})


def test_pieces_are_no_python_objects():
    """Handling each piece in Python took most of the CPU seconds of op13's encoding."""
    words = distinct_words(20_000)
    texts = [" ".join(words[i:i + 50]) for i in range(0, len(words), 50)]
    code = tokens.Encoder(tokens.tokenizer_path())
    code.encode(["warm up"], 0)
    before = sys.getallocatedblocks()
    found = code.encode(texts, 0)
    assert len(code.memo) > 19_000
    assert sys.getallocatedblocks() - before < len(words) / 2
    assert sum(map(len, found)) > len(words)


def test_cuts_are_those_of_the_expression():
    rng = random.Random(5)
    parts = [*" \n\t\r\x0b\x7f\x01abZéÀ×÷ÿßµ~!.1'日😀İ¿\xa0", "\n\n", "a\nb", "!\nq", "é\né"]
    for _ in range(300):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(30)]
        data = [t.encode() for t in texts]
        starts = np.cumsum([0, *map(len, data)])
        at = np.flatnonzero(tokens.cuts(np.frombuffer(b"".join(data), dtype=np.uint8), starts[:-1])).tolist() + [starts[-1]]
        found = [b"".join(data)[a:b].decode() for a, b in zip(at, at[1:])]
        expected = [x for t in texts for x in CUT.split(t) if x]
        assert found == expected


def test_best_fit_pieces_beyond_groups_and_memo(spark, monkeypatch):
    """Nulls, texts that stay whole and copies, over several groups of texts and memos."""
    t = Tokenizer.from_file(tokens.tokenizer_path())
    t.encode_special_tokens = True
    rng, words = random.Random(6), distinct_words(400)
    texts = [" ".join(rng.choices(words, k=40)) + rng.choice(["", ".", " ", "\nÜber\nx", "  y", "\x00 z"]) for _ in range(80)]
    texts += [None, "", " ", "a", " a", "\n", *texts[:5]]
    with monkeypatch.context() as m:
        m.setattr(tokens, "GROUP_CHARS", 3000)
        m.setattr(tokens, "MEMO_PIECES", 100)
        code = tokens.Encoder(tokens.tokenizer_path())
        for i in range(0, len(texts), 30):
            some = texts[i:i + 30]
            assert [x.tolist() for x in code.encode(some, 0)] == [t.encode(x or "", add_special_tokens=False).ids + [0] for x in some]
        assert len(code.old)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    found = best_fit.cut_documents(docs, tokens.tokenizer_path(), 64, 0).groupBy("doc_id").sum("length").collect()
    assert dict(map(tuple, found)) == {i: len(t.encode(x or "", add_special_tokens=False).ids) + 1 for i, x in enumerate(texts)}
