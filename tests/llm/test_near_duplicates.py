"""Near-duplicates where doc_ids repeat, and recall on a whole table."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from lagframe.llm import minhash
from tests.llm.test_operators import jaccard_components, words

SCHEMA = "doc_id long, text string, DOC_ID2 string, kept string, Hash string"


def near(text, at):
    ws = text.split()
    ws[at] = "other"
    return " ".join(ws)


def by_row(rows, width):
    """Component (number of its first row) of every row by the texts alone."""
    plain = [type("R", (), {"doc_id": i, "text": r[1]}) for i, r in enumerate(rows)]
    return jaccard_components(plain, width)


def expected(rows, width):
    sets, component = by_row(rows, width)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[component[i]] = min(r[0], least.get(component[i], r[0]))
    out = Counter()
    for i, r in enumerate(rows):
        name = least.get(component[i]) if sets[i] else r[0]
        out[r[0], len(sets[i]), name, name is None or r[0] == name] += 1
    return out


@pytest.fixture(scope="module")
def repeated():
    rng = random.Random(8)
    a, b, c = (words(rng, 60) for _ in range(3))
    rows = [(1, a), (5, b), (5, near(a, 30)), (7, near(b, 30)), (9, c), (9, a)]
    for i in range(60):
        text = words(rng, rng.choice([3, 40, 90]))
        ids = [rng.randint(20, 50) for _ in range(rng.randint(1, 4))]
        rows += [(d, text if rng.random() < .5 else near(text, 1)) for d in ids]
    rows += [rows[0], rows[7], (None, a), (None, "nothing like it at all here"), (60, None), (60, None), (61, ""),
             (62, c.upper()), (62, c)]
    return [(*r, "x", "y", "z") for r in rows]


def test_rows_of_one_doc_id_are_judged_by_their_text(spark, repeated):
    docs = spark.createDataFrame(repeated, SCHEMA).repartition(3)
    found = Counter(map(tuple, minhash.near_duplicates(docs, width=4).collect()))
    assert found == expected(repeated, 4)
    six = Counter(map(tuple, minhash.near_duplicates(spark.createDataFrame(repeated[:6], SCHEMA), width=4).collect()))
    assert six == Counter({(1, 57, 1, True): 1, (5, 57, 5, True): 1, (5, 57, 1, False): 1, (7, 57, 5, False): 1,
                           (9, 57, 9, True): 1, (9, 57, 1, False): 1})


def test_keep_first_keeps_one_row_of_each_group(spark, repeated):
    docs = spark.createDataFrame(repeated, SCHEMA).repartition(3)
    out = minhash.keep_first(docs, width=4)
    assert out.columns == docs.columns
    found = Counter((r[0], r[1]) for r in out.collect())
    sets, component = by_row(repeated, 4)
    groups = {}
    for i, r in enumerate(repeated):
        if r[0] is None:
            assert found[r[0], r[1]] == 1
        elif sets[i]:
            groups.setdefault(component[i], []).append((r[0], r[1]))
        else:
            assert found[r[0], r[1]] == 1      # repeats of it are one document
    for rows in groups.values():
        # the least doc_id stays, with one of its texts
        kept = [(k, n) for k, n in found.items() if k in rows and k[0] is not None]
        assert len(kept) == 1 and kept[0][1] == 1 and kept[0][0][0] == min(r[0] for r in rows)
    assert minhash.keep_first(docs.limit(0), 4).count() == 0


def test_every_link_of_a_whole_table_is_found(spark):
    """Recall against brute force: all pairs that share a shingle, through an inverted index."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    sets = {r.doc_id: frozenset(minhash.shingle_set(r.text, 4).tolist()) for r in rows}
    holders = {}
    for d, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(d)
    common = Counter()
    for d, s in sets.items():
        common.update((e, d) for x in s for e in holders[x] if e < d)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [(a, b) for (a, b), n in common.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert len(links) > 50
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(frame, 4).collect()} == {d: find(d) for d in sets}
