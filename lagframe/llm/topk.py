"""Exact top-k inner products by term-at-a-time accumulation.

The query rows are written once to the shared folder. Each task goes
through its own candidates in blocks, turns a block into postings (for
every term, the rows that have it and their weights) and streams the
queries past it in blocks. For every term the weighted postings are
scattered into dense score rows, one row per query; partition selection
keeps a query's best few of the block, ties to the smaller id. What is left
is merged per query. Neither side is ever held whole, nothing is broadcast
and no pair is skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow.dataset as ds
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagframe.llm.common import filesystem, map_columns, pick
from lagframe.session import scratch_path

SCALE = 256.0
QUERY_BLOCK = 256
CANDIDATE_BLOCK = 8192
EXACT = 1 << 62     # scores beyond this are summed as Python integers
LONG = (-(1 << 63), (1 << 63) - 1)
PARTIAL_SCHEMA = "query_id long, vec_id long, score long"


def quantized(vector: list | None) -> list[int] | None:
    """floor(256 * x) of every component; None if the vector takes no part."""
    if vector is None or any(x is None for x in vector):
        return None
    scaled = np.floor(SCALE * np.array(vector, dtype=np.float64))
    return [int(x) for x in scaled] if np.isfinite(scaled).all() else None


def dense(rows: list[list[int]]) -> np.ndarray:
    """Rows of equal width, short ones filled with zeros; objects if too large for int64."""
    width = max(map(len, rows), default=0)
    out = [r + [0] * (width - len(r)) for r in rows]
    top = max((abs(x) for r in rows for x in r), default=0)
    return np.array(out, dtype=np.int64 if top < 1 << 31 else object).reshape(len(rows), width)


class Postings:
    """A block of candidates by term, in ascending id order."""

    def __init__(self, ids: list[int], rows: list[list[int]]):
        order = np.argsort(np.array(ids, dtype=np.int64), kind="stable")
        self.ids = np.array(ids, dtype=np.int64)[order]
        weights = dense(rows)[order]
        self.top = int(abs(weights).max()) if weights.size else 0
        self.terms = [(at, weights[at, t]) for t in range(weights.shape[1]) for at in [np.flatnonzero(weights[:, t])]]

    def scores(self, queries: np.ndarray) -> np.ndarray:
        top = (int(abs(queries).max()) if queries.size else 0) * self.top * max(1, queries.shape[1])
        kind = np.int64 if top < EXACT else object
        out = np.zeros((len(queries), len(self.ids)), dtype=kind)
        for t, (at, weights) in enumerate(self.terms[:queries.shape[1]]):
            asked = np.flatnonzero(queries[:, t])
            if len(asked) and len(at):
                out[np.ix_(asked, at)] += np.multiply.outer(queries[asked, t].astype(kind), weights.astype(kind))
        return out if kind is np.int64 else np.clip(out, *LONG)

    def best(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
        """(query_id, vec_id, score) of each query's k best rows, its own rows aside."""
        scores = self.scores(queries)
        for query_id, row in zip(query_ids.tolist(), scores, strict=True):
            others = np.flatnonzero(self.ids != query_id)
            row = row[others]
            if len(row) > k:
                least = np.partition(row, len(row) - k)[len(row) - k]
                kept = np.flatnonzero(row >= least)
                others, row = others[kept], row[kept]
            # rows stand in id order, so a stable sort gives ties to the smaller id
            for i in np.argsort(-row, kind="stable")[:k].tolist():
                yield query_id, int(self.ids[others[i]]), int(row[i])


def query_blocks(path: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    fs, at = filesystem(path)
    for batch in ds.dataset(at, filesystem=fs, format="parquet").to_batches(batch_size=QUERY_BLOCK):
        rows = [(i, v) for i, x in zip(batch["vec_id"].to_pylist(), batch["embedding"].to_pylist(), strict=True)
                if (v := quantized(x)) is not None]
        if rows:
            yield np.array([i for i, _ in rows], dtype=np.int64), dense([v for _, v in rows])


def top_k(vectors: DataFrame, is_query: str, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows for each query row.

    ``is_query`` is a condition on vec_id. Rows with a null vec_id, a null
    vector or a null or non-finite component take no part; an empty vector
    scores 0 with all, and of vectors of different length the common terms
    count. Candidates under the query's own vec_id aren't ranked; a vec_id
    repeated among the queries asks once, with its least vector, and one
    repeated among the candidates is ranked as often as it occurs. Scores
    outside the range of a long are set to its end. Fewer than k others give
    fewer rows, an empty table none.
    """
    rows = pick(vectors, "vec_id", "embedding").where("vec_id is not null and embedding is not null")
    path = scratch_path(vectors.sparkSession, "queries")
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    queries.write.parquet(path)

    def search(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        ids: list[int] = []
        block: list[list[int]] = []

        def found() -> Iterator[dict[str, list]]:
            postings = Postings(ids, block)
            for query_ids, asked in query_blocks(path):
                best = list(postings.best(query_ids, asked, k))
                yield {n: [b[i] for b in best] for i, n in enumerate(("query_id", "vec_id", "score"))}

        for batch in batches:
            for vec_id, vector in zip(batch["vec_id"], batch["embedding"], strict=True):
                if (v := quantized(vector)) is not None:
                    ids.append(vec_id)
                    block.append(v)
            if len(ids) >= CANDIDATE_BLOCK:
                yield from found()
                ids, block = [], []
        if ids:
            yield from found()

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (map_columns(rows, search, PARTIAL_SCHEMA).withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
