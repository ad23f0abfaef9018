"""The opN_ queries over the given tables, and their SQL where there is any."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lagframe.llm import (best_fit, chat, collocations, langid, minhash, mixing, packing, periodic_runs, quality_rules, token_files, topk,
                          url_filter, warc)
from lagframe.llm.common import pick
from lagframe.llm.tokens import tokenizer_path
from lagframe.session import configure, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into sequences of 2048 ids."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best other vectors for every vector whose id is divisible by 50."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", k=5)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the list entries active when it was fetched."""
    pages = table(spark, sf_dir, "pages")
    return url_filter.evaluate(url_filter.derived_captures(pages), url_filter.derived_entries(pages))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language, score and acceptance of every document."""
    docs = table(spark, sf_dir, "documents")
    rows = pick(docs, "doc_id", "text").withColumn("held_out", langid.held_out())
    return langid.predict_languages(rows, langid.fit_languages(docs), ["doc_id", "held_out"])


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from the archives written of it."""
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality_rules.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")) \
        .drop("stratum", "n_lines")


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn with its repair and rendered segment."""
    return chat.repair_conversations(table(spark, sf_dir, "conversations"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document, on shingles of four words."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document, and the training position of its first copy."""
    return mixing.taken_words(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as written to token-id files and read back."""
    files = token_files.write_token_files(table(spark, sf_dir, "documents"),
                                          scratch_path(spark, "tokens"), tokenizer_path())
    return token_files.read_token_files(spark, files)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of two or three words of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def plant_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents, by the checksum of doc_id, repeat their words from a place on."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None and words else 1
    if h % 10:
        return words
    g, n = h // 10, len(words)
    at = g % n
    period = 1 + (n - at) // (3 + g % 8)
    return words[:at] + [words[at + i % period] for i in range(n - at)]


def runs_of_documents(docs: DataFrame) -> DataFrame:
    """Digests of the runs of documents with planted periods; a null doc_id has none planted."""
    return periodic_runs.digest(periodic_runs.periodic_runs(docs, rewrite=plant_period))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document's words and what is left without their repeats."""
    return runs_of_documents(table(spark, sf_dir, "documents"))


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in as few sequences of 2048 ids as best fit finds."""
    return best_fit.pack_best_fit(table(spark, sf_dir, "documents"), tokenizer_path())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_packing, op2_topk, op3_url_filter, op4_language_id, op5_warc, op6_quality_rules, op7_chat,
    op8_minhash, op9_token_files, op10_mixing, op11_collocations, op12_periodic_runs, op13_best_fit)}

ORACLES: dict[str, str] = {
    "op3_url_filter": url_filter.SQL,
    "op11_collocations": collocations.SQL,
}
