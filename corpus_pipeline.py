"""From raw documents to packed training sequences, one written stage after another."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lagframe.llm import langid, minhash, mixing, packing, quality_rules
from lagframe.llm.common import pick, stage
from lagframe.llm.tokens import tokenizer_path
from lagframe.session import configure


def check_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs.

    Null, empty and wordless texts go; a null lang is a stratum, a null doc_id is
    unlabelled; repeated rows are judged each on its own.
    """
    return quality_rules.keep_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified, by a model of the documents given.

    Null and letterless texts go. Rows without doc_id or lang are judged but not learnt
    from; without any labelled row every document goes.
    """
    return langid.keep_identified(docs, langid.fit_languages(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, on shingles of five words.

    That of the least doc_id. Rows that repeat doc_id and text are one document, other texts under a
    doc_id are documents of their own; rows without doc_id and texts without words stay.
    """
    return minhash.keep_first(docs, width=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies that the target weights ask for, each with its place in the curriculum.

    The place is in columns, as the order of rows doesn't survive the files. Texts
    without words aren't taken; null sources are one source; repeated rows and
    null doc_ids are documents of their own.
    """
    return mixing.dated_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document, placed in sequences of 2048 ids along the curriculum.

    Each task packs one range of the training; sequence_id rises from range
    to range. Within a task, sequences are numbered as they fill up. Null and
    empty texts are an end id alone; a null doc_id stays null. The encoder is a lean
    one, as the executors also hold what the stages before have left.
    """
    return packing.pack_documents(mixing.in_order(pick(docs, "doc_id", "text", *mixing.ORDER)), tokenizer_path(),
                                  lean=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", check_quality),
    ("language ID", identify_language),
    ("near-dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack),
]

# No SQL expresses the tokenizer and the trained models; tests compare the
# stages with brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written and read again.

    Extra columns are carried to the last stage, which returns pieces. An empty
    table gives an empty result at every stage.
    """
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
