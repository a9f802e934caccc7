"""A training corpus from `documents`: toxicity, exact dedup, near dedup, mixing, encoding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallymart.llm import bpe, exact_dedup, mixing, simhash, toxicity
from tallymart.llm.shared import read, settle, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model rejects go; it is fitted on a bounded sample of labelled ones."""
    return toxicity.accepted(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return exact_dedup.keepers(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts whose fingerprints links of at most 4 bits connect the one with the smallest doc_id stays."""
    return simhash.keepers(docs, words=4, distance=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix from the first file to the last."""
    return mixing.interleaved(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text and digests of ids and decoded text, written in the order of the mix.

    Rows read again come in the order of the scan, so the place in the mix (slot, at) is computed
    again from the stage's rows, which gives the same, and stays beside each row.
    """
    return bpe.round_trip(mixing.placed(docs), tokenizer_path(), with_ids=True, carried=("slot", "at"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Iterated components, a fitted model and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage's rows are written as Parquet and read again.

    Sorted by (slot, at) they are in the order of the mix.
    """
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
