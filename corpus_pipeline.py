"""From raw documents to mixed, packed training tokens: one Parquet table between any two stages."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cardfeat.llm import quality_rules as rules
from cardfeat.llm.decontaminate import remove_contaminated
from cardfeat.llm.mixing import sample_mix
from cardfeat.llm.simhash import drop_near_copies
from cardfeat.llm.tables import read
from cardfeat.llm.token_files import read_tokens, token_digests, write_tokens
from cardfeat.session import drop_folder, scratch_path, stage_scope

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return rules.drop_rejected(docs, read(spark, sf_dir, "labels"))


def different_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_copies(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at the rates that bring the domains to their target weights."""
    return sample_mix(docs, read(spark, sf_dir, "labels"))


def packed_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, read back: place, number of ids and checksum of each document."""
    path = scratch_path(spark, "token-files")
    write_tokens(docs, path, TOKENIZER)
    return token_digests(read_tokens(spark, path))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", good_documents),
    ("simhash_near_dedup", different_documents),
    ("benchmark_decontamination", clean_documents),
    ("source_mixing", mixed_documents),
    ("token_output", packed_tokens),
]

#: The stages hash, tokenize and fit, which SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and read again before the next.

    What a stage keeps for itself goes once its result is written, and so does the result before.
    """
    docs, before = read(spark, sf_dir, "documents"), None
    for name, function in STAGES[:-1]:
        path = scratch_path(spark, name)
        with stage_scope(spark):
            kept = function(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before:
            drop_folder(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
