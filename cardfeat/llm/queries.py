"""The registered queries of this subpackage: each operator over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardfeat.llm import cross_polytope, decontaminate, fill_in_middle, html_text, language, line_dedup, mixing, prefix_trie, secrets, simhash, token_files
from cardfeat.llm import quality_classifier as classifier
from cardfeat.llm import quality_rules as rules
from cardfeat.llm.tables import read
from cardfeat.sources.sinks import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


@query
def op7_quality_rules(spark, d):
    return rules.quality_rules(read(spark, d, "documents"), read(spark, d, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


@query
def op4_simhash(spark, d):
    return simhash.simhash_classes(read(spark, d, "documents"))


@query
def op6_decontaminate(spark, d):
    found = decontaminate.contamination(read(spark, d, "documents"), read(spark, d, "benchmark"), longest=True)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
        F.coalesce(F.col("longest.n_words"), F.lit(0)).cast("bigint").alias("longest_words"),
        F.col("longest.item_id").alias("longest_item"),
        F.col("longest.item_word").cast("bigint").alias("longest_item_word"),
        F.col("longest.doc_word").cast("bigint").alias("longest_doc_word"),
    )


@query
def op5_token_files(spark, d):
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(read(spark, d, "documents"), path, TOKENIZER)
    return token_files.token_digests(token_files.read_tokens(spark, path))


@query
def op1_secrets(spark, d):
    return secrets.digest(secrets.secrets(read(spark, d, "documents")))


@query
def op8_quality_classifier(spark, d):
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
    scores = classifier.quality_scores(read(spark, d, "documents"), read(spark, d, "labels"), ~held_out)
    predicted = (F.col("score") >= classifier.PREDICT_AT).cast("int").alias("predicted")
    return scores.select("doc_id", held_out.alias("held_out"), "score", predicted)


@query
def op2_language(spark, d):
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    found = language.identify(read(spark, d, "documents"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op10_html_text(spark, d):
    return html_text.extract(read(spark, d, "pages"))


@query
def op3_line_dedup(spark, d):
    return line_dedup.delete_repeated_lines(read(spark, d, "documents"))


@query
def op9_mixing(spark, d):
    return mixing.mix_rates(read(spark, d, "documents"), read(spark, d, "labels"))


@query
def op11_cross_polytope(spark, d):
    return cross_polytope.linked_vectors(read(spark, d, "embeddings"))


@query
def op12_prefix_trie(spark, d):
    return prefix_trie.prefix_trie(prefix_trie.rebuilt_paths(read(spark, d, "conversations")))


@query
def op13_fill_in_middle(spark, d):
    return fill_in_middle.digest(fill_in_middle.fill_in_middle(read(spark, d, "documents")))
