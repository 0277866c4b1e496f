"""One registered query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.llm.common import read, texts
from spendloom.llm.conversations import damaged, repair_conversations
from spendloom.llm.fingerprints import NEAR_BITS, fingerprints_with_edits, near_counts
from spendloom.llm.html_text import extract_text
from spendloom.llm.importance import importance_sample
from spendloom.llm.jaccard_join import jaccard_groups
from spendloom.llm.line_dedup import dedup_lines
from spendloom.llm.mixing import mix, taken
from spendloom.llm.packing import best_fit_packing, token_pieces
from spendloom.llm.quality_score import quality_scores
from spendloom.llm.repetition import quality_rules
from spendloom.llm.suffix_dedup import remove_repeats
from spendloom.llm.token_counts import token_counts
from spendloom.llm.toxicity import toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = fingerprints_with_edits(texts(read(spark, sf_dir, "documents")))
    near = near_counts(prints.select("doc_id", "fingerprint"), "doc_id % 20 = 0", NEAR_BITS)
    asked = F.coalesce(F.col("doc_id") % 20 == 0, F.lit(False))
    others = prints.filter(~asked).withColumn("n_near", F.lit(None).cast("long"))
    return prints.filter(asked).join(near, "fingerprint", "left").select(*others.columns).unionByName(others)


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return cut.select("doc_id", "n_removed", "emptied", F.length(text).cast("long").alias("n_chars"), F.sha2(text, 256).alias("text_sha256"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(mix(read(spark, sf_dir, "documents")))


@query
def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read(spark, sf_dir, "pages"))


SEQUENCE_TOKENS = 2048


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_pieces(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), SEQUENCE_TOKENS)
    return best_fit_packing(pieces, SEQUENCE_TOKENS)


@query
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(read(spark, sf_dir, "documents"), percent=85, width=4).select("doc_id", "n_shingles", "component_id")


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents")).drop("spans")


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents"))


@query
def op11_importance_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_sample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(read(spark, sf_dir, "conversations"), damage=damaged)


@query
def op13_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
