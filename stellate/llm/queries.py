"""The operators applied to the whole tables, one query each. Every query
derives its digest columns from what the operator returns or writes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode_decode
from .common import package_on_workers, read
from .decontaminate import find_contamination
from .fingerprints import document_fingerprints
from .hard_negatives import HARD_NEGATIVES_SQL, hard_negatives
from .line_runs import LINE_REPORT_SQL, line_report
from .merkle import MERKLE_SQL, verify_documents
from .quality import score_documents
from .quality_rules import QUALITY_RULES_SQL, judge_documents
from .shards import shard_documents
from .simhash import near_duplicates
from .suffix_dedup import remove_repeats
from .token_files import token_files
from .token_rollup import corpus_totals

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        package_on_workers(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    QUERIES[fn.__name__] = run
    return run


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents")).drop("spans", "kept")


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("hits", "items")


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(read(spark, sf_dir, "documents"), tokenizer())


@query
def op4_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read(spark, sf_dir, "documents"))


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(read(spark, sf_dir, "documents"), tokenizer())


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


@query
def op7_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(read(spark, sf_dir, "documents"))


ORACLES["op7_line_runs"] = LINE_REPORT_SQL


@query
def op8_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_totals(read(spark, sf_dir, "documents"), {
        n.split(".")[0]: tokenizer(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.tiktoken")})


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(read(spark, sf_dir, "documents"))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), label.alias("label"))
    return hard_negatives(rows, F.col("id") % 50 == 0)


ORACLES["op11_hard_negatives"] = HARD_NEGATIVES_SQL


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary")) % 7 == 0
    return verify_documents(docs, tampered).drop("tree", "low", "siblings")


ORACLES["op12_merkle_manifest"] = MERKLE_SQL


@query
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


ORACLES["op13_quality_rules"] = QUALITY_RULES_SQL
