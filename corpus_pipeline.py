"""The training-data pipeline over ``documents``: each stage calls one
operator on all that the stage before it kept; what it returns is written as
Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stellate.llm.bpe import encode_decode
from stellate.llm.common import package_on_workers, read, stored
from stellate.llm.decontaminate import remove_contaminated
from stellate.llm.line_runs import delete_copies
from stellate.llm.quality import keep_quality
from stellate.llm.queries import tokenizer
from stellate.llm.simhash import keep_one


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    package_on_workers(spark)
    return keep_quality(docs, read(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines are cut out of the texts."""
    return delete_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    package_on_workers(spark)
    return keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with benchmark passages go."""
    package_on_workers(spark)
    return remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as ids: their number and digests of ids and decoded text."""
    package_on_workers(spark)
    return encode_decode(docs, tokenizer())


STAGES = [("quality", quality), ("lines", lines), ("near copies", near_copies), ("benchmark", benchmark), ("tokens", tokens)]

#: A trained classifier and a tokenizer have no SQL form; tests hold run()
#: against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each stored before the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
