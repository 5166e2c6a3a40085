"""Corpus preparation, stage after stage: quality rules, line dedup, near-dedup, decontamination, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame: the columns of
documents, and from the last one the token ids beside them.  Written between
the stages or not, the rows are the same.  Nulls, empty and repeated rows, and
clashing column names are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sharelens.llm import bpe, decontaminate, line_dedup, near_dedup, quality_rules
from sharelens.llm.frames import read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the target is what the labels table calls good."""
    return quality_rules.keep_documents(docs, quality_rules.trusted_labels(read(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; blocks of lines that an earlier document has are deleted from the text."""
    return line_dedup.dedup_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate class."""
    return near_dedup.keep_first(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    return decontaminate.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids, the number of tokens, and digests of the ids and of the decoded text."""
    coded = bpe.encode_decode(docs)
    new = {"n_tokens": F.col("bpe.n_tokens"), "ids": F.col("bpe.ids"), "ids_sha256": F.sha2("bpe.ids", 256),
           "decoded_sha256": F.sha2(F.col("bpe.decoded").cast("binary"), 256)}
    taken = {c.lower() for c in docs.columns}
    named = [c.alias(name if name not in taken else f"bpe_{name}") for name, c in new.items()]
    return coded.select("row.*", *named)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near", near),
    ("benchmark", benchmark),
    ("tokens", tokens),
]

#: the stages hash shingles, align lines and run a tokenizer: SQL can't express them
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; a stage's result is written to the shared folder before the next one reads it."""
    from sharelens.session import scratch_path

    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
