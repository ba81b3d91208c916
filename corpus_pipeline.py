"""The corpus pipeline: documents through the stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from incidara.llm import bpe, decontaminate, lines, simhash, toxicity
from incidara.llm.common import read
from incidara.llm.registry import tokenizer_source
from incidara.session import stage

#: Words whose tokens a worker remembers: fewer than the operator's own, as its workers serve all stages.
REMEMBERED = 40_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the classifier learns from this stage's own input."""
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def drop_line_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs."""
    return lines.drop_later_runs(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def drop_benchmark_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of test items; those that are mostly such go whole."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its token counts and digests of its ids and of the text decoded from them."""
    return bpe.round_trip(docs, tokenizer_source(), REMEMBERED)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_line_runs),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_spans),
    ("bpe encoding and decoding", tokenize),
]

#: A trained classifier decides in the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table ``documents`` of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
