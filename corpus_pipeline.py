"""The corpus pipeline: documents without toxic texts, frequent lines and near
copies, mixed to target weights and encoded.

Each stage takes (spark, docs, sf_dir); ``run`` writes what a stage returns to
the shared folder and rereads it as the next one's ``docs``.  All stages but
the last return the columns of ``documents``.  The mix repeats a document as
often as it takes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowtriage.llm import line_dedup, mixing, order_minhash, toxicity
from flowtriage.llm.common import materialise, table
from flowtriage.llm.queries import token_digests


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs, report=False)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return order_minhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_digests(docs, "source", "lang", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("bpe", encode),
]

#: A fitted classifier and alignments aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
