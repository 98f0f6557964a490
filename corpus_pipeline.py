"""A cleaning pipeline over ``documents``: each stage is one operator, works on all that the
stage before kept, and is written as Parquet before the next one reads it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import jaccard_join, line_dedup, packing, quality, toxicity
from plumbline.llm.common import match, read, stage
from plumbline.session import shared_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _hashed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with the text's hash in a column of a name that is free, and that name."""
    name = next(f"_h{i}" for i in count() if f"_h{i}" not in docs.columns)
    return docs.withColumn(name, F.xxhash64("text")), name


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects. The verdict is joined by id and text."""
    keyed, h = _hashed(docs)
    # the ledger is written; policies only read its bits (a filter on them must not reach the rules' expressions)
    rows = stage(quality.ledger(keyed.select(F.struct("doc_id", F.col(h).alias("_h")).alias("key"), "text"), "key"), "ledger")
    verdicts = quality.apply_policy(rows)
    good = verdicts.where("kept").select(F.col("doc_id.doc_id").alias("doc_id"), F.col("doc_id._h").alias(h)).distinct()
    return match(keyed, good, ["doc_id", h], "left_semi").select(*docs.columns)


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network doesn't call toxic; it learns from the labels of ``documents`` that aren't held out."""
    net = toxicity.trained(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    keyed, h = _hashed(docs)
    scores = toxicity.scored(keyed.select(F.struct("doc_id", F.col(h).alias("_h")).alias("key"), "text"), net, "key")
    good = scores.where("predicted = 0").select(F.col("doc_id.doc_id").alias("doc_id"), F.col("doc_id._h").alias(h)).distinct()
    return match(keyed, good, ["doc_id", h], "left_semi").select(*docs.columns)


def line_dedup_(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier line matches; documents of which nothing is left go."""
    rows = line_dedup.deduplicated(docs)
    emptied = (F.size("removed_lines") > 0) & ~F.coalesce(F.col("text"), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    return rows.where(~emptied).withColumn("n_chars", F.when(F.size("removed_lines") > 0, F.char_length("text").cast("bigint"))
                                           .otherwise(F.col("n_chars"))).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; rows that share this id all stay."""
    found = jaccard_join.near_duplicates(docs)
    extra = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(extra, "doc_id", "left_anti").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are left, packed into sequences of 4,096 tokens."""
    return packing.best_fit(packing.pieces(docs, "word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("toxicity", toxic_out),
    ("line dedup", line_dedup_),
    ("n-gram Jaccard join", near_dedup),
    ("best-fit packing", packed),
]

#: The network, the ordered line matches and the packing aren't SQL; tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, folder = read(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, step) in enumerate(STAGES):
        step(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
