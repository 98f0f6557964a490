"""What several operators share: whole-table reads, hashed row keys, ordered integer names."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import shared_dir, stage

#: The characters that part words everywhere in this package, as a Java and as a Python class.
SPACE = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"

__all__ = ["SPACE", "WORD", "read", "stage", "shared_dir", "binary", "task_id", "whole", "match", "ranked", "slices", "vocabulary", "hot_join", "likely"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Where the public tokenizer file ``name`` lies on this machine."""
    import public_tokenizers

    return name if os.path.isabs(name) else public_tokenizers.path(name)


def whole(text: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def binary(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def task_id() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that a task's memory follows its texts and not the session's batch size."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def match(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys of which null equals null; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def ranked(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """Distinct rows with an integer name that follows the order of ``by``.

    A range shuffle puts the rows in order over all partitions; the name is the partition's
    number and the place in it, so no task sees more than its range. The rows of a range are
    distinct and sorted, so a task that runs again gives the same names.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        df.repartitionByRange(n, *by).sortWithinPartitions(*by)
        .withColumn(name, F.monotonically_increasing_id())
    )


#: A key with more than this share of all rows is joined by broadcast; fewer than 1 / HOT_SHARE keys can have it.
HOT_SHARE = 1 / 1024


def hot_join(rows: DataFrame, facts: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """``rows`` joined with ``facts`` (one row per key, with its number of rows in ``weight``).

    The facts of hot keys, fewer than 1,024 whatever the table, are broadcast, so their rows stay where
    they are; the rest meets by shuffle, no key of it holding more than ``HOT_SHARE`` of the rows.
    """
    is_hot = F.col(weight) > F.lit(total) * HOT_SHARE
    hot = facts.where(is_hot).withColumn("_hot", F.lit(True))
    near = rows.join(F.broadcast(hot), key, "left")
    found = near.where("_hot").drop("_hot")
    far = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(facts.where(~is_hot), key)
    return found.unionByName(far)


#: At most so many 64-bit words, whatever the table, are broadcast to drop rows before a join.
FILTER_WORDS = 1 << 19


def likely(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` without most of those whose ``key`` isn't among that of ``keys``; a join must follow.

    A Bloom filter: each key sets two bits of one word. With more keys it only lets more rows pass.
    """
    words = min(FILTER_WORDS, keys.count() // 4 + 1)
    h = F.xxhash64(key)

    def marked(df: DataFrame, bits: str) -> DataFrame:
        return df.withColumn("_h", h).withColumns({
            "_word": F.expr(f"pmod(shiftrightunsigned(_h, 12), {words}L)"),
            bits: F.expr("shiftleft(1L, cast(_h & 63 AS int)) | shiftleft(1L, cast(shiftrightunsigned(_h, 6) & 63 AS int))"),
        }).drop("_h")

    held = marked(keys.select(key), "_bits").groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    return marked(rows, "_own").join(F.broadcast(held), "_word").where("(_own & _bits) = _own").select(*rows.columns)
