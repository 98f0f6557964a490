"""Exact duplicates by deterministic block naming.

A text is cut into blocks of a fixed number of bytes. Equal blocks get one integer name, by
sorting the distinct blocks; then adjacent pairs of names are named the same way, level by level,
until each document has one name. Two documents are equal exactly when they reach the same name
at the same level, so the identity is free of collisions.

The blocks' contents are shuffled once. A 64-bit hash routes them; contents that share a hash
but differ are told apart by their order, so a hash collision changes no result. All later
levels move pairs of integers only.

Null texts count as empty; all empty texts are equal. Rows with the same id and text are one key
and come back once each; ids may be null (smallest last: a null id never stays if another row
can). An empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import SPACE, match, ranked, stage, whole

BLOCK_BYTES = 4096
KEY = ["_id", "_h"]


def _named(blocks: DataFrame, on: list[str]) -> DataFrame:
    """Blocks with the integer name of what they hold; ``on`` names the columns that decide it."""
    names = stage(ranked(blocks.select(*on).distinct(), on, "_name"), "names")
    return match(blocks, names, on).drop(*on)


def identities(df: DataFrame, block_bytes: int = BLOCK_BYTES, hash_bits: int = 64) -> DataFrame:
    """One row per distinct (id, text): ``_id``, ``_h`` and its identity ``_level``, ``_name``.

    ``hash_bits`` narrows the routing hash; tests use it to force collisions.
    """
    keyed = df.select("_id", "_h", F.encode("_norm", "utf-8").alias("_bin"))
    parts = F.greatest(F.lit(1), F.ceil(F.octet_length("_bin") / block_bytes).cast("int"))
    cut = F.transform(F.sequence(F.lit(0), parts - 1), lambda i: F.substring(F.col("_bin"), i * block_bytes + 1, F.lit(block_bytes)))
    route = F.xxhash64("_block").bitwiseAND(F.lit((1 << hash_bits) - 1 if hash_bits < 64 else -1))
    blocks = keyed.select(*KEY, F.posexplode(cut).alias("_pos", "_block")).withColumn("_route", route)

    # The one shuffle of contents. Copies fold before it, on the side that reads them.
    content = stage(
        blocks.groupBy("_route", "_block").agg(F.lit(1).alias("_one"))
        .groupBy("_route").agg(F.count("*").alias("_contents")), "routes")
    shared = content.where("_contents > 1").select("_route")
    if shared.isEmpty():  # the hash tells all contents apart
        named = _named(blocks.select(*KEY, "_pos", "_route"), ["_route"])
    else:
        clash = F.broadcast(shared.withColumn("_clash", F.lit(True))) if hash_bits < 64 else shared.withColumn("_clash", F.lit(True))
        marked = blocks.join(clash, "_route", "left").withColumn("_block", F.when(F.col("_clash"), F.col("_block")))
        named = _named(marked.select(*KEY, "_pos", "_route", "_block"), ["_route", "_block"])
    named = stage(named, "level")
    most = named.agg(F.max("_pos")).first()[0]

    level, done = 0, []
    while most:  # as many levels as the longest document's number of blocks has binary digits
        sizes = named.groupBy(*KEY).agg(F.max("_pos").alias("_last"))
        joined = match(named, sizes, KEY)
        done.append(joined.where("_last = 0").select(*KEY, F.lit(level).alias("_level"), "_name"))
        side = lambda k: F.max(F.when(F.col("_pos") % 2 == k, F.col("_name")))
        pairs = (
            joined.where("_last > 0").groupBy(*KEY, F.floor(F.col("_pos") / 2).alias("_pos"))
            .agg(side(0).alias("_left"), side(1).alias("_right"))
        )
        named = stage(_named(pairs, ["_left", "_right"]), "level")
        most, level = named.agg(F.max("_pos")).first()[0], level + 1
    done.append(named.select(*KEY, F.lit(level).alias("_level"), "_name"))
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out.distinct()


def exact_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, hash_bits: int = 64,
) -> DataFrame:
    """A row per document: ``doc_id``, ``keep_id`` (smallest id among equal texts), ``group_size``,
    ``kept`` and ``text_sha256`` of the text with each run of white space made one space."""
    rows = df.select(F.col(id_col).alias("_id"), F.regexp_replace(whole(text_col), f"{SPACE}+", " ").alias("_norm"))
    rows = rows.withColumn("_h", F.xxhash64("_norm"))
    digests = stage(rows.select(*KEY, F.sha2(F.col("_norm"), 256).alias("text_sha256")), "digests")
    own = identities(rows, block_bytes, hash_bits)
    labelled = stage(match(digests, own, KEY).select("_id", "text_sha256", "_level", "_name"), "labelled")
    groups = labelled.groupBy("_level", "_name").agg(F.min("_id").alias("keep_id"), F.count("*").alias("group_size"))
    return labelled.join(groups, ["_level", "_name"]).select(
        F.col("_id").alias("doc_id"), "keep_id", "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )
