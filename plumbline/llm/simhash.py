"""Near-duplicate documents by SimHash fingerprints and multi-index hashing.

A text's words (A-Z in lower case) give its shingles of three words, repeats included; a text of one
or two words has its whole sequence as one. A bit of the fingerprint is 1 where more than half of
the shingles' XXH64 values (seed 42) have it. Fingerprints within three bits link.

Equal fingerprints fold first. Each fingerprint is cut into two halves of 32 bits. Of two
fingerprints within three bits, one half differs in at most one bit; so the table of halves is
asked for every half itself and for its Hamming ball of radius one (half of the ball does: of two
halves one bit apart, the one with the 0 asks). Where two halves are found in the table, the
fingerprints that hold them meet only if a second index finds them: under equal halves the other
halves differ in at most three bits, so one of their four bytes is equal; under halves one bit apart
they differ in at most two, so one of three parts of 11, 11 and 10 bits is. No link is lost, and a half
that very many fingerprints share is not compared pair by pair. What meets is verified in full.

Null and empty texts and texts without words have fingerprint zero and link like any other. Rows
with the same id are one node, whatever their texts; a null id is nobody's component, and its row's
component is the smallest id it reaches, null if there is none. Repeated rows each have a result.
Texts are read whole, in pieces of bounded memory. An empty table gives an empty result. Only the
id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import binary, hot_join, slices, stage
from plumbline.llm.jaccard_join import components

SHINGLE, SEED, RADIUS = 3, 42, 3
#: Shingles hashed at once.
PIECE = 50_000


def fingerprint(text: bytes) -> int:
    """The 64-bit fingerprint of a text, unsigned."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    last = max(1, len(words) - SHINGLE + 1)
    votes, digest, join = np.zeros(64, np.int64), xxhash.xxh64_intdigest, b" ".join
    for s in range(0, last, PIECE):
        hashes = np.array([digest(join(words[i:i + SHINGLE]), SEED) for i in range(s, min(s + PIECE, last))], ">u8")
        votes += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > last).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, print): the fingerprint of every row as a signed long."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = np.array([fingerprint(t) for t in binary(batch.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got)], ["id", "print"])

    return rows.mapInArrow(hashed, f"id {dict(rows.dtypes)['id']}, print bigint")


def _ball(value: Column, bits: int) -> Column:
    """The value itself and, for each of its 0 bits, the value with that bit set."""
    flips = F.transform(
        F.sequence(F.lit(0), F.lit(bits - 1)), lambda i: F.call_function("shiftleft", F.lit(1).cast("bigint"), i))
    return F.concat(F.array(value), F.transform(
        F.filter(flips, lambda bit: value.bitwiseAND(bit) == 0), lambda bit: value.bitwiseOR(bit)))


def _parts(value: Column, widths: list[int]) -> Column:
    """A 32-bit value cut into parts of these widths."""
    out, at = [], 32
    for width in widths:
        at -= width
        out.append(F.shiftrightunsigned(value, at).bitwiseAND(F.lit((1 << width) - 1).cast("bigint")))
    return F.array(*out)


def links(prints: DataFrame) -> DataFrame:
    """(a, b): all pairs of the distinct fingerprints in ``print`` within three bits, a before b."""
    low = F.lit(0xFFFFFFFF).cast("bigint")
    high = F.shiftrightunsigned("print", 32)
    halves = stage(prints.select("print", F.explode(F.array(
        F.struct(high.alias("half"), F.col("print").bitwiseAND(low).alias("other"), F.lit(0).alias("which")),
        F.struct(F.col("print").bitwiseAND(low).alias("half"), high.alias("other"), F.lit(1).alias("which")),
    )).alias("_")).select("print", "_.*"), "halves")
    table = stage(halves.groupBy("which", "half").agg(F.count("*").alias("n")), "halves-table")
    asked = table.select("which", F.col("half").alias("mine"), "n", F.explode(_ball(F.col("half"), 32)).alias("half")).where(
        "half <> mine OR n > 1")  # a half of one fingerprint has nothing to find under itself
    met = stage(asked.drop("n").join(table.drop("n"), ["which", "half"]).select("which", "mine", F.col("half").alias("theirs")), "met")

    def placed(side: str, other_side: str, name: str) -> DataFrame:
        """The fingerprints of one side of each met pair of halves, once for each part of their other half."""
        equal = F.col("mine") == F.col("theirs")
        parts = F.posexplode(F.when(equal, _parts(F.col("other"), [8, 8, 8, 8])).otherwise(_parts(F.col("other"), [11, 11, 10])))
        return halves.withColumnRenamed("half", side).join(met, ["which", side]).select(
            "which", side, other_side, F.col("print").alias(name), parts.alias("place", "part"))

    on = ["which", "mine", "theirs", "place", "part"]
    mine, theirs = placed("mine", "theirs", "a"), placed("theirs", "mine", "b")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS
    pairs = mine.join(theirs, on).where((F.col("a") != F.col("b")) & near)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, ``fingerprint`` (16 hex digits) and ``component_id`` of every row."""
    rows = stage(fingerprints(df, id_col, text_col), "prints")
    prints = stage(rows.groupBy("print").agg(F.count("*").alias("n"), F.min("id").alias("first")), "distinct")
    # rows that share an id are one node
    shared = rows.where("id is not null").groupBy("id").agg(F.min("print").alias("a"), F.max("print").alias("b"), F.count("*").alias("n"))
    several = shared.where("a < b")
    more = rows.join(several.where("n > 2").select("id", "a"), "id").where("print <> a").select("a", F.col("print").alias("b"))
    found = components(links(prints.select("print")).union(several.select("a", "b")).union(more))
    named = prints.join(found.withColumnRenamed("node", "print"), "print", "left").withColumn("comp", F.coalesce("comp", "print"))
    firsts = named.groupBy("comp").agg(F.min("first").alias("component_id"))
    facts = stage(named.join(firsts, "comp").select("print", "n", "component_id"), "named")
    total = facts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return hot_join(rows, facts, "print", "n", total).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
