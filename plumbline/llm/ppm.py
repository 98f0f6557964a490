"""Scoring by prediction by partial matching over a byte-context trie.

A text is its lower-cased words with one space between and an end symbol. The trie holds, for
every context of five bytes seen in the training texts, how often each byte followed, and for
every shorter one in how many different longer contexts it did (update exclusion). A byte is
predicted from the longest context that the trie has; where it never followed that context, the
model escapes (method D: half a count of each follower goes to the escape) to the context without
its first byte, in which the followers already ruled out no longer count. Below the empty context
all bytes not yet ruled out are equally likely. The code length of a text is the sum.

Everything counted comes from all training rows and grows with them. Scan tasks gather texts in
blocks, count words and byte grams per block, and pack the block's texts and its sorted grams.
Bounds taken from every 1,024th gram of each block cut the grams into ranges of about equal weight;
what a block has in a range travels as one packed row. Words travel in the same way, cut into
ranges of their hash, and are told apart by their bytes. A range sums its blocks, works out its part
of the trie (``context_trie``) and answers each block with the chances of exactly what occurs in it:
no task and no driver holds the model. A range that one context makes too heavy is shared by more
groups of blocks, each with the range's sums.

Null and empty texts are one end token. Rows are scored one by one, so null ids, ties and repeated
rows stay; a null id counts as the empty text for the split. Without training rows all bytes are
equally likely. An empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import binary, slices, stage, task_id
from plumbline.llm.context_trie import ORDER, cut_contexts, edges, log_chances, merged, pack, unpack

#: Bytes of text in a block, unless one text is longer.
BLOCK_BYTES = 16_000_000
#: Positions looked at together.
STRIP = 1_000_000
#: Grams of a block in one packed row, and how many grams one mark stands for.
PIECE, MARK = 1 << 20, 1024
#: Grams, counted once a block, that a range is meant to hold, and that a group may hold.
RANGE_GRAMS, GROUP_GRAMS = 500_000, 8_000_000
END = b"\n"


def held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def plain(text: bytes) -> list[bytes]:
    return text.lower().split()


def grams_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ``ORDER`` + 1 bytes ending at each position of each text, as one number, and where each text ends.

    Before a text stand end symbols.
    """
    lengths = np.array([len(t) + ORDER for t in texts])
    raw = np.frombuffer(b"".join([END * ORDER + t for t in texts]), np.uint8)
    gram = np.zeros(len(raw), np.int64)
    for k in range(ORDER + 1):  # the byte itself lowest, the nearest byte before it highest
        gram[ORDER:] |= raw[ORDER - k: len(raw) - k].astype(np.int64) << (8 * (ORDER + 1 - k) if k else 0)
    ends = np.cumsum(lengths)
    inside = np.ones(len(raw), bool)
    for k in range(ORDER):
        inside[ends - lengths + k] = False
    return gram[inside], np.cumsum(lengths - ORDER)


def _strips(texts: list[bytes]) -> Iterator[list[bytes]]:
    own, size = [], 0
    for t in texts:
        own.append(t)
        size += len(t)
        if size >= STRIP:
            yield own
            own, size = [], 0
    if own:
        yield own


def pack_words(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(END.join(words))


def unpack_words(data: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(data).split(END)


def _gather(rows: DataFrame, trains: Callable) -> DataFrame:
    """Per block: its packed texts, every word in it with its count in training texts, and the same of its grams, packed in order."""
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"kind string, block string, n bigint, ids array<{kind}>, texts binary, keys binary, counts binary, marks array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, serial = zstandard.ZstdCompressor(level=1), 0
        ids, texts, size, arrow = [], [], 0, pa.null()

        def table(kind: str, name: str, height: int, **own: pa.Array) -> pa.RecordBatch:
            types = {"n": pa.int64(), "ids": pa.list_(arrow), "texts": pa.binary(),
                     "keys": pa.binary(), "counts": pa.binary(), "marks": pa.list_(pa.int64())}
            return pa.RecordBatch.from_arrays(
                [pa.array([kind] * height), pa.array([name] * height), *[own.get(c, pa.nulls(height, t)) for c, t in types.items()]],
                ["kind", "block", *types])

        def block() -> Iterator[pa.RecordBatch]:
            nonlocal serial
            name = f"{task_id()}-{serial}"
            serial += 1
            seen, taught, lines = Counter(), Counter(), []
            for i, text in zip(ids, texts):
                words = plain(text)
                (taught if trains(i) else seen).update(words)
                lines.append(b" ".join(words) + END)
            for w in seen.keys() - taught.keys():
                taught[w] = 0
            parts = []
            for teach in (True, False):
                for strip in _strips([x for i, x in zip(ids, lines) if trains(i) == teach]):
                    keys, n = np.unique(grams_of(strip)[0], return_counts=True)
                    parts.append((keys, n if teach else n * 0))
                    if len(parts) == 16:
                        parts = [merged(parts)]
            keys, n = merged(parts)
            yield table("texts", name, 1, ids=pa.array([ids], pa.list_(arrow)),
                        texts=pa.array([packer.compress(b"".join(lines))], pa.binary()))
            known = sorted(taught, key=zlib.crc32)
            for at in range(0, len(known), PIECE):
                own = known[at: at + PIECE]
                yield table("word", name, 1, n=pa.array([len(own)]), keys=pa.array([pack_words(own)]),
                            counts=pa.array([pack(np.array([taught[w] for w in own], np.int64))]))
            for at in range(0, len(keys), PIECE):
                own = slice(at, at + PIECE)
                yield table("gram", name, 1, keys=pa.array([pack(keys[own])]), counts=pa.array([pack(n[own])]),
                            marks=pa.array([keys[own][::MARK] >> 8], pa.list_(pa.int64())))
            # the end token of each training text
            yield table("end", name, 1, n=pa.array([sum(map(trains, ids))], pa.int64()))

        for batch in slices(batches):
            arrow = batch.column(0).type
            for i, text in zip(batch.column(0).to_pylist(), binary(batch.column(1))):
                ids.append(i)
                texts.append(text)
                size += len(text)
                if size >= BLOCK_BYTES:
                    yield from block()
                    ids, texts, size = [], [], 0
        if ids:
            yield from block()

    return rows.mapInArrow(run, schema)


def _bounds(pieces: DataFrame) -> list[int]:
    """Contexts that part the grams of all blocks into ranges of about equal weight, at most eight a shuffle partition."""
    marks = pieces.select(F.explode("marks").alias("mark"))
    ranges = _ranges(pieces.sparkSession, marks.count() * MARK)
    if ranges < 2:
        return []
    found = marks.agg(F.percentile_approx("mark", [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0]
    return sorted(set(found))


def _cut(pieces: DataFrame, bounds: list[int], words: bool = False) -> DataFrame:
    """Each block's grams or words by range: (bucket, block, size, keys, counts).

    ``bounds`` are of contexts for grams and of hashes for words.
    """
    inner = np.array(bounds, np.int64) << (0 if words else 8)
    load, save = (unpack_words, pack_words) if words else (unpack, pack)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4):
            rows = []
            for block, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                keys, counts = load(keys), unpack(counts)
                place = np.fromiter(map(zlib.crc32, keys), np.int64, len(keys)) if words else keys
                stops = [0, *np.searchsorted(place, inner), len(keys)]
                rows.extend((i, block, b - a, save(keys[a:b]), pack(counts[a:b])) for i, (a, b) in enumerate(zip(stops, stops[1:])) if b > a)
            columns = zip(*rows) if rows else [[]] * 5
            types = [pa.int32(), pa.string(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types)], ["bucket", "block", "size", "keys", "counts"])

    return pieces.select("block", "keys", "counts").mapInArrow(run, "bucket int, block string, size bigint, keys binary, counts binary")


def _shared(cuts: DataFrame) -> DataFrame:
    """``cuts`` with the number of groups that share its range, and the one that its block is in."""
    weights = cuts.groupBy("bucket").agg(F.greatest(F.lit(1), F.ceil(F.sum("size") / GROUP_GRAMS)).cast("int").alias("shares"))
    return cuts.join(weights, "bucket").withColumn("share", F.pmod(F.xxhash64("block"), "shares").cast("int"))


def _ranges(spark, keys: int) -> int:
    return max(1, min(-(-keys // RANGE_GRAMS), 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _summed_words(table: pa.Table) -> pa.Table:
    """Distinct words of packed rows with the sums of their counts: (word, n)."""
    parts, held = [], 0

    def folded() -> pa.Table:
        return pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

    for keys, counts in zip(table["keys"], table["counts"]):
        parts.append(pa.table({"word": pa.array(unpack_words(keys.as_py()), pa.large_binary()), "n": unpack(counts.as_py())}))
        held += parts[-1].num_rows
        if held > 4 * RANGE_GRAMS:
            parts, held = [folded()], 0
    return folded()


def word_counts(pieces: DataFrame) -> tuple[DataFrame, int, int]:
    """(block, bucket, words, seen): each block's words and their counts in all training texts; all training words; distinct ones."""
    spark = pieces.sparkSession
    n = _ranges(spark, pieces.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    cuts = _shared(stage(_cut(pieces, [(i << 32) // n for i in range(1, n)], words=True), "cut_words"))

    def fold(table: pa.Table) -> pa.Table:
        found = _summed_words(table)
        counts = found["n"].to_numpy()
        return pa.table({
            "bucket": table["bucket"][:1], "shares": table["shares"][:1], "keys": pa.array([pack_words(found["word"].to_pylist())]),
            "counts": pa.array([pack(counts)]), "total": pa.array([int(counts.sum())]), "known": pa.array([int((counts > 0).sum())])})

    kinds = "bucket int, shares int, keys binary, counts binary, total bigint, known bigint"
    sums = stage(
        cuts.select("bucket", "share", "shares", "keys", "counts").groupBy("bucket", "share").applyInArrow(fold, kinds)
        .groupBy("bucket").applyInArrow(fold, kinds), "word_sums")
    total, known = sums.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first()
    facts = sums.withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).select(
        F.col("bucket").alias("_bucket"), F.col("share").alias("_share"), F.col("keys").alias("_keys"), "counts")

    def answer(cuts: pa.Table, facts: pa.Table) -> pa.Table:
        if not cuts.num_rows:
            return pa.table({"block": pa.array([], pa.string()), "bucket": pa.array([], pa.int32()),
                             "words": pa.array([], pa.binary()), "seen": pa.array([], pa.binary())})
        kept, counts = pa.array(unpack_words(facts["_keys"][0].as_py()), pa.large_binary()), unpack(facts["counts"][0].as_py())
        packer = zstandard.ZstdCompressor(level=1)
        found = [packer.compress(counts[pc.index_in(pa.array(unpack_words(k.as_py()), pa.large_binary()), value_set=kept).to_numpy()].tobytes())
                 for k in cuts["keys"]]
        return pa.table({"block": cuts["block"], "bucket": cuts["bucket"], "words": cuts["keys"], "seen": pa.array(found, pa.binary())})

    replies = cuts.select("bucket", "share", "block", "keys").groupBy("bucket", "share").cogroup(
        facts.groupBy("_bucket", "_share")).applyInArrow(answer, "block string, bucket int, words binary, seen binary")
    return replies, total, known


def _summed(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    parts, held = [], 0
    for keys, counts in zip(table["keys"], table["counts"]):
        parts.append((unpack(keys.as_py()), unpack(counts.as_py())))
        held += len(parts[-1][0])
        if held > 4 * RANGE_GRAMS:
            parts, held = [merged(parts)], 0
    return merged(parts)


def gram_scores(pieces: DataFrame) -> DataFrame:
    """(block, bucket, keys, chances): the packed grams of each block, and the log10 probability of each one's last byte."""
    spark, bounds = pieces.sparkSession, _bounds(pieces)
    cuts = _shared(stage(_cut(pieces, bounds), "cut_grams"))

    def fold(table: pa.Table) -> pa.Table:
        keys, counts = _summed(table)
        return pa.table({"bucket": table["bucket"][:1], "shares": table["shares"][:1],
                         "keys": pa.array([pack(keys)]), "counts": pa.array([pack(counts)])})

    def finish(table: pa.Table) -> pa.Table:
        keys, counts = _summed(table)
        bucket = table["bucket"][0].as_py()
        rows = edges(keys[counts > 0], bounds, bucket)
        size, prefix, symbol, child, n = zip(*rows) if rows else [[]] * 5
        one = lambda value, kind: pa.array([value] + [None] * len(rows), kind)
        more = lambda values, kind: pa.array([None, *values], kind)
        return pa.table({
            "bucket": one(bucket, pa.int32()), "shares": one(table["shares"][0].as_py(), pa.int32()),
            "keys": one(pack(keys), pa.binary()), "counts": one(pack(counts), pa.binary()),
            "size": more(size, pa.int32()), "prefix": more(prefix, pa.int64()), "symbol": more(symbol, pa.int64()),
            "child": more(child, pa.int64()), "n": more(n, pa.int64())})

    packed = "bucket int, shares int, keys binary, counts binary"
    sums = stage(
        cuts.select("bucket", "share", "shares", "keys", "counts").groupBy("bucket", "share").applyInArrow(fold, packed)
        .groupBy("bucket").applyInArrow(finish, f"{packed}, size int, prefix bigint, symbol bigint, child bigint, n bigint"), "sums")

    context = ["size", "prefix", "symbol"]
    cut = (
        sums.where("size IS NOT NULL").groupBy(*context, "child").agg(F.sum("n").alias("n"))
        .groupBy(*context).agg(F.sum(F.when(F.col("child") < 0, F.col("n")).otherwise(1)).alias("n"))
    )
    paths = spark.createDataFrame(
        [(i, size, p) for i in range(len(bounds) + 1) for size in range(ORDER) for p in cut_contexts(bounds, i, size)],
        "bucket int, size int, prefix bigint")
    whole = sums.where("size IS NULL").select("bucket", "shares", "keys", "counts")
    facts = (
        whole.unionByName(paths.join(cut, ["size", "prefix"]).join(whole.select("bucket", "shares"), "bucket"), allowMissingColumns=True)
        .withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
        .select(F.col("bucket").alias("_bucket"), F.col("share").alias("_share"), F.col("keys").alias("_keys"), "counts", *context, "n")
    )

    def answer(cuts: pa.Table, facts: pa.Table) -> pa.Table:
        if not cuts.num_rows:
            return pa.table({"block": pa.array([], pa.string()), "bucket": pa.array([], pa.int32()),
                             "keys": pa.array([], pa.binary()), "chances": pa.array([], pa.binary())})
        head = facts.filter(facts["_keys"].is_valid())
        keys = unpack(head["_keys"][0].as_py())
        chances = log_chances(keys, unpack(head["counts"][0].as_py()), facts.filter(facts["size"].is_valid()))
        packer = zstandard.ZstdCompressor(level=1)
        found = [packer.compress(chances[np.searchsorted(keys, unpack(k.as_py()))].tobytes()) for k in cuts["keys"]]
        return pa.table({"block": cuts["block"], "bucket": cuts["bucket"], "keys": cuts["keys"], "chances": pa.array(found, pa.binary())})

    return cuts.select("bucket", "share", "block", "keys").groupBy("bucket", "share").cogroup(
        facts.groupBy("_bucket", "_share")).applyInArrow(answer, "block string, bucket int, keys binary, chances binary")


def scored(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", is_held_out: Callable = held_out) -> DataFrame:
    """A row per document: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score``."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    parts = stage(_gather(rows, lambda i: not is_held_out(i)), "blocks")
    part = lambda k: parts.where(F.col("kind") == k)

    words, taught, known = word_counts(part("word"))
    ends = part("end").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    tokens, distinct = taught + ends, known + (ends > 0)
    replies = words.unionByName(gram_scores(part("gram")), allowMissingColumns=True)

    def score(texts: pa.Table, replies: pa.Table) -> pa.Table:
        ids = texts["ids"][0].values
        lines = zstandard.ZstdDecompressor().decompress(texts["texts"][0].as_py()).split(END)[:-1]
        unzip = zstandard.ZstdDecompressor().decompress
        place, seen = {}, []
        for packed, counts in zip(*(replies.filter(replies["words"].is_valid())[c] for c in ("words", "seen"))):
            for w in unpack_words(packed.as_py()):
                place[w] = len(place)
            seen.append(np.frombuffer(unzip(counts.as_py()), np.int64))
        seen = np.concatenate([*seen, [ends]])
        scale = math.log10(tokens + 1 * (distinct + 1))
        logs = np.log10(seen + 1) - scale
        ranges = replies.filter(replies["keys"].is_valid()).sort_by("bucket")
        keys = np.concatenate([unpack(k.as_py()) for k in ranges["keys"]])
        chances = np.concatenate([np.frombuffer(unzip(c.as_py())) for c in ranges["chances"]])
        n_tokens, n_known, base, totals = [], [], [], []
        for strip in _strips([x + END for x in lines]):
            gram, stops = grams_of(strip)
            sums = np.concatenate([[0.0], np.cumsum(chances[np.searchsorted(keys, gram)])])
            totals.extend(np.diff(sums[np.concatenate([[0], stops])]).tolist())
            for line in strip:
                at = np.array([*[place[w] for w in line.split()], len(place)])
                n_tokens.append(len(at))
                n_known.append(int((seen[at] > 0).sum()))
                base.append(float(logs[at].sum()))
        held = [is_held_out(i) for i in ids.to_pylist()]
        return pa.table({
            "doc_id": ids, "held_out": pa.array(held), "n_tokens": pa.array(n_tokens, pa.int64()),
            "n_known": pa.array(n_known, pa.int64()), "train_tokens": pa.array([tokens] * len(held), pa.int64()),
            "base_score": pa.array(base), "score": pa.array(totals)})

    return part("texts").select("block", "ids", "texts").groupBy("block").cogroup(replies.withColumnRenamed("block", "at").groupBy("at")).applyInArrow(
        score, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
