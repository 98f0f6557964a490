"""Best-fit packing of token sequences in bulk-synchronous rounds.

Documents and gaps are ordered by size. In a round every class of equally long pieces, longest
first, looks up its successor among the gaps (the smallest that holds it); the pieces of the
class and the gaps of that size are matched by rank, so no two pieces want one gap; the gaps that
got a piece move to their new size, and the next sweep starts. What finds no gap opens sequences.

Pieces are ordered and ranked by Spark: a range shuffle by length and id, then a place within the
range and an offset for each range and length, so equally long pieces (copies) spread over tasks
however many they are. The sweeps need only how many pieces and gaps there are of each size, at
most ``capacity`` numbers; they run on these counts and give intervals of ranks. Each task then
places its pieces by a binary search in the intervals, whatever the number of pieces.

A null text counts as empty and still takes its end token. Rows with the same id are packed one
by one; null ids come last in the order. An empty table gives an empty result. Only id and text
are read.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import binary, slices, stage, vocabulary

CAPACITY = 4096
END = 1
CACHE = 400_000
#: Words that the tokenizer gets in one call.
CALL = 256
#: Bytes of text whose words are looked up together.
TOGETHER = 4_000_000


class WordTokens:
    """Token ids of texts from a tokenizer that drops white space: it is asked once per chunk
    between ASCII white space, which none of its tokens spans. Places of tokens rise with the text."""

    def __init__(self, name: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.known, self.older = Tokenizer.from_file(vocabulary(name)), {}, {}

    def __call__(self, text: bytes) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        return self.of([text])[0]

    def of(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text."""
        if len(self.known) > CACHE:  # the generation before goes; what is met again moves over from this one
            self.known, self.older = {}, self.known
        words, known, older = [t.split() for t in texts], self.known, self.older
        new = set().union(*words).difference(known)
        if new:
            fresh = new.difference(older)
            for w in new - fresh:
                known[w] = older[w]
            self.look_up(list(fresh))
        return [b"".join(map(known.__getitem__, own)) for own in words]

    def look_up(self, words: list[bytes]) -> None:
        """Many words in one call, with a space between them; the place of a token says whose it is."""
        for at in range(0, len(words), CALL):
            own = words[at: at + CALL]
            text = [w.decode() for w in own]
            found = self.tokenizer.encode(" ".join(text), add_special_tokens=False)
            ends = np.cumsum([len(w) + 1 for w in text])
            places = np.fromiter((x for x, _ in found.offsets), np.int64, len(found))
            cuts = 4 * np.searchsorted(places, ends)
            ids = np.array(found.ids, "<u4").tobytes()
            self.known.update(zip(own, [ids[i:j] for i, j in zip([0, *cuts.tolist()], cuts.tolist())]))


@lru_cache(maxsize=1)
def word_tokens(name: str) -> WordTokens:
    """One per Python worker, so that later tasks find what earlier ones looked up."""
    return WordTokens(name)


def portions(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The texts in order, up to ``TOGETHER`` bytes at a time unless one text has more."""
    own: list[bytes] = []
    size = 0
    for text in texts:
        if own and size + len(text) > TOGETHER:
            yield own
            own, size = [], 0
        own.append(text)
        size += len(text)
    if own:
        yield own


def pieces(
    df: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """A row per piece of each document's ids and end token: ``doc_id``, ``piece``, ``start``,
    ``length``, ``ids_crc32``. Only documents longer than ``capacity`` are cut."""
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(vocabulary)
        for batch in slices(batches):
            rows, number, start, length, sums = [], [], [], [], []
            for i, own_ids in enumerate(x for texts in portions(binary(batch.column(1))) for x in tokens.of(texts)):
                ids = memoryview(own_ids + tail)
                for k, at in enumerate(range(0, len(ids) // 4, capacity)):
                    own = ids[4 * at: 4 * (at + capacity)]
                    rows.append(i)
                    number.append(k)
                    start.append(at)
                    length.append(len(own) // 4)
                    sums.append(zlib.crc32(own))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(rows, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(sums, pa.int64()),
            ], ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def sweeps(sizes: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """The rounds on counts: (length, first rank, first sequence, offset) of each interval of ranks.

    Within an interval the rank and the sequence rise together and the offset stays.
    """
    plan: list[tuple[int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # size: runs of sequences (first, how many)
    open_sizes: list[int] = []
    opened = 0

    def give_back(size: int, first: int, n: int) -> None:
        if size and n:
            if not gaps[size]:
                bisect.insort(open_sizes, size)
            gaps[size].append((first, n))

    for length in sorted(sizes, reverse=True):
        rank, left = 0, sizes[length]
        while left:
            at = bisect.bisect_left(open_sizes, length)
            if at == len(open_sizes):
                n = -(-left // (capacity // length))  # new sequences, as few as hold the rest
                give_back(capacity, opened, n)
                opened += n
                continue
            size = open_sizes[at]
            first, n = gaps[size].pop()
            if not gaps[size]:
                del open_sizes[at]
            used = min(n, left)
            plan.append((length, rank, first, capacity - size))
            rank, left = rank + used, left - used
            give_back(size - length, first, used)
            give_back(size, first + used, n - used)
    return plan


def best_fit(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id`` and ``offset`` for rows with a ``length`` of 1 to ``capacity``; other columns stay.

    Rows are ordered by length and then by ``doc_id``, ``piece`` and ``start``. Columns named like the two
    results are replaced.
    """
    spark = rows.sparkSession
    at_name = next(f"_at{i}" for i in count() if f"_at{i}" not in rows.columns)
    rows = stage(rows.drop("sequence_id", "offset"), "pieces")  # the range shuffle reads its input twice, once for the bounds
    order = ["length", "doc_id", "piece"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = stage(
        rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
        .withColumn(at_name, F.monotonically_increasing_id()), "ranges")
    # a number for each range and length: at most the ranges plus ``capacity`` rows
    runs = sorted(
        placed.groupBy("length", F.shiftright(at_name, 33).alias("part"))
        .agg(F.min(at_name).alias("first"), F.count("*").alias("n")).collect(),
        key=lambda r: (r["length"], r["part"]))
    sizes: dict[int, int] = defaultdict(int)
    first_at, rank_at = [], []
    for r in runs:
        first_at.append(r["first"])
        rank_at.append(sizes[r["length"]])
        sizes[r["length"]] += r["n"]
    by_place = np.argsort(np.array(first_at, np.int64))
    first_of = np.array(first_at, np.int64)[by_place]
    rank_of = np.array(rank_at, np.int64)[by_place]
    plan = np.array(sorted(sweeps(sizes, capacity)), np.int64).reshape(-1, 4)
    shift, columns = 1 << 44, rows.columns
    keys = plan[:, 0] * shift + plan[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(at_name).to_numpy(zero_copy_only=False)
            length = batch.column("length").to_numpy(zero_copy_only=False)
            k = np.searchsorted(first_of, at, "right") - 1
            rank = rank_of[k] + at - first_of[k]
            own = np.searchsorted(keys, length * shift + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], pa.array(plan[own, 2] + rank - plan[own, 1]), pa.array(plan[own, 3])],
                [*columns, "sequence_id", "offset"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return placed.mapInArrow(run, f"{kept}, sequence_id bigint, offset bigint")
