"""What the two set-similarity joins share: hashed word shingles, a sieve, rare-first prefixes, verification.

Sets are the distinct shingles of five words (of all words where there are fewer), as 64-bit
hashes. Two sets link at Jaccard similarity 80 % or more. All steps are exact.

The sieve. Order a set of n by hash. Sets that link share at least k of the n - ceil(.8 n) + k
first elements of each, with k about n / 5; so only this two fifths of the elements travel, packed
in sorted arrays, and a set whose shared elements there are fewer than k links with nothing. Texts
without near copies end here; the rest is small. The sieve also names each set by a hash of all of it, so that
equal sets are folded before any text is read again; a second sieve then counts how many elements of a set any
other has, which must be four fifths.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import binary, likely, ranked, slices, stage, task_id

WINDOW = 5
PERCENT = 80
#: Elements that one task packs before it sends them on.
BLOCK = 2_000_000
#: Bytes of text whose windows are hashed together.
TOGETHER = 2_000_000
#: Words of more bytes are hashed one by one.
LONG_WORD = 64
#: Fixed odd multipliers of the places in a window.
PLACES = [int.from_bytes(xxhash.xxh3_64_digest(bytes([i])), "big") | 1 for i in range(WINDOW)]
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


class Cut(NamedTuple):
    """A set for each line of at least ``least`` words, numbered by line, or one for each text, numbered 0."""

    by_line: bool
    least: int = 0


class Sets(NamedTuple):
    text: np.ndarray  # place of the set's text among the texts
    no: np.ndarray
    size: np.ndarray
    elements: np.ndarray  # of all sets one after the other, each set sorted and distinct


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: eight bytes at a time, all words together. ``data`` ends with eight bytes of any value."""
    eights = np.ndarray(len(data) - 7, "<u8", data, strides=1)
    out = mixed(sizes.astype(np.uint64))
    left = np.flatnonzero(sizes <= LONG_WORD)
    for at in range(0, LONG_WORD, 8):
        left = left[sizes[left] > at]
        if not len(left):
            break
        spare = (8 * np.maximum(0, at + 8 - sizes[left])).astype(np.uint64)
        own = (eights[starts[left] + at] << spare) >> spare
        out[left] = mixed(out[left] ^ own)
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i]: starts[i] + sizes[i]])
    return out


def shingled(texts: list[bytes], cut: Cut, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> Sets:
    """The sets of all texts in order; only those that ``wanted`` (of place of text and number) keeps."""
    data = b"\n".join(texts).lower() + bytes(8)
    end = len(data) - 8
    codes = np.frombuffer(data, np.uint8, end)
    space = np.ones(end + 2, bool)
    space[1:-1] = SPACES[codes]
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    text_starts = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]]) if texts else np.zeros(0, np.int64)
    if cut.by_line:
        ends = np.flatnonzero(codes == 10)
        line, head = np.searchsorted(ends, starts), np.searchsorted(ends, text_starts)
        own, words = np.unique(line, return_counts=True)  # ``line`` is in order
        text = np.searchsorted(head, own, "right") - 1
        no = own - head[text]
    else:
        words = np.bincount(np.searchsorted(text_starts, starts, "right") - 1, minlength=len(texts))
        text = np.arange(len(texts))
        no = np.zeros(len(texts), np.int64)
    keep = words >= cut.least
    if wanted is not None:
        keep &= wanted(text, no)
    first = np.cumsum(words) - words  # the set's first word
    if not keep.all():
        chosen = np.repeat(keep, words)
        starts, sizes = starts[chosen], sizes[chosen]
        text, no, words = text[keep], no[keep], words[keep]
        first = np.cumsum(words) - words
    h = word_hashes(data, starts, sizes)
    h = np.concatenate([h, np.zeros(WINDOW, np.uint64)])
    m = len(starts)
    owner = np.repeat(np.arange(len(words)), words)
    x = np.zeros(m, np.uint64)
    for i, place in enumerate(PLACES):
        x += h[i: i + m] * np.uint64(place)
    # a window starts at each word but the set's last four; a shorter set has one, at its first word
    starting = np.arange(m) - first[owner] < np.maximum(words - WINDOW + 1, 1)[owner]
    for n in range(1, WINDOW):
        at = first[words == n]
        x[at] = np.uint64(n)
        for i in range(n):
            x[at] += h[at + i] * np.uint64(PLACES[i])
    x, owner = mixed(x[starting]), owner[starting]
    # in the order of owner and element: one key holds the owner and the element's first bits
    bits = np.uint64(max(1, len(words)).bit_length())
    key = (owner.astype(np.uint64) << (np.uint64(64) - bits)) | (x >> bits)
    order = np.argsort(key)
    key, y = key[order], x[order]
    if np.any((key[1:] == key[:-1]) & (y[1:] != y[:-1])):
        order = np.lexsort((x, owner))
        y = x[order]
    owner = owner[order]
    fresh = np.ones(len(y), bool)
    fresh[1:] = (y[1:] != y[:-1]) | (owner[1:] != owner[:-1])
    return Sets(text, no, np.bincount(owner[fresh], minlength=len(words)), y[fresh])


def portions(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """The place of the first and the texts themselves, up to ``TOGETHER`` bytes unless one text has more."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if i > first and size + len(text) > TOGETHER:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, texts[first:]


def firsts(sets: Sets, most: np.ndarray) -> np.ndarray:
    """The elements that are among the first ``most`` of their set."""
    start = np.cumsum(sets.size) - sets.size
    owner = np.repeat(np.arange(len(sets.size)), sets.size)
    return sets.elements[np.arange(len(owner)) - start[owner] < most[owner]]


def signs(sets: Sets) -> list[bytes]:
    """16 bytes for each set, which equal sets share."""
    own, ends = sets.elements.tobytes(), np.cumsum([0, *sets.size]).tolist()
    return [xxhash.xxh3_128_digest(own[8 * i: 8 * j]) for i, j in zip(ends, ends[1:])]


def needed(n):
    """Smallest overlap of a set of n with any set that it links with."""
    return -(-PERCENT * n // 100)


def shared_least(n):
    """Of the first elements that travel, how many a linked set shares at least (one less than the bound, at least 1)."""
    return np.maximum(1, n // 5 - 1)


def _send(n: np.ndarray) -> np.ndarray:
    return np.minimum(n, n - needed(n) + np.maximum(1, n // 5))


def _steps(owners: np.ndarray) -> tuple[bytes, bytes]:
    """Owners in rising order as the steps between them: a byte each, and in full those that a byte can't hold."""
    step = np.diff(owners, prepend=0)
    return np.minimum(step, 255).astype(np.uint8).tobytes(), step[step >= 255].astype(np.uint32).tobytes()


def _owners(steps: bytes, wide: bytes) -> np.ndarray:
    step = np.frombuffer(steps, np.uint8).astype(np.int64)
    step[step == 255] = np.frombuffer(wide, np.uint32)
    return np.cumsum(step)


def sieve(rows: DataFrame, cut: Cut) -> DataFrame:
    """Every set of ``rows`` (id, text) as ``id``, ``no``, ``n``, ``near``, false where it can't link, and ``sign``,
    16 bytes of the set where it can.

    ``rows`` must come from files or a staged table, so that a task that runs again packs the same blocks.
    """
    def read_(batch: pa.RecordBatch) -> Iterator[tuple[list, Sets]]:
        names = batch.column(0).to_pylist()
        for first, texts in portions(binary(batch.column(1))):
            sets = shingled(texts, cut)
            yield [names[first + i] for i in sets.text.tolist()], sets

    return _sieved(rows.select("id", "text"), read_, _send, shared_least, signs)


def candidates(heads: DataFrame) -> DataFrame:
    """The heads of which at least the needed part is shared with other heads."""
    def read_(batch: pa.RecordBatch) -> Iterator[tuple[list, Sets]]:
        lists = batch.column(1)
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        none = np.zeros(len(sizes), np.int64)
        yield batch.column(0).to_pylist(), Sets(none, none, sizes, lists.flatten().to_numpy().view(np.uint64))

    verdicts = _sieved(heads.select(F.col("key").alias("id"), "elements"), read_, lambda n: n, needed)
    return stage(heads.join(verdicts.where("near").select(F.col("id").alias("key")), "key"), "candidates")


def _sieved(rows: DataFrame, read_: Callable[[pa.RecordBatch], Iterator[tuple[list, Sets]]],
            send: Callable[[np.ndarray], np.ndarray], least: Callable[[np.ndarray], np.ndarray],
            sign: Callable[[Sets], list[bytes]] | None = None) -> DataFrame:
    """``id``, ``no``, ``n`` of each set that ``read_`` gives, and ``near``: of the first ``send(n)`` elements other sets sent ``least(n)``.
    ``sign`` is null where it isn't asked for or ``near`` is false."""
    kind = rows.schema["id"].dataType
    buckets = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = f"bucket int, block string, hashes binary, owners binary, wide binary, ids array<{kind.simpleString()}>, nos binary, sizes binary, signs binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = 0
        ids, nos, sizes, sent, hashes, named_, arrow = [], [], [], [], [], [], pa.null()

        def block() -> pa.RecordBatch:
            nonlocal serial
            owners = np.repeat(np.arange(len(ids)), np.concatenate(sent))
            values = np.concatenate(hashes)
            at = ((values >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)
            order = np.argsort(at, kind="stable")
            # half of a hash will do: the sieve only lets a little more pass
            values, owners, ends = values[order].astype(np.uint32), owners[order], np.searchsorted(at[order], np.arange(buckets + 1))
            full = [b for b in range(buckets) if ends[b + 1] > ends[b]] or [0]
            name, head = f"{task_id()}-{serial}", full[0]
            serial += 1
            own = lambda x: [x if b == head else None for b in full]  # noqa: E731  once for each block
            steps = [_steps(owners[ends[b]: ends[b + 1]]) for b in full]
            return pa.RecordBatch.from_arrays([
                pa.array(full, pa.int32()), pa.array([name] * len(full)),
                pa.array([values[ends[b]: ends[b + 1]].tobytes() for b in full], pa.binary()),
                pa.array([x for x, _ in steps], pa.binary()), pa.array([x for _, x in steps], pa.binary()),
                pa.array(own(ids), pa.list_(arrow)), pa.array(own(np.concatenate(nos).astype(np.int32).tobytes()), pa.binary()),
                pa.array(own(np.concatenate(sizes).astype(np.uint32).tobytes()), pa.binary()),
                pa.array(own(b"".join(named_)), pa.binary()),
            ], ["bucket", "block", "hashes", "owners", "wide", "ids", "nos", "sizes", "signs"])

        packed = 0
        for batch in slices(batches):
            arrow = batch.column(0).type
            for names, sets in read_(batch):
                ids += names
                nos.append(sets.no)
                sizes.append(sets.size)
                sent.append(send(sets.size))
                hashes.append(firsts(sets, sent[-1]))
                if sign is not None:
                    named_ += sign(sets)
                packed += len(hashes[-1])
                if packed > BLOCK:
                    yield block()
                    ids, nos, sizes, sent, hashes, named_, packed = [], [], [], [], [], [], 0
        if ids:
            yield block()

    def meet(table: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(x, np.uint32) for x in table["hashes"].to_pylist()]
        values = np.concatenate(hashes)
        order = np.argsort(values, kind="stable")
        equal = values[order][1:] == values[order][:-1]
        shared = np.zeros(len(values), bool)
        shared[order[1:][equal]] = True
        shared[order[:-1][equal]] = True
        owners, counts, at = [], [], 0
        for h, o, wide in zip(hashes, table["owners"].to_pylist(), table["wide"].to_pylist()):
            who, how = np.unique(_owners(o, wide)[shared[at: at + len(h)]], return_counts=True)
            owners.append(who.astype(np.uint32).tobytes())
            counts.append(how.astype(np.uint32).tobytes())
            at += len(h)
        return pa.table({
            "block": table["block"], "owners": pa.array(owners, pa.binary()), "counts": pa.array(counts, pa.binary()),
            "ids": table["ids"], "nos": table["nos"], "sizes": table["sizes"], "signs": table["signs"]})

    def judge(table: pa.Table) -> pa.Table:
        head = next(i for i, x in enumerate(table["sizes"].to_pylist()) if x is not None)
        sizes = np.frombuffer(table["sizes"][head].as_py(), np.uint32).astype(np.int64)
        found = np.zeros(len(sizes), np.int64)
        for o, c in zip(table["owners"].to_pylist(), table["counts"].to_pylist()):
            found[np.frombuffer(o, np.uint32)] += np.frombuffer(c, np.uint32)
        near, own = (sizes > 0) & (found >= least(sizes)), table["signs"][head].as_py()
        return pa.table({
            "id": table["ids"][head].values, "no": pa.array(np.frombuffer(table["nos"][head].as_py(), np.int32)),
            "n": pa.array(sizes), "near": pa.array(near),
            "sign": pa.array([own[16 * i: 16 * i + 16] if own and x else None for i, x in enumerate(near.tolist())], pa.binary())})

    met = rows.mapInArrow(pack, schema).groupBy("bucket").applyInArrow(
        meet, schema.replace("bucket int, ", "").replace("hashes binary, owners binary, wide binary", "owners binary, counts binary"))
    return met.groupBy("block").applyInArrow(judge, f"id {kind.simpleString()}, no int, n bigint, near boolean, sign binary")


def bitmaps(sets: Sets, words: int) -> np.ndarray:
    """A row of ``words`` 64-bit words for each set: bit b is the parity of the number of elements that fall on b.

    Each element that only one of two sets has flips one bit, so the bits in which two bitmaps differ
    are never more than the elements in which the sets differ.
    """
    bits, n = 64 * words, len(sets.size)
    owner = np.repeat(np.arange(n), sets.size)
    place = (sets.elements & np.uint64(bits - 1)).astype(np.int64)
    parity = (np.bincount(owner * bits + place, minlength=bits * n) & 1).astype(np.uint8)
    return np.packbits(parity).view(np.int64).reshape(n, words)


def far(x: str, y: str, words: int) -> Column:
    """In how many bits two bitmaps differ."""
    return F.expr(" + ".join(f"bit_count({x}.b{i} ^ {y}.b{i})" for i in range(words)))


def may_link(n1: str, x: str, n2: str, y: str, words: int) -> Column:
    """Bitmap filter: sets that link differ in at most n1 + n2 less twice the overlap they need."""
    return far(x, y, words) <= F.expr(f"{n1} + {n2} - 2 * (({PERCENT} * ({n1} + {n2}) + {99 + PERCENT}) div {100 + PERCENT})")


def representatives(rows: DataFrame, sieved: DataFrame, cut: Cut, words: int) -> tuple[DataFrame, DataFrame]:
    """The sets that the sieve left, numbered in the order of (id, no), as ``key``, ``id``, ``no`` and ``head``, the first
    equal set; and the heads that may link: ``key``, ``n``, ``bits`` (a bitmap of ``words`` words) and ``elements``.

    Only texts that hold a head are read again; most others are dropped before the shuffle.
    """
    fields = [f"b{i}" for i in range(words)]
    left = stage(ranked(
        sieved.where("near AND id IS NOT NULL").select("id", "no", "n", "sign").distinct(), ["id", "no"], "key"), "near")
    heads = left.groupBy("sign", "n").agg(F.min("key").alias("head"))
    members = stage(left.join(heads, ["sign", "n"]).select("key", "id", "no", "head"), "members")
    firsts_ = members.where("key = head")
    wanted = firsts_.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("no", "key"))).alias("keys"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys_of = [dict(keys) for keys in batch.column(1).to_pylist()]
            for first, texts in portions(binary(batch.column(0))):
                keys = lambda text, no: [keys_of[first + i].get(k) for i, k in zip(text.tolist(), no.tolist())]  # noqa: B023, E731  used in this turn
                sets = shingled(texts, cut, lambda text, no: np.array([k is not None for k in keys(text, no)], bool))
                bits = bitmaps(sets, words)
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys(sets.text, sets.no), pa.int64()), pa.array(sets.size),
                    pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(bits[:, i])) for i in range(words)], fields),
                    pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sets.size]), pa.int32()), pa.array(sets.elements.view(np.int64))),
                ], ["key", "n", "bits", "elements"])

    # rows that are equal, id and text, once
    own = likely(rows.select("id", "text"), firsts_, "id")
    texts = own.join(wanted, "id").groupBy("id").agg(*[F.first(c).alias(c) for c in ("text", "keys")]).select("text", "keys")
    words_ = ", ".join(f"{f}: bigint" for f in fields)
    built = texts.mapInArrow(build, f"key bigint, n bigint, bits struct<{words_}>, elements array<bigint>")
    return members, candidates(stage(built, "heads"))


def named(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text) with ``id`` of the row's id and its text's hash, so that texts that share an id keep apart;
    null where the id is null."""
    text = F.col(text_col).cast("string")
    both = F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"))
    return df.select(F.when(F.col(id_col).isNotNull(), both).alias("id"), text.alias("text"), F.col(id_col).alias("plain"))


def prefix_index(heads: DataFrame) -> DataFrame:
    """Prefixes of the heads in the order of rarity: ``key``, ``n``, ``unique``, ``prefix``, ``bits``.

    Elements of one set only come first in that order and lead nowhere, so they are counted
    (``unique``) and not listed. Sets whose prefix holds nothing else are left out.
    """
    postings = heads.select("key", "n", F.explode("elements").alias("element"))
    shared = postings.groupBy("element").agg(F.count("*").alias("sets")).where("sets > 1")
    rare = (
        postings.join(shared, "element").groupBy("key", "n")
        .agg(F.array_sort(F.collect_list(F.struct("sets", "element"))).alias("order"))
        .withColumn("unique", F.col("n") - F.size("order"))
        .withColumn("take", F.expr(f"n - ((n * {PERCENT} + 99) div 100) + 1 - unique").cast("int"))
        .where("take > 0")
    )
    cut = rare.select("key", "n", "unique", F.slice("order.element", 1, F.col("take")).alias("prefix"))
    return stage(cut.join(heads.select("key", "bits"), "key"), "prefixes")


def can_link(n1: str, at1: str, n2: str, at2: str) -> Column:
    """Length filter, and the positional filter at one common element: what comes before it and after it bounds the overlap."""
    least = f"((({PERCENT} * ({n1} + {n2})) + {99 + PERCENT}) div {100 + PERCENT})"
    return F.expr(
        f"100 * {n1} >= {PERCENT} * {n2} AND 100 * {n2} >= {PERCENT} * {n1} AND "
        f"least({at1}, {at2}) + 1 + least({n1} - {at1} - 1, {n2} - {at2} - 1) >= {least}")


def verified(pairs: DataFrame, heads: DataFrame, name: str) -> DataFrame:
    """All pairs (a, b) with ``linked``: their sets compared element by element."""
    one = heads.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("elements").alias("ea"))
    two = heads.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("elements").alias("eb"))
    both = F.size(F.array_intersect("ea", "eb"))
    linked = 100 * both >= PERCENT * (F.col("na") + F.col("nb") - both)
    return stage(pairs.join(one, "a").join(two, "b").select("a", "b", linked.alias("linked")), name)
