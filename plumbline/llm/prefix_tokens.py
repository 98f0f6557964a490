"""Exact token counts of every prefix of a text, by dynamic programming over prefixes.

The last token of a byte-pair encoding of ``text[:i]`` starts at some j, and the tokens before it
are the encoding of ``text[:j]``. So ``count[i] = count[j] + 1``, and the right j is the only one
whose piece can follow the last token of ``text[:j]``. One pass gives the count of all prefixes;
what a truncation keeps or a budget allows is then read off without encoding again.

A text is cut only where no piece of the vocabulary can span; the table of a chunk is worked out
once and reused. Differences between neighbouring prefixes are kept as one signed byte per
character (a longer piece can make a longer prefix cheaper).

Null and empty texts have no prefix and no token. Every row is treated by itself: null ids, ties
and repeated rows stay. An empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import binary, slices
from plumbline.llm.pieces import BPE, FALLBACK, PieceModel, model

MODEL = "piece_bpe_32k.model"
CACHE = 400_000
KEPT = 40


class Prefixes:
    """Count and last token of prefixes; a prefix that other words begin with is worked out once."""

    def __init__(self, pieces: PieceModel) -> None:
        if pieces.kind != BPE:
            raise ValueError("prefix tables are for byte-pair models")
        self.pieces, self.known = pieces, {}

    def last_step(self, text: str, before: list[tuple[int, int | None]]) -> tuple[int, int]:
        """The entry of ``text`` from the entries of its shorter prefixes."""
        pieces, i = self.pieces, len(text)
        if text[-1] not in pieces.scores:
            return before[-1][0] + (len(text[-1].encode()) if pieces.bytes else 1), FALLBACK
        for j in range(max(0, i - pieces.longest), i):
            own = pieces.scores.get(text[j:])
            if own is not None and pieces.follows(before[j][1], text[j:], own[0]):
                return before[j][0] + 1, own[0]
        raise AssertionError("every prefix has an encoding")

    def steps(self, text: str) -> bytes:
        """For each character, by how much it changes the number of tokens."""
        if len(self.known) > CACHE:
            self.known.clear()
        known, entries = self.known, [(0, None)]
        for i in range(1, len(text) + 1):
            # long runs are not kept: their prefixes would take the square of their length
            entry = known.get(text[:i]) if i <= KEPT else None
            if entry is None:
                start = max(0, i - self.pieces.longest - 1)
                entry = self.last_step(text[start:i], entries[start:]) if start else self.last_step(text[:i], entries)
                if i <= KEPT:
                    known[text[:i]] = entry
            entries.append(entry)
        return bytes([(b[0] - a[0]) & 255 for a, b in zip(entries, entries[1:])])


class PrefixTables:
    """Prefix tables of whole texts; chunks seen before are looked up."""

    def __init__(self, pieces: PieceModel) -> None:
        self.pieces, self.known = pieces, {}
        self.part = lru_cache(CACHE)(Prefixes(pieces).steps)

    def __call__(self, text: bytes) -> np.ndarray:
        """The change at each character of ``text``; the cumulative sum is the count of each prefix."""
        p, known = self.pieces, self.known
        if p.collapse:
            raise ValueError("a model that collapses spaces has no table by character")
        chunks = p.cutter.findall(p.normalised(text))
        if not chunks:
            return np.zeros(0, np.int8)
        if len(known) > CACHE:
            known.clear()
        for c in set(chunks).difference(known):
            known[c] = b"".join(map(self.part, p.parts(c.decode())))
        steps = np.frombuffer(b"".join([known[c] for c in chunks]), np.int8)
        if p.prefix:  # the dummy prefix counts with the first character
            first, steps = int(steps[0]), steps[1:].copy()
            steps[0] += first
        return steps


@lru_cache(maxsize=1)
def tables_of(vocabulary: str) -> PrefixTables:
    """One per Python worker, so that later tasks find what earlier ones worked out."""
    return PrefixTables(model(vocabulary))


def counts(steps: np.ndarray) -> np.ndarray:
    """Tokens of every prefix, of none to all characters."""
    return np.concatenate([[0], np.cumsum(steps, dtype=np.int64)])


def longest_within(steps: np.ndarray, limit: int) -> int:
    """Characters of the longest prefix that takes at most ``limit`` tokens."""
    return int(np.flatnonzero(counts(steps) <= limit)[-1])


def prefix_tables(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = MODEL) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``steps``: the stored table, a byte per character."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = tables_of(vocabulary)
        for batch in slices(batches):
            texts = binary(batch.column(1))
            steps = [tables(t) for t in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(map(len, texts), pa.int64()),
                pa.array([int(s.sum(dtype=np.int64)) for s in steps], pa.int64()),
                pa.array([s.tobytes() for s in steps], pa.binary()),
            ], ["doc_id", "n_bytes", "n_tokens", "steps"])

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, steps binary")


def budgets(
    df: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = MODEL,
) -> DataFrame:
    """Per document, from its prefix table: ``n_bytes``, ``n_tokens``, ``over_limit`` and
    ``fit_chars``, the characters of the longest prefix of at most ``limit`` tokens. The tables
    are not kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = tables_of(vocabulary)
        for batch in slices(batches):
            sizes, totals, fits = [], [], []
            for text in binary(batch.column(1)):
                steps = tables(text)
                total = int(steps.sum(dtype=np.int64))
                sizes.append(len(text))
                totals.append(total)
                fits.append(longest_within(steps, limit))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64()),
                pa.array([t > limit for t in totals], pa.bool_()), pa.array(fits, pa.int64()),
            ], ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean, fit_chars bigint")
