"""SentencePiece encoding and decoding by a weighted finite-state transducer.

Three machines are compiled from a model file: the normaliser (dummy prefix, space mark), the
piece transducer (a path of characters for each piece, weighted by minus its score, and for
characters without a piece the path of its UTF-8 bytes) and, for byte-pair models, an acceptor
over neighbouring pieces that gives weight 0 to pairs which encode to themselves and infinity to
all others. An input is composed with them lazily, arc by arc, and the encoding is the shortest
path in the tropical semiring. For a unigram model that is the best segmentation. For a byte-pair
model all finite paths have only self-encoding neighbours; there is exactly one, the encoding.

Decoding runs the piece transducer backwards. Texts are composed in chunks that no piece spans,
and a chunk's path is kept for the next time.

Null and empty texts encode to nothing and decode to an empty text. Rows are treated one by one:
null ids, ties and repeated rows stay; an empty table gives an empty result. Only id and text are
read.
"""

from __future__ import annotations

import math
import zlib
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
#: By how much an unknown character costs more than the worst piece, as in the library.
UNKNOWN_PENALTY = 10.0


class Transducer:
    def __init__(self, pieces: PieceModel) -> None:
        self.pieces, self.known, self.older, self.prefixes = pieces, {}, {}, {}
        self.part = lru_cache(CACHE)(lambda text: np.array(self.shortest(text), np.int32).tobytes())
        worst = min((s for _, s in pieces.scores.values()), default=0.0)
        self.unknown = UNKNOWN_PENALTY - worst
        self.pair = pieces.kind == BPE
        size = 1 + max([pieces.unknown, *pieces.bytes.values(), *(i for i, _ in pieces.scores.values())])
        self.output = [b""] * size
        for p, (i, _) in pieces.scores.items():
            self.output[i] = p.encode()
        for b, i in pieces.bytes.items():
            self.output[i] = bytes([b])
        self.output[pieces.unknown] = " ⁇ ".encode()
        # each prefix of a text then has one state only: its own byte-pair encoding's last piece
        self.single = self.pair and pieces.letters <= set(pieces.scores)
        #: All ends of pieces, with the piece's id if the end is a piece itself.
        self.tails = {p[k:]: -2 for p in pieces.scores for k in range(len(p))} | {p: i for p, (i, _) in pieces.scores.items()}

    def arcs(self, text: str, i: int):
        """What enters position ``i``: where it starts, ids on the arc, state it leads to, weight."""
        p = self.pieces
        for j in range(max(0, i - p.longest), i):
            own = p.scores.get(text[j:i])
            if own is not None:
                yield j, (own[0],), own[0], 0.0 if self.pair else -own[1]
        if text[i - 1] not in p.scores:
            ids = tuple(p.bytes[b] for b in text[i - 1].encode()) if p.bytes else (p.unknown,)
            yield i - 1, ids, FALLBACK, 0.0 if self.pair else self.unknown

    def shortest(self, text: str) -> list[int]:
        """Ids of the shortest path through the composition with ``text``.

        The distances to a prefix don't depend on what follows it, so they are kept for the next
        text that begins the same way.
        """
        if len(self.prefixes) > CACHE:
            self.prefixes.clear()
        if self.single:
            return self.only(text)
        best: list[dict] = [{None: (0.0, None)}]
        for i in range(1, len(text) + 1):
            own = self.prefixes.get(text[:i]) if i <= KEPT else None
            if own is None:
                own = {}
                for j, ids, to, weight in self.arcs(text, i):
                    key = to if self.pair else None
                    for state, (cost, _) in best[j].items():
                        total = cost + weight
                        if total < own.get(key, (math.inf, None))[0] and (
                                not self.pair or to == FALLBACK or self.pieces.follows(state, text[j:i], to)):
                            own[key] = (total, (j, state, ids))
                if i <= KEPT:
                    self.prefixes[text[:i]] = own
            best.append(own)
        at, state, out = len(text), min(best[-1], key=lambda s: best[-1][s][0]), []
        while at:
            at, state, ids = best[at][state][1]
            out.append(ids)
        return [x for ids in reversed(out) for x in ids]

    def only(self, text: str) -> list[int]:
        """The path where each prefix has one finite path, so that the first arc which the acceptor lets pass is the one.

        Arcs into a position are tried shortest first, as far back as any piece reaches.
        """
        prefixes, tails, pairs, follows = self.prefixes, self.tails, self.pieces.pairs, self.pieces.follows
        begins, states = [0], [FALLBACK]
        for i in range(1, len(text) + 1):
            own = prefixes.get(text[:i]) if i <= KEPT else None
            if own is None:
                j = i - 1
                piece = text[j]
                number = tails.get(piece, FALLBACK)
                while number != FALLBACK:
                    if number >= 0:
                        passes = pairs.get((states[j] << 32) + number)
                        if passes is None:
                            passes = follows(states[j], piece, number)
                        if passes:
                            break
                    j -= 1
                    piece = text[j:i]
                    number = tails[piece]
                own = (j, number)
                if i <= KEPT:
                    prefixes[text[:i]] = own
            begins.append(own[0])
            states.append(own[1])
        at, out, p = len(text), [], self.pieces
        while at:
            if states[at] == FALLBACK:
                out += reversed([p.bytes[b] for b in text[at - 1].encode()] if p.bytes else [p.unknown])
            else:
                out.append(states[at])
            at = begins[at]
        return out[::-1]

    def encode(self, text: bytes) -> np.ndarray:
        chunks = self.pieces.cutter.findall(self.pieces.normalised(text))
        if len(self.known) > CACHE:  # the generation before goes; what is met again moves over from this one
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        for c in set(chunks).difference(known):
            own = older.get(c)
            known[c] = b"".join(map(self.part, self.pieces.parts(c.decode()))) if own is None else own
        return np.frombuffer(b"".join([known[c] for c in chunks]), np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        out = self.output
        joined = b"".join([out[i] for i in ids.tolist()])
        if self.pieces.prefix and joined.startswith(b" "):
            joined = joined[1:]
        return joined if joined.isascii() else joined.decode("utf-8", "replace").encode()


@lru_cache(maxsize=1)
def machine_of(vocabulary: str) -> Transducer:
    """One per Python worker, so that later tasks find what earlier ones worked out."""
    return Transducer(model(vocabulary))


def _mapped(df: DataFrame, id_col: str, value_col: str, cast: str, schema: str, one, vocabulary: str) -> DataFrame:
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(value_col).cast(cast).alias("value"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = machine_of(vocabulary)
        for batch in slices(batches):
            columns = one(machine, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *names])

    return rows.mapInArrow(run, f"doc_id {kind}, {schema}")


def encoded(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = MODEL) -> DataFrame:
    """``doc_id`` and ``ids``, the token ids of the whole text."""

    def one(machine: Transducer, texts: pa.Array) -> list[pa.Array]:
        return [pa.array([machine.encode(t) for t in binary(texts)], pa.list_(pa.int32()))]

    return _mapped(df, id_col, text_col, "string", "ids array<int>", one, vocabulary)


def decoded(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: str = MODEL) -> DataFrame:
    """``doc_id`` and ``text``; null ids decode to an empty text."""

    def one(machine: Transducer, lists: pa.Array) -> list[pa.Array]:
        texts = [machine.decode(np.array(x or [], np.int32)) for x in lists.to_pylist()]
        return [pa.array(texts, pa.binary()).cast(pa.string())]

    return _mapped(df, id_col, ids_col, "array<int>", "text string", one, vocabulary)


def round_trips(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = MODEL) -> DataFrame:
    """Encode and decode every text: ``n_tokens``, ``ids_crc32`` (little-endian 32-bit ids),
    ``decoded_bytes`` and ``same``, whether the text came back (the space mark as a space)."""

    def one(machine: Transducer, column: pa.Array) -> list[pa.Array]:
        counts, sums, sizes, same = [], [], [], []
        for text in binary(column):
            ids = machine.encode(text)
            back = machine.decode(ids)
            counts.append(len(ids))
            sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
            sizes.append(len(back))
            same.append(back == text or back == text.replace("▁".encode(), b" "))
        return [pa.array(counts, pa.int64()), pa.array(sums, pa.int64()), pa.array(sizes, pa.int64()), pa.array(same, pa.bool_())]

    return _mapped(df, id_col, text_col, "string",
                   "n_tokens bigint, ids_crc32 bigint, decoded_bytes bigint, same boolean", one, vocabulary)
