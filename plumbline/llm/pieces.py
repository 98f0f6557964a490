"""A SentencePiece model as tables: pieces, scores, byte fallback and the places where text can be cut."""

from __future__ import annotations

import re
from functools import lru_cache

from plumbline.llm.common import vocabulary

MARK = "▁"
#: Stands for a character that no piece has: its UTF-8 bytes are the tokens, and nothing merges with it.
FALLBACK = -1
BPE, UNIGRAM = "bpe", "unigram"


class PieceModel:
    """Pieces are held with a space where the file has the space mark.

    Only models without a character map are read; the normaliser then is the dummy prefix, the
    collapsing of spaces if the model asks for it, and the mark.
    """

    def __init__(self, scores: dict[str, tuple[int, float]], bytes_: dict[int, int], kind: str = BPE,
                 prefix: bool = True, collapse: bool = False, unknown: int = 0) -> None:
        self.scores, self.bytes, self.kind = scores, bytes_, kind
        self.prefix, self.collapse, self.unknown = prefix, collapse, unknown
        self.longest = max(map(len, scores), default=1)
        #: Whether the second piece can follow the first, by their ids in one number (see ``follows``).
        self.pairs: dict[int, bool] = {}
        self.names = {i: p for p, (i, _) in scores.items()}
        self.letters = {c for p in scores for c in p}
        self.inside = {p[i: i + 2] for p in scores for i in range(len(p) - 1)}
        self.cutter = self._cuts()

    @classmethod
    def load(cls, name: str) -> PieceModel:
        from sentencepiece import sentencepiece_model_pb2 as schema

        proto = schema.ModelProto()
        with open(vocabulary(name), "rb") as file:
            proto.ParseFromString(file.read())
        rules = proto.normalizer_spec
        if rules.precompiled_charsmap or not rules.escape_whitespaces:
            raise ValueError("models with a character map or unmarked spaces aren't supported")
        kinds = {1: UNIGRAM, 2: BPE}
        if proto.trainer_spec.model_type not in kinds:
            raise ValueError("neither a BPE nor a unigram model")
        normal = {p.piece.replace(MARK, " "): (i, p.score) for i, p in enumerate(proto.pieces) if p.type == 1}
        raw = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == 6}
        unknown = next(i for i, p in enumerate(proto.pieces) if p.type == 2)
        return cls(normal, raw, kinds[proto.trainer_spec.model_type], rules.add_dummy_prefix,
                   rules.remove_extra_whitespaces, unknown)

    def normalised(self, text: bytes) -> bytes:
        text = text.replace(MARK.encode(), b" ")
        if self.collapse:
            text = b" ".join(x for x in text.split(b" ") if x)
        return b" " + text if text and self.prefix else text

    def _cuts(self) -> re.Pattern[bytes]:
        """Chunks at spaces and line breaks, if the vocabulary has no piece across them; else the whole text."""
        if "\n" in self.letters or any(re.search("[^ ] ", p) for p in self.scores):
            return re.compile(rb"(?s).+")
        return re.compile(rb"\n| *[^ \n]+| +")

    def parts(self, chunk: str) -> list[str]:
        """``chunk`` cut between neighbouring characters that no piece has side by side."""
        inside = self.inside
        cuts = [i for i in range(1, len(chunk)) if chunk[i - 1: i + 1] not in inside]
        return [chunk[i:j] for i, j in zip([0, *cuts], [*cuts, len(chunk)])]

    def merged(self, text: str) -> list[str]:
        """Byte-pair encoding of a short string of known characters: best score first, then leftmost."""
        scores, parts = self.scores, list(text)
        nothing = (0, float("-inf"))
        gains = [scores.get(a + b, nothing)[1] for a, b in zip(parts, parts[1:])]
        while gains:
            best = max(gains)
            if best == nothing[1]:
                break
            i = gains.index(best)
            parts[i: i + 2] = [parts[i] + parts[i + 1]]
            del gains[i]
            if i:
                gains[i - 1] = scores.get(parts[i - 1] + parts[i], nothing)[1]
            if i < len(gains):
                gains[i] = scores.get(parts[i] + parts[i + 1], nothing)[1]
        return parts

    def follows(self, last: int | None, piece: str, number: int) -> bool:
        """Can ``piece`` come next? In a byte-pair encoding exactly when the two alone encode to themselves."""
        if self.kind == UNIGRAM:
            return True
        before = "" if last is None or last == FALLBACK else self.names[last]
        key = ((FALLBACK if before == "" else last) << 32) + number
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > 2_000_000:
                self.pairs.clear()
            known = self.pairs[key] = self.merged(before + piece) == ([before, piece] if before else [piece])
        return known


@lru_cache(maxsize=2)
def model(name: str) -> PieceModel:
    return PieceModel.load(name)
