"""A path takes the first arc that fits, and ids stay the library's."""

import random

from plumbline.llm import sentencepiece_fst
from plumbline.llm.common import vocabulary


def test_paths_are_the_librarys_and_known_pairs_are_not_worked_out_again(monkeypatch):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary(sentencepiece_fst.MODEL))
    monkeypatch.setattr(sentencepiece_fst, "CACHE", 50)
    machine = sentencepiece_fst.Transducer(sentencepiece_fst.model(sentencepiece_fst.MODEL))
    assert machine.single
    draw = random.Random(5)
    letters = "aaeeiinnrrsttthhoodulmcé'.,-5中\U0001f600́ "
    texts = ["", " ", "a" * 300, "▁x", "x\ny  z\t", "\U0001f469‍\U0001f4bb", *(
        "".join(draw.choice(letters) for _ in range(draw.randint(1, 120))) for _ in range(300))]
    for text in texts:
        assert machine.encode(text.encode()).tolist() == library.encode(text)
    calls, follows = [], machine.pieces.follows
    machine = sentencepiece_fst.Transducer(machine.pieces)
    monkeypatch.setattr(machine.pieces, "follows", lambda *pair: calls.append(pair) or follows(*pair))
    for text in texts:
        machine.encode(text.encode())
    assert not calls
