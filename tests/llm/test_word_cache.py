"""Token ids stay the library's when the cache of words fills up and turns over."""

import numpy as np

from plumbline.llm import packing


def test_ids_are_the_same_while_generations_turn_over(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 3)
    tokens = packing.WordTokens("word_bpe_49k.json")
    texts = ["", "one two", "one  two\tthree, Four", "five six seven", "one two", "Eight é!! nine", "one", "two one ten", " \n"]
    for text in texts * 3:
        want = tokens.tokenizer.encode(text, add_special_tokens=False).ids
        assert tokens(text.encode()) == np.array(want, "<u4").tobytes()
    assert len(tokens.known) + len(tokens.older) < 20


class Counted:
    """A tokenizer that counts the strings it is given."""

    def __init__(self, real):
        self.real, self.strings = real, 0

    def encode(self, text, **how):
        self.strings += 1
        return self.real.encode(text, **how)

    def encode_batch(self, texts, **how):
        self.strings += len(texts)
        return self.real.encode_batch(texts, **how)


def test_new_words_go_to_the_library_together_and_keep_their_ids(monkeypatch):
    tokens = packing.WordTokens("word_bpe_49k.json")
    tokens.tokenizer = Counted(tokens.tokenizer)
    odd = ["été", "́x", " ", "a b", "​", "<|endoftext|>", "x<|startoftext|>y", "İI", "don't", "'s", "\U0001f469‍\U0001f4bb", "\x1c", " q"]
    words = [f"{w}{i if i % 3 else ''}" for i, w in enumerate(odd * 40)] + [f"word{i}x" for i in range(400)]
    want = {w: np.array(tokens.tokenizer.real.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in words}
    whole = tokens.tokenizer.real.encode(" ".join(words), add_special_tokens=False).ids
    assert tokens(" ".join(words).encode()) == b"".join(want[w] for w in words) == np.array(whole, "<u4").tobytes()
    assert tokens.tokenizer.strings < 10
    assert all(tokens.known[w.encode()] == want[w] for w in words)
    texts = ["", "one " * 50, "two", "three four " * 30, ""]
    monkeypatch.setattr(packing, "TOGETHER", 60)
    parts = list(packing.portions([t.encode() for t in texts]))
    assert [t.decode() for own in parts for t in own] == texts and len(parts) > 1


def test_texts_of_a_batch_are_looked_up_together():
    texts = [b"one two " * 100_000] * 3
    assert [len(own) for own in packing.portions(texts)] == [3]
    tokens = packing.WordTokens("word_bpe_49k.json")
    want = np.array(tokens.tokenizer.encode("one two " * 5, add_special_tokens=False).ids, "<u4").tobytes()
    assert tokens.of([b"one two " * 5] * 3) == [want] * 3
