"""Operators held against plain loops over the rows of a small table."""

import collections
import zlib

import numpy as np
import pytest

from plumbline.llm import line_dedup, toxicity
from plumbline.llm.common import read

SMALL = "/root/testdata/sf0.001"


def shingles(words):
    return {tuple(words[i: i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def linked(a, b):
    return bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)


def lines_to_remove(rows, min_words):
    """Numbers of the lines of each document that match an earlier line of any document."""
    gone, seen = collections.defaultdict(set), collections.defaultdict(set)
    earlier = []
    for i, text in sorted(rows, key=lambda r: r[0]):
        for no, line in enumerate((text or "").split("\n")):
            words = line.encode().lower().split()
            if len(words) >= min_words:
                own = shingles(words)
                near = set().union(*(seen[s] for s in own)) if own else set()
                if any(linked(own, earlier[k]) for k in near):
                    gone[i].add(no)
                for s in own:
                    seen[s].add(len(earlier))
                earlier.append(own)
    return gone


def slow_score(net, text):
    """The largest window's probability, one word and one step after the other, in double precision."""
    p = {k: np.asarray(v, np.float64) for k, v in net.p.items()}
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    h, words, best = toxicity.HIDDEN, text.encode().lower().split(), -np.inf
    vectors = []
    for w in words:
        marked = b"\x02" + w + b"\x03"
        grams = [(a * 65536 + b * 256 + c) * 2654435761 % (1 << 32) >> 8 for a, b, c in zip(marked, marked[1:], marked[2:])]
        vectors.append(np.concatenate([p["words"][zlib.crc32(w) % toxicity.WORDS],
                                       np.mean([p["trigrams"][g % toxicity.TRIGRAMS] for g in grams], axis=0)]))
    last = max(0, len(words) - toxicity.WINDOW)
    for start in sorted({min(s, last) for s in range(0, last + toxicity.STRIDE, toxicity.STRIDE)}):
        window, states = vectors[start: start + toxicity.WINDOW], []
        for d in (0, 1):
            s, own = np.zeros(h), []
            for x in (window if d == 0 else window[::-1]):
                gates, g = x @ p["w"][d] + p["b"][d], s @ p["u"][d]
                z, r = sigmoid(gates[:h] + g[:h]), sigmoid(gates[h: 2 * h] + g[h: 2 * h])
                s = z * s + (1 - z) * np.tanh(gates[2 * h:] + r * g[2 * h:])
                own.append(s)
            states.append(own if d == 0 else own[::-1])
        both = np.concatenate(states, axis=1)
        share = np.exp(both @ p["attention"])
        best = max(best, (share / share.sum()) @ both @ p["out"] + p["bias"][0])
    return sigmoid(best)


@pytest.fixture(scope="module")
def small(spark):
    """Documents of the small table by id, and the network that its labels give."""
    docs = read(spark, SMALL, "documents")
    return docs, {r.doc_id: r.text for r in docs.collect()}, toxicity.trained(docs, read(spark, SMALL, "labels"))


def test_lines_of_any_length_match_brute_force(spark, small):
    docs, texts, _ = small
    want = lines_to_remove(texts.items(), 1)
    assert any(want.values())
    got = {r.doc_id: set(r.removed_lines) for r in line_dedup.deduplicated(docs, min_words=1).collect()}
    assert got == {i: want[i] for i in texts}


def test_toxicity_scores_match_plain_steps(spark, small):
    docs, texts, net = small
    rows = toxicity.scored(docs, net).collect()
    assert len(rows) == len(texts)
    for r in rows:
        if (texts[r.doc_id] or "").split():
            assert r.score == pytest.approx(slow_score(net, texts[r.doc_id]), rel=1e-3, abs=1e-5)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
