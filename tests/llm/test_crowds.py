"""Hubs are for crowded buckets only; windows hashed together are the sets that plain Python makes."""

import itertools
import random

import numpy as np
import pytest

from plumbline.llm import jaccard_join, line_dedup, simjoin

from test_brute_force import lines_to_remove


def variants(families, size, seed=3):
    """Lines of 60 words, in each family with one word changed."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(8))
    lines = []
    for _ in range(families):
        base = [word() for _ in range(60)]
        for _ in range(size):
            own = list(base)
            own[draw.randrange(60)] = word()
            lines.append(" ".join(own))
    draw.shuffle(lines)
    return list(enumerate(lines))


@pytest.fixture
def compared(monkeypatch):
    """Names of the comparisons made."""
    names, real = [], simjoin.verified
    monkeypatch.setattr(simjoin, "verified", lambda pairs, heads, name: names.append(name) or real(pairs, heads, name))
    return names


def component_ids(rows):
    sets = {i: {tuple(w[k:k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in rows)}
    comp = {i: i for i in sets}
    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * len(sets[a] | sets[b]) and comp[a] != comp[b]:
            low, high = sorted((comp[a], comp[b]))
            comp = {i: low if c == high else c for i, c in comp.items()}
    return comp


@pytest.mark.parametrize("families, size, hubs", [(30, 5, False), (2, 60, True)])
def test_lines_take_hub_rounds_only_in_crowded_buckets(spark, compared, families, size, hubs):
    rows = variants(families, size)
    got = line_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    want = lines_to_remove(rows, 5)
    assert {r.doc_id: set(r.removed_lines) for r in got.collect()} == {i: want[i] for i, _ in rows}
    assert ("first" in compared) == hubs
    assert compared[-1] == "more"


@pytest.mark.parametrize("families, size, hubs", [(30, 5, False), (2, 60, True)])
def test_documents_take_hub_rounds_only_in_crowded_buckets(spark, monkeypatch, families, size, hubs):
    staged, real = [], jaccard_join.stage
    monkeypatch.setattr(jaccard_join, "stage", lambda df, name: staged.append(name) or real(df, name))
    rows = variants(families, size)
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == component_ids(rows)
    assert ("rest" in staged) != hubs  # one hub connects a family


@pytest.mark.parametrize("by_line, least", [(True, 1), (True, 5), (False, 0)])
def test_sets_of_many_texts_at_once(by_line, least):
    draw = random.Random(5)
    odd = ["", "\n", " a b ", "A\tb\nc d e f g H\n\n", "x" * 500 + " y " + "x" * 501 + " y", "é ü ß\x0bq\x0cw\x1cz t", "abcdefgh abcdefghi"]
    texts = odd + ["".join(draw.choice("ab c\nD") for _ in range(draw.randrange(120))) for _ in range(200)] + [""]
    texts = [t.encode() for t in texts]
    want = []
    for i, t in enumerate(texts):
        for no, line in enumerate(t.lower().split(b"\n") if by_line else [t.lower()]):
            w = line.split()
            if (w or not by_line) and len(w) >= least:
                want.append((i, no, {tuple(w[k:k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())))
    got = simjoin.shingled(texts, simjoin.Cut(by_line, least))
    assert [(i, no, len(s)) for i, no, s in want] == list(zip(got.text.tolist(), got.no.tolist(), got.size.tolist()))
    # equal windows have equal hashes and others don't, whatever is hashed beside them
    apart = [simjoin.shingled([t], simjoin.Cut(by_line, least)).elements for t in texts]
    assert np.array_equal(np.concatenate(apart), got.elements)
    assert len(set(got.elements.tolist())) == len(set().union(*[s for _, _, s in want]))
    parts = np.split(got.elements, np.cumsum(got.size)[:-1])
    for (_, _, a), x in zip(want[:60], parts):
        for (_, _, b), y in zip(want[:60], parts):
            assert len(a & b) == len(set(x.tolist()) & set(y.tolist()))


def test_steps_of_owners():
    owners = np.array([0, 0, 3, 258, 258, 513, 100_000, 100_255, 100_510, 100_764])
    assert simjoin._owners(*simjoin._steps(owners)).tolist() == owners.tolist()
    assert simjoin._owners(*simjoin._steps(owners[:0])).tolist() == []


def test_candidates_share_four_fifths(spark):
    sets = [list(range(100, 110)), list(range(102, 112)), list(range(103, 113)), list(range(200, 210)), [100, *range(300, 309)]]
    heads = spark.createDataFrame([(i, [x << 40 | x for x in s]) for i, s in enumerate(sets)], "key long, elements array<long>")
    # 0 shares 8 of 10 with 1; 1 all with 0 and 2; 2 shares 9 with 1
    assert sorted(r.key for r in simjoin.candidates(heads).collect()) == [0, 1, 2]
