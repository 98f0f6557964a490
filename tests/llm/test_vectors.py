"""Whitening and hard negatives against numpy, SimHash against all pairs."""

import math
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from plumbline.llm import hard_negatives, simhash, whitening

NAN, INF = math.nan, math.inf
SCHEMA = "vec_id long, embedding array<double>, label int, x int, weight int, component string, at int, label__ int"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "c", 3, 4) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(7)
    v = rng.normal(size=(300, 6)) * [1, 0.5, 2, 0.2, 1, 0.7]
    v[:120] = v[0]  # one vector holds two fifths of the rows
    return v


def whitened(df, **kw):
    rows = whitening.whitened_rows(df, **kw).collect()
    by = defaultdict(dict)
    for r in rows:
        by[r["vec_id"]][r["component"]] = r
    return rows, by


@pytest.mark.parametrize("weights", ["counts", "ones"])
def test_whitening_equals_numpy(spark, cloud, weights):
    df = vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(cloud)])
    rows, by = whitened(df, weights=weights)
    x = np.floor(1024 * cloud).astype(int) + 100000
    used = x if weights == "counts" else np.unique(x, axis=0)
    n, s = len(used), used.sum(0)
    y = used - s / n
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1], u[:, ::-1]
    assert len(rows) == 300 * 6 and {r["n"] for r in rows} == {n}
    assert [by[i][1]["deviation"] for i in range(300)] == ((n * x - s) ** 2).sum(1).tolist()
    got = np.array([[by[i][c]["whitened"] for c in range(1, 7)] for i in range(300)])
    want = (x - s / n) @ u / np.sqrt(e)
    assert np.allclose(got * np.sign((got * want).sum(0)), want, atol=1e-9)
    assert np.allclose([by[0][c]["explained"] for c in range(1, 7)], e / e.sum(), rtol=1e-9)
    assert rows[0]["identity_error"] < 1e-9


def test_whitening_edges(spark):
    good = [(1, [0.1, 0.2], 0), (2, [0.3, -0.2], 0), (2, [0.3, -0.2], 0), (None, [0.5, 0.7], None)]
    bad = [(5, None, 1), (6, [], 1), (7, [0.1, None], 1), (8, [NAN, 0.1], 1), (9, [0.1, -INF], 1), (10, [0.1, 0.2, 0.3], 1), (11, [1e300, 0.0], 1)]
    rows, by = whitened(vectors(spark, good + bad))
    assert len(rows) == 8 and set(by) == {1, 2, None} and rows[0]["n"] == 4
    assert whitened(vectors(spark, []))[0] == []
    assert whitened(vectors(spark, bad[:5]))[0] == []
    assert whitened(vectors(spark, [(i, [1.0, 2.0], 0) for i in range(4)]))[0] == []  # no variance
    line = whitened(vectors(spark, [(i, [float(i), 2.0 * i], 0) for i in range(4)]))[1]
    assert {len(v) for v in line.values()} == {1}  # one direction has variance
    wide = whitened(vectors(spark, [(i, [i * 1e10, 0.5 * i], 0) for i in range(5)]))[1]
    assert wide[2][1]["deviation"] is not None and wide[0][1]["deviation"] is None


def mined_by_hand(rows, every):
    ok = [(i, lab, [math.floor(256 * c) for c in v]) for i, v, lab in rows
          if i is not None and lab is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    dot = lambda a, b: sum(p * q for p, q in zip(a, b))
    out = []
    for a, la, xa in (r for r in ok if r[0] % every == 0):
        pos = sorted((-dot(xa, x), i) for i, lab, x in ok if lab == la and i != a)[:5]
        for p, pid in pos:
            neg = sorted((-s, i) for i, lab, x in ok if lab != la and i != a and 30 * -p <= 100 * (s := dot(xa, x)) <= 90 * -p)[:10]
            out += [(a, pid, r + 1, i, -p, -s) for r, (s, i) in enumerate(neg)]
    return sorted(out)


def mined(df, **kw):
    return sorted(tuple(r) for r in hard_negatives.mined(hard_negatives.integer_vectors(df), **kw).collect())


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 8))
    rows = []
    for i in range(700):
        lab = int(rng.integers(0, 4))
        rows.append((i, (centres[lab] * 0.2 + rng.normal(size=8) * 0.15).tolist(), lab))
    rows += [(1000 + i, rows[3][1], 1 + i % 2) for i in range(300)]  # one vector, a third of the rows, ties only
    monkeypatch.setattr(hard_negatives, "LEAST_ROWS", 100)
    assert mined(vectors(spark, rows), anchors="id % 50 = 0") == mined_by_hand(rows, 50)


def test_hard_negatives_edges(spark):
    rows = [(0, [0.5, 0.5], 1), (100, [0.5, 0.4], 1), (3, [0.3, 0.3], 2), (4, [0.3, 0.3], 2), (5, [-0.5, -0.5], 2), (None, [0.3, 0.3], 2),
            (6, [0.3, 0.3], None), (7, None, 2), (8, [], 2), (9, [0.3, None], 2), (10, [NAN, 0.1], 2), (11, [INF, 0.1], 2), (200, [0.1, 0.1], 9)]
    assert mined(vectors(spark, rows)) == mined_by_hand(rows, 100)
    odd = rows + [(12, [0.1, 0.2, 0.3], 2), (13, [1e200, 0.1], 2)]
    assert mined(vectors(spark, odd)) == mined_by_hand(rows, 100)
    assert mined(vectors(spark, [])) == []
    big = [(i, [(-1) ** i * 3e6 + i, 2e6 * (i % 3)], i % 2) for i in range(0, 400, 50)]  # beyond exact doubles
    assert mined(vectors(spark, big)) == mined_by_hand(big, 100)
    shifted = hard_negatives.shifted_labels(vectors(spark, [(7, [1.0], 9), (8, [1.0], 9), (None, [1.0], 3), (14, [1.0], None)]))
    assert [r["label"] for r in shifted.collect()] == [0, 9, 3, None]


def prints_by_hand(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in nodes:
        for b in nodes:
            if linked(a, b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_simhash_links_equal_all_pairs(spark):
    rng = np.random.default_rng(5)
    prints = {int(rng.integers(0, 2**63)) for _ in range(40)}
    for p in list(prints)[:20]:
        for _ in range(12):
            q = p
            for b in rng.choice(64, rng.integers(1, 6), replace=False):
                q ^= 1 << int(b)
            prints.add(q)
    prints |= {0, 2**64 - 1, 2**63, 7, 2**32, 2**32 - 1}
    base = int(rng.integers(0, 2**63))  # one half shared by many
    prints |= {base ^ (1 << i) ^ (1 << j) for i in range(12) for j in range(12, 20)}
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    got = {(r["a"], r["b"]) for r in simhash.links(spark.createDataFrame([(p,) for p in signed], "print long")).collect()}
    m = 2**64 - 1
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & m).bit_count() <= 3}


def test_simhash_documents(spark):
    long = " ".join(f"w{i % 97} x{i % 89}" for i in range(70000))
    texts = [None, "", " \t\n", "A b", "a B", "a", "One two three four", "one TWO\x0bthree four", "é È three", "é è three", long, long + " end"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "quite another text of id three"), (None, "a"), (None, "nobody else says this"), (5, "a"), (40, "quite another text of id three")]
    df = spark.createDataFrame([(*r, 1, "f", 5) for r in rows], "doc_id long, text string, print int, fingerprint string, component_id int")
    got = [tuple(r) for r in simhash.near_duplicates(df).collect()]
    prints = [prints_by_hand(t) for _, t in rows]
    node = classes(range(len(rows)), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3 or rows[a][0] is not None and rows[a][0] == rows[b][0])
    want = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if node[j] == node[i] and rows[j][0] is not None]
        want.append((doc, f"{prints[i]:016x}", min(ids, default=None)))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert simhash.near_duplicates(df.where("false")).collect() == []
