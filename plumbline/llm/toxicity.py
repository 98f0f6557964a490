"""Toxicity by a bidirectional gated recurrent network with attention, trained and run in numpy.

A word enters as the sum of two views: a vector of the word itself (hashed) and the mean vector of
its character trigrams (hashed), so that an inflected form is known by its stem. Two gated
recurrent layers read a window of words forwards and backwards, attention pools their states, and
a logistic unit gives the window's score. A document's score is that of its highest window, over
all overlapping windows of its whole text.

Training takes a bounded sample of the labelled rows that aren't held out: at most
``sample_toxic`` and ``sample_clean`` rows by a hash of their id, texts of at most
``sample_bytes``. A label belongs to the document, so a step learns from each document's window
that scores highest just then (the first time by the log odds of its words). One task learns from the
whole sample. The weights have a fixed size of about a megabyte and go to the tasks with the function.

Null and empty texts score as one window without words. Labels of rows without text, null labels
and null ids are not learned from; repeated labels count once for each row. Without any usable
label all scores are 0. Rows are scored one by one, so ties and repeated rows stay; an empty table
gives an empty result. Only id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import binary, slices

WORDS = 1 << 14
TRIGRAMS = 1 << 13
WIDTH = 12
HIDDEN = 10
WINDOW = 32
STRIDE = 16
KNOWN = 150_000


def held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 0


def not_held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 != 0


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed word, hashed trigrams of all words, and where each word's trigrams begin."""
    own = np.fromiter((zlib.crc32(w) % WORDS for w in words), np.int64, len(words))
    raw = np.frombuffer(b"".join([b"\x02" + w + b"\x03" for w in words]), np.uint8).astype(np.int64)
    sizes = np.array([len(w) for w in words])
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    at = np.arange(int(sizes.sum())) + np.repeat(2 * np.arange(len(words)), sizes)
    code = (raw[at] * 65536 + raw[at + 1] * 256 + raw[at + 2]) * 2654435761 % (1 << 32) >> 8
    return own, code % TRIGRAMS, begins


def windows_of(n: int) -> np.ndarray:
    """First words of the overlapping windows of a text of n words; the last ends with the text."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    starts = np.arange(0, n - WINDOW + STRIDE, STRIDE)
    return np.minimum(starts, n - WINDOW)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Network:
    """Weights, forward and backward passes. Axis order is (step, window, unit)."""

    def __init__(self, seed: int = 7) -> None:
        draw = self.draw = np.random.default_rng(seed)
        f = lambda *shape, scale: (draw.standard_normal(shape) * scale).astype(np.float32)
        h = HIDDEN
        self.p = {
            "words": f(WORDS, WIDTH, scale=0.1), "trigrams": f(TRIGRAMS, WIDTH, scale=0.1),
            "w": f(2, 2 * WIDTH, 3 * h, scale=0.3), "b": np.zeros((2, 3 * h), np.float32), "u": f(2, h, 3 * h, scale=0.3),
            "attention": f(2 * h, scale=0.3), "out": f(2 * h, scale=0.3), "bias": np.zeros(1, np.float32),
        }
        self.p["b"][:, :h] = 1.0
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        self.t = 0

    def inputs(self, words: list[bytes]) -> tuple[np.ndarray, tuple]:
        """Both views of each word, and what the backward pass needs of them."""
        own, trigrams, begins = features(words)
        sizes = np.diff(np.append(begins, len(trigrams)))
        mean = np.add.reduceat(self.p["trigrams"][trigrams], begins, axis=0) / sizes[:, None]
        return np.concatenate([self.p["words"][own], mean.astype(np.float32)], 1), (own, trigrams, sizes)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Gate inputs of both directions, side by side."""
        return np.concatenate([x @ self.p["w"][d] + self.p["b"][d] for d in (0, 1)], 1)

    def read(self, gates: np.ndarray, keep: bool = False):
        """States of both directions for gate inputs of (step, window, 6 * hidden)."""
        steps, n, _ = gates.shape
        h = HIDDEN
        states, trace = np.empty((steps, n, 2 * h), np.float32), []
        for d in (0, 1):
            s, u = np.zeros((n, h), np.float32), self.p["u"][d]
            for t in (range(steps) if d == 0 else range(steps - 1, -1, -1)):
                x, g = gates[t, :, 3 * h * d: 3 * h * (d + 1)], s @ u
                zr = _sigmoid(x[:, : 2 * h] + g[:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                c = np.tanh(x[:, 2 * h:] + r * g[:, 2 * h:])
                if keep:
                    trace.append((d, t, s, z, r, c, g[:, 2 * h:]))
                s = c + z * (s - c)
                states[t, :, h * d: h * (d + 1)] = s
        return states, trace

    def pool(self, states: np.ndarray, real: np.ndarray):
        a = np.where(real, states @ self.p["attention"], -1e9)
        a = np.exp(a - a.max(0))
        a /= a.sum(0)
        pooled = np.einsum("tn,tnh->nh", a, states)
        return a, pooled, pooled @ self.p["out"] + self.p["bias"][0]

    def learn(self, words: list[bytes], place: np.ndarray, real: np.ndarray, label: np.ndarray, rate: float) -> None:
        """One step on windows given as places in ``words`` (step, window)."""
        h, n = HIDDEN, len(label)
        x, (own, trigrams, sizes) = self.inputs(words)
        # half of the words are known by their trigrams only, or rare forms would not be learned
        seen = (self.draw.random(len(words)) < 0.5).astype(np.float32)[:, None]
        x[:, :WIDTH] *= 2 * seen
        gates = self.project(x)[place] * real[:, :, None]
        states, trace = self.read(gates, keep=True)
        a, pooled, logit = self.pool(states, real)
        dlogit = (_sigmoid(logit) - label) / n
        grad = {"out": pooled.T @ dlogit, "bias": np.array([dlogit.sum()], np.float32)}
        dpool = dlogit[:, None] * self.p["out"]
        da = np.einsum("nh,tnh->tn", dpool, states)
        da = a * (da - (a * da).sum(0))
        grad["attention"] = np.einsum("tn,tnh->h", da, states)
        dstates = a[:, :, None] * dpool + da[:, :, None] * self.p["attention"]
        dgates, du = np.zeros_like(gates), np.zeros_like(self.p["u"])
        carried = [np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)]
        for d, t, s, z, r, c, gc in reversed(trace):
            ds = dstates[t, :, h * d: h * (d + 1)] + carried[d]
            dc = ds * (1 - z) * (1 - c * c)
            dz = ds * (s - c) * z * (1 - z)
            dr = dc * gc * r * (1 - r)
            dgates[t, :, 3 * h * d: 3 * h * (d + 1)] = np.concatenate([dz, dr, dc], 1)
            through = np.concatenate([dz, dr, dc * r], 1)
            du[d] += s.T @ through
            carried[d] = ds * z + through @ self.p["u"][d].T
        dgates *= real[:, :, None]
        flat = np.zeros((len(words), 6 * h), np.float32)
        np.add.at(flat, place.ravel(), dgates.reshape(-1, 6 * h))
        parts = [flat[:, : 3 * h], flat[:, 3 * h:]]
        grad["u"], grad["b"] = du, np.stack([q.sum(0) for q in parts])
        grad["w"] = np.stack([x.T @ q for q in parts])
        dx = sum(q @ self.p["w"][d].T for d, q in enumerate(parts))
        grad["words"] = np.zeros_like(self.p["words"])
        np.add.at(grad["words"], own, 2 * seen * dx[:, :WIDTH])
        grad["trigrams"] = np.zeros_like(self.p["trigrams"])
        np.add.at(grad["trigrams"], trigrams, np.repeat(dx[:, WIDTH:] / sizes[:, None], sizes, 0))
        self.t += 1
        for k, g in grad.items():
            m, v = self.moments[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            self.p[k] -= rate * (m / (1 - 0.9 ** self.t)) / (np.sqrt(v / (1 - 0.99 ** self.t)) + 1e-6)


class Scorer:
    """Window scores of whole texts; a word's gate inputs are worked out once."""

    def __init__(self, net: Network) -> None:
        self.net, self.known, self.rows = net, {}, np.zeros((1, 6 * HIDDEN), np.float32)

    def _places(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        if len(self.known) > KNOWN:
            self.known, self.rows = {}, self.rows[:1]
        new = list(set().union(*texts).difference(self.known))
        more = [self.net.project(self.net.inputs(new[i: i + 20_000])[0]) for i in range(0, len(new), 20_000)]
        for i, w in enumerate(new, len(self.known) + 1):
            self.known[w] = i
        if more:
            self.rows = np.concatenate([self.rows, *more])
        return [np.array([self.known[w] for w in t], np.int64) for t in texts]

    def logits(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """For each text, given as words, the logits of all its windows."""
        places, starts = self._places(texts), [windows_of(len(t)) for t in texts]
        base = np.concatenate([[0], np.cumsum([max(len(p), WINDOW) for p in places])])
        flat = np.zeros(int(base[-1]), np.int64)  # short texts are filled up with the empty row
        for b, p in zip(base, places):
            flat[b: b + len(p)] = p
        first = np.concatenate([b + s for b, s in zip(base, starts)]) if texts else np.zeros(0, np.int64)
        out = np.empty(len(first), np.float32)
        for i in range(0, len(first), 2048):
            at = flat[first[i: i + 2048][None, :] + np.arange(WINDOW)[:, None]]
            real = at > 0
            states, _ = self.net.read(self.rows[at])
            out[i: i + 2048] = self.net.pool(states, real)[2]
        return np.split(out, np.cumsum([len(s) for s in starts])[:-1]) if texts else []


def _odds(texts: list[list[bytes]], labels: np.ndarray) -> dict[bytes, float]:
    """Log odds of each word by the documents that have it."""
    counts: dict[bytes, list[int]] = {}
    for words, label in zip(texts, labels):
        for w in set(words):
            counts.setdefault(w, [0, 0])[int(label)] += 1
    bad, good = labels.sum() + 1, len(labels) - labels.sum() + 1
    return {w: float(np.log((b + 0.1) / bad) - np.log((g + 0.1) / good)) for w, (g, b) in counts.items()}


def fit(texts: list[bytes], labels: list[int], steps: int = 500, batch: int = 64, rate: float = 0.01, seed: int = 7) -> Network:
    """A network from texts and their labels, after about ``steps`` steps and 8 passes at least."""
    net, draw = Network(seed), np.random.default_rng(seed)
    one: dict[bytes, bytes] = {}  # a word is held once, however often it comes
    words, marks = [[one.setdefault(w, w) for w in t.lower().split()] for t in texts], np.array(labels, np.float32)
    usable = [i for i, w in enumerate(words) if w]
    words, marks = [words[i] for i in usable], marks[usable]
    odds = _odds(words, marks)
    epochs = max(8, -(-steps * batch // max(1, len(words))))
    for epoch in range(epochs):
        if epoch == 0:
            best = []
            for w in words:
                own = np.array([odds[x] for x in w])
                starts = windows_of(len(w))
                best.append(int(starts[np.argmax([own[s: s + WINDOW].max() for s in starts])]))
        else:
            scorer, best = Scorer(net), []
            for i in range(0, len(words), 500):
                part = words[i: i + 500]
                best += [int(windows_of(len(w))[np.argmax(z)]) for w, z in zip(part, scorer.logits(part))]
        order = draw.permutation(len(words))
        for i in range(0, len(order), batch):
            own = order[i: i + batch]
            picked = [words[k][best[k]: best[k] + WINDOW] for k in own]
            names = sorted(set().union(*picked))
            index = {w: j for j, w in enumerate(names)}
            place = np.zeros((WINDOW, len(own)), np.int64)
            real = np.zeros((WINDOW, len(own)), bool)
            for j, window in enumerate(picked):
                place[: len(window), j] = [index[w] for w in window]
                real[: len(window), j] = True
            net.learn(names, place, real, marks[own], rate * (1 - epoch / (epochs + 1)))
    return net


def sample(
    docs: DataFrame, labels: DataFrame, sample_toxic: int = 1500, sample_clean: int = 2500, sample_bytes: int = 20_000,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The rows to learn from (id, text, toxic). First the ids are drawn, then only their texts are fetched."""
    usable = labels.select(F.col(id_col).alias("_id"), F.col("toxic").cast("int").alias("_toxic")).where(
        "_id IS NOT NULL AND _toxic IN (0, 1)").where(not_held_out("_id"))
    pick = lambda label, n: usable.where(F.col("_toxic") == label).orderBy(F.xxhash64("_id"), "_id").limit(n)
    ids = pick(1, sample_toxic).union(pick(0, sample_clean))
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).where(
        F.octet_length("_text") <= sample_bytes).join(F.broadcast(ids), "_id").select("_id", "_text", "_toxic")


def scored(df: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: ``doc_id``, ``held_out``, ``score``, ``predicted``."""
    weights = net.p if net else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network.__new__(Network)
        own.p = weights
        scorer = Scorer(own) if weights else None
        for batch in slices(batches, 500):
            words = [t.lower().split() for t in binary(batch.column(1))]
            best = np.array([z.max() for z in scorer.logits(words)], np.float64) if scorer else np.full(len(words), -np.inf)
            score = 1 / (1 + np.exp(-best))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([held_out(i) for i in batch.column(0).to_pylist()], pa.bool_()),
                pa.array(score), pa.array((score >= 0.5).astype(np.int32)),
            ], ["doc_id", "held_out", "score", "predicted"])

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def trained(docs: DataFrame, labels: DataFrame, **bounds) -> Network | None:
    """A network from ``labels``; None if they hold no two kinds.

    The bounded sample goes to one task, which learns; the driver gets the weights only.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))]
        rows.sort(key=lambda row: (str(row[0]), row[1], row[2]))
        marks = [row[2] for row in rows]
        if len(set(marks)) == 2:
            p = fit([row[1].encode() for row in rows], marks).p
            yield pa.RecordBatch.from_arrays([
                pa.array(list(p)), pa.array([x.shape for x in p.values()], pa.list_(pa.int32())),
                pa.array([x.astype("<f4").tobytes() for x in p.values()], pa.binary()),
            ], ["name", "shape", "weights"])

    learnt = sample(docs, labels, **bounds).repartition(1).mapInArrow(run, "name string, shape array<int>, weights binary").collect()
    if not learnt:
        return None
    net = Network.__new__(Network)
    net.p = {r["name"]: np.frombuffer(r["weights"], "<f4").reshape(r["shape"]) for r in learnt}
    return net
