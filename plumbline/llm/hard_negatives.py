"""Hard negatives from an R-tree packed by sort-tile-recursive order, searched best box first.

Components become the integers ``floor(256 * c)``; a score is an integer inner product, exact. The
rows are range-partitioned by label and their most varied component into groups that fit a task;
inside a group the rows of each label are tiled recursively along the next components, which gives
leaves of up to 128 rows, and leaves get parents. Every box keeps the least and greatest value of
every component, its labels and its smallest id. The interval of each component gives an interval
of inner products with a query.

A query carries score windows and wants the first k rows of each. It visits the boxes of a group in
the order of their upper bounds, and leaves out a box that has no row of a wanted label, whose
interval lies outside all windows, or which can't beat the kth row found so far: its bound is lower,
or equal with no smaller id. Groups answer on their own and the answers are merged, k rows of each
group and window; queries pass by a group's tree one after another, so a task holds one group. First
every anchor looks for its positives, then for the negatives in the windows that their scores give.

Rows with a null id, a null label, a null or empty vector or a null or non-finite component take
no part; nor do rows of any but the most frequent vector length (the longer of equally frequent
ones), nor components so large that an inner product could outgrow a long. Equal scores come in the
order of ids. Repeated rows take part each; an anchor's own id is never its positive, whatever row
has it. An anchor without positives, or a positive without negatives, has no rows, and an empty table
has none. Only id, label and vector are read; other columns may have any names.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import stage, task_id

SCALE = 256
LEAF, FANOUT = 128, 16
#: Rows of a group, whose tree a task holds: at most, and at least where there are cores to spare.
GROUP_ROWS, LEAST_ROWS = 65_536, 2_048
_EXACT = 2**53
_NONE = -(2**62)

_ENTRY = "group int, kind int, at bigint, ids array<bigint>, labels array<bigint>, xs array<int>, lows array<bigint>, highs array<bigint>"
_FOUND = "at bigint, place int, score bigint, id bigint"


def integer_vectors(df: DataFrame, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding") -> DataFrame:
    """(id, label, x) of the rows that take part, written once."""
    rows = df.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
        F.col(vec_col).cast("array<double>").alias("v")).where("id is not null and label is not null and size(v) > 0")
    fits = f"abs(c) * {SCALE} < sqrt(4.6e18D / size(v)) - 1 and abs(c) * {SCALE} < 2147483000D"
    rows = rows.where(f"forall(v, c -> c is not null and not isnan(c) and {fits})")
    whole = stage(rows.select("id", "label", F.expr(f"transform(v, c -> cast(floor({SCALE} * c) as int))").alias("x")), "integers")
    sizes = whole.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("rows"))
    best = sizes.agg(F.max_by("size", F.struct("rows", "size"))).first()[0]
    return whole.where(F.size("x") == F.lit(best or 0))


def _flat(column: pa.Array, kind=np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def by_variance(rows: DataFrame) -> tuple[int, list[int]]:
    """The number of rows, and the components from the most to the least varied; they steer the tiling only."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = _flat(batch.column(0), float)
                part = np.array([np.full(x.shape[1], float(len(x))), x.sum(axis=0), (x * x).sum(axis=0)])
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(total.shape[1], dtype=np.int32)), *map(pa.array, total)], ["place", "n", "s", "s2"])

    sums = rows.select("x").mapInArrow(partial, "place int, n double, s double, s2 double").groupBy("place").agg(
        *[F.sum(c).alias(c) for c in ("n", "s", "s2")]).collect()
    spread = {r["place"]: r["s2"] / r["n"] - (r["s"] / r["n"]) ** 2 for r in sums}
    return int(sums[0]["n"]) if sums else 0, sorted(spread, key=lambda i: (-spread[i], i))


def tiles(x: np.ndarray, labels: np.ndarray, ids: np.ndarray, dims: list[int], leaf: int = LEAF) -> list[np.ndarray]:
    """Row numbers of each leaf: rows of a label are cut into slabs along one component after another.

    Labels with fewer rows than a leaf holds share tiles with their neighbours.
    """
    out: list[np.ndarray] = []

    def tile(rows: np.ndarray, at: int) -> None:
        leaves = -(-len(rows) // leaf)
        if leaves <= 1:
            out.append(rows[np.argsort(ids[rows], kind="stable")])
            return
        left = max(1, min(len(dims) - at, math.ceil(math.log2(leaves))))
        slabs = max(2, math.ceil(leaves ** (1 / left) - 1e-9))
        dim = x[rows, dims[at]] if at < len(dims) else ids[rows]
        rows = rows[np.lexsort((ids[rows], dim))]
        size = leaf * -(-leaves // slabs)
        for s in range(0, len(rows), size):
            tile(rows[s:s + size], min(at + 1, len(dims)))

    order = np.argsort(labels, kind="stable")
    runs = np.split(order, np.flatnonzero(np.diff(labels[order])) + 1)
    small: list[np.ndarray] = []
    for run in runs:
        if len(run) >= leaf:
            tile(run, 0)
        else:
            small.append(run)
            if sum(map(len, small)) >= leaf:
                tile(np.concatenate(small), 0)
                small = []
    if small:
        tile(np.concatenate(small), 0)
    return out


def build(rows: DataFrame) -> tuple[DataFrame, int]:
    """The packed leaves, one row each, as a written table, and the number of groups."""
    n, dims = by_variance(rows)
    cores = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, -(-n // GROUP_ROWS), min(cores, n // LEAST_ROWS))
    first = dims[0] if dims else 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        ids, labels = (np.concatenate([b.column(i).to_numpy() for b in got]) for i in (0, 1))
        x = np.concatenate([_flat(b.column(2)) for b in got])
        leaves = tiles(x, labels, ids, dims)
        for s in range(0, len(leaves), 64):
            part = leaves[s:s + 64]
            yield pa.RecordBatch.from_arrays([
                pa.array([task_id()] * len(part), pa.int32()), pa.array([0] * len(part), pa.int32()),
                pa.array(range(s, s + len(part)), pa.int64()),
                pa.array([ids[p] for p in part], pa.list_(pa.int64())), pa.array([labels[p] for p in part], pa.list_(pa.int64())),
                pa.array([x[p].ravel().astype(np.int32) for p in part], pa.list_(pa.int32())),
                pa.array([[]] * len(part), pa.list_(pa.int64())), pa.array([[]] * len(part), pa.list_(pa.int64())),
            ], ["group", "kind", "at", "ids", "labels", "xs", "lows", "highs"])

    dealt = rows.select("id", "label", "x", F.col("x")[first].alias("_key")).repartitionByRange(groups, "label", "_key", "id")
    return stage(dealt.select("id", "label", "x").mapInArrow(pack, _ENTRY), "rtree"), groups


class Tree:
    """The boxes over the leaves of one group."""

    def __init__(self, leaves: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        most = max(int(np.abs(x).max(initial=0)) for _, _, x in leaves)
        self.kind = float if (most + 1) ** 2 * leaves[0][2].shape[1] < _EXACT else np.int64
        self.most = most
        self.leaves = [(ids, labels, x.astype(self.kind)) for ids, labels, x in leaves]
        boxes = [(x.min(0), x.max(0), lab.min(), lab.max(), ids.min()) for ids, lab, x in self.leaves]
        self.kids: list[list[int]] = [[] for _ in boxes]
        level = list(range(len(boxes)))
        while len(level) > 1:
            above = []
            for s in range(0, len(level), FANOUT):
                kids = level[s:s + FANOUT]
                lo, hi, least, most_, first = zip(*[boxes[i] for i in kids])
                above.append(len(boxes))
                boxes.append((np.min(lo, 0), np.max(hi, 0), min(least), max(most_), min(first)))
                self.kids.append(kids)
            level = above
        self.root = level[0]
        self.lo, self.hi = np.array([b[0] for b in boxes]), np.array([b[1] for b in boxes])
        self.labels = [(int(b[2]), int(b[3])) for b in boxes]
        self.first = [int(b[4]) for b in boxes]

    def search(self, q: np.ndarray, own: int, label: int, same: bool, lows: list[int], highs: list[int], k: int) -> list[list[tuple[int, int]]]:
        """For each window the first k (score, id) of rows with the label (or, not ``same``, another), not of id ``own``."""
        kind = self.kind if self.kind is float and max(self.most, int(np.abs(q).max())) ** 2 * len(q) < _EXACT else np.int64
        q = q.astype(kind)
        lo, hi = self.lo.astype(kind, copy=False), self.hi.astype(kind, copy=False)
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        greatest, least = (hi @ up + lo @ down).astype(np.int64).tolist(), (lo @ up + hi @ down).astype(np.int64).tolist()
        found: list[list[tuple[int, int]]] = [[] for _ in lows]  # (-score, id), sorted
        windows = range(len(lows))

        def wanted(node: int) -> bool:
            a, b = self.labels[node]
            if not (a <= label <= b) if same else a == b == label:
                return False
            for w in windows:
                top = min(greatest[node], highs[w])
                if top >= lows[w] and least[node] <= highs[w]:
                    if len(found[w]) < k or (-top, self.first[node]) < found[w][-1]:
                        return True
            return False

        queue = [(-greatest[self.root], self.root)]
        floor, ceiling = min(lows), max(highs)
        while queue:
            _, node = heapq.heappop(queue)
            if not wanted(node):
                continue
            if self.kids[node]:
                for kid in self.kids[node]:
                    if wanted(kid):
                        heapq.heappush(queue, (-greatest[kid], kid))
                continue
            ids, labels, x = self.leaves[node]
            scores = x.astype(kind, copy=False) @ q
            least_wanted = max(floor, min(-found[w][-1][0] if len(found[w]) == k else lows[w] for w in windows))
            ok = (scores >= least_wanted) & (scores <= ceiling) & ((labels == label) if same else (labels != label)) & (ids != own)
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            got = sorted(zip((-scores[at]).astype(np.int64).tolist(), ids[at].tolist()))
            for w in windows:
                mine = [g for g in got if lows[w] <= -g[0] <= highs[w]][:k]
                if mine:
                    found[w] = sorted(found[w] + mine)[:k]
        return [[(-s, i) for s, i in f] for f in found]


def search(index: DataFrame, groups: int, queries: DataFrame, same: bool, k: int) -> DataFrame:
    """(at, place, score, id, rank): the first k rows of window ``place`` of query ``at``.

    ``queries`` has at, id, label, x, lows, highs. Each query is sent to every group once.
    """

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, leaves, tree = None, [], None
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            kinds, numbers, ats = (batch.column(c).to_pylist() for c in ("kind", "group", "at"))
            for i in range(batch.num_rows):
                if numbers[i] != group:
                    group, leaves, tree = numbers[i], [], None
                ids, labels = (batch.column(c)[i].values.to_numpy() for c in ("ids", "labels"))
                x = batch.column("xs")[i].values.to_numpy()
                if kinds[i] == 0:
                    leaves.append((ids.copy(), labels.copy(), x.reshape(len(ids), -1).astype(np.int64)))
                    continue
                if not leaves:
                    continue
                tree = tree or Tree(leaves)
                lows, highs = (batch.column(c)[i].as_py() for c in ("lows", "highs"))
                for w, found in enumerate(tree.search(x.astype(np.int64), int(ids[0]), int(labels[0]), same, lows, highs, k)):
                    out += [(ats[i], w, s, j) for s, j in found]
            if out:
                at, place, score, ids = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at, pa.int64()), pa.array(place, pa.int32()), pa.array(score, pa.int64()), pa.array(ids, pa.int64())],
                    ["at", "place", "score", "id"])

    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(1).alias("kind"), "at", F.array("id").alias("ids"),
        F.array("label").alias("labels"), F.col("x").alias("xs"), "lows", "highs")
    # a leaf row holds up to 128 vectors, a query row one: both kinds keep small batches small
    both = index.unionByName(asked).repartition(groups, "group").sortWithinPartitions("group", "kind", "at")
    found = stage(both.mapInArrow(answer, _FOUND), "found")
    return found.withColumn("rank", F.expr("row_number() over (partition by at, place order by score desc, id)")).where(F.col("rank") <= k)


def mined(
    rows: DataFrame, anchors: str = "id % 100 = 0", positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the rows (id, label, x).

    A negative's score is between ``low`` and ``high`` percent of the positive's.
    """
    index, groups = build(rows)
    chosen = stage(rows.where(anchors).withColumn("at", F.monotonically_increasing_id()), "anchors")
    whole = F.array(F.lit(_NONE)).alias("lows"), F.array(F.lit(-_NONE)).alias("highs")
    best = search(index, groups, chosen.select("*", *whole), True, positives)
    # at most `positives` rows an anchor; its windows in the order of the positives' ranks
    windows = best.groupBy("at").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("p")).select(
        "at", "p", F.expr(f"transform(p, r -> cast(ceil(cast(r.score as decimal(20,0)) * {low} / 100BD) as bigint))").alias("lows"),
        F.expr(f"transform(p, r -> cast(floor(cast(r.score as decimal(20,0)) * {high} / 100BD) as bigint))").alias("highs"))
    windows = stage(chosen.join(windows, "at"), "windows")
    hard = search(index, groups, windows.drop("p"), False, negatives)
    facts = windows.select("at", F.col("id").alias("anchor_id"), F.posexplode("p").alias("place", "p"))
    return hard.withColumnRenamed("id", "negative_id").join(facts, ["at", "place"]).select(
        "anchor_id", F.col("p.id").alias("positive_id"), "rank", "negative_id", F.col("p.score").alias("positive_score"),
        F.col("score").alias("negative_score"))


def shifted_labels(df: DataFrame, id_col: str = "vec_id", label_col: str = "label", every: int = 7, classes: int = 10) -> DataFrame:
    """Every seventh id has its label moved on by one: wrong labels that mining has to live with."""
    return df.withColumn(label_col, F.expr(
        f"if(`{id_col}` % {every} = 0, (cast(`{label_col}` as bigint) + 1) % {classes}, `{label_col}`)"))
