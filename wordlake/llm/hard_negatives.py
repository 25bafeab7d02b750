"""Operator 12, hard-negative mining: cover trees over norm-augmented candidates.

A row's vector is scaled to whole numbers; its score for an anchor is the inner product.  Every
candidate gets one more coordinate that brings all candidates of a tree to one length R, an anchor
gets 0 there; so the score is |anchor| R cos(angle), and what is near by angle scores high.  A cover
tree's levels are centres chosen farthest first: all points of a node lie within the level's
covering radius of their centre, centres lie at least as far apart.  Around a centre at angle t
from the anchor, a covering angle r bounds all scores between those of the angles t + r and t - r.
Descent is best first; nodes whose bounds lie outside what is asked (the best so far, or the
windows of the positives) and nodes without a fitting label are skipped, and the points of the
leaves that remain are verified on their whole-number scores.

Candidates are dealt to blocks, one tree each; anchors visit every block, first for their
positives, then with the windows that these give.  Each block answers with its best few, which are
ranked over all blocks.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no
part; vectors meet only vectors of their length; rows alike in vec_id, label and vector are one
row, rows that share a vec_id with other contents are rows of their own; a null vec_id is no
anchor and comes last among ties; a zero vector scores 0 everywhere; an anchor without positives
has no rows; scores beyond a long are an error; other columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordlake.operators.lineage import cut_lineage

#: Candidates of a block, points of a leaf, centres of a level.
BLOCK_ROWS, LEAF, CENTRES = 1 << 14, 256, 16
#: Points of leaves that are verified at once, once a search has gone on for a while.
READ = 4096
#: Levels after which nodes are parted evenly, whatever lies far.
DEEP = 40
#: What rounding may take from an angle.
ROUNDING = 1e-9
LAST = (1 << 63) - 1


def prepared(rows: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label, vector (whole numbers as doubles), row (a hash that names it): of the rows that take part."""
    fine = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    scaled = F.transform(F.col("embedding").cast("array<double>"), lambda x: x * F.lit(float(scale)))
    vector = F.transform(scaled, lambda x: F.when(F.abs(x) < F.lit(float(1 << 53)), F.floor(x).cast("double")).otherwise(x))  # above, doubles are whole
    out = rows.filter(fine).select(F.col("vec_id").cast("long"), F.col("label").cast("long"), vector.alias("vector"))
    return out.withColumn("row", F.xxhash64("vec_id", "label", F.col("vector")))


def scores_of(points: np.ndarray, vector: np.ndarray, most: float) -> np.ndarray:
    """Exact inner products of whole-number doubles, the points' largest being ``most``: by doubles, 64-bit or Python integers."""
    size = most * float(np.abs(vector).max(initial=0)) * max(1, len(vector))
    if size < 2**52:
        return points @ vector
    if size < 2**62 and most < 2**62 and np.abs(vector).max() < 2**62:
        return points.astype(np.int64) @ vector.astype(np.int64)
    return np.array([sum(int(x) * int(y) for x, y in zip(p, vector, strict=True)) for p in points], object)


@dataclass
class Node:
    """A cover-tree node: its children, or the points of a leaf; and the labels below as bits by their remainder of 64."""

    centres: np.ndarray | None = None  # augmented, one per child
    angles: np.ndarray | None = None  # covering angle of each child
    children: list | None = None
    masks: np.ndarray | None = None  # labels of each child
    single: np.ndarray | None = None  # whether the child has one label only
    only: np.ndarray | None = None  # a label of each child
    points: slice | None = None


class CoverTree:
    """A cover tree over one block's candidates; the points of a leaf stand together in its arrays."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, vectors: np.ndarray) -> None:
        squares = (vectors * vectors).sum(1)
        self.length = float(np.sqrt(squares.max())) or 1.0
        self.most = float(np.abs(vectors).max(initial=0))
        raised = np.concatenate([vectors, np.sqrt(np.maximum(self.length**2 - squares, 0))[:, None]], 1) / self.length
        self.order: list[np.ndarray] = []
        self.placed = 0
        self.root = self.built(np.arange(len(ids)), raised, labels)
        order = np.concatenate(self.order)
        self.ids, self.labels, self.rows, self.vectors = ids[order], labels[order], rows[order], vectors[order]

    def built(self, at: np.ndarray, unit: np.ndarray, labels: np.ndarray, depth: int = 0) -> Node:
        if len(at) <= LEAF:
            self.order.append(at)
            self.placed += len(at)
            return Node(points=slice(self.placed - len(at), self.placed))
        # farthest first: each new centre is the point farthest from those there are
        nearest, owner, centres = np.full(len(at), -2.0), np.zeros(len(at), np.int64), []
        new = 0
        while len(centres) < (CENTRES if depth < DEEP else 1):
            cosine = unit[at] @ unit[at[new]]
            closer = cosine > nearest
            nearest[closer], owner[closer] = cosine[closer], len(centres)
            centres.append(at[new])
            new = int(nearest.argmin())
            if nearest[new] > 1 - 1e-12:
                break
        if len(centres) == 1:  # copies of one vector, or centres that part too little: parted evenly
            owner = np.arange(len(at)) * CENTRES // len(at)
            centres = [at[0]] * CENTRES
        children, angles, masks, single, only, kept = [], [], [], [], [], []
        for c, centre in enumerate(centres):
            mine = owner == c
            below = at[mine]
            if not len(below):
                continue
            kept.append(centre)
            children.append(self.built(below, unit, labels, depth + 1))
            angles.append(float(np.arccos(np.clip(nearest[mine].min(), -1, 1))) + 1e-7)
            own = np.unique(labels[below])
            masks.append(np.bitwise_or.reduce(np.left_shift(np.uint64(1), (own % 64).astype(np.uint64))))
            single.append(len(own) == 1)
            only.append(own[0])
        return Node(unit[kept], np.array(angles), children, np.array(masks, np.uint64), np.array(single), np.array(only))

    def descend(self, vector: np.ndarray, wanted: Callable[[Node], np.ndarray], asks: Callable[[float, float], bool], take: Callable[[slice | np.ndarray, np.ndarray], None]) -> None:
        """Visit nodes by their upper bound, best first: those of ``wanted`` labels whose bounds ``asks`` accepts.

        The leaves' points go to ``take`` with their scores: first one leaf, then twice as much each time, up to ``READ`` points.
        """
        length = float(np.sqrt((vector * vector).sum()))
        top = length * self.length
        slack = ROUNDING * (top + 1)
        heap: list[tuple] = [(-top, 0, -top, self.root)]
        number, size = 0, 1
        while heap:
            leaves, held = [], 0
            while heap and held < size:
                high, _, low, node = heapq.heappop(heap)
                if not asks(low - slack, slack - high):
                    continue
                if node.points is not None:
                    leaves.append(node.points)
                    held += node.points.stop - node.points.start
                    continue
                angle = np.arccos(np.clip(node.centres[:, :-1] @ vector / (length or 1.0), -1, 1))
                highs, lows = top * np.cos(np.maximum(angle - node.angles, 0)), top * np.cos(np.minimum(angle + node.angles, np.pi))
                for fine, child, a, b in zip(wanted(node).tolist(), node.children, highs.tolist(), lows.tolist(), strict=True):
                    if fine:
                        number += 1
                        heapq.heappush(heap, (-a, number, b, child))
            if leaves:
                at = np.concatenate([np.arange(x.start, x.stop) for x in leaves])
                take(at, scores_of(np.concatenate([self.vectors[x] for x in leaves]), vector, self.most))
            size = min(max(2 * held, size), READ)


def positives_in(tree: CoverTree, anchor: dict, limit: int) -> list[tuple]:
    """(score, id, row) of the block's ``limit`` best rows of the anchor's label, without the anchor's own."""
    best: list[tuple] = []
    bit, label, own = np.uint64(1 << (int(anchor["label"]) % 64)), anchor["label"], anchor["row"]

    def take(at: np.ndarray, scores: np.ndarray) -> None:
        nonlocal best
        fine = (tree.labels[at] == label) & (tree.rows[at] != own)
        if len(best) == limit:
            fine &= scores >= -best[-1][0]
        at_, scores_ = at[fine], scores[fine]
        best = sorted([*best, *zip((-scores_).tolist(), tree.ids[at_].tolist(), tree.rows[at_].tolist(), strict=True)])[:limit]

    tree.descend(anchor["vector"], lambda node: node.masks & bit != 0, lambda low, high: len(best) < limit or high >= -best[-1][0], take)
    return [(int(-s), i, r) for s, i, r in best]


def negatives_in(tree: CoverTree, anchor: dict, windows: list[tuple[int, int]], limit: int) -> list[list[tuple]]:
    """Per window (least, most): (score, id, row) of the block's ``limit`` best rows of other labels with scores inside."""
    best: list[list[tuple]] = [[] for _ in windows]
    label = anchor["label"]

    def asks(low: float, high: float) -> bool:
        return any(low <= b and high >= (a if len(x) < limit else -x[-1][0]) for (a, b), x in zip(windows, best, strict=True))

    def take(at: np.ndarray, scores: np.ndarray) -> None:
        # no window can use a score below all of their least, or above all of their most
        open_ = [(max(a, -best[w][-1][0]) if len(best[w]) == limit else a, b) for w, (a, b) in enumerate(windows)]
        other = (scores >= min(a for a, _ in open_)) & (scores <= max(b for _, b in open_)) & (tree.labels[at] != label)
        if not other.any():
            return
        at_, scores_ = at[other], scores[other]
        for w, (a, b) in enumerate(open_):
            inside = np.flatnonzero((scores_ >= a) & (scores_ <= b))
            if len(inside):
                some = at_[inside]
                best[w] = sorted([*best[w], *zip((-scores_[inside]).tolist(), tree.ids[some].tolist(), tree.rows[some].tolist(), strict=True)])[:limit]

    tree.descend(anchor["vector"], lambda node: ~node.single | (node.only != label), asks, take)
    return [[(int(-s), i, r) for s, i, r in x] for x in best]


def answered(candidates: DataFrame, anchors: DataFrame, blocks: int, answer: Callable[[CoverTree, dict], list[tuple]], columns: str) -> DataFrame:
    """What ``answer`` gives for every anchor in every block; a block's tree is built once, then its anchors stream past it."""
    key = [F.size("vector").alias("length")]
    trees = candidates.select(*key, F.pmod("row", F.lit(blocks)).alias("block"), F.lit(0).alias("kind"), "vec_id", "label", "row", "vector", F.lit(None).cast("array<long>").alias("lows"), F.lit(None).cast("array<long>").alias("highs"))
    asked = anchors.select(*key, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.lit(1).alias("kind"), "vec_id", "label", "row", "vector", "lows", "highs")
    names = ["length", "block", "kind", "vec_id", "label", "row", "vector", "lows", "highs"]
    types = {"long": pa.int64(), "int": pa.int32()}
    arrow = pa.schema([(c.split()[0], types[c.split()[1]]) for c in columns.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, tree = None, [], None
        for batch in batches:
            out: list[tuple] = []
            small = [batch.column(c).to_pylist() for c in names if c != "vector"]
            vectors = batch.column("vector")
            flat, edges = vectors.flatten().to_numpy(), np.append(0, np.cumsum(vectors.value_lengths().to_numpy()))
            for i, (length, block, kind, vec_id, label, row, lows, highs) in enumerate(zip(*small, strict=True)):
                vector = flat[edges[i] : edges[i + 1]]
                if (length, block) != at:
                    at, held, tree = (length, block), [], None
                if kind == 0:
                    held.append((LAST if vec_id is None else vec_id, label, row, vector.copy()))
                    continue
                if tree is None:
                    if not held:
                        continue
                    held = list({(i, c, r, v.tobytes()): (i, c, r, v) for i, c, r, v in held}.values())  # repeated rows are one
                    ids, labels, rows, points = zip(*held, strict=True)
                    tree, held = CoverTree(np.array(ids), np.array(labels), np.array(rows), np.array(points)), []
                out += answer(tree, {"vec_id": vec_id, "label": label, "row": row, "vector": vector, "lows": lows, "highs": highs})
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), arrow.types, strict=True)], schema=arrow)

    both = trees.unionByName(asked).repartition("length", "block").sortWithinPartitions("length", "block", "kind")
    return both.select(*names).mapInArrow(run, columns)


def hard_negatives(rows: DataFrame, anchors_of: str = "vec_id % 100 = 0", positives: int = 5, negatives: int = 5, percent: int = 80, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are its best rows of the same label; a positive's negatives are the best
    rows of other labels that score at least ``percent`` percent of the positive and no more than it.
    """
    candidates = cut_lineage(prepared(rows, scale))
    blocks = 1 + candidates.count() // BLOCK_ROWS
    none = F.lit(None).cast("array<long>")
    anchors = cut_lineage(candidates.filter(anchors_of).distinct())
    asked = anchors.withColumns({"lows": none, "highs": none})
    same = lambda tree, a: [(a["row"], i, r, s) for s, i, r in positives_in(tree, a, positives)]
    found = answered(candidates, asked, blocks, same, "anchor long, id long, row long, score long")
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "id", "row")
    chosen = cut_lineage(found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives))
    # least whole score s with 100 s >= percent * p
    window = F.sort_array(F.collect_list(F.struct("place", F.expr(f"{percent} * score div 100 + cast({percent} * score % 100 > 0 as long)").alias("low"), F.col("score").alias("high"))))
    windows = chosen.groupBy(F.col("anchor").alias("row")).agg(window.alias("x"))
    with_windows = anchors.join(windows, "row").select("vec_id", "label", "row", "vector", F.col("x.low").alias("lows"), F.col("x.high").alias("highs"))

    def other(tree: CoverTree, a: dict) -> list[tuple]:
        ranges = list(zip(a["lows"], a["highs"], strict=True))
        return [(a["row"], a["vec_id"], w + 1, i, r, s) for w, x in enumerate(negatives_in(tree, a, ranges, negatives)) for s, i, r in x]

    hard = answered(candidates, with_windows, blocks, other, "anchor long, anchor_id long, place int, id long, row long, score long")
    per = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id", "row")
    ranked = hard.withColumn("rank", F.row_number().over(per)).filter(F.col("rank") <= negatives)
    named = lambda c: F.when(F.col(c) < LAST, F.col(c))
    pos = chosen.select("anchor", "place", named("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return ranked.join(pos, ["anchor", "place"]).select("anchor_id", "positive_id", "rank", named("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
