"""Operator 11, n-gram Jaccard join: an R-tree over count vectors.

A document's set holds the hashes of its distinct ``shingle``-word runs (a shorter text is one run;
a text without words has an empty set and links with nothing).  The elements are hashed into groups
and the counts of the groups are the set's point.  Two sets share at most the summed minima of
their points, and a set shares with the sets of a box at most the summed minima of its point and
the box's upper corner; so an R-tree over the points leaves few pairs, which are verified on the
full sets.

Which points meet in one tree: sets of the similarity differ in at most d elements, d by their
sizes, so of d + 1 + s groups at least 1 + s hold the same elements in both.  The content of each
of a set's first groups is a cell, and the sets of a cell make a block around its least member.
Empty groups would make huge cells: a set with more than s of them is dealt again by other groups
(sets that agree in empty groups only have that many both).

First each block's star around its least member is verified.  Blocks that then hold several
components are asked by the members outside the largest one: askers and tree come in shares of
about ``SHARE``, and an asker gives its 1,024 nearest partners of other components first and the rest
only if there are more and it has not found its component by then, so a group of many copies never
lists all its pairs.

Defined results: null, empty and blank texts are components of their own; repeated rows get equal
results; rows that share a doc_id with other words are judged apart; rows with a null doc_id take
part, their component_id is the least doc_id they reach (null if there is none).  Partners that tie
in their bound come by node.  Texts of any length are read whole.  Other columns are ignored; an
empty table gives no rows.  doc_ids lie below 2**62.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlake.llm import near_dup
from wordlake.llm.common import U64, first_words, mix, pieces, utf8
from wordlake.operators.lineage import cut_lineage

#: Times that a set is dealt by new groups because too many were empty.
DEALS = 4
#: Members of a share of a block, and elements of their sets.
SHARE, SHARE_ELEMENTS = 4096, 1 << 22
#: Points of a leaf, and children of an inner node.
FANOUT = 16
#: Up to which of its nearest partners an asker names them in each round; a share holds no more than the last.
ROUNDS = (1024, 1 << 62)


def most_unlike(sizes: np.ndarray, percent: int) -> np.ndarray:
    """In how many elements a set of each size differs at most from a partner of the similarity."""
    return (sizes + 100 * sizes // percent) * (100 - percent) // (100 + percent)


def level(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Number of groups, a power of two k with room for d + 1 + k / 16 of them, by a set's size."""
    need = most_unlike(sizes, percent) + 1
    k = np.ones(len(sizes), np.int64)
    while (short := need + k // 16 > k).any():
        k[short] *= 2
    return k


def cell_keys(hashes: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all sets: (number of the set, key), by the contents of their first groups.

    A set is dealt at its own level and, where that is another one, at the level of its largest
    partners.
    """
    first = first_words(counts)
    full = np.flatnonzero(counts)
    own, above = level(counts[full], percent), level(100 * counts[full] // percent, percent)
    up = own != above
    item, k = np.concatenate([full, full[up]]), np.concatenate([own, above[up]])
    upto = most_unlike(counts[item], percent) + 1 + k // 16
    of, keys = [], []
    for deal in range(DEALS):
        if not len(item):
            break
        n = counts[item]
        row = np.repeat(np.arange(len(item)), n)
        element = hashes[np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + first[item][row]]
        element = mix(element ^ U64(0x9E3779B97F4A7C15 * (deal + 1) & 0xFFFFFFFFFFFFFFFF))
        group = (element & (k[row] - 1).astype(U64)).astype(np.int64)
        mine = np.flatnonzero(group < upto[row])
        by = mine[np.lexsort((group[mine], row[mine]))]
        row, group, element = row[by], group[by], element[by]
        lead = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (group[1:] != group[:-1]))[: len(row)])
        tag = lambda r, g: (k[r].astype(U64) << U64(32)) ^ (g.astype(U64) << U64(3)) ^ U64(deal)
        if len(lead):
            content = np.bitwise_xor.reduceat(element, lead) * U64(0xD1342543DE82EF95) + np.add.reduceat(element, lead)
            of.append(item[row[lead]])
            keys.append(mix(content ^ mix(tag(row[lead], group[lead]))))
        empty = upto - np.bincount(row[lead], minlength=len(item))
        again = np.flatnonzero(empty > k // 16)
        if deal == DEALS - 1:
            for r in again.tolist():
                holds = np.zeros(int(upto[r]), bool)
                holds[group[lead][row[lead] == r]] = True
                none = np.flatnonzero(~holds)
                of.append(np.full(len(none), item[r]))
                keys.append(mix(mix(tag(np.full(len(none), r), none)) + U64(1)))
        item, k, upto = item[again], k[again], upto[again]
    if not of:
        return np.empty(0, np.int64), np.empty(0, U64)
    of, keys = np.concatenate(of), np.concatenate(keys)
    by = np.argsort(of, kind="stable")
    return of[by], keys[by]


def points(hashes: np.ndarray, counts: np.ndarray, percent: int) -> list[bytes]:
    """The counts of each set's groups, a byte each (255 for more); twice as many groups as its level has."""
    size = np.maximum(8, 2 * level(counts, percent))
    edge, out = first_words(counts).tolist(), []
    place = (hashes >> U64(32)).astype(np.int64)
    for i, g in enumerate(size.tolist()):
        out.append(np.minimum(np.bincount(place[edge[i] : edge[i + 1]] & (g - 1), minlength=g), 255).astype(np.uint8).tobytes())
    return out


def sketches(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Per row of docs: doc_id, copy (digest of the word sequence), n_shingles, keys (cells)."""
    arrow = pa.schema([("doc_id", pa.int64()), ("copy", pa.binary()), ("n_shingles", pa.int64()), ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", near_dup.CHUNK_BYTES):
            hashes, counts, digests = near_dup.shingle_sets(utf8(piece.column("text")), shingle)
            of, keys = cell_keys(hashes, counts, percent)
            edges = first_words(np.bincount(of, minlength=len(counts))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(keys.view(np.int64)))
            yield pa.record_batch([piece.column("doc_id").cast(pa.int64()), pa.array(digests, pa.binary()), pa.array(counts.astype(np.int64)), lists], schema=arrow)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, copy binary, n_shingles long, keys array<long>")


def marks_of(texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """node, n_shingles, bits (the point) of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", near_dup.CHUNK_BYTES):
            hashes, counts, _ = near_dup.shingle_sets(utf8(piece.column("text")), shingle)
            yield pa.record_batch([piece.column("node"), pa.array(counts.astype(np.int64)), pa.array(points(hashes, counts, percent), pa.binary())], names=["node", "n_shingles", "bits"])

    return texts.select("node", "text").mapInArrow(run, "node long, n_shingles long, bits binary")


def folded(vectors: list[bytes], size: int) -> np.ndarray:
    """Points brought to ``size`` groups: groups whose numbers agree in the lower bits are added up."""
    return np.stack([np.frombuffer(v, np.uint8).reshape(-1, size).sum(0, dtype=np.int32) for v in vectors]) if vectors else np.empty((0, size), np.int32)


def reaches(common: np.ndarray, size: np.ndarray | int, other: np.ndarray | int, percent: int) -> np.ndarray:
    """Whether sets of these sizes that share ``common`` elements have the similarity."""
    return 100 * common >= percent * (size + other - common)


class Tree:
    """An R-tree over points, packed by size and then by the first groups; boxes keep upper corners and sizes."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray) -> None:
        slab = FANOUT * FANOUT
        by = np.lexsort((sizes,))
        half = vectors[:, : vectors.shape[1] // 2].sum(1)
        by = np.concatenate([by[i : i + slab][np.argsort(half[by[i : i + slab]], kind="stable")] for i in range(0, len(by), slab)])
        self.order = by
        #: Per level from the leaves' points up: upper corners, least and largest sizes.
        self.levels = [(vectors[by], sizes[by], sizes[by])]
        while len(self.levels[-1][1]) > FANOUT:
            high, least, most = self.levels[-1]
            at = np.arange(0, len(least), FANOUT)
            self.levels.append((np.maximum.reduceat(high, at), np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)))

    def near(self, vector: np.ndarray, size: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the points that the bound leaves, and the bounds."""
        beyond = size - int(vector.sum())  # of counts above 255
        at = np.arange(len(self.levels[-1][1]))
        bound = at
        for depth in range(len(self.levels) - 1, -1, -1):
            high, least, most = self.levels[depth]
            fits = (100 * size >= percent * least[at]) & (100 * most[at] >= percent * size)
            at = at[fits]
            bound = np.minimum(high[at], vector).sum(1) + beyond
            fine = reaches(np.minimum(bound, size), size, least[at], percent)
            at, bound = at[fine], bound[fine]
            if depth and len(at):
                at = (at[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                at = at[at < len(self.levels[depth - 1][1])]
        return self.order[at], bound


def possible(edges: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """The edges (leaf, hub) that the summed minima of their points leave possible."""
    a, b = (marks.select(F.col("node").alias(end), F.col("n_shingles").alias(f"{end}_n"), F.col("bits").alias(f"{end}_bits")) for end in ("leaf", "hub"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, n = batch.column("leaf_n").to_numpy(), batch.column("hub_n").to_numpy()
            common = np.empty(len(m), np.int64)
            for i, (x, y) in enumerate(zip(batch.column("leaf_bits").to_pylist(), batch.column("hub_bits").to_pylist(), strict=True)):
                size = min(len(x), len(y))
                u, v = folded([x], size)[0], folded([y], size)[0]
                common[i] = np.minimum(u, v).sum() + m[i] - u.sum()
            fine = np.flatnonzero(reaches(np.minimum(common, np.minimum(m, n)), m, n, percent))
            yield batch.select(["leaf", "hub"]).take(pa.array(fine))

    return edges.join(a, "leaf").join(b, "hub").select("leaf", "hub", "leaf_n", "hub_n", "leaf_bits", "hub_bits").mapInArrow(run, "leaf long, hub long")


def tree_pairs(shares: DataFrame, percent: int, after: int, upto: int) -> DataFrame:
    """Candidates (leaf, hub) of each share, the askers' ``after + 1``-th to ``upto``-th nearest partners of other
    components; a null hub says that the asker has more.

    Rows of ``shares``: block, a, b, asks, node, component, n_shingles, bits; of a share the tree's members come first.
    """
    arrow = pa.schema([("leaf", pa.int64()), ("hub", pa.int64())])

    def answers(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        asks, node, component, sizes, vectors = (list(x) for x in zip(*rows, strict=True))
        points = folded(vectors, min(map(len, vectors)))
        node, component, sizes, asks = np.array(node), np.array(component), np.array(sizes), np.array(asks)
        held, asking = np.flatnonzero(~asks), np.flatnonzero(asks)
        if not len(held) or not len(asking):
            return
        tree = Tree(points[held], sizes[held])
        leaf, hub, more = [], [], []
        for i in asking.tolist():
            at, bound = tree.near(points[i], int(sizes[i]), percent)
            others = node[held[at]] != node[i]
            at, bound = held[at[others]], bound[others]
            at = at[np.lexsort((node[at], -bound))]  # one order for all rounds
            other = component[at] != component[i]
            some = at[after:upto][other[after:upto]]
            leaf.append(np.full(len(some), node[i]))
            hub.append(node[some])
            if other[upto:].any():
                more.append(node[i])
        leaf, hub = np.concatenate(leaf), np.concatenate(hub)
        yield pa.record_batch([pa.array(np.append(np.maximum(leaf, hub), np.array(more, np.int64))), pa.array([*np.minimum(leaf, hub).tolist(), *[None] * len(more)], pa.int64())], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        at = None
        for batch in batches:
            for block, a, b, *row in zip(*(batch.column(c).to_pylist() for c in ("block", "a", "b", "asks", "node", "component", "n_shingles", "bits")), strict=True):
                if (block, a, b) != at:
                    if held:
                        yield from answers(held)
                    held, at = [], (block, a, b)
                held.append(tuple(row))
        if held:
            yield from answers(held)

    dealt = shares.repartition("block", "a", "b").sortWithinPartitions("block", "a", "b")
    return dealt.select("block", "a", "b", "asks", "node", "component", "n_shingles", "bits").mapInArrow(run, "leaf long, hub long").distinct()


def components_of(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with the component of their node."""
    return rows.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def mixed_blocks(members: DataFrame, found: DataFrame) -> DataFrame:
    """block, its largest component, and the shares for the members outside it and for all: of the blocks that hold several."""
    each = components_of(members, found).groupBy("block", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("elements"))
    largest = F.max_by(F.struct("component", "n", "elements"), F.struct("n", -F.col("component"))).alias("largest")
    blocks = each.groupBy("block").agg(largest, F.sum("n").alias("size"), F.sum("elements").alias("elements")).filter("size > largest.n")
    shares = lambda n, elements: F.ceil(F.greatest(n / SHARE, elements / SHARE_ELEMENTS))
    outside = [F.col(c) - F.col(f"largest.{x}") for c, x in (("size", "n"), ("elements", "elements"))]
    return blocks.select("block", F.col("largest.component").alias("largest"), shares(*outside).alias("askers"), shares(F.col("size"), F.col("elements")).alias("trees"))


def linked_classes(docs: DataFrame, sketch: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The classes of equal word sequences, and (node, component) of those that are not their component's least."""
    classes = cut_lineage(near_dup.text_classes(sketch.drop("keys"), ("n_shingles",)))
    cells = near_dup.class_keys(sketch, classes)
    hubs = cells.groupBy("key").agg(F.min("node").alias("block"), F.max("node").alias("last")).filter("block < last").select("key", "block")
    shared = cut_lineage(cells.join(hubs, "key").select("block", "node").distinct())
    wanted = classes.join(shared.select("node").distinct(), "node", "left_semi").select("node", "copy", "id")
    texts = near_dup.node_texts(docs, wanted)
    marks = cut_lineage(marks_of(texts, shingle, percent))
    members = shared.join(marks.select("node", "n_shingles"), "node")
    stars = shared.filter("node <> block").select(F.col("node").alias("leaf"), F.col("block").alias("hub"))
    links = cut_lineage(near_dup.confirmed(possible(stars, marks, percent), texts, shingle, percent))
    found = near_dup.components(links)
    # who asks, and in how many shares, is fixed here, so that the rounds' orders agree
    blocks = mixed_blocks(members, found)
    placed = cut_lineage(components_of(members.join(blocks, "block"), found).withColumn("outside", F.col("component") != F.col("largest")).drop("component", "largest").join(marks.select("node", "bits"), "node"))
    after = 0
    for upto in ROUNDS:
        now = components_of(placed, found)
        if after:
            now = now.join(mixed_blocks(placed.select("block", "node", "n_shingles"), found).select("block"), "block", "left_semi")
        share = lambda n: F.pmod(F.xxhash64("node", F.lit(3)), F.col(n))
        all_of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        rest = ["block", "node", "component", "n_shingles", "bits"]
        trees = now.select(*rest, F.lit(False).alias("asks"), share("trees").alias("b"), all_of("askers").alias("a"))
        askers = now.filter("outside").select(*rest, F.lit(True).alias("asks"), share("askers").alias("a"), all_of("trees").alias("b"))
        pairs = cut_lineage(tree_pairs(trees.unionByName(askers), percent, after, upto))
        named, unnamed = pairs.agg(F.count("hub"), F.count_if(F.col("hub").isNull())).first()
        if named:
            links = cut_lineage(links.unionByName(near_dup.confirmed(pairs.filter("hub is not null"), texts, shingle, percent)))
            found = near_dup.components(links)
        if not unnamed:
            break
        after = upto
    return classes, found


def jaccard_components(docs: DataFrame, shingle: int = 3, percent: int = 90) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id."""
    sketch = cut_lineage(sketches(docs, shingle, percent))
    return near_dup.with_components(sketch, *linked_classes(docs, sketch, shingle, percent)).select("doc_id", "n_shingles", "component_id")
