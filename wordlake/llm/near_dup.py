"""Operator 8, MinHash near-dedup: one-permutation hashing, optimal densification, star edges.

A document's set holds the hashes of its distinct ``shingle``-word runs (a shorter text is one
run; a text without words has an empty set and links with nothing).  Each set is hashed once; bin
i keeps the least hash in its share of the range, and an empty bin copies the first full bin in an
order of its own (optimal densification).  ``rows`` bins make a band, equal bands share a bucket.

Exact copies are folded first.  In each bucket only the edges from one hub (the least node) to the
other members are candidates, so candidates never outnumber bands times documents; each document
tries the hub it shares most buckets with.  Candidates are confirmed on the full sets.  A star may
miss a link between two leaves, so the members of buckets that still hold several components are
dealt anew, by their rarest shingles: similar sets share one of these for certain, while sets that
differ in many places do not.  There stars are drawn again, ``HUBS`` hubs a round (members of the
smallest components first), until no bucket holds two components whose pairs were not looked at.

Defined results: null, empty and blank texts are components of their own; repeated rows get equal
results; rows that share a doc_id with other words are judged apart, each by its own text; rows
with a null doc_id take part, their component_id is the least doc_id they reach (null if there is
none).  Ties between hubs go to the lesser node.  Texts of any length are hashed whole.  Other
columns are ignored by ``near_duplicates`` and carried by ``drop_near_duplicates``; an empty table
gives no rows.  doc_ids lie below 2**62: numbers above that stand for texts without an id of
their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordlake.llm.common import U64, bit_table, first_words, gram_hashes, is_set, joined_words, mix, pieces, utf8, word_bounds, word_keys
from wordlake.operators.lineage import cut_lineage, stored

CHUNK_BYTES = 1 << 20
#: Nodes that are made of a text's digest, not of a doc_id, begin here.
HASHED = 1 << 62
#: Bits of the table of wanted texts: 8 MB, whatever their number.
COPY_BITS = 1 << 26
#: Leaves of one hub that are confirmed in one place.
SHARE = 512
#: Edges that a task joins at once.
EDGES = 1 << 20
#: Hubs of a bucket of rare shingles in one round; up to 1,000 Spark cuts such a choice down before its shuffle.
HUBS = 1000


def probe_order(bins: int, seed: int = 11) -> np.ndarray:
    """For each bin (column) an order of its own over all bins."""
    rng = np.random.RandomState(seed)
    return np.stack([rng.permutation(bins) for _ in range(bins)], 1).astype(np.int16)


def shingle_sets(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Sorted distinct shingle hashes of all texts, their counts per text, and the texts' digests."""
    data, counts = joined_words([t.lower() for t in texts])
    buf = np.frombuffer(data, np.uint8)
    words = word_keys(buf, *word_bounds(buf))
    first = first_words(counts)
    grams = gram_hashes(words, n)
    doc = np.repeat(np.arange(len(counts)), counts)
    size = max(0, len(words) - n + 1)
    fine = doc[:size] == doc[n - 1 :][:size]
    hashes, of = grams[fine], doc[:size][fine]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        extra = np.array([int(np.bitwise_xor.reduce(mix(words[first[i] : first[i + 1]] + np.arange(counts[i], dtype=U64)))) ^ int(counts[i]) for i in short.tolist()], U64)
        hashes, of = np.concatenate([hashes, mix(extra)]), np.concatenate([of, short])
    by = np.lexsort((hashes, of))
    hashes, of = hashes[by], of[by]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    hashes, of = hashes[new], of[new]
    digests = [hashlib.blake2b(x, digest_size=16).digest() for x in data.split(b"\n")] if counts.sum() else [b""] * len(counts)
    return hashes, np.bincount(of, minlength=len(counts)), digests


def shingles_of(text: bytes, n: int) -> set[bytes]:
    """The distinct shingles themselves: what a link is confirmed on in the end."""
    words = text.lower().split()
    return {b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def signatures(hashes: np.ndarray, counts: np.ndarray, bins: int, probes: np.ndarray) -> np.ndarray:
    """One densified signature per set; rows of empty sets mean nothing."""
    of = np.repeat(np.arange(len(counts)), counts)
    place = ((hashes >> U64(32)) * U64(bins) >> U64(32)).astype(np.int64)
    key = of * bins + place
    lead = np.ones(len(key), bool)
    lead[1:] = key[1:] != key[:-1]  # sorted hashes: the first of a bin is its least
    flat = np.zeros(len(counts) * bins, U64)
    full = np.zeros(len(counts) * bins, bool)
    flat[key[lead]], full[key[lead]] = hashes[lead], True
    signs, full = flat.reshape(-1, bins), full.reshape(-1, bins)
    row, col = np.nonzero(~full & (counts > 0)[:, None])
    for step in range(bins):
        if not len(row):
            break
        source = probes[step, col]
        found = full[row, source]
        signs[row[found], col[found]] = signs[row[found], source[found]]
        row, col = row[~found], col[~found]
    return signs


def band_keys(signs: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Bucket keys, one per band; the band's number is part of the key."""
    cut = signs[:, : bands * rows].reshape(-1, bands, rows)
    out = np.tile(np.arange(1, bands + 1, dtype=U64), (len(signs), 1))
    for r in range(rows):
        out = mix((out * U64(0x9E3779B97F4A7C15)) ^ cut[:, :, r])
    return out


def sketches(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """Per row of docs: doc_id, copy (digest of the word sequence), n_shingles, keys, bits.

    ``bits`` holds 512 parities of the set: two sets differ in at least as many shingles as bits.
    """
    names = ["doc_id", "copy", "n_shingles", "keys", "bits"]
    arrow = pa.schema(list(zip(names, [pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())], strict=True)))
    bins = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes = probe_order(bins)
        for piece in pieces(batches, "text", CHUNK_BYTES):
            for a in range(0, piece.num_rows, 1000):
                some = piece.slice(a, 1000)
                hashes, counts, digests = shingle_sets(utf8(some.column("text")), shingle)
                keys = band_keys(signatures(hashes, counts, bins, probes), bands, rows)
                full = counts > 0
                odd = np.bincount(np.repeat(np.arange(len(counts)), counts) * 512 + (hashes % U64(512)).astype(np.int64), minlength=len(counts) * 512) & 1
                bits = np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(-1, 8)
                lists = [pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(full * x.shape[1])).astype(np.int32)), pa.array(x[full].ravel().view(np.int64))) for x in (keys, bits)]
                yield pa.record_batch([some.column("doc_id").cast(pa.int64()), pa.array(digests, pa.binary()), pa.array(counts.astype(np.int64)), *lists], schema=arrow)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, copy binary, n_shingles long, keys array<long>, bits array<long>")


def with_copy(docs: DataFrame, only: np.ndarray | None = None) -> DataFrame:
    """``docs`` with ``__copy``, the digest of the lower-cased word sequence; of rows whose bit is set in the table ``only``."""
    schema = T.StructType([*docs.schema.fields, T.StructField("__copy", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", CHUNK_BYTES):
            digests = [hashlib.blake2b(b" ".join(t.lower().split()), digest_size=16).digest() for t in utf8(piece.column("text"))]
            out = pa.record_batch([*piece.columns, pa.array(digests, pa.binary())], names=[*piece.schema.names, "__copy"])
            if sent is not None:
                bits = np.array([int.from_bytes(d[:4], "big") for d in digests], np.int64) % COPY_BITS
                out = out.filter(pa.array(is_set(sent.value, bits)))
            yield out

    sent = None if only is None else docs.sparkSession.sparkContext.broadcast(only)
    return docs.mapInArrow(run, schema)


def text_classes(sketch: DataFrame, carried: tuple[str, ...] = ("n_shingles", "keys", "bits")) -> DataFrame:
    """One row per distinct word sequence: copy, id (least doc_id), the ``carried`` columns, node.

    The node is the id where no other sequence has it, else a number above all doc_ids that is
    made of the digest: so every sequence has a node of its own.
    """
    classes = stored(sketch.filter("n_shingles > 0").groupBy("copy").agg(F.min("doc_id").alias("id"), *[F.first(c).alias(c) for c in carried]))
    clash = classes.filter(F.col("id").isNotNull()).groupBy("id").count().filter("count > 1").select("id", F.lit(True).alias("clash"))
    own = F.when(F.col("clash").isNull(), F.col("id"))
    return classes.join(clash, "id", "left").withColumn("node", F.coalesce(own, F.lit(HASHED) + F.pmod(F.xxhash64("copy"), F.lit(HASHED)))).drop("clash")


def confirmed(edges: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The edges (leaf, hub) whose full sets reach the similarity.

    A hub's leaves are dealt out in shares of about ``SHARE`` rows; its text goes once to each
    share and the leaves' texts stream past it, so neither a hub of very many leaves nor its text
    weighs on one task.
    """
    hubs = edges.groupBy("hub").agg(F.ceil(F.count("*") / SHARE).alias("shares"))
    leaves = edges.join(hubs, "hub").withColumnRenamed("leaf", "node").join(texts, "node").select("hub", F.pmod(F.xxhash64("node"), F.col("shares")).alias("share"), F.col("node").alias("leaf"), "text")
    centres = hubs.withColumnRenamed("hub", "node").join(texts, "node").select(F.col("node").alias("hub"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"), F.lit(None).cast("long").alias("leaf"), "text")
    both = centres.unionByName(leaves).repartition("hub", "share").sortWithinPartitions("hub", "share", F.asc_nulls_first("leaf"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, own_text, own_shingles = np.empty(0, U64), b"", None
        for piece in pieces(batches, "text", CHUNK_BYTES):
            texts = utf8(piece.column("text"))
            sets, counts, _ = shingle_sets(texts, shingle)
            edge, out = first_words(counts).tolist(), []
            for i, leaf in enumerate(piece.column("leaf").to_pylist()):
                mine = sets[edge[i] : edge[i + 1]]
                if leaf is None:
                    own, own_text, own_shingles = mine.copy(), texts[i], None
                    continue
                at = np.minimum(np.searchsorted(own, mine), len(own) - 1)
                common = int((own[at] == mine).sum())
                if 100 * common >= percent * (len(mine) + len(own) - common):  # by hashes; now by the words
                    own_shingles = own_shingles or shingles_of(own_text, shingle)
                    both = shingles_of(texts[i], shingle)
                    if 100 * len(both & own_shingles) >= percent * len(both | own_shingles):
                        out.append(i)
            yield piece.select(["leaf", "hub"]).take(pa.array(out, pa.int64()))

    return both.mapInArrow(run, "leaf long, hub long")


def joined_ends(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the edges that is not its component's least, and that least node."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    top = np.arange(len(nodes))
    while True:
        low = np.minimum(top[a], top[b])
        new = top.copy()
        for end in (a, b, top[a], top[b]):
            np.minimum.at(new, end, low)
        new = new[new]
        if (new == top).all():
            break
        top = new
    rest = np.flatnonzero(top != np.arange(len(nodes)))
    return nodes[rest], nodes[top[rest]]


def contracted(edges: DataFrame, by: str | None = None) -> DataFrame:
    """Edges (u, v) replaced, some at a time, by stars around the least node of what they join.

    With ``by``, edges of the same value lie in the same place and are never parted.
    """
    def stars(u: list[np.ndarray], v: list[np.ndarray]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(x) for x in joined_ends(np.concatenate(u), np.concatenate(v))], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u: list[np.ndarray] = []
        v: list[np.ndarray] = []
        held = 0
        for batch in batches:
            new_u, new_v = (batch.column(c).to_numpy() for c in ("u", "v"))
            if held > EDGES:  # the rows are sorted by u: what belongs to the last u stays together
                cut = int(np.searchsorted(new_u, u[-1][-1], "right")) if by else 0
                u.append(new_u[:cut])
                v.append(new_v[:cut])
                new_u, new_v = new_u[cut:], new_v[cut:]
                if len(new_u):
                    yield stars(u, v)
                    u, v, held = [], [], 0
            if len(new_u):
                u.append(new_u)
                v.append(new_v)
                held += len(new_u)
        if u:
            yield stars(u, v)

    dealt = edges.repartition(by).sortWithinPartitions(by) if by else edges
    return dealt.mapInArrow(run, "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """node, component (the least node reachable) of all nodes that are not their component's least.

    Each round joins what stands together in a task, brings all labels of a node together (a node
    has one per task at most, so no node is hot), and lets every node jump to its label's own
    label.  Rounds grow with the logarithm of the longest chain.  A round is two short jobs: every
    stage has as many tasks as there are partitions, and the driver keeps what it knows of each.
    """
    e = contracted(links.select(F.greatest("leaf", "hub").alias("u"), F.least("leaf", "hub").alias("v")).filter("u <> v"))
    while True:
        e = stored(contracted(e, "u"))
        up = e.select(F.col("u").alias("v"), F.col("v").alias("w"))
        # w is null where the label has no label of its own
        jumped = stored(e.join(up, "v", "left"))
        if jumped.filter("w is not null").isEmpty():
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        e = contracted(jumped.select("u", F.coalesce("w", "v").alias("v")))


def hub_edges(members: DataFrame) -> DataFrame:
    """Leaf, hub and the buckets they share: one edge from each bucket's hub to its other members."""
    return members.filter("node <> hub").groupBy(F.col("node").alias("leaf"), "hub").agg(F.count("*").alias("shared"))


def rare_prefixes(texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """node, key, size, place: the rarest shingles of each set, of which similar sets share at least one.

    A set of n shingles meets any partner of the similarity in ceil(percent * n / 100) of them, so
    the n - that + 1 rarest of both (in one order for all) have one in common.  Rarity is counted
    over the given texts; shingles of one text only have no partner and are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", CHUNK_BYTES):
            hashes, counts, _ = shingle_sets(utf8(piece.column("text")), shingle)
            owners = np.repeat(piece.column("node").to_numpy(), counts)
            yield pa.record_batch([pa.array(owners), pa.array(hashes.view(np.int64)), pa.array(np.repeat(counts.astype(np.int64), counts))], names=["node", "key", "size"])

    items = texts.select("node", "text").mapInArrow(run, "node long, key long, size long")
    often = items.groupBy("key").agg(F.count("*").alias("often"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("often", "key"))
    needed = F.ceil(F.col("size") * percent / 100)
    return items.join(often, "key").withColumn("place", place).filter((F.col("place") <= F.col("size") - needed + 1) & (F.col("often") > 1)).select("node", "key", "size", "place")


def mixed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows (key, node, ...) of the keys that still hold more than one component, with
    ``component`` and ``own``, the rows of that component under the key."""
    now = rows.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    each = now.groupBy("key", "component").agg(F.count("*").alias("own"))
    keys = each.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a <> b").select("key")
    return now.join(cut_lineage(each.join(keys, "key", "left_semi")), ["key", "component"])


def unlike(bits: str, other: str) -> Column:
    """In how many parities two sets differ: in at least as many shingles do they."""
    return sum((F.bit_count(F.col(bits)[i].bitwiseXOR(F.col(other)[i])) for i in range(8)), F.lit(0))


def possible(percent: int) -> Column:
    """False only for pairs that cannot reach the similarity: by their sizes, by what can follow
    their first common shingle, or by the parities that differ."""
    n = F.col("size") + F.col("hub_size")
    sizes = F.lit(100) * F.least("size", "hub_size") >= F.lit(percent) * F.greatest("size", "hub_size")
    follow = F.lit(1) + F.least(F.col("size") - F.col("place"), F.col("hub_size") - F.col("hub_place"))
    return sizes & (follow * (100 + percent) >= n * percent) & (unlike("bits", "hub_bits") * (100 + percent) <= n * (100 - percent))


def near_enough(edges: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """The edges whose sizes and differing parities leave the similarity possible."""
    a, b = (marks.select(F.col("node").alias(end), F.col("n_shingles").alias(f"{end}_n"), F.col("bits").alias(f"{end}_bits")) for end in ("leaf", "hub"))
    n = F.col("leaf_n") + F.col("hub_n")
    fine = (F.lit(100) * F.least("leaf_n", "hub_n") >= F.lit(percent) * F.greatest("leaf_n", "hub_n")) & (unlike("leaf_bits", "hub_bits") * (100 + percent) <= n * (100 - percent))
    return edges.join(a, "leaf").join(b, "hub").filter(fine).select("leaf", "hub")


def class_keys(sketch: DataFrame, classes: DataFrame) -> DataFrame:
    """node, key: the keys of each class, from the row of its least doc_id."""
    own = classes.select(F.col("copy").alias("c"), "id", "node")
    return sketch.filter("n_shingles > 0").join(own, (F.col("copy") == F.col("c")) & F.col("doc_id").eqNullSafe(F.col("id"))).select("node", F.explode("keys").alias("key"))


def node_texts(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """node, text: one text of each class that ``marks`` (copy, id, node) names.

    A bit table of 8 MB turns away most other texts before they are shuffled; where it fills up,
    the join alone decides.
    """
    bit = F.conv(F.hex(F.substring("copy", 1, 4)), 16, 10).cast("long") % COPY_BITS
    only = bit_table(marks.select(bit.alias("bit")), COPY_BITS)
    rows = with_copy(docs.select(F.col("doc_id").cast("long"), "text"), only).withColumnRenamed("__copy", "copy")
    mine = rows.join(marks.select("copy", "id", "node"), (rows["copy"] == marks["copy"]) & rows["doc_id"].eqNullSafe(marks["id"]))
    return stored(mine.groupBy("node").agg(F.first("text").alias("text")))


def linked_classes(docs: DataFrame, sketch: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The classes of equal word sequences, and (node, component) of those that are not their component's least."""
    classes = stored(text_classes(sketch.drop("keys"), ("n_shingles", "bits")))
    buckets = class_keys(sketch, classes)
    hubs = buckets.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub < last").select("key", "hub")
    members = stored(buckets.join(hubs, "key"))
    nodes = members.select("node").distinct()
    marks = stored(classes.join(nodes, "node", "left_semi").select("node", "copy", "id", "n_shingles", "bits"))
    texts = node_texts(docs, marks)
    # each leaf's nearest hub first: most leaves need no other
    stars = hub_edges(members)
    checked = stored(near_enough(stars.groupBy("leaf").agg(F.max_by("hub", F.struct("shared", -F.col("hub"))).alias("hub")), marks, percent))
    found = components(stored(confirmed(checked, texts, shingle, percent)))
    unsure = mixed(members.select("key", "node"), found).select("node").distinct()
    left = stored(rare_prefixes(texts.join(unsure, "node", "left_semi"), shingle, percent))
    while True:
        now = stored(mixed(left, found).join(marks.select("node", "bits"), "node"))
        if now.isEmpty():
            return classes, found
        order = Window.partitionBy("key").orderBy("own", "component", "node")
        hubs = stored(now.withColumn("turn", F.row_number().over(order)).filter(F.col("turn") <= HUBS).select("key", F.col("node").alias("hub"), F.col("component").alias("of"), F.col("size").alias("hub_size"), F.col("place").alias("hub_place"), F.col("bits").alias("hub_bits")))
        pairs = now.join(hubs, "key").filter((F.col("component") != F.col("of")) & possible(percent)).select(F.greatest("node", "hub").alias("leaf"), F.least("node", "hub").alias("hub")).distinct()
        done = checked.select(F.greatest("leaf", "hub").alias("leaf"), F.least("leaf", "hub").alias("hub"))
        fresh = stored(pairs.join(done, ["leaf", "hub"], "left_anti"))
        more = stored(confirmed(fresh, texts, shingle, percent))
        if not more.isEmpty():
            # the stars found so far join what all links of before do
            found = components(found.select(F.col("node").alias("leaf"), F.col("component").alias("hub")).unionByName(more))
        checked = checked.unionByName(fresh)
        left = now.join(hubs.select("key", F.col("hub").alias("node")), ["key", "node"], "left_anti").select("node", "key", "size", "place")


def labelled(docs: DataFrame, shingle: int, percent: int, bands: int, rows: int) -> DataFrame:
    """Per row of docs: doc_id, copy, n_shingles, component (a node), node, id (its class's least doc_id), component_id."""
    sketch = stored(sketches(docs, shingle, bands, rows))
    return with_components(sketch, *linked_classes(docs, sketch, shingle, percent))


def with_components(sketch: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``sketch`` with the component of their class."""
    known = classes.select("copy", "id", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # only nodes that are no doc_id can hide a smaller one
    hidden = known.filter(F.col("node") >= HASHED).groupBy("component").agg(F.min("id").alias("hidden_id"))
    known = known.join(hidden, "component", "left").withColumn("component_id", F.least(F.when(F.col("component") < HASHED, F.col("component")), F.col("hidden_id")))
    out = sketch.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("copy")).alias("copy")).join(known, "copy", "left")
    return out.withColumn("component_id", F.when(F.col("copy").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))


def near_duplicates(docs: DataFrame, shingle: int = 2, percent: int = 80, bands: int = 56, rows: int = 7) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id, kept.

    With 56 bands of 7 bins two sets of similarity 0.8 share no bucket once in 500,000 pairs.
    """
    return labelled(docs, shingle, percent, bands, rows).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = 56, rows: int = 7) -> DataFrame:
    """``docs`` with one document of each group: that of the least doc_id, or any if none has one.

    Rows are told apart by doc_id and word sequence: of rows alike in both one stays, and rows
    that share a doc_id with other words are judged apart.  Texts without words all stay.
    """
    rows_of = labelled(docs, shingle, percent, bands, rows).filter(F.col("copy").isNotNull()).select("component", "copy", "doc_id")
    chosen = rows_of.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "copy")).alias("c")).select(F.col("c.doc_id").alias("__id"), F.col("c.copy").alias("__class"))
    keyed = with_copy(docs).withColumn("__id_of", F.col("doc_id").cast("long"))
    wordless = F.coalesce("text", F.lit("")).rlike("\\A[ \\t-\\r]*\\z")
    one = keyed.filter(~wordless).groupBy("__copy", "__id_of").agg(*[F.first(c).alias(c) for c in docs.columns])
    kept = one.join(chosen, one["__copy"].eqNullSafe(chosen["__class"]) & one["__id_of"].eqNullSafe(chosen["__id"]), "left_semi")
    return kept.select(*docs.columns).unionByName(docs.filter(wordless))
