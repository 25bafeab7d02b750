"""Operator 5, benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Words are lower-cased runs of ASCII letters and digits and of anything beyond ASCII.  Every n-gram
of a test item is a seed, however frequent: two shared n-grams may both be common ones, so a choice
by rarity would lose copies that the rule below reports.  Where a document holds ``min_hits``
different seeds of an item within a stretch (the item's length, widened on both sides by as many
words as an alignment of the least score can insert), the stretch is aligned with the item word by
word, unless the words they share cannot reach the score; the alignment's score as a share of a
perfect one decides.

The items come to the tasks in blocks of ``BLOCK_BYTES`` (or one item, if that is longer); each
block is one pass over the documents, so neither side is ever shuffled or collected as a whole.  The
number of passes follows the benchmark's size alone; every block goes through the same plan.

Defined results: null and empty texts, and items of fewer than ``n`` words, match nothing (a word or
two stand in any text; such an item says nothing about a leak); rows that share an item_id are items
of their own, but rows that repeat an item whole are one; repeated documents are each reported; of
stretches that tie the first is reported; texts of any length are searched whole; null ids are
carried; other columns are ignored by ``leaks`` and carried by ``drop_leaks``; empty tables give no
leaks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlake.llm.common import U64, first_words, gram_hashes, pieces, utf8, word_bounds, word_keys

CHUNK_BYTES = 2 << 20
#: Bytes of item text in one block: what a pass broadcasts.
BLOCK_BYTES = 16 << 20
#: Hits of a chunk that are handled at once; a document's are never parted.
HITS = 1 << 19
SPACED = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
MATCH, MISMATCH, GAP = 2, -1, -1


@dataclass
class Items:
    """A block of test items: ids, word hashes, and each seed's hash, item and place in it."""

    ids: list
    words: list[np.ndarray]
    seeds: np.ndarray
    item: np.ndarray
    place: np.ndarray
    pair: np.ndarray  # number of each seed's (item, hash)
    need: np.ndarray


def hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and the words per text."""
    split = [t.decode().lower().encode().translate(SPACED).split() for t in texts]
    buf = np.frombuffer(b"\n".join([b" ".join(x) for x in split]), np.uint8)
    return word_keys(buf, *word_bounds(buf)), np.fromiter(map(len, split), np.int64, len(split))


def grams_of(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and place of every n-gram."""
    owner = np.repeat(np.arange(len(counts)), counts)
    grams = gram_hashes(words, n)
    at = np.flatnonzero(owner[: len(grams)] == owner[n - 1 :][: len(grams)])
    return grams[at], owner[at], at - first_words(counts)[owner[at]]


def item_block(rows: list, n: int, min_hits: int) -> Items:
    """All n-grams of a block of (item_id, text) rows; an item of few n-grams needs no more than it has."""
    words, counts = hashed([(r[1] or "").encode() for r in rows])
    seeds, item, place = grams_of(words, counts, n)
    known, pair = np.unique(np.stack([item.astype(U64), seeds], 1), axis=0, return_inverse=True) if len(seeds) else (np.empty((0, 2), U64), np.empty(0, np.int64))
    need = np.minimum(min_hits, np.bincount(known[:, 0].astype(np.int64), minlength=len(rows)))
    return Items([r[0] for r in rows], np.split(words, np.cumsum(counts)[:-1]) if rows else [], seeds, item, place, pair.ravel(), np.maximum(need, 1))


class Finder:
    """Looks up n-grams among sorted seeds; a bit table turns most of them away."""

    def __init__(self, seeds: np.ndarray) -> None:
        self.sorted = np.unique(seeds)
        self.mask = U64((1 << max(16, min(27, int(len(self.sorted)).bit_length() + 5))) - 1)
        self.table = np.zeros(int(self.mask) + 1, bool)
        self.table[self.sorted & self.mask] = True

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the n-grams that are seeds, and which seed each is."""
        at = np.flatnonzero(self.table[grams & self.mask])
        if not len(at) or not len(self.sorted):
            return at[:0], at[:0]
        which = np.minimum(np.searchsorted(self.sorted, grams[at]), len(self.sorted) - 1)
        fine = self.sorted[which] == grams[at]
        return at[fine], which[fine]


def hits_in_chunk(texts: list[bytes], items: Items, finder: Finder, n: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Word hashes, first words, and per hit: text, seed row of the items, place in the text; some texts at a time."""
    words, counts = hashed(texts)
    first = first_words(counts)
    grams, owner, place = grams_of(words, counts, n)
    at, which = finder.hits(grams)
    order = np.argsort(items.seeds, kind="stable")
    held = items.seeds[order]
    wanted = finder.sorted[which]
    low = np.searchsorted(held, wanted, "left")
    many = np.searchsorted(held, wanted, "right") - low
    total = np.cumsum(many)
    a = 0
    while a < len(at):
        b = max(a + 1, int(np.searchsorted(total, total[a] - many[a] + HITS, "right")))
        if b < len(at):  # whole documents, one at least
            edge = int(np.searchsorted(owner[at], owner[at[b]], "left"))
            b = edge if edge > a else int(np.searchsorted(owner[at], owner[at[b]], "right"))
        some = many[a:b]
        rep = np.repeat(np.arange(a, b), some)
        row = order[np.arange(len(rep)) - np.repeat(np.cumsum(some) - some, some) + low[rep]]
        yield words, first, owner[at[rep]], row, place[at[rep]]
        a = b


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Best Smith-Waterman score and where in the text it ends."""
    shift = -GAP * np.arange(len(text) + 1)
    row, best, end = np.zeros(len(text) + 1, np.int64), 0, 0
    for word in item:
        new = np.zeros_like(row)
        new[1:] = np.maximum(row[:-1] + np.where(text == word, MATCH, MISMATCH), row[1:] + GAP)
        row = np.maximum(np.maximum.accumulate(np.maximum(new, 0) + shift) - shift, 0)
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def stretches(doc_at: np.ndarray, place: np.ndarray, seed: np.ndarray, length: int, need: int, slack: int) -> list[tuple[int, int]]:
    """Merged stretches of a document around the hits of one item that hold enough seeds."""
    begin = doc_at - place - slack
    order = np.argsort(begin, kind="stable")
    begin, seed = begin[order], seed[order]
    stop = begin + length + 2 * slack
    edges = np.append(np.flatnonzero(np.append(True, begin[1:] > stop[:-1])), len(begin)).tolist()
    return [(max(0, int(begin[a])), int(stop[b - 1])) for a, b in zip(edges[:-1], edges[1:], strict=True) if b - a >= need and len(np.unique(seed[a:b])) >= need]


def leaks_in_chunk(texts: list[bytes], items: Items, finder: Finder, n: int, least: float) -> Iterator[tuple]:
    """(text number, item number, score, start word, end word) of each leak."""
    for words, first, doc, row, doc_at in hits_in_chunk(texts, items, finder, n):
        item, item_at, seed = items.item[row], items.place[row], items.pair[row]
        by = np.lexsort((seed, item, doc))
        doc, item, doc_at, item_at, seed = doc[by], item[by], doc_at[by], item_at[by], seed[by]
        head = np.append(True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]))
        edge = np.append(np.flatnonzero(head), len(doc))
        distinct = np.add.reduceat((head | np.append(True, seed[1:] != seed[:-1])).astype(np.int64), edge[:-1])
        fine = np.flatnonzero(distinct >= items.need[item[edge[:-1]]])
        for a, b in zip(edge[fine].tolist(), edge[fine + 1].tolist(), strict=True):
            d, i = int(doc[a]), int(item[a])
            own = items.words[i]
            text, enough = words[first[d] : first[d + 1]], least * MATCH * len(own)
            best = (0, 0, 0, 0)
            slack = int(max(0.0, MATCH * len(own) - enough) / -GAP) + 1
            for lo_, hi_ in stretches(doc_at[a:b], item_at[a:b], seed[a:b], len(own), int(items.need[i]), slack):
                part = text[lo_:hi_]
                if MATCH * min(np.isin(own, part).sum(), np.isin(part, own).sum()) < enough:
                    continue
                score, end = align(own, part)
                if score > best[0]:
                    best = (score, lo_, hi_, end)
            if best[0] and best[0] >= enough:
                _, lo_, hi_, end = best
                back = align(own[::-1], text[lo_ : lo_ + end][::-1])[1]
                yield d, i, best[0] / (MATCH * len(own)), lo_ + end - back, lo_ + end


def leaks(docs: DataFrame, benchmark: DataFrame, n: int = 3, min_hits: int = 2, least: float = 0.4, id_column: str = "doc_id") -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, score, start_word, end_word."""
    spark = docs.sparkSession
    benchmark = benchmark.select(F.col("item_id").cast("long"), "text").distinct()
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = 1 + int(size) // BLOCK_BYTES
    schema = "doc_id long, item_id long, score double, start_word long, end_word long"
    arrow = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("start_word", pa.int64()), ("end_word", pa.int64())])
    taken = docs.filter(F.col("text").isNotNull()).select(F.col(id_column).cast("long").alias("doc_id"), "text")
    out = spark.createDataFrame([], schema)
    for block in range(blocks):
        rows = benchmark.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        items = item_block(rows, n, min_hits)
        if not len(items.seeds):
            continue
        sent = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            items = sent.value
            finder = Finder(items.seeds)
            for piece in pieces(batches, "text", CHUNK_BYTES):
                ids = piece.column("doc_id").to_pylist()
                found = [(ids[d], items.ids[i], score, a, b) for d, i, score, a, b in leaks_in_chunk(utf8(piece.column("text")), items, finder, n, least)]
                if found:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*found, strict=True), arrow.types, strict=True)], schema=arrow)

        found = taken.mapInArrow(run, schema)
        out = found if block == 0 else out.unionByName(found)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, n: int = 3, min_hits: int = 2, least: float = 0.4) -> DataFrame:
    """``docs`` without the rows that hold a test item; a row is known by its doc_id and its text."""
    keyed = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    found = leaks(keyed, benchmark, n, min_hits, least, "__row").select(F.col("doc_id").alias("__leak")).distinct()
    return keyed.join(found, F.col("__row") == F.col("__leak"), "left_anti").select(*docs.columns)
