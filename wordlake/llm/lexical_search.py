"""Operator 13, ranked lexical search: hybrid term-at-a-time and document-at-a-time scoring.

Terms are runs of ASCII letters (lower-cased) and digits and of anything beyond ASCII.  One pass
over the texts keeps, per document, its number of terms and the counts of those that items ask for;
a bit table of fixed size turns most others away.  Documents are dealt to shards whose postings fit
a task, and every item visits every shard.  There an item's short lists are added up term at a
time; the sums then act as one more list, with a bound, beside the long lists, which are searched
document at a time: blocks of documents are visited by their bound (the summed maxima of the lists
in the block), and all blocks below the best scores so far are skipped.  The best of all shards are
ranked at the end.  Scores are whole numbers, so skipping changes nothing.

Defined results: documents without terms (null, empty and blank texts too) count nowhere and are
never found; rows that repeat a doc_id are documents of their own, and equal rows stand beside each
other; a null doc_id comes last among equal scores; items alike in item_id and text are one item,
items that share an item_id with other texts are ranked each on its own; an item without terms, or
whose terms no document holds, has no rows; texts of any length are read whole; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordlake.llm.common import U64, bit_table, is_set, pieces, utf8, word_bounds, word_hashes, word_keys
from wordlake.operators.lineage import cut_lineage

CHUNK_BYTES = 1 << 20
#: ASCII letters are lowered; what belongs to no term becomes a space.
LOWERED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
#: Bits of the table of asked terms: 1 MB, whatever their number.
FILTER_BITS = 1 << 23
#: Postings of a shard, about.
SHARD_POSTINGS = 1 << 21
MOST_TASKS = 20_000
#: Documents of a block, blocks that are scored at once, and the documents per posting of the short lists.
BLOCK, BLOCKS_AT_ONCE, SHORT_PART = 128, 16, 8
#: The formula's constants: b of the length norm is 50 %, k1 is 1.2 (in thousandths with m in percent).
SCALE, LENGTH_PERCENT = 1_000_000_000, 50


def term_counts(texts: list[bytes], asked: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """Terms per text; and for each (text, different term) the text's number, the term and its count.

    With ``asked`` (a bit table by word hash) only terms whose bit is set.
    """
    data = b"\n".join([t.translate(LOWERED) for t in texts])
    buf = np.frombuffer(data, np.uint8)
    starts, ends = word_bounds(buf)
    of = np.searchsorted(np.flatnonzero(buf == 10), starts)
    total = np.bincount(of, minlength=len(texts))
    if asked is not None:
        bit = (word_hashes(buf, starts, ends) % U64(FILTER_BITS)).astype(np.int64)
        mine = np.flatnonzero(is_set(asked, bit))
        starts, ends, of = starts[mine], ends[mine], of[mine]
    keys = word_keys(buf, starts, ends)
    by = np.lexsort((keys, of))
    keys, of = keys[by], of[by]
    lead = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (of[1:] != of[:-1]))[: len(keys)])
    terms = [data[a:b] for a, b in zip(starts[by[lead]].tolist(), ends[by[lead]].tolist(), strict=True)]
    return total, of[lead], terms, np.diff(np.append(lead, len(keys)))


def item_terms(items: DataFrame) -> DataFrame:
    """item, item_id, term, bit: the different terms of each different item."""
    arrow = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("term", pa.string()), ("bit", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", CHUNK_BYTES):
            _, of, terms, _ = term_counts(utf8(piece.column("text")), None)
            buf = np.frombuffer(b" ".join(terms), np.uint8)
            bit = (word_hashes(buf, *word_bounds(buf)) % U64(FILTER_BITS)).astype(np.int64) if terms else np.empty(0, np.int64)
            yield pa.record_batch([piece.column("item").take(pa.array(of)), piece.column("item_id").take(pa.array(of)), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(bit)], schema=arrow)

    different = items.select(F.col("item_id").cast("long"), "text").distinct().withColumn("item", F.xxhash64("item_id", "text"))
    return different.select("item", "item_id", "text").mapInArrow(run, "item long, item_id long, term string, bit long")


def postings(docs: DataFrame, asked: np.ndarray) -> DataFrame:
    """Per document with terms: doc_id, n (its terms), terms and tf (of those whose bit is set)."""
    sent = docs.sparkSession.sparkContext.broadcast(asked)
    arrow = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.string())), ("tf", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", CHUNK_BYTES):
            total, of, terms, tf = term_counts(utf8(piece.column("text")), sent.value)
            edges = pa.array(np.append(0, np.cumsum(np.bincount(of, minlength=len(total)))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(edges, x) for x in (pa.array(terms, pa.binary()).cast(pa.string()), pa.array(tf.astype(np.int32)))]
            yield pa.record_batch([piece.column("doc_id"), pa.array(total), *lists], schema=arrow).filter(pa.array(total > 0))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, terms array<string>, tf array<int>")


def weight(n_docs: Column, df: Column) -> Column:
    """floor(1000 ln((2 N + 2) / (2 df + 1)))."""
    return F.floor(F.lit(1000.0) * F.log((F.lit(2.0) * n_docs + 2.0) / (F.lit(2.0) * df + 1.0))).cast("long")


@dataclass
class Postings:
    """A term's documents (rising), their scores before the term's weight, and where its blocks begin."""

    docs: np.ndarray
    impact: np.ndarray
    blocks: np.ndarray  # numbers of the blocks that hold postings
    edges: np.ndarray  # where each of them begins, and the end
    most: np.ndarray  # the greatest impact in each


def in_blocks(docs: np.ndarray, impact: np.ndarray) -> Postings:
    block = docs // BLOCK
    head = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
    return Postings(docs, impact, block[head], np.append(head, len(docs)), np.maximum.reduceat(impact, head))


class Shard:
    """The postings of a shard's documents, in the order of their ids."""

    def __init__(self, ids: list[int | None], n: np.ndarray, terms: list[list[str]], tf: list[list[int]], n_docs: int, n_terms: int) -> None:
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        self.ids = [ids[i] for i in order]
        m = 100 - LENGTH_PERCENT + LENGTH_PERCENT * n[order] * n_docs // n_terms
        numbers: dict[str, int] = {}
        of = np.array([numbers.setdefault(t, len(numbers)) for i in order for t in terms[i]], np.int64)
        counts = np.array([x for i in order for x in tf[i]], np.int64)
        doc = np.repeat(np.arange(len(order)), [len(terms[i]) for i in order])
        impact = SCALE * counts // (1000 * counts + 20 * m[doc])
        by = np.argsort(of, kind="stable")
        edges = np.searchsorted(of[by], np.arange(len(numbers) + 1)).tolist()
        self.lists = {t: in_blocks(doc[by[edges[k] : edges[k + 1]]], impact[by[edges[k] : edges[k + 1]]]) for t, k in numbers.items()}

    def best(self, terms: list[str], weights: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best documents above 0 (numbers in the shard, best first) and their scores."""
        lists = sorted(((self.lists[t], w) for t, w in zip(terms, weights, strict=True) if w > 0 and t in self.lists), key=lambda x: len(x[0].docs))
        if not lists:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        size = np.cumsum([len(p.docs) for p, _ in lists])
        short = max(1, int(np.searchsorted(size, len(self.ids) // SHORT_PART, "right")))
        # term at a time: the short lists become one
        docs = np.concatenate([p.docs for p, _ in lists[:short]])
        scores = np.concatenate([p.impact * w for p, w in lists[:short]])
        by = np.argsort(docs, kind="stable")
        head = np.flatnonzero(np.append(True, docs[by[1:]] != docs[by[:-1]]))
        summed = in_blocks(docs[by[head]], np.add.reduceat(scores[by], head))
        streams = [(summed, 1), *lists[short:]]
        # document at a time: blocks by their bound, until the k best so far lie above
        bound = np.zeros(len(self.ids) // BLOCK + 1, np.int64)
        for p, w in streams:
            bound[p.blocks] += p.most * w
        visit = np.argsort(-bound, kind="stable")
        visit = visit[bound[visit] > 0]
        best_docs, best_scores = np.empty(0, np.int64), np.empty(0, np.int64)
        least = np.partition(summed.impact, -k)[-k] if len(summed.impact) >= k else 1
        for a in range(0, len(visit), BLOCKS_AT_ONCE):
            some = visit[a : a + BLOCKS_AT_ONCE]
            some = np.sort(some[bound[some] >= least])
            if not len(some):
                break
            total = np.zeros(len(some) * BLOCK, np.int64)
            for p, w in streams:
                at = np.minimum(np.searchsorted(p.blocks, some), len(p.blocks) - 1)
                for place, i in zip(np.flatnonzero(p.blocks[at] == some).tolist(), at[p.blocks[at] == some].tolist(), strict=True):
                    part = slice(p.edges[i], p.edges[i + 1])
                    total[p.docs[part] - (some[place] - place) * BLOCK] += p.impact[part] * w
            found = np.flatnonzero(total >= max(least, 1))
            best_docs = np.append(best_docs, found % BLOCK + some[found // BLOCK] * BLOCK)
            best_scores = np.append(best_scores, total[found])
            keep = np.lexsort((best_docs, -best_scores))[:k]
            best_docs, best_scores = best_docs[keep], best_scores[keep]
            if len(best_scores) == k:
                least = max(least, int(best_scores[-1]))
        return best_docs, best_scores


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """The k best documents of each item: item_id, rank, doc_id, score."""
    asked = cut_lineage(item_terms(items))
    held = cut_lineage(postings(docs, bit_table(asked, FILTER_BITS)))
    n_docs, n_terms, size = held.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    df = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weighed = asked.join(df, "term").withColumn("w", weight(F.lit(float(n_docs)), F.col("df")))
    queries = weighed.groupBy("item", "item_id").agg(F.sort_array(F.collect_list(F.struct("term", "w"))).alias("x"))
    shards = 1 + size // SHARD_POSTINGS
    tasks = min(shards, MOST_TASKS)
    shard = F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(shards))
    none = lambda t: F.lit(None).cast(t)
    rows = held.select(shard.alias("shard"), F.lit(0).alias("kind"), F.col("doc_id").alias("id"), "n", none("long").alias("item"), "terms", F.col("tf").cast("array<long>").alias("numbers"))
    each = queries.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), F.lit(1).alias("kind"), F.col("item_id").alias("id"), F.lit(0).cast("long").alias("n"), "item", F.col("x.term").alias("terms"), F.col("x.w").alias("numbers"))
    arrow = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, index = None, [], None
        for batch in batches:
            out: list[tuple] = []
            for shard, kind, i, n, item, terms, numbers in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                if shard != at:
                    at, held, index = shard, [], None
                if kind == 0:
                    held.append((i, n, terms, numbers))
                    continue
                if not held and index is None:
                    continue
                if index is None:
                    ids, sizes, words, tf = zip(*held, strict=True)
                    index, held = Shard(ids, np.array(sizes, np.int64), words, tf, n_docs, n_terms), []
                found, scores = index.best(terms, numbers, k)
                out += [(item, i, index.ids[d], s) for d, s in zip(found.tolist(), scores.tolist(), strict=True)]
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), arrow.types, strict=True)], schema=arrow)

    dealt = rows.unionByName(each).repartitionById(tasks, (F.col("shard") % tasks).cast("int")).sortWithinPartitions("shard", "kind")
    found = dealt.select("shard", "kind", "id", "n", "item", "terms", "numbers").mapInArrow(run, "item long, item_id long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
