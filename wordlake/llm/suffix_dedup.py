"""Operator 6, suffix-array dedup: a sparse suffix array over minimiser positions.

Of all suffixes of the corpus only those are retained that start at a minimiser: the k-gram of
least hash in a window of ``min_words`` words.  Copies of a passage of ``min_words`` or more words
choose the same places, so every repeated passage holds a retained suffix in each copy.  Retained
suffixes travel with their context to the minimiser's place, are sorted there, and each is
compared with its neighbours; the texts before them are sorted and compared from their ends.  The
two common lengths extend a match to the right and to the left, word by word (by 64-bit hashes of
the words).

Every word that lies in a run of ``min_words`` words which also starts earlier (smaller doc_id, or
same document, earlier) is a repeat; the first copy stays.

Defined results: null and empty texts have no passages; texts of any length are read whole; rows
with equal doc_id and text are one document, and so are equal texts without a doc_id; rows with
equal doc_id and other text are ordered by the hash of their text; a null doc_id sorts last and is
given back as null; of tied copies the first in that order is named; an empty table gives no rows.
Other columns are ignored, or carried as they are by ``cut_passages``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordlake.llm import windows
from wordlake.llm.common import pieces

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def common(s: windows.Strings, left: np.ndarray, right: np.ndarray, step: int, limit: int) -> np.ndarray:
    """Words (at most ``limit``) that two lists of places have in common, going on by ``step`` (1 or -1)."""
    low, high = s.first[:-1][s.of], s.first[1:][s.of]
    out = np.zeros(len(left), np.int64)
    alive = np.arange(len(left))
    for i in range(limit):
        a, b = left[alive] + step * i, right[alive] + step * i
        fine = (a >= low[left[alive]]) & (a < high[left[alive]]) & (b >= low[right[alive]]) & (b < high[right[alive]])
        alive, a, b = alive[fine], a[fine], b[fine]
        alive = alive[s.words[a] == s.words[b]]
        if not len(alive):
            break
        out[alive] += 1
    return out


def sorted_neighbours(keys: list[bytes], s: windows.Strings, at: np.ndarray, step: int, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the keys, the words each shares with the one before it there, and per key the most it shares with a neighbour."""
    order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
    shared = np.append(0, common(s, at[order[:-1]], at[order[1:]], step, limit))
    most = np.zeros(len(keys), np.int64)
    most[order] = np.maximum(shared, np.append(shared[1:], 0))
    return order, shared, most


def suffix_matches(s: windows.Strings, min_words: int) -> np.ndarray:
    """SPANs of the passages that stand earlier as well, from the sorted retained suffixes.

    The suffixes (from the minimiser on) are sorted and compared with their neighbours, which
    gives the words a match extends to the right; the texts before the minimiser are sorted from
    their ends likewise, which gives its extension to the left.  Suffixes that share r words with
    their neighbours on the right and l on the left of the minimiser, r + l >= ``min_words``, hold
    the same passage; the first of them in the corpus is the one the others repeat.
    """
    n = len(s.meta)
    if n < 2:
        return np.empty(0, windows.SPAN)
    anchor = s.first[:-1] + s.meta["anchor"]
    begin, stop = s.starts[s.first[:-1]].tolist(), s.ends[s.first[1:] - 1].tolist()
    middle = s.starts[anchor].tolist()
    right = sorted_neighbours([s.data[a:b] + b" " for a, b in zip(middle, stop, strict=True)], s, anchor, 1, min_words)
    left = sorted_neighbours([(b" " + s.data[a:b])[::-1] for a, b in zip(begin, middle, strict=True)], s, anchor - 1, -1, min_words)
    left[2][s.meta["anchor"] == 0] = 0
    # words left of the minimiser in the passages of min_words words that a suffix may share
    most = np.minimum(left[2], s.meta["anchor"])
    least = np.maximum(min_words - right[2], s.meta["anchor"] - (np.diff(s.first) - min_words))
    where, before, lead = [], [], []
    for words in range(int(least.min()), int(most.max()) + 1):
        some = np.flatnonzero((least <= words) & (words <= most))
        if len(some) < 2:
            continue
        same = []
        for (order, shared, _), need in ((right, min_words - words), (left, words)):
            group = np.empty(n, np.int64)
            group[order] = np.cumsum(shared < need)
            same.append(group[some])
        by = np.lexsort((some, same[1], same[0]))  # strings are in order of the corpus
        a, b, i = same[0][by], same[1][by], some[by]
        head = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        first = i[np.flatnonzero(head)[np.cumsum(head) - 1]]
        again = ~head & windows.differ(s.meta, i, first)
        where.append(i[again])
        lead.append(first[again])
        before.append(np.full(int(again.sum()), words))
    if not where:
        return np.empty(0, windows.SPAN)
    i, first, l = (np.concatenate(x) for x in (where, lead, before))
    by = np.lexsort((-l, i))
    i, first, l = i[by], first[by], l[by]
    head = np.flatnonzero(np.append(True, (i[1:] != i[:-1]) | (first[1:] != first[:-1]) | (l[1:] != l[:-1] - 1))[: len(i)])
    out = np.empty(len(head), windows.SPAN)
    out["count"] = np.diff(np.append(head, len(i)))
    i, first, l = i[head], first[head], l[head]
    for name, of in (("", i), ("first_", first)):
        out[f"{name}doc"], out[f"{name}text"] = s.meta["doc"][of], s.meta["text"][of]
        out[f"{name}start"] = s.meta["start"][of] + s.meta["anchor"][of] - l
    out["home"] = s.meta["start"][i]
    return out


def passage_spans(docs: DataFrame, min_words: int = 50, k: int = 5) -> DataFrame:
    """Runs of repeated windows, as ``windows.SPANS``."""
    return windows.found_spans(docs, min_words, k, lambda s: suffix_matches(s, min_words))


def first_places(spans: DataFrame) -> DataFrame:
    """The spans with the first place in the corpus, also those that only name the first copy of their chunk.

    Such a copy is a whole packed string, so it is dealt to the string it names and takes on that
    string's own spans; windows between and around these stand first in the named string.
    """
    sent = F.col("home") >= 0
    key = [F.when(sent, F.col("doc")).otherwise(F.col("first_doc")).alias("d"), F.when(sent, F.col("text_hash")).otherwise(F.col("first_text")).alias("t"), F.when(sent, F.col("home")).otherwise(F.col("first_start")).alias("w")]
    own = F.when(sent, F.struct((F.col("start") - F.col("home")).alias("at"), "count", "first_doc", "first_text", "first_start"))
    copy = F.when(~sent, F.struct("doc", "text_hash", "start", "count"))
    strings = spans.select(*key, own.alias("own"), copy.alias("copy")).groupBy("d", "t", "w").agg(F.array_sort(F.collect_set("own")).alias("own"), F.collect_set("copy").alias("copies"))
    stop = F.coalesce(F.array_max(F.transform("copies", lambda c: c["count"])), F.lit(0).cast("long"))
    at = lambda i: F.coalesce(F.get("own", i)["at"], stop)
    named = lambda a, b: F.struct(a.alias("at"), (b - a).alias("count"), F.col("d").alias("first_doc"), F.col("t").alias("first_text"), (F.col("w") + a).alias("first_start"))
    gaps = F.transform("own", lambda x, i: named(x["at"] + x["count"], at(i + 1)))
    whole = F.concat("own", F.array(named(F.lit(0).cast("long"), at(F.lit(0)))), gaps)
    place = lambda doc, text, start, x, count: F.struct(doc.alias("doc"), text.alias("text_hash"), (start + x["at"]).alias("start"), count.alias("count"), x["first_doc"].alias("first_doc"), x["first_text"].alias("first_text"), x["first_start"].alias("first_start"))
    mine = F.transform("own", lambda x: place(F.col("d"), F.col("t"), F.col("w"), x, x["count"]))
    copied = F.flatten(F.transform("copies", lambda c: F.transform("whole", lambda x: place(c["doc"], c["text_hash"], c["start"], x, F.least(x["count"], c["count"] - x["at"])))))
    return strings.withColumn("whole", whole).select(F.explode(F.concat(mine, copied)).alias("x")).select("x.*").filter(F.col("count") > 0)


def repeated_passages(docs: DataFrame, min_words: int = 50, k: int = 5) -> DataFrame:
    """One row per repeated passage: doc_id, start_word, n_words, first_doc_id, first_start_word.

    The first copy of a passage is named by first_doc_id and first_start_word; a passage ends where
    the first copies of its windows no longer follow one another.
    """
    spans = first_places(passage_spans(docs, min_words, k)).withColumn("shift", F.col("first_start") - F.col("start"))
    along = Window.partitionBy("doc", "text_hash", "first_doc", "first_text", "shift").orderBy("start", "count")
    reached = F.max(F.col("start") + F.col("count")).over(along.rowsBetween(Window.unboundedPreceding, -1))
    runs = spans.withColumn("new", F.when(F.col("start") <= reached, 0).otherwise(1)).withColumn("run", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        runs.groupBy("doc", "text_hash", "first_doc", "first_text", "shift", "run")
        .agg(F.min("start").alias("start_word"), (F.max(F.col("start") + F.col("count")) - F.min("start") + F.lit(min_words - 1)).alias("n_words"), F.min("first_start").alias("first_start_word"))
        .select(windows.doc_id_of("doc").alias("doc_id"), "start_word", "n_words", windows.doc_id_of("first_doc").alias("first_doc_id"), "first_start_word")
    )


def without_words(text: bytes, runs: list[dict], width: int) -> bytes:
    """The text without the words that repeated windows cover; what stays is parted by newlines."""
    places = [m.span() for m in WORD.finditer(text)]
    step = np.zeros(len(places) + 1, np.int64)
    np.add.at(step, [r["start"] for r in runs], 1)
    np.add.at(step, [r["start"] + r["count"] + width - 1 for r in runs], -1)
    kept = np.cumsum(step[:-1]) <= 0
    edge = np.flatnonzero(np.diff(np.concatenate([[0], kept.astype(np.int8), [0]])))
    return b"\n".join(text[places[a][0] : places[b - 1][1]] for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def cut_passages(docs: DataFrame, min_words: int = 50, k: int = 5) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; a text of which nothing stays goes.

    Texts without repeats are returned unchanged, other columns as they are (``n_chars``, where
    present as a number, follows the new text).
    """
    spans = windows.spans_per_document(passage_spans(docs, min_words, k)).withColumnsRenamed({"doc": "__span_doc", "text_hash": "__span_text"})
    joined = windows.with_keys(docs).join(spans, (F.col("__doc") == F.col("__span_doc")) & (F.col("__text") == F.col("__span_text")), "left")
    schema = T.StructType([*docs.schema.fields, T.StructField("__gone", T.BooleanType())])
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", windows.CHUNK_BYTES):
            texts, runs = piece.column("text").to_pylist(), piece.column("__runs").to_pylist()
            cut = [without_words(t.encode(), r, min_words).decode() if r else t for t, r in zip(texts, runs, strict=True)]
            cols = [pa.array(cut, pa.string()) if c == "text" else piece.column(c) for c in names]
            yield pa.record_batch([*cols, pa.array([bool(r) and not t for t, r in zip(cut, runs, strict=True)])], names=[*names, "__gone"])

    out = joined.select(*names, "__runs").mapInArrow(run, schema).filter(~F.col("__gone")).drop("__gone")
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))
    return out
