"""Operator 4, license scan: exact base phrases and fuzzy short notices.

ASCII letters are lower-cased; words are runs of ASCII letters and digits and of anything beyond
ASCII.  Base phrases are counted wherever their words stand consecutively.  Each longer notice may
differ by up to ``edits`` characters: cut into edits + 1 seeds, one of them must occur unchanged
(pigeonhole), so exact seeds locate candidate windows and the regex library's bounded-error match
verifies the edits there and reports the span.

Defined results: null and empty texts have no words, no labels and score 0; texts of any length are
scanned whole, in time that grows with their length; places that tie are all reported; repeated
rows and null doc_ids are scanned each on its own; other columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlake.llm.common import pieces, utf8

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: (label, notice, edits allowed)
NOTICES = [
    ("mit", "released under the mit license", 2),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    ("apache", "licensed under the apache license version", 3),
    ("gpl", "licensed under the gnu general public license", 4),
    ("bsd", "redistribution and use in source and binary forms with or without modification", 6),
    ("mpl", "subject to the terms of the mozilla public license", 4),
    ("cc-by", "licensed under a creative commons attribution", 4),
    ("cc-by", "licensed under cc by", 1),
    ("reserved", "all rights reserved", 2),
]
CHUNK_BYTES = 4 << 20
#: Everything that is no word byte becomes a space.
SPACED = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
PLACES = "array<struct<label:string,kind:string,start_word:long,n_words:long,edits:long,score:double>>"


def seeds(notice: str, edits: int) -> list[tuple[int, bytes]]:
    """edits + 1 pieces of the notice, each with its place."""
    n, k = len(notice), edits + 1
    return [(i * n // k, notice[i * n // k : (i + 1) * n // k].encode()) for i in range(k)]


@functools.cache
def matcher(notice: str, edits: int):  # noqa: ANN201
    """The bounded-error pattern for a notice between word bounds."""
    import regex

    return regex.compile(rb"(?e)(?<![^ ])(?:" + regex.escape(notice).replace("\\ ", " ").encode() + b"){e<=" + str(edits).encode() + rb"}(?![^ ])")


def windows(text: bytes, spaces: np.ndarray, notice: str, edits: int) -> list[tuple[int, int]]:
    """Merged candidate windows, widened to word bounds; ``spaces`` are the places of the text's spaces."""
    found = []
    for at, seed in seeds(notice, edits):
        i = text.find(seed)
        while i >= 0:
            found.append((max(0, i - at - edits - 1), min(len(text), i - at + len(notice) + edits + 1)))
            i = text.find(seed, i + 1)
    if not found:
        return []
    bounds = np.concatenate([[-1], spaces, [len(text)]])
    a, b = np.array(sorted(found)).T
    a = bounds[np.searchsorted(bounds, a, "right") - 1] + 1
    b = np.maximum.accumulate(bounds[np.searchsorted(bounds, b, "left")])
    head = np.flatnonzero(np.append(True, a[1:] > b[:-1]))
    return list(zip(a[head].tolist(), b[np.append(head[1:], len(b)) - 1].tolist(), strict=True))


def scan(text: bytes) -> tuple[int, list[tuple]]:
    """Words of the text and its places: (label, kind, start_word, n_words, edits, score)."""
    words = text.lower().translate(SPACED).split()
    flat = b" " + b" ".join(words) + b" "
    body = flat[1:-1]
    spaces = np.flatnonzero(np.frombuffer(body, np.uint8) == 32)
    word_at = lambda i: int(np.searchsorted(spaces, i))
    out: list[tuple] = []
    for phrase, label in BASE.items():
        look = b" " + phrase.encode() + b" "
        i = flat.find(look)
        while i >= 0:
            out.append((label, "base", word_at(i), phrase.count(" ") + 1, 0, 1.0))
            i = flat.find(look, i + len(look) - 1)
    for label, notice, edits in NOTICES:
        for a, b in windows(body, spaces, notice, edits):
            for m in matcher(notice, edits).finditer(body[a:b]):
                cost = sum(m.fuzzy_counts)
                out.append((label, "notice", word_at(a + m.start()), m[0].strip().count(b" ") + 1, cost, 1.0 - cost / len(notice)))
    return len(words), out


def license_places(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_words and ``places``, the base phrases and notices found with their spans."""
    one = pa.struct([("label", pa.string()), ("kind", pa.string()), ("start_word", pa.int64()), ("n_words", pa.int64()), ("edits", pa.int64()), ("score", pa.float64())])
    arrow = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("places", pa.list_(one))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", CHUNK_BYTES):
            counts, places = zip(*map(scan, utf8(piece.column("text"))), strict=True)
            rows = [[dict(zip(("label", "kind", "start_word", "n_words", "edits", "score"), p, strict=True)) for p in x] for x in places]
            yield pa.record_batch([piece.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(rows, pa.list_(one))], schema=arrow)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, n_words long, places {PLACES}")


def license_summary(docs: DataFrame) -> DataFrame:
    """Per row of docs: counts, places and labels of the base phrases, all labels, best score."""
    base = F.filter("places", lambda p: p.kind == "base")
    named = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p.label))), ",")
    return license_places(docs).select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda p: p.start_word)).alias("first_word"),
        F.array_max(F.transform(base, lambda p: p.start_word)).alias("last_word"),
        named(base).alias("base_labels"),
        named(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p.score)), F.lit(0.0)).alias("score"),
    )
