"""Operator 7, quality rules: exact base rules and a calibrated hashed n-gram classifier.

Base counts: words, code points in words, symbols, repeated lines, and words inside three-word
windows that stand twice or more in the text.  The classifier is a logistic regression over hashed
word 1- and 2-grams and byte 3-grams, fitted on a bounded sample of labelled quality rows and
calibrated (Platt) on rows of the sample that it was not fitted on; texts are scored in Arrow
batches against a fixed threshold.

Defined results: null and empty texts have zero counts and fail the base rules; without rows of
both labels the classifier scores 1 and only the base rules count; a score that ties with the
threshold is kept; texts of any length are judged whole; repeated rows and null doc_ids are judged
each on its own; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlake.llm.common import U64, first_words, gram_hashes, joined_words, pieces, utf8, word_bounds, word_keys
from wordlake.llm.training import fit_logistic, fit_platt, labelled_sample, sigmoid

CHUNK_BYTES = 2 << 20
WORD_SIZE = CHAR_SIZE = 4096
SYMBOLS = b"#*$%&|<>"
#: Labelled rows per label that the classifier is fitted on: the bound of the sample.
ROWS_PER_LABEL = 1500
THRESHOLD = 0.5


@dataclass
class Model:
    """Weights, bias, and the calibration's slope and offset; ``weights`` None: no classifier."""

    weights: np.ndarray | None
    bias: float = 0.0
    slope: float = 1.0
    offset: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.ones(len(x))
        return sigmoid(self.slope * (x @ self.weights + self.bias) + self.offset).astype(np.float64)


def describe(texts: list[bytes], with_features: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Base counts (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) and features per text."""
    data, counts = joined_words(texts)
    buf = np.frombuffer(data, np.uint8)
    starts, ends = word_bounds(buf)
    words = word_keys(buf, starts, ends)
    first = first_words(counts)
    base = np.zeros((len(texts), 5), np.int64)
    base[:, 0] = counts
    doc = np.repeat(np.arange(len(counts)), counts)
    if len(words):
        leads = np.append(0, np.cumsum((buf & 0xC0) != 0x80))
        base[:, 1] = np.bincount(doc, leads[ends] - leads[starts], len(counts)).astype(np.int64)
    for i, t in enumerate(texts):
        base[i, 2] = sum(t.count(bytes([c])) for c in SYMBOLS)
        lines = t.split(b"\n")
        if len(lines) > 1:
            full = [x for x in lines if x.split(None, 1)]
            base[i, 3] = len(full) - len(set(full))
    three = gram_hashes(words, 3)
    at = np.flatnonzero(doc[: len(three)] == doc[2:][: len(three)]) if len(three) else np.empty(0, np.int64)
    by = at[np.lexsort((three[at], doc[at]))]
    same = (three[by[1:]] == three[by[:-1]]) & (doc[by[1:]] == doc[by[:-1]])
    twice = np.zeros(len(by), bool)
    twice[1:] |= same
    twice[:-1] |= same
    if twice.any():  # of one hash; now of the same words?
        flagged = by[twice]
        spans = [(int(d), data[a:b]) for d, a, b in zip(doc[flagged], starts[flagged].tolist(), ends[flagged + 2].tolist(), strict=True)]
        often = Counter(spans)
        twice[np.flatnonzero(twice)] = [often[x] > 1 for x in spans]
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[by[twice] + k] = True
    base[:, 4] = np.bincount(doc[covered], minlength=len(counts))
    if not with_features:
        return base, np.empty((len(texts), 0), np.float32)
    two = gram_hashes(words, 2)
    out = np.zeros((len(texts), WORD_SIZE + CHAR_SIZE), np.float32)
    for i in range(len(texts)):
        a, b = int(first[i]), int(first[i + 1])
        if a == b:
            continue
        keys = np.concatenate([words[a:b], two[a : b - 1]]) % U64(WORD_SIZE)
        chars = buf[starts[a] : ends[b - 1]].astype(np.uint32)
        grams = (chars[:-2] * np.uint32(2654435761) + chars[1:-1] * np.uint32(40503) + chars[2:] * np.uint32(2246822519)) * np.uint32(2654435761) >> np.uint32(20)
        row = np.sqrt(np.append(np.bincount(keys.astype(np.int64), minlength=WORD_SIZE), np.bincount(grams.astype(np.int64) % CHAR_SIZE, minlength=CHAR_SIZE)))
        out[i] = row / np.sqrt((row * row).sum())
    return base, out


def train(docs: DataFrame, labels: DataFrame, per_label: int = ROWS_PER_LABEL) -> Model:
    """Fit on a bounded sample of documents that ``labels`` (doc_id, quality 0 or 1) marks."""
    sample = labelled_sample(docs, labels, "quality", per_label)
    y = np.array([float(label) > 0 for label, _ in sample])
    if not len(y) or y.all() or not y.any():
        return Model(None)
    x = np.concatenate([describe([t.encode() for _, t in sample[i : i + 200]])[1] for i in range(0, len(sample), 200)])
    held = np.arange(len(y)) % 4 == 3
    if not 0 < y[held].sum() < held.sum() or not 0 < y[~held].sum() < (~held).sum():
        held[:] = False
    w, b = fit_logistic(x[~held], y[~held, None].astype(np.float32))
    check = held if held.any() else ~held
    slope, offset = fit_platt((x[check] @ w + b)[:, 0].astype(np.float64), y[check])
    return Model(w[:, 0], float(b[0]), slope, offset)


def judge(docs: DataFrame, model: Model, threshold: float = THRESHOLD, min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """Per row of docs: doc_id, the base counts, base_failed, score and kept."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", CHUNK_BYTES):
            for a in range(0, piece.num_rows, 500):
                some = piece.slice(a, 500)
                base, x = describe(utf8(some.column("text")), sent.value.weights is not None)
                yield pa.record_batch([some.column("doc_id").cast(pa.int64()), *(pa.array(np.ascontiguousarray(c)) for c in base.T), pa.array(sent.value.score(x))], names=["doc_id", *names, "score"])

    schema = ", ".join(["doc_id long", *(f"{n} long" for n in names), "score double"])
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
    return found.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= threshold)).select("doc_id", *names, "base_failed", "kept", "score")
