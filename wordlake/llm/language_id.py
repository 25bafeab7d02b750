"""Operator 1, language ID: error-correcting output codes over hashed byte n-grams.

Each language has a codeword of +1 and -1.  One binary n-gram classifier per bit predicts that
bit; loss-weighted decoding adds up each bit's logistic loss against a codeword, weighted by the
bit's accuracy on rows that its classifier was not fitted on, and takes the nearest codeword.  The
score is the codewords' softmax at the chosen one; a text is flagged ambiguous where the two
nearest codewords are close, or no codeword is near.

Defined results: null texts and texts without a letter are ``und`` with score 0; with no labelled
rows every text is ``und``; with one language only, every other text is that language with score 1; of
languages that tie the first in order of name is taken (and flagged); texts of any length are read
whole; repeated rows and null doc_ids are predicted each on its own; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlake.llm.common import pieces
from wordlake.llm.training import bounded_sample, fit_logistic, hashed_counts, sigmoid

UNKNOWN = "und"
SIZE = 4096
CHUNK_BYTES = 2 << 20
#: Labelled rows per language that the classifiers are fitted on: the bound of the sample.
ROWS_PER_LANGUAGE = 700


@dataclass
class Model:
    """Languages, their codewords (languages x bits), the bit classifiers and the bits' weights."""

    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """n rows of +1/-1: all useful splits for few classes, else random columns, far apart."""
    if n <= 1:
        return np.ones((n, 0), np.float32)
    if n <= 5:
        splits = [[1] + [1 if s >> i & 1 else -1 for i in range(n - 1)] for s in range((1 << n - 1) - 1)]
        return np.array(splits, np.float32).T
    rng, bits, best, kept = np.random.RandomState(seed), int(np.ceil(10 * np.log2(n))), -1.0, None
    for _ in range(200):
        code = rng.choice([-1, 1], (n, bits)).astype(np.float32)
        same = code @ code.T
        far = float((bits - same[~np.eye(n, dtype=bool)]).min())
        if far > best and (np.abs(code.sum(0)) < n).all():
            best, kept = far, code
    return kept


def ngram_keys(text: str) -> np.ndarray:
    """Hashed 2- and 3-grams of the lower-cased text's bytes."""
    b = np.frombuffer(b" " + text.lower().encode() + b" ", np.uint8).astype(np.uint32)
    two = b[:-1] * np.uint32(2654435761) + b[1:] * np.uint32(40503)
    three = two[:-1] * np.uint32(31) + b[2:] * np.uint32(2246822519) + np.uint32(77)
    return (np.concatenate([two, three]) * np.uint32(2654435761) >> np.uint32(20)).astype(np.int64) % SIZE


def train(rows: DataFrame, per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """Fit on a bounded sample of rows with ``text`` and ``lang``."""
    sample = [(lang, t) for lang, t in bounded_sample(rows, "lang", per_language) if any(c.isalpha() for c in t)]
    languages = sorted({lang for lang, _ in sample})
    codes = codewords(len(languages))
    if not codes.shape[1]:
        return Model(languages, codes, np.zeros((SIZE, 0), np.float32), np.zeros(0, np.float32), np.zeros(0, np.float32))
    x = hashed_counts((ngram_keys(t) for _, t in sample), SIZE)
    at = np.array([languages.index(lang) for lang, _ in sample])
    y = (codes[at] > 0).astype(np.float32)
    balance = 1 / np.bincount(at, minlength=len(languages))[at]
    held = np.arange(len(x)) % 5 == 4
    if held.any() and not held.all():
        w, b = fit_logistic(x[~held], y[~held], weight=balance[~held])
        right = ((x[held] @ w + b > 0) == (y[held] > 0)).mean(0)
    else:
        right = np.ones(codes.shape[1])
    w, b = fit_logistic(x, y, weight=balance)
    return Model(languages, codes, w, b, np.maximum(2 * right - 1, 0.05).astype(np.float32))


def decode(margin: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language index, score, and distance between the two nearest codewords' scores."""
    loss = np.zeros((len(margin), len(model.languages)))
    for bit in range(margin.shape[1]):
        loss += model.trust[bit] * -np.log(sigmoid(np.outer(margin[:, bit], model.codes[:, bit])))
    odds = np.exp(loss.min(1, keepdims=True) - loss)
    share = odds / odds.sum(1, keepdims=True)
    order = np.sort(share, 1)
    return loss.argmin(1), order[:, -1], order[:, -1] - (order[:, -2] if share.shape[1] > 1 else 0)


def predict(docs: DataFrame, model: Model, ambiguous_below: float = 0.2, names: tuple[str, str, str] = ("lang_pred", "score", "ambiguous")) -> DataFrame:
    """Per row of docs: its columns, and the predicted language, its score and the ambiguity flag.

    The three take the names given; columns of docs that have these names are replaced.
    """
    docs = docs.drop(*names)
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    own = docs.columns
    taken = docs.select("*", F.col("text").rlike("\\p{L}").alias("__letter"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), *(f"`{n}` {t}" for n, t in zip(names, ("string", "double", "boolean"), strict=True))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for piece in pieces(batches, "text", CHUNK_BYTES):
            n = piece.num_rows
            pred, score, unsure = [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
            which = [i for i, x in enumerate(piece.column("__letter").to_pylist()) if x] if m.languages else []
            texts = piece.column("text")
            for a in range(0, len(which), 256):
                some = which[a : a + 256]
                if m.codes.shape[1]:
                    x = hashed_counts((ngram_keys(texts[i].as_py()) for i in some), SIZE)
                    best, share, gap = decode(x @ m.weights + m.bias, m)
                else:
                    best, share, gap = np.zeros(len(some), int), np.ones(len(some)), np.ones(len(some))
                score[some], unsure[some] = share, gap < ambiguous_below
                for i, j in zip(some, best.tolist(), strict=True):
                    pred[i] = m.languages[j]
            values = [pa.array(pred), pa.array(score), pa.array(unsure)]
            yield pa.record_batch([*(piece.column(c) for c in own), *values], names=[*own, *names])

    return taken.mapInArrow(run, schema)
