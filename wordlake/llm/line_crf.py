"""Operator 10, quality classifier: a linear-chain conditional random field over lines.

Every line of a text is labelled good or bad.  Features are the line's length, its shares of
character classes, repeated words and lines, and the same of the lines before and after it;
transition weights tie neighbouring labels.  The labelled rows mark whole documents, so a
document's label stands for each of its lines in training.  A document's score is the mean of its
lines' forward-backward marginals for "good", weighted by line length and calibrated (Platt) on
documents of the sample that the model was not fitted on.

Defined results: null, empty and blank texts get the labelled rows' share of good documents (0.5
without any); so does every text if the labels are all alike or missing; texts of any length are
scored whole, their lines' features made in parts; equal lines of a text count each; repeated rows
and null doc_ids are scored each on its own; other columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlake.llm.common import pieces, utf8, word_bounds, word_hashes
from wordlake.llm.training import fit_platt, labelled_sample, sigmoid

CHUNK_BYTES = 2 << 20
#: Labelled rows per label that the model is fitted on: the bound of the sample.
ROWS_PER_LABEL = 800
#: Character classes by byte: 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 full stop or comma, 6 other punctuation, 7 beyond ASCII.
CLASS = np.array([7 if c >= 128 else 1 if 97 <= c <= 122 else 2 if 65 <= c <= 90 else 3 if 48 <= c <= 57 else 4 if chr(c).isspace() else 5 if chr(c) in ".,;:'" else 6 if 33 <= c <= 126 else 0 for c in range(256)], np.int64)
OWN = 14
#: Lines whose features are held at once; texts of more lines are taken in parts.
LINES = 1 << 13


@dataclass
class Model:
    """Line weights (features x 2), transitions, start weights, and the share of good documents."""

    emit: np.ndarray | None
    move: np.ndarray | None
    start: np.ndarray | None
    prior: float
    slope: float = 1.0
    offset: float = 0.0


def repeated_lines(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which lines stand earlier in their text as well."""
    whole = word_hashes(buf, starts, ends)
    by = np.lexsort((np.arange(len(whole)), whole, doc))
    again = np.zeros(len(whole), bool)
    again[by[1:]] = (whole[by[1:]] == whole[by[:-1]]) & (doc[by[1:]] == doc[by[:-1]])
    return again


def line_features(texts: list[bytes], again: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features per line, lines per text, and the lines' lengths (0 for blank lines).

    ``again`` says which lines are repeats where the texts are only parts.
    """
    counts = np.fromiter((t.count(b"\n") + 1 for t in texts), np.int64, len(texts))
    data = b"\n".join(texts)
    buf = np.frombuffer(data, np.uint8)
    ends = np.append(np.flatnonzero(buf == 10), len(buf))
    starts = np.append(0, ends[:-1] + 1)
    n = len(ends)
    doc = np.repeat(np.arange(len(texts)), counts)
    line_of = np.repeat(np.arange(n), ends - starts + np.append(np.ones(n - 1, np.int64), 0))
    kinds = np.bincount(line_of * 8 + CLASS[buf], minlength=n * 8).reshape(n, 8).astype(np.float64)
    kinds[:-1, 4] -= 1  # the newline itself
    length = (ends - starts).astype(np.float64)
    wb, we = word_bounds(buf, (32, 10, 9, 13, 11, 12))
    words = word_hashes(buf, wb, we)
    of = np.searchsorted(ends, wb, "right")
    n_words = np.bincount(of, minlength=n).astype(np.float64)
    by = np.lexsort((words, of))
    first = np.ones(len(by), bool)
    first[1:] = (words[by[1:]] != words[by[:-1]]) | (of[by[1:]] != of[by[:-1]])
    distinct = np.bincount(of[by[first]], minlength=n).astype(np.float64)
    again = (repeated_lines(buf, starts, ends, doc) if again is None else again) & (n_words > 0)
    size, count = np.maximum(length, 1), np.maximum(n_words, 1)
    letters = np.maximum(kinds[:, 1] + kinds[:, 2] + kinds[:, 7], 1)
    last = np.where(length > 0, buf[np.maximum(ends - 1, 0)] if len(buf) else 0, 0)
    own = np.stack(
        [
            np.log1p(length) / 5, length == 0, n_words <= 3, kinds[:, 2] / letters, kinds[:, 3] / size, kinds[:, 6] / size, np.minimum(kinds[:, 6] / count, 3) / 3, kinds[:, 7] / size,
            kinds[:, 0] / size, 1 - distinct / count, again, np.minimum(length / count, 20) / 10, np.isin(last, (33, 46, 63)), np.minimum(kinds[:, 5] / count, 1),
        ],
        1,
    ).astype(np.float64)
    out = np.zeros((n, 1 + 3 * OWN))
    out[:, 0] = 1
    out[:, 1 : 1 + OWN] = own
    inside = doc[1:] == doc[:-1]
    out[1:, 1 + OWN : 1 + 2 * OWN] = own[:-1] * inside[:, None]
    out[:-1, 1 + 2 * OWN :] = own[1:] * inside[:, None]
    return out, counts, np.where(n_words > 0, length, 0)


def log_add(x: np.ndarray) -> np.ndarray:
    """log of the sum of exponentials over the last axis of length 2."""
    top = x.max(-1)
    return top + np.log(np.exp(x - top[..., None]).sum(-1))


def forward_backward(score: np.ndarray, counts: np.ndarray, move: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals per line (lines x 2) and expected transitions summed per chain (2 x 2 in all)."""
    order = np.argsort(-counts, kind="stable")
    sizes = counts[order]
    first = (np.cumsum(counts) - counts)[order]
    steps = int(sizes[0]) if len(sizes) else 0
    alive = [int(np.searchsorted(-sizes, -t, "left")) for t in range(steps)]
    ahead, back = np.zeros_like(score), np.zeros_like(score)
    for t in range(steps):
        at = first[: alive[t]] + t
        ahead[at] = score[at] + (start if t == 0 else log_add((ahead[at - 1][:, :, None] + move).transpose(0, 2, 1)))
    for t in range(steps - 2, -1, -1):
        at = first[: alive[t + 1]] + t
        back[at] = log_add(move + (score[at + 1] + back[at + 1])[:, None, :])
    joint = ahead + back
    marginals = np.exp(joint - log_add(joint)[:, None])
    pairs = np.zeros((2, 2))
    inner = np.setdiff1d(np.arange(len(score)), first + sizes - 1, assume_unique=True)
    if len(inner):
        both = ahead[inner][:, :, None] + move + (score[inner + 1] + back[inner + 1])[:, None, :]
        top = both.max((1, 2), keepdims=True)
        weight = np.exp(both - top)
        pairs = (weight / weight.sum((1, 2), keepdims=True)).sum(0)
    return marginals, pairs


def along(first: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Logarithms of the vectors that ``first`` becomes by one matrix of ``steps`` (n x 2 x 2) after another.

    The chain is cut into segments whose matrices are multiplied side by side, so n steps take
    about twice the square root of n operations on arrays.
    """
    n = len(steps)
    if not n:
        return np.empty((0, 2))
    size = int(np.sqrt(n))
    parts = -(-n // size)
    padded = np.full((parts * size, 2, 2), -np.inf)
    padded[:, [0, 1], [0, 1]] = 0.0  # the identity
    padded[:n] = steps
    grid = padded.reshape(parts, size, 2, 2)
    total = np.empty_like(grid)
    total[:, 0] = grid[:, 0]
    for t in range(1, size):
        total[:, t] = np.logaddexp(total[:, t - 1, :, :1] + grid[:, t, :1, :], total[:, t - 1, :, 1:] + grid[:, t, 1:, :])
    begin = np.empty((parts, 2))
    begin[0] = first
    for s in range(1, parts):
        begin[s] = np.logaddexp(begin[s - 1, 0] + total[s - 1, -1, 0], begin[s - 1, 1] + total[s - 1, -1, 1])
    out = np.logaddexp(begin[:, None, :1] + total[:, :, 0], begin[:, None, 1:] + total[:, :, 1])
    return out.reshape(-1, 2)[:n]


def long_marginals(score: np.ndarray, move: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The marginals of ``forward_backward`` for one chain of many lines."""
    first = score[0] + start
    ahead = np.concatenate([first[None], along(first, move[None] + score[1:, None, :])])
    onward = (move[None] + score[1:, None, :]).transpose(0, 2, 1)[::-1]
    back = np.concatenate([np.zeros((1, 2)), along(np.zeros(2), onward)])[::-1]
    joint = ahead + back
    return np.exp(joint - log_add(joint)[:, None])


def long_text(text: bytes, model: Model) -> tuple[float, float, np.ndarray]:
    """As ``raw_scores`` for one text of many lines: features are made for some lines at a time."""
    buf = np.frombuffer(text, np.uint8)
    ends = np.append(np.flatnonzero(buf == 10), len(buf))
    starts = np.append(0, ends[:-1] + 1)
    n = len(ends)
    again = repeated_lines(buf, starts, ends, np.zeros(n, np.int8))
    score, length = np.empty((n, 2)), np.empty(n)
    for a in range(0, n, LINES):
        b = min(n, a + LINES)
        lo, hi = max(0, a - 1), min(n, b + 1)  # a line sees its neighbours
        x, _, size = line_features([text[starts[lo] : ends[hi - 1]]], again[lo:hi])
        score[a:b], length[a:b] = x[a - lo : b - lo] @ model.emit, size[a - lo : b - lo]
    good = long_marginals(score, model.move, model.start)[:, 1]
    total = float(length.sum())
    return (float((length * good).sum() / total) if total else model.prior), total, good


def fit(x: np.ndarray, counts: np.ndarray, good: np.ndarray, steps: int = 150, rate: float = 0.1, l2: float = 1e-3) -> Model:
    """Maximum likelihood (Adam) with each document's label on all its lines."""
    label = np.repeat(good.astype(int), counts)
    truth = np.stack([1 - label, label], 1).astype(np.float64)
    first = np.cumsum(counts) - counts
    stays = np.zeros((2, 2))
    for g in (0, 1):
        stays[g, g] = (counts[good == bool(g)] - 1).sum()
    begins = truth[first].sum(0)
    params = [np.zeros((x.shape[1], 2)), np.zeros((2, 2)), np.zeros(2)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    n = float(len(x))
    for t in range(1, steps + 1):
        marginals, pairs = forward_backward(x @ params[0], counts, params[1], params[2])
        grads = [x.T @ (marginals - truth), pairs - stays, marginals[first].sum(0) - begins]
        for p, g, (m, v) in zip(params, grads, moments, strict=True):
            g = g / n + l2 * p
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Model(*params, float(good.mean()))


def train(docs: DataFrame, labels: DataFrame, per_label: int = ROWS_PER_LABEL) -> Model:
    """Fit on a bounded sample of documents that ``labels`` (doc_id, quality 0 or 1) marks."""
    sample = [(float(label) > 0, t) for label, t in labelled_sample(docs, labels, "quality", per_label) if t.strip()]
    good = np.array([g for g, _ in sample], bool)
    if not len(good) or good.all() or not good.any():
        return Model(None, None, None, float(good.mean()) if len(good) else 0.5)
    texts = [t.encode() for _, t in sample]
    held = np.arange(len(texts)) % 4 == 3  # calibrated on texts that the model was not fitted on
    if min(good[held].sum(), (~good[held]).sum(), good[~held].sum(), (~good[~held]).sum()) == 0:
        held[:] = False
    x, counts, _ = line_features([t for t, h in zip(texts, held, strict=True) if not h])
    model = fit(x, counts, good[~held])
    model.prior = float(good.mean())
    check = held if held.any() else ~held
    model.slope, model.offset = fit_platt(log_odds(raw_scores([t for t, c in zip(texts, check, strict=True) if c], model)[0]), good[check])
    return model


def log_odds(share: np.ndarray) -> np.ndarray:
    """Log odds of shares, kept finite."""
    share = np.clip(share, 1e-6, 1 - 1e-6)
    return np.log(share / (1 - share))


def raw_scores(texts: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Length-weighted mean marginal per text (the prior for blank texts), text length, line marginals."""
    many = [t.count(b"\n") >= LINES for t in texts]
    if any(many):
        score, total, lines = np.empty(len(texts)), np.empty(len(texts)), [np.empty(0)] * len(texts)
        rest = [i for i, x in enumerate(many) if not x]
        if rest:
            score[rest], total[rest], found = raw_scores([texts[i] for i in rest], model)
            for i, x in zip(rest, found, strict=True):
                lines[i] = x
        for i in np.flatnonzero(many).tolist():
            score[i], total[i], lines[i] = long_text(texts[i], model)
        return score, total, lines
    x, counts, length = line_features(texts)
    good = forward_backward(x @ model.emit, counts, model.move, model.start)[0][:, 1]
    doc = np.repeat(np.arange(len(texts)), counts)
    total = np.bincount(doc, length, len(texts))
    score = np.where(total > 0, np.bincount(doc, length * good, len(texts)) / np.maximum(total, 1), model.prior)
    return score, total, np.split(good, np.cumsum(counts)[:-1])


def document_scores(texts: list[bytes], model: Model) -> tuple[np.ndarray, list[list[float]]]:
    """Score per text, and the marginals of its lines."""
    if model.emit is None or not texts:
        return np.full(len(texts), model.prior), [[] for _ in texts]
    share, total, lines = raw_scores(texts, model)
    score = np.where(total > 0, sigmoid(model.slope * log_odds(share) + model.offset), model.prior)
    return score, [x.tolist() for x in lines]


def score_lines(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of docs: doc_id, score, line_scores (the marginal of "good" of each line)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", CHUNK_BYTES):
            score, lines = document_scores(utf8(piece.column("text")), sent.value)
            yield pa.record_batch([piece.column("doc_id").cast(pa.int64()), pa.array(score), pa.array(lines, pa.list_(pa.float32()))], names=["doc_id", "score", "line_scores"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, line_scores array<float>")
