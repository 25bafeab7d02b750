"""Small linear models trained on a bounded sample of labelled rows."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordlake.llm.common import hash01


def shares(labels: DataFrame, label: str, n_rows: Column, per_label: int, max_labels: int) -> tuple[Column, int] | None:
    """Which share of each label's rows (counted by ``n_rows``) makes a sample of about ``per_label`` rows; and the labels."""
    counts = labels.groupBy(label).agg(n_rows.alias("n")).limit(max_labels + 1).collect()
    if len(counts) > max_labels:
        raise ValueError(f"more than {max_labels} labels in {label}")
    if not counts:
        return None
    return F.create_map(*[F.lit(x) for c in counts for x in (c[0], min(1.0, per_label / max(1, c["n"])))])[F.col(label)], len(counts)


def bounded_sample(rows: DataFrame, label: str, per_label: int, max_labels: int = 1000) -> list[tuple[str, str]]:
    """About ``per_label`` different (label, text) pairs of each label, chosen by a hash of the text.

    The sample is what a model is fitted on; it is the only part of the rows that comes to the
    driver: copies of a text count once, and at most ``2 * per_label`` pairs times the number of
    labels are taken.  More than ``max_labels`` labels are an error.
    """
    rows = rows.filter(F.col(label).isNotNull() & F.col("text").isNotNull()).select(F.col(label).cast("string").alias(label), "text")
    share = shares(rows, label, F.approx_count_distinct(F.xxhash64("text")), per_label, max_labels)
    if share is None:
        return []
    chosen = rows.filter(hash01("text", F.lit(7)) < share[0]).groupBy(label, F.xxhash64("text").alias("h")).agg(F.min("text").alias("text"))
    return sorted((r[0], r[1]) for r in chosen.orderBy("h", label).limit(2 * per_label * share[1]).select(label, "text").collect())


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_label: int, max_labels: int = 100) -> list[tuple[str, str]]:
    """As ``bounded_sample``, for labels in a table of their own (doc_id, label).

    The labels are sampled first, by a hash of doc_id; only these, at most twice ``per_label`` times
    the number of different labels, are broadcast to the documents, so no text is shuffled.
    """
    labels = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", label)
    share = shares(labels, label, F.count("*"), per_label, max_labels)
    if share is None:
        return []
    bound = 2 * per_label * share[1]
    chosen = labels.filter(hash01("doc_id", F.lit(7)) < share[0]).distinct().limit(bound)
    found = docs.filter(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return sorted((r[0], r[1]) for r in found.select(F.col(label).cast("string"), "text").limit(bound).collect())


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-4, steps: int = 250, rate: float = 0.5, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features x outputs) and biases of independent logistic models; y is 0 or 1 (rows x outputs)."""
    n, outputs = len(x), y.shape[1]
    weight = np.ones((n, 1), np.float32) if weight is None else weight.reshape(-1, 1).astype(np.float32)
    weight = weight / weight.sum()
    w, b = np.zeros((x.shape[1], outputs), np.float32), np.zeros(outputs, np.float32)
    mw, vw, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)
    for t in range(1, steps + 1):
        error = (sigmoid(x @ w + b) - y) * weight
        gw, gb = x.T @ error + l2 * w, error.sum(0)
        for g, m, v, at in ((gw, mw, vw, w), (gb, mb, vb, b)):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            at -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w, b


def sigmoid(z: np.ndarray) -> np.ndarray:
    """Logistic function, safe for large arguments."""
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit_platt(margin: np.ndarray, y: np.ndarray, steps: int = 400) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities (with Platt's softened targets)."""
    up, down = float((y > 0).sum()), float((y <= 0).sum())
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    scale = float(np.std(margin)) or 1.0
    a, b = 1.0 / scale, 0.0
    for _ in range(steps):
        p = sigmoid(a * margin + b)
        h = p * (1 - p) + 1e-9
        ga, gb = ((p - target) * margin).sum() + 1e-3 * a, (p - target).sum()
        haa, hab, hbb = (h * margin * margin).sum() + 1e-3, (h * margin).sum(), h.sum() + 1e-6
        det = haa * hbb - hab * hab + 1e-12
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = min(1.0, 2.0 / (abs(da) * scale + abs(db) + 1e-9))
        a, b = a - step * da, b - step * db
        if abs(da) * scale + abs(db) < 1e-8:
            break
    return float(a), float(b)


def hashed_counts(keys: Iterable[np.ndarray], size: int) -> np.ndarray:
    """Square roots of hashed n-gram counts, each row scaled to length 1 (float32)."""
    rows = [np.sqrt(np.bincount(k, minlength=size)).astype(np.float32) for k in keys]
    out = np.array(rows, np.float32) if rows else np.zeros((0, size), np.float32)
    del rows
    for a in range(0, len(out), 256):  # in place and in blocks: in training this is the driver's largest table
        some = out[a : a + 256]
        some /= np.maximum(np.sqrt((some * some).sum(1, keepdims=True)), 1e-9)
    return out
