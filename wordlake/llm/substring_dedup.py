"""Operator 9, substring dedup: exact repeated windows by super-k-mer partitioning.

Words are runs of anything but ASCII white space.  Every window of ``width`` words whose words
also start earlier (smaller doc_id, or same document, earlier) is a repeat; the words that any
repeat covers are removed.  Windows are judged on the input texts.

Defined results: null and empty texts have no words and an empty kept text; texts shorter than a
window are kept whole, texts of any length are judged whole; rows with equal doc_id and text are
one document (both keep the same words), and so are equal texts without a doc_id; rows with equal
doc_id and other text are ordered by the hash of their text; a null doc_id sorts last.  Of tied
windows the first in that order stays.  Other columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from wordlake.llm import windows


def repeated_spans(docs: DataFrame, width: int = 20, k: int = 3) -> DataFrame:
    """Runs of windows that also start earlier: doc, text_hash, start, count and the first place."""
    return windows.found_spans(docs, width, k, lambda s: windows.repeated_windows(s, width))


def substring_dedup(docs: DataFrame, width: int = 20, k: int = 3) -> DataFrame:
    """Per row of ``docs``: doc_id, kept_text, n_words, n_removed."""
    return windows.removed_words(docs, repeated_spans(docs, width, k), width)
