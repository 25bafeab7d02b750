"""Operator 3, packing: power-of-two decomposition of tokenized documents.

A document of n tokens is cut into pieces whose lengths are the powers of two in n's binary form
(and as many pieces of ``max_len`` as fit).  Each piece is a sequence of its own, so no sequence
crosses documents and none is padded; equal lengths share a bucket, from which equal-shape
batches are drawn.  The whole job is one scan: no shuffle.

Defined results: null and empty texts give one piece holding only the end id; texts of any length
are tokenized whole; null ``doc_id`` is carried; repeated and tied rows are packed each, under
sequence ids of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlake.llm.common import pieces, word_hashes

TOKENIZER_FILE = "byte_bpe_50k.json"
#: With any of these in a text it is encoded whole, not by units.
OTHER_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -‏    ⁠　﻿]")
CHUNK_BYTES = 2 << 20
#: Distinct units whose ids a worker remembers at most; beyond that it starts anew.
KNOWN_UNITS = 400_000
#: Of each byte: 1 space or newline, 2 ASCII punctuation, 3 ASCII letter, 0 anything else.
KIND = np.array([1 if c in b" \n" else 3 if chr(c).isalpha() and c < 128 else 2 if 32 < c < 127 and not chr(c).isdigit() else 0 for c in range(256)], np.uint8)


def public_path(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Token ids of texts, by units that the pre-tokenizer never joins.

    A unit starts where a space or newline follows anything else, and where ASCII punctuation
    follows an ASCII letter.  Equal units of a chunk are found by 64-bit hash and compared by their
    bytes (should two differ, the chunk is encoded whole); each
    unit that is new to the worker goes through the tokenizer, the others come from a table of at
    most ``known_units`` units (beyond that it starts anew).
    """

    def __init__(self, path: str, known_units: int = KNOWN_UNITS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.known_units = known_units
        self.reset()

    def reset(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.flat = np.empty(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 12, np.int64)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, new: list[bytes]) -> None:
        for i in range(0, len(new), 10_000):
            part = new[i : i + 10_000]
            ids = self.whole([x.decode() for x in part])
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            known = len(self.rows)
            at, n = int(self.starts[known]), int(sizes.sum())
            if at + n > len(self.flat):
                self.flat = np.concatenate([self.flat[:at], np.empty(max(at, n) + n, np.uint32)])
            if known + len(ids) >= len(self.starts):
                self.starts = np.concatenate([self.starts, np.empty(len(self.starts) + len(ids), np.int64)])
            self.flat[at : at + n] = [x for row in ids for x in row]
            self.starts[known + 1 : known + 1 + len(ids)] = at + np.cumsum(sizes)
            self.rows.update(zip(part, range(known, known + len(ids)), strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        odd = [bool(OTHER_SPACE.search(t)) for t in texts]
        raw = [b"" if o else t.encode() for t, o in zip(texts, odd, strict=True)]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        found = self._units(np.frombuffer(b"".join(raw), np.uint8), np.cumsum(sizes) - sizes, sizes)
        if found is None:
            return [np.array(x, np.uint32) for x in self.whole(texts)]
        ids, bounds = found
        out = [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        for i in np.flatnonzero(odd):
            out[i] = np.array(self.whole([texts[i]])[0], np.uint32)
        return out

    def _units(self, buf: np.ndarray, doc_at: np.ndarray, doc_size: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """All ids and each text's bounds in them; None if two different units share a hash."""
        if not len(buf):
            return np.empty(0, np.uint32), np.zeros(len(doc_at) + 1, np.int64)
        kind = KIND[buf]
        first = np.ones(len(buf), bool)
        first[1:] = (kind[1:] == 1) & (kind[:-1] != 1) | (kind[1:] == 2) & (kind[:-1] == 3)
        first[doc_at[doc_size > 0]] = True
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(buf))
        hashes = word_hashes(buf, starts, ends)
        hashes ^= (ends - starts).astype(np.uint64)
        _, sample, group = np.unique(hashes, return_index=True, return_inverse=True)
        of_sample = np.arange(len(buf)) + np.repeat(starts[sample][group] - starts, ends - starts)
        if (ends - starts != (ends - starts)[sample][group]).any() or (buf[of_sample] != buf).any():
            return None
        data = buf.tobytes()
        units = [data[a:b] for a, b in zip(starts[sample].tolist(), ends[sample].tolist(), strict=True)]
        if len(self.rows) > self.known_units:
            self.reset()
        new = [u for u in units if u not in self.rows]
        if new:
            self.learn(new)
        rows = np.fromiter(map(self.rows.__getitem__, units), np.int64, len(units))[group]
        at, sizes = self.starts[rows], self.starts[rows + 1]
        sizes -= at
        end = np.cumsum(sizes)
        ids = self.flat[np.repeat(at - end + sizes, sizes) + np.arange(int(end[-1]))]
        before = np.searchsorted(starts, doc_at + doc_size)
        return ids, np.concatenate([[0], np.append(0, end)[before]])


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process, kept for its next tasks."""
    return Encoder(path)


def piece_lengths(n: int, max_len: int) -> list[int]:
    """n as a sum of powers of two, none above max_len, largest first."""
    out = [max_len] * (n // max_len)
    rest = n % max_len
    return out + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack_pieces(docs: DataFrame, tokenizer_path: str, max_len: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, bucket (log2 of the length), doc_tokens, ids.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit integers.  ``max_len``
    must be a power of two.  The tokenizer file must be readable at the same path on every worker.
    """
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    schema = "doc_id long, start long, length long, bucket int, doc_tokens long, ids binary"
    arrow = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("bucket", pa.int32()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", CHUNK_BYTES):
            cols: list[list] = [[] for _ in arrow]
            encoded = encoder(tokenizer_path).encode([t or "" for t in batch.column("text").to_pylist()])
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                ids = np.append(found, np.uint32(end_id)).astype("<u4").tobytes()
                n, start = len(ids) // 4, 0
                for size in piece_lengths(n, max_len):
                    for c, v in zip(cols, (doc_id, start, size, size.bit_length() - 1, n, ids[4 * start : 4 * (start + size)]), strict=True):
                        c.append(v)
                    start += size
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, arrow.types, strict=True)], schema=arrow)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer_path: str, max_len: int = 2048, end_id: int = 1) -> DataFrame:
    """``pack_pieces`` with ``sequence_id`` and ``offset``: each piece fills a sequence of its own.

    Sequence ids are unique but not dense; they follow the rows' places in the input's partitions,
    so numbering costs no shuffle.
    """
    return pack_pieces(docs, tokenizer_path, max_len, end_id).withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write the sequences as Parquet, one folder per length bucket, without a shuffle."""
    packed.write.partitionBy("bucket").parquet(path)
