"""Helpers that the operators share: tables, lineage cuts, chunks of words as arrays.

The array helpers run inside tasks.  They turn the texts of one chunk (a few MB) into word
boundaries and 64-bit word hashes without a Python loop over words.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
WORD_BASE = U64(0x9E3779B97F4A7C15)
GRAM_BASE = U64(0xD1342543DE82EF95)
HASH_BLOCK = 1 << 20
#: Bits of one row of a bit table: what Spark's bitmap functions hold.
BIT_ROW = 1 << 15


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: Column, modulus: int) -> Column:
    """crc32 of the column's text form, modulo ``modulus``: the folds of the contracts."""
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(modulus))


def hash01(*columns: Column | str) -> Column:
    """A deterministic number in [0, 1) per row, for bounded training samples."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


def bit_table(bits: DataFrame, size: int) -> np.ndarray:
    """The set bits among ``size`` (column ``bit``), eight to a byte.

    Whatever the number of rows, size / 8 bytes come to the driver, in rows of up to 4 KB.
    """
    rows = bits.groupBy((F.col("bit") / BIT_ROW).cast("int").alias("row")).agg(F.bitmap_construct_agg(F.pmod("bit", F.lit(BIT_ROW))).alias("bits"))
    out = np.zeros(max(1, size // BIT_ROW) * BIT_ROW // 8, np.uint8)
    for row, part in rows.collect():
        out[row * BIT_ROW // 8 : (row + 1) * BIT_ROW // 8] = np.frombuffer(part, np.uint8)
    return out


def is_set(table: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which of the bits are set."""
    return (table[bits >> 3] >> (bits & 7).astype(np.uint8) & 1).astype(bool)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8; null becomes empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def give_back() -> None:
    """Return freed memory to the system: workers serve one task after another, and what the allocators
    keep of a task's arrays would stand beside the executor's own memory in all steps that follow."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts in ``column`` hold about ``limit`` bytes, one row at least.

    Memory that was freed before is given back at the task's begin and end.
    """
    give_back()
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        at, held = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if held and held + n > limit:
                yield batch.slice(at, i - at)
                at, held = i, 0
            held += n
        if at < batch.num_rows:
            yield batch.slice(at)
    give_back()


def powers(base: np.uint64, n: int, known: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    """base**0..n-1 modulo 2**64, and the same of its inverse; kept for the worker's next chunk."""
    key = int(base)
    if key not in known or len(known[key][0]) < n:
        size = max(n, 1 << 16)
        inverse = pow(key, -1, 1 << 64)
        up, down = np.full(size, base, U64), np.full(size, inverse, U64)
        up[0] = down[0] = 1
        known[key] = np.cumprod(up), np.cumprod(down)
    up, down = known[key]
    return up[:n], down[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (in place where possible)."""
    h ^= h >> U64(33)
    h *= U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


def word_bounds(buf: np.ndarray, separators: tuple[int, ...] = (32, 10)) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of a buffer whose words are parted by the separators."""
    is_sep = buf == separators[0]
    for s in separators[1:]:
        is_sep |= buf == s
    ends = np.append(np.flatnonzero(is_sep), len(buf))
    starts = np.append(0, ends[:-1] + 1)
    full = ends > starts
    return starts[full], ends[full]


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit hash of each word; the buffer is handled in blocks, so memory follows the words only."""
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + HASH_BLOCK, "right")))
        a, b = int(starts[i]), int(ends[j - 1])
        up, down = powers(WORD_BASE, b - a + 1)
        total = np.zeros(b - a + 1, U64)
        np.cumsum((buf[a:b].astype(U64) + U64(1)) * up[: b - a], out=total[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = (total[e] - total[s]) * down[s]
        i = j
    if salt:
        out ^= U64(salt)
    return mix(out)


def word_keys(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, known: dict = {}) -> np.ndarray:  # noqa: B006
    """64-bit key of each word: words of up to 7 bytes never share one, longer words take theirs from a
    cryptographic digest.  ``word_hashes`` is a polynomial, for which texts of one hash can be written down.

    Digests are kept for the worker's next chunk, as long as these words take less than some MB.
    """
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[: len(buf)] = buf
    lanes = np.ndarray(len(buf) + 1, "<u8", padded, strides=(1,))
    sizes = ends - starts
    short = np.minimum(sizes, 7).astype(U64)
    out = mix((lanes[starts] & ((U64(1) << (short * U64(8))) - U64(1))) | (short << U64(56)))
    data = buf.tobytes()
    for i in np.flatnonzero(sizes > 7).tolist():
        word = data[starts[i] : ends[i]]
        key = known.get(word)
        if key is None:
            key = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
            if len(word) < 64:
                if len(known) >= 1 << 16:
                    known.clear()
                known[word] = key
        out[i] = key
    return out


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive words (length len(words) - n + 1, empty if there is none)."""
    size = len(words) - n + 1
    if size <= 0:
        return np.empty(0, U64)
    out = words[:size].copy()
    for k in range(1, n):
        out *= GRAM_BASE
        out += words[k : k + size]
    return mix(out)


def long_gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """As gram_hashes, by prefix sums: for long runs."""
    size = len(words) - n + 1
    if size <= 0:
        return np.empty(0, U64)
    up, down = powers(GRAM_BASE, len(words) + 1)
    total = np.zeros(len(words) + 1, U64)
    np.cumsum(words * up[: len(words)], out=total[1:])
    return mix((total[n:] - total[:size]) * down[:size])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    size = len(values) - width + 1
    if size <= 0:
        return values[:0]
    span, out = 1, values
    while span * 2 <= width:
        out = np.minimum(out[: len(out) - span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[:size], out[rest : rest + size]) if rest else out[:size]


def joined_words(texts: list[bytes]) -> tuple[bytes, np.ndarray]:
    """The words of each text joined by one space, the texts by a newline; and the words per text."""
    split = [t.split() for t in texts]
    return b"\n".join([b" ".join(x) for x in split]), np.fromiter(map(len, split), np.int64, len(split))


def first_words(counts: np.ndarray) -> np.ndarray:
    """Index of each text's first word, and the total at the end."""
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
