"""Repeated word windows over a whole corpus, dealt by minimiser.

A window is ``width`` consecutive words of one document.  Its minimiser is the leftmost k-gram of
least hash among its k-grams, so equal windows have equal minimisers.  Consecutive windows with
the same minimiser travel as one packed string (a super-k-mer) to the minimiser's place.  k-grams
that hold a large share of the corpus come last in that order, so a common phrase does not draw
all its surroundings to one place.  Within one chunk of a task, equal strings are packed once (as
a map-side combine does): later copies are repeats already.

A survey of the corpus (its bytes, its frequent k-grams) fixes how many units the strings are
dealt to, so that a unit stays small whatever the corpus; a task streams its units one by one.

A document is the pair (doc_id, 32 bits of the xxhash64 of its text), so rows that repeat a doc_id
with the same text are one document and rows that share a doc_id with other texts are not mixed
up.  A null doc_id sorts after all others; there 60 more bits of the text stand for the id, so
equal texts without an id are one document.  doc_ids lie below 2**62.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordlake.llm.common import U64, first_words, gram_hashes, joined_words, long_gram_hashes, pieces, sliding_min, utf8, word_bounds, word_hashes, word_keys

CHUNK_BYTES = 4 << 20
#: Longest run of words handled at once; longer documents are handled in overlapping runs.
MAX_WORDS = 1 << 19
#: Raw bytes of packed strings that a reducing task unpacks at once.
UNPACK_BYTES = 8 << 20
#: Document keys from here on stand for texts without a doc_id.
KEYLESS = 1 << 62
#: Bytes of text whose strings make a unit; units above this number of tasks share tasks.
UNIT_BYTES = 3 << 20
MOST_TASKS = 20_000
#: Buckets that k-grams are counted in, and the share of all k-grams that makes a bucket frequent.
BUCKETS = 1 << 20
FREQUENT = 1 / (1 << 14)

PACKED = "part int, kind int, raw_bytes long, body binary, meta binary"
#: Of each packed string: its document's key, the word it starts at, its minimiser's place in it.
META = np.dtype([("doc", "<i8"), ("text", "<i8"), ("start", "<i8"), ("anchor", "<i8"), ("group", "<i8")])
#: How META travels: column by column, the rising document ids as differences.
SENT = {"doc": "<i8", "text": "<u4", "start": "<u4", "anchor": "<u4", "group": "<u2"}
#: Runs of repeated windows: where they are and where the first of them stands first.  ``home`` is the
#: first word of the packed string they lie in, or -1: a whole string that was not sent, since its chunk
#: holds it earlier, at first_doc, first_text, first_start (itself perhaps a repeat).
SPAN = np.dtype([("doc", "<i8"), ("text", "<i8"), ("start", "<i8"), ("count", "<i8"), ("first_doc", "<i8"), ("first_text", "<i8"), ("first_start", "<i8"), ("home", "<i8")])
SPANS = "doc long, text_hash long, start long, count long, first_doc long, first_text long, first_start long, home long"


@dataclass
class Strings:
    """Packed strings as one buffer, in order of (doc, text, start)."""

    data: bytes
    starts: np.ndarray  # of words, in bytes
    ends: np.ndarray
    words: np.ndarray  # hashes
    of: np.ndarray  # the string of each word
    first: np.ndarray  # the first word of each string
    meta: np.ndarray


@dataclass
class Plan:
    """Units that strings are dealt to, tasks that hold them, and which buckets of k-grams are frequent."""

    units: int
    tasks: int
    frequent: np.ndarray


def with_keys(docs: DataFrame) -> DataFrame:
    """``docs`` with the key columns ``__doc`` and ``__text``."""
    keyless = F.lit(KEYLESS) + F.shiftrightunsigned(F.xxhash64("text"), 4)
    return docs.withColumns({"__doc": F.coalesce(F.col("doc_id").cast("long"), keyless), "__text": F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF))})


def doc_id_of(key: str) -> Column:
    """The doc_id of a document key."""
    return F.when(F.col(key) < F.lit(KEYLESS), F.col(key))


def survey(docs: DataFrame, k: int) -> Plan:
    """Bytes of the corpus and its frequent k-grams, by one pass over the texts.

    A task reports only buckets that hold the share ``FREQUENT`` of its own k-grams, so at most
    1 / FREQUENT rows; at most as many come to the driver.  What is called frequent changes how
    windows are dealt, never which are found.
    """
    arrow = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, size = np.zeros(BUCKETS, np.int64), 0
        for piece in pieces(batches, "text", CHUNK_BYTES // 4):
            data, _ = joined_words(utf8(piece.column("text")))
            buf = np.frombuffer(data, np.uint8)
            grams = gram_hashes(word_hashes(buf, *word_bounds(buf)), k)
            counts += np.bincount((grams % U64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
            size += len(data)
        total = int(counts.sum())
        many = np.flatnonzero(counts > total * FREQUENT)
        yield pa.record_batch([pa.array(np.concatenate([[-1, -2], many])), pa.array(np.concatenate([[size, total], counts[many]]))], schema=arrow)

    sums = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    rows = dict(sums.orderBy(F.col("bucket") >= 0, F.desc("n")).limit(2 + int(1 / FREQUENT)).collect())
    frequent = np.zeros(BUCKETS, bool)
    frequent[[b for b, n in rows.items() if b >= 0 and n > rows[-2] * FREQUENT]] = True
    units = 1 + rows.get(-1, 0) // UNIT_BYTES
    return Plan(units, min(units, MOST_TASKS), frequent)


def send_meta(meta: np.ndarray) -> bytes:
    """META rows as bytes for ``read_meta``."""
    columns = {name: meta[name] for name in SENT} | {"doc": np.diff(meta["doc"], prepend=0)}
    return b"".join(columns[name].astype(kind).tobytes() for name, kind in SENT.items())


def read_meta(sent: bytes) -> np.ndarray:
    """META rows that ``send_meta`` packed."""
    n = len(sent) // sum(np.dtype(kind).itemsize for kind in SENT.values())
    out, at = np.empty(n, META), 0
    for name, kind in SENT.items():
        out[name] = np.frombuffer(sent, kind, n, at)
        at += n * np.dtype(kind).itemsize
    np.cumsum(out["doc"], out=out["doc"])
    return out


def runs_of_windows(words: np.ndarray, doc: np.ndarray, width: int, k: int, frequent: np.ndarray) -> tuple[np.ndarray, ...]:
    """First window, last window and minimiser place of each super-k-mer, and the minimiser's hash."""
    grams = gram_hashes(words, k)
    late = frequent[(grams % U64(BUCKETS)).astype(np.int64)]
    grams = (grams >> U64(1)) | (late.astype(U64) << U64(63))
    size = len(words) - width + 1
    if size <= 0:
        none = np.empty(0, np.int64)
        return none, none, none, np.empty(0, U64)
    low = U64((1 << 20) - 1)
    least = sliding_min((grams & ~low) | np.arange(len(grams), dtype=U64), width - k + 1)
    fine = doc[:size] == doc[width - 1 :]
    new = np.ones(size, bool)
    new[1:] = (least[1:] != least[:-1]) | (doc[1:size] != doc[: size - 1])
    at = np.flatnonzero(new & fine)
    stop = np.flatnonzero(fine & np.append(new[1:] | ~fine[1:], True))
    place = (least[at] & low).astype(np.int64)
    return at, stop, place, grams[place]


def pack_chunk(batch: pa.RecordBatch, width: int, k: int, parts: int, frequent: np.ndarray) -> Iterator[tuple]:
    """Rows of PACKED for the documents of one chunk."""
    order = np.lexsort((batch.column("__text").to_numpy(), batch.column("__doc").to_numpy()))
    batch = batch.take(pa.array(order))
    texts = utf8(batch.column("text"))
    keys = list(zip(batch.column("__doc").to_pylist(), batch.column("__text").to_pylist(), strict=True))
    data, counts = joined_words(texts)
    del texts
    starts, ends = word_bounds(np.frombuffer(data, np.uint8))
    words = word_hashes(np.frombuffer(data, np.uint8), starts, ends)
    doc = np.repeat(np.arange(len(counts)), counts)
    first = first_words(counts)
    seen: dict[bytes, int] = {}
    owners: list[tuple[int, int]] = []
    sent: list[bytes] = []
    rows: list[tuple] = []
    groups: list[int] = []
    spans: list[tuple] = []
    doc = doc.astype(np.int32)
    for base in range(0, max(1, len(words) - width + 1), MAX_WORDS - width + 1):
        part = slice(base, min(len(words), base + MAX_WORDS))
        at, stop, place, least = runs_of_windows(words[part], doc[part], width, k, frequent)
        a_bytes, b_bytes = starts[base + at].tolist(), ends[base + stop + width - 1].tolist()
        docs_of = doc[base + at]
        begin = (base + at - first[docs_of]).tolist()
        for a, b, d, w, n, p, g in zip(a_bytes, b_bytes, docs_of.tolist(), begin, (stop - at + 1).tolist(), (place - at).tolist(), (least >> U64(16)).tolist(), strict=True):
            string = data[a:b]
            i = seen.setdefault(string, len(sent))
            if i == len(sent):
                sent.append(string)
                owners.append((d, w))
                rows.append((*keys[d], w, p))
                groups.append(g)
            elif (keys[d], w) != (keys[owners[i][0]], owners[i][1]):
                d0, w0 = owners[i]
                spans.append((*keys[d], w, n, *keys[d0], w0, -1))
    del data, starts, ends, words, doc, seen
    press = zstandard.ZstdCompressor(level=3)
    group = np.array(groups, U64)
    to = (group % U64(parts)).astype(np.int64)
    by = np.argsort(to, kind="stable")
    cuts = np.flatnonzero(np.diff(to[by], prepend=-1, append=parts))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        which = by[a:b].tolist()
        body = b"\n".join([sent[i] for i in which])
        meta = np.zeros(len(which), META)
        for name, values in zip(("doc", "text", "start", "anchor"), zip(*(rows[i] for i in which), strict=True), strict=True):
            meta[name] = values
        meta["group"] = ((group[by[a:b]] // U64(parts)) & U64(0xFFFF)).astype(np.int64)
        yield int(to[by[a]]), 0, len(body), press.compress(body), press.compress(send_meta(meta))
    for a in range(0, len(spans), 4096):
        some = np.array(spans[a : a + 4096], SPAN)
        yield int(some["text"][0] % parts), 1, 0, b"", press.compress(some.tobytes())


def packed_strings(docs: DataFrame, width: int, k: int, plan: Plan) -> DataFrame:
    """All super-k-mers of the documents, each row the strings of one chunk for one unit."""
    sent = docs.sparkSession.sparkContext.broadcast(plan)
    arrow = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("raw_bytes", pa.int64()), ("body", pa.binary()), ("meta", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", CHUNK_BYTES):
            cols = list(zip(*pack_chunk(piece, width, k, sent.value.units, sent.value.frequent), strict=True))
            if cols:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, arrow.types, strict=True)], schema=arrow)

    return docs.filter(F.col("text").isNotNull()).select("__doc", "__text", "text").mapInArrow(run, PACKED)


def unpack(bodies: list[tuple[bytes, bytes]], turn: int, turns: int) -> Strings:
    """The strings whose minimiser group falls to ``turn``, in order of their documents."""
    metas, strings = [], []
    for body, meta in bodies:
        rows = read_meta(zstandard.decompress(meta))
        mine = np.flatnonzero(rows["group"] % turns == turn)
        if len(mine):
            text = zstandard.decompress(body).split(b"\n")
            strings += text if len(mine) == len(rows) else [text[i] for i in mine.tolist()]
            metas.append(rows[mine])
    meta = np.concatenate(metas) if metas else np.empty(0, META)
    order = np.lexsort((meta["start"], meta["text"], meta["doc"]))
    data = b"\n".join([strings[i] for i in order.tolist()])
    starts, ends = word_bounds(np.frombuffer(data, np.uint8))
    words = word_keys(np.frombuffer(data, np.uint8), starts, ends)
    breaks = np.frombuffer(data, np.uint8)[np.minimum(ends, max(0, len(data) - 1))] == 10
    of = np.concatenate([[0], np.cumsum(breaks)[:-1]]).astype(np.int64) if len(starts) else np.empty(0, np.int64)
    first = np.searchsorted(of, np.arange(len(meta) + 1))
    return Strings(data, starts, ends, words, of, first, meta[order])


def differ(meta: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which strings of two lists have their minimisers at different places of the corpus (repeated rows are one place)."""
    place = meta["start"] + meta["anchor"]
    return (meta["doc"][a] != meta["doc"][b]) | (meta["text"][a] != meta["text"][b]) | (place[a] != place[b])


def repeated_windows(s: Strings, width: int) -> np.ndarray:
    """SPANs of the windows that stand earlier as well.

    Windows are sorted by hash; each is then compared byte by byte with the first of its hash.
    """
    grams = long_gram_hashes(s.words, width)
    size = len(grams)
    if not size:
        return np.empty(0, SPAN)
    at = np.flatnonzero(s.of[:size] == s.of[width - 1 :])
    if not len(at):
        return np.empty(0, SPAN)
    by = np.argsort(grams[at], kind="stable")
    sorted_hash = grams[at[by]]
    new = np.append(True, sorted_hash[1:] != sorted_hash[:-1])
    lead = at[by[np.flatnonzero(new)[np.cumsum(new) - 1]]]
    rest = np.flatnonzero(~new)
    here, lead = at[by[rest]], lead[rest]
    data, a, b = s.data, s.starts, s.ends
    same = np.fromiter((data[i:j] == data[m:n] for i, j, m, n in zip(a[here].tolist(), b[here + width - 1].tolist(), a[lead].tolist(), b[lead + width - 1].tolist(), strict=True)), bool, len(here))
    if not same.all():  # two windows of one hash: go by the words themselves
        known: dict[bytes, int] = {}
        clash = np.isin(grams[at], grams[here[~same]])
        here, lead = here[~np.isin(grams[here], grams[here[~same]])], lead[~np.isin(grams[here], grams[here[~same]])]
        extra = [(i, known.setdefault(data[a[i] : b[i + width - 1]], i)) for i in at[clash].tolist()]
        extra = [(i, j) for i, j in extra if i != j]
        here = np.concatenate([here, np.array([i for i, _ in extra], np.int64)])
        lead = np.concatenate([lead, np.array([j for _, j in extra], np.int64)])
    start = s.meta["start"][s.of] + np.arange(len(s.of)) - s.first[s.of]
    key = lambda w: (s.meta["doc"][s.of[w]], s.meta["text"][s.of[w]], start[w])
    other = np.zeros(len(here), bool)
    for x, y in zip(key(here), key(lead), strict=True):
        other |= x != y
    here, lead = here[other], lead[other]
    by = np.argsort(here, kind="stable")
    here, lead = here[by], lead[by]
    if not len(here):
        return np.empty(0, SPAN)
    new = np.append(True, (here[1:] != here[:-1] + 1) | (lead[1:] != lead[:-1] + 1) | (s.of[here[1:]] != s.of[here[:-1]]) | (s.of[lead[1:]] != s.of[lead[:-1]]))
    head = np.flatnonzero(new)
    out = np.empty(len(head), SPAN)
    out["count"] = np.diff(np.append(head, len(here)))
    out["doc"], out["text"], out["start"] = key(here[head])
    out["first_doc"], out["first_text"], out["first_start"] = key(lead[head])
    out["home"] = s.meta["start"][s.of[here[head]]]
    return out


def reduce_strings(packed: DataFrame, plan: Plan, find: Callable[[Strings], np.ndarray]) -> DataFrame:
    """Bring each minimiser's strings together and return the SPANs that ``find`` makes of them.

    A task streams its units in order and holds one at a time; a unit above ``UNPACK_BYTES`` is
    taken in turns, some minimisers each.
    """
    names = [f for f in SPAN.names]
    arrow = pa.schema([(c.split()[0], pa.int64()) for c in SPANS.split(", ")])

    def batch(spans: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(np.ascontiguousarray(spans[n])) for n in names], schema=arrow)

    def unit(bodies: list[tuple[bytes, bytes]], raw: int) -> Iterator[pa.RecordBatch]:
        turns = 1 + raw // UNPACK_BYTES
        for turn in range(turns if bodies else 0):
            spans = find(unpack(bodies, turn, turns))
            for i in range(0, len(spans), 100_000):
                yield batch(spans[i : i + 100_000])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bodies, raw, at = [], 0, -1
        for b in batches:
            for part, kind, size, body, meta in zip(*(b.column(c).to_pylist() for c in ("part", "kind", "raw_bytes", "body", "meta")), strict=True):
                if kind:
                    yield batch(np.frombuffer(zstandard.decompress(meta), SPAN))
                    continue
                if part != at:
                    yield from unit(bodies, raw)
                    bodies, raw, at = [], 0, part
                bodies.append((body, meta))
                raw += size
        yield from unit(bodies, raw)

    return packed.repartitionById(plan.tasks, F.col("part") % plan.tasks).sortWithinPartitions("part").mapInArrow(run, SPANS)


def found_spans(docs: DataFrame, width: int, k: int, find: Callable[[Strings], np.ndarray]) -> DataFrame:
    """The SPANs that ``find`` makes of all windows of ``docs``."""
    plan = survey(docs, k)
    return reduce_strings(packed_strings(with_keys(docs), width, k, plan), plan, find)


def spans_per_document(spans: DataFrame) -> DataFrame:
    """One row per document that has repeats: its runs of repeated windows."""
    return spans.groupBy("doc", "text_hash").agg(F.collect_list(F.struct("start", "count")).alias("__runs"))


def cover(text: bytes, runs: list[dict] | None, width: int) -> tuple[bytes, int, int]:
    """The words left when those under repeated windows go; words in all; words gone."""
    words = text.split()
    if not runs:
        return b" ".join(words), len(words), 0
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, [r["start"] for r in runs], 1)
    np.add.at(step, [r["start"] + r["count"] + width - 1 for r in runs], -1)
    gone = np.cumsum(step[:-1]) > 0
    return b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]), len(words), int(gone.sum())


def removed_words(docs: DataFrame, spans: DataFrame, width: int) -> DataFrame:
    """``docs`` (with keys) and, per row, kept_text, n_words, n_removed."""
    joined = with_keys(docs.select("doc_id", "text")).join(spans_per_document(spans), (F.col("__doc") == F.col("doc")) & (F.col("__text") == F.col("text_hash")), "left").select("doc_id", "text", "__runs")
    arrow = pa.schema([("doc_id", pa.int64()), ("kept_text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", CHUNK_BYTES):
            found = [cover(t, r, width) for t, r in zip(utf8(piece.column("text")), piece.column("__runs").to_pylist(), strict=True)]
            kept, words, gone = zip(*found, strict=True)
            yield pa.record_batch([piece.column("doc_id").cast(pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(words, pa.int64()), pa.array(gone, pa.int64())], schema=arrow)

    return joined.mapInArrow(run, "doc_id long, kept_text string, n_words long, n_removed long")
