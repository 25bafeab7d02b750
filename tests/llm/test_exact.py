"""Exact operators against brute force, on small tables with nulls, ties and odd texts."""

import collections
import hashlib
import os
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from wordlake.llm import decontaminate, html_text, license_scan, near_dup, packing, quality_rules, substring_dedup, suffix_dedup
from wordlake.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, score double, doc long, start long, lang_pred string"


def table(spark, rows):
    """Documents with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(d, t, None, "s", None, 7, 0.5, 1, 2, "q") for d, t in rows], SCHEMA)


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    words = ["a", "b", "c", "dd", "éé", "F.", "the", "of"]
    base = [" ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(rng.choice((3, 30, 90)))) for _ in range(12)]
    rows = []
    for i in range(n):
        t = rng.choice(base).split()
        for _ in range(rng.choice((0, 0, 1, 3))):
            t[rng.randrange(len(t))] = "x" + str(rng.randrange(9))
        rows.append((i, rng.choice((" ", "\n", " \t")).join(t)))
    passage = " ".join(f"p{i}" for i in range(70))
    rows += [(100, "left " + passage + " right"), (101, passage), (102, "z " * 300), (103, ""), (104, None), (105, "   \n"), (106, "one"), (107, "ONE"), (108, passage.upper())]
    return rows


def windows_brute(rows, width):
    first, words = {}, {d: (t or "").encode().split() for d, t in rows}
    for d in sorted(words):
        for i in range(len(words[d]) - width + 1):
            first.setdefault(tuple(words[d][i : i + width]), (d, i))
    return {d: [(w, any(first[tuple(ws[j : j + width])] != (d, j) for j in range(max(0, i - width + 1), min(i, len(ws) - width) + 1))) for i, w in enumerate(ws)] for d, ws in words.items()}


def spans_of(rows, width, k, frequent=None):
    """Both operators' spans by packing and reducing in this process, all in one unit."""
    import numpy as np
    import pyarrow as pa

    from wordlake.llm import windows

    frequent = np.zeros(windows.BUCKETS, bool) if frequent is None else frequent
    chunks = [pa.record_batch([pa.array([d]), pa.array([0]), pa.array([t])], names=["__doc", "__text", "text"]) for d, t in rows]
    packed = [row for chunk in chunks for row in windows.pack_chunk(chunk, width, k, 1, frequent)]
    strings = windows.unpack([(body, meta) for _, kind, _, body, meta in packed if not kind], 0, 1)
    assert all(not kind for _, kind, *_ in packed)
    return windows.repeated_windows(strings, width), suffix_dedup.suffix_matches(strings, width)


@pytest.mark.parametrize("often", [False, True])
def test_windows_of_documents_that_are_handled_in_runs(monkeypatch, often):
    import numpy as np

    from wordlake.llm import windows

    monkeypatch.setattr(windows, "MAX_WORDS", 90)
    rng = random.Random(12)
    shared = [f"s{i}" for i in range(160)]
    rows = [(d, " ".join([f"d{d}w{i}" for i in range(rng.randrange(40))] + shared[rng.randrange(9) :] + [f"e{d}w{i}" for i in range(rng.randrange(40))])) for d in range(6)]
    for spans in spans_of(rows, 20, 3, np.random.RandomState(1).rand(windows.BUCKETS) < 0.7 if often else None):
        got = {(int(x["doc"]), int(x["start"]) + i, int(x["first_doc"]), int(x["first_start"]) + i) for x in spans for i in range(int(x["count"]))}
        first, expected = {}, set()
        for d, t in rows:
            w = t.split()
            for i in range(len(w) - 19):
                f = first.setdefault(tuple(w[i : i + 20]), (d, i))
                if f != (d, i):
                    expected.add((d, i, *f))
        assert got == expected


@pytest.mark.parametrize("units", [1, 7])
def test_windows_in_units_and_turns(spark, monkeypatch, units):
    """Several units and turns, frequent k-grams, one long text, and many copies."""
    from wordlake.llm import windows

    monkeypatch.setattr(windows, "UNPACK_BYTES", 20_000)
    rng = random.Random(2)
    common = "in the end of it all".split()
    rows = [(d, " ".join(x for _ in range(12) for x in [*common, *(f"w{rng.randrange(60)}" for _ in range(3))])) for d in range(60)] + [(900, " ".join(f"u{i}" for i in range(40_000)))] + [(1000 + d, "one text that stands here many times " * 5) for d in range(300)]
    size = sum(len(t) for _, t in rows)
    monkeypatch.setattr(windows, "UNIT_BYTES", 1 + size // units)
    brute = windows_brute(rows, 20)
    docs = table(spark, rows).repartition(5)
    got = {r.doc_id: r.n_removed for r in substring_dedup.substring_dedup(docs).collect()}
    assert got == {d: sum(g for _, g in x) for d, x in brute.items()} and sum(got.values()) > 5000
    covered = {}
    for r in suffix_dedup.repeated_passages(docs, 20, 3).collect():
        covered.setdefault(r.doc_id, set()).update(range(r.start_word, r.start_word + r.n_words))
    assert {d: len(x) for d, x in covered.items()} == {d: n for d, n in got.items() if n}


def test_texts_without_ids(spark):
    """Equal texts without an id are one document; others are told apart by the text."""
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(None, "a b " + passage), (None, "c d " + passage), (None, "c d " + passage), (3, passage)]
    assert sorted((str(r.doc_id), r.n_removed) for r in substring_dedup.substring_dedup(table(spark, rows)).collect()) == [("3", 0)] + [("None", 60)] * 3
    found = suffix_dedup.repeated_passages(table(spark, rows)).distinct().collect()
    assert {(r.doc_id, r.start_word, r.n_words, r.first_doc_id) for r in found} == {(None, 2, 60, 3)}
    assert sorted(str(r.text) for r in suffix_dedup.cut_passages(table(spark, rows)).collect()) == sorted(["a b", "c d", "c d", passage])
    assert {r.doc_id for r in quality_rules.judge(table(spark, rows), quality_rules.Model(None)).collect()} == {None, 3}


def test_repeated_rows_and_very_long_texts(spark):
    """Row-wise operators give equal rows equal results; one text of megabytes passes through all of them."""
    long = " ".join(f"w{i % 90_000}" for i in range(300_000))
    rows = [(1, "cc by words here"), (1, "cc by words here"), (2, long)]
    docs = table(spark, rows)
    summary = license_scan.license_summary(docs).collect()
    assert len(summary) == 3 and summary[0] == summary[1] and summary[2].n_words == 300_000
    judged = quality_rules.judge(docs, quality_rules.Model(None)).collect()
    assert judged[0] == judged[1] and judged[2].n_words == 300_000
    html = "<article><p>" + long + "</p></article>"
    pages = html_text.extract_text(spark.createDataFrame([(1, "u", html), (1, "u", html), (None, None, "")], "page_id long, url string, html string")).collect()
    assert [r.text for r in pages] == [long, long, ""]
    near = near_dup.near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.n_shingles, r.kept) for r in near) == [(1, 3, True), (1, 3, True), (2, 90_000, True)]
    assert {r.doc_id: r.n_removed for r in substring_dedup.substring_dedup(docs).collect()} == {1: 0, 2: 210_000}
    leaks = decontaminate.leaks(docs, spark.createDataFrame([(7, " ".join(f"w{i}" for i in range(500, 530)))], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.score) for r in leaks] == [(2, 7, 1.0)]
    items = spark.createDataFrame([(7, "cc by words here"), (7, "cc by words here")], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()) == [(1, 7), (1, 7)]


def test_buckets_are_written_by_length(spark, tmp_path):
    packed = packing.pack(table(spark, [(1, "word " * 700), (2, "")]), packing.public_path(packing.TOKENIZER_FILE))
    packing.write_buckets(packed, f"{tmp_path}/packed")
    back = spark.read.parquet(f"{tmp_path}/packed")
    assert back.count() == packed.count() and {(1 << r.bucket) for r in back.collect()} == {r.length for r in back.collect()}


def test_substring_dedup(spark):
    rows = corpus()
    brute = windows_brute(rows, 20)
    got = substring_dedup.substring_dedup(table(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        kept = b" ".join(w for w, gone in brute[r.doc_id] if not gone).decode()
        assert (r.n_words, r.n_removed, r.kept_text) == (len(brute[r.doc_id]), sum(g for _, g in brute[r.doc_id]), kept), r.doc_id


def test_substring_dedup_repeated_and_keyless_rows(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    got = substring_dedup.substring_dedup(table(spark, [(1, passage), (1, passage), (None, passage), (2, "other " + passage)])).collect()
    assert sorted(((r.doc_id or -1), r.n_removed) for r in got) == [(-1, 30), (1, 0), (1, 0), (2, 30)]


def test_suffix_dedup(spark):
    rows = corpus(2)
    brute = windows_brute(rows, 50)
    got = {d: set() for d, _ in rows}
    for r in suffix_dedup.repeated_passages(table(spark, rows)).collect():
        got[r.doc_id] |= set(range(r.start_word, r.start_word + r.n_words))
        assert r.n_words >= 50 and (r.first_doc_id, r.first_start_word) < (r.doc_id, r.start_word)
    assert got == {d: {i for i, (_, g) in enumerate(x) if g} for d, x in brute.items()} and got[101] == set(range(70))


def passages_brute(rows, width):
    """Maximal runs of windows whose first copies follow one another."""
    first, words, out = {}, {d: t.split() for d, t in rows}, []
    for d in sorted(words):
        last = None
        for i in range(len(words[d]) - width + 1):
            f = first.setdefault(tuple(words[d][i : i + width]), (d, i))
            if f == (d, i):
                last = None
            elif last == (f[0], f[1] - i):
                out[-1][2] += 1
            else:
                last = (f[0], f[1] - i)
                out.append([d, i, width, *f])
    return sorted(map(tuple, out))


@pytest.mark.parametrize("chunk_bytes", [300, 1500, 4 << 20])
def test_passages_do_not_depend_on_chunks(spark, monkeypatch, chunk_bytes):
    monkeypatch.setattr(suffix_dedup.windows, "CHUNK_BYTES", chunk_bytes)
    rng = random.Random(17)
    shared = [[f"s{k}w{i}" for i in range(30)] for k in range(5)]
    rows = []
    for d in range(60):
        words = []
        for _ in range(rng.randrange(1, 4)):
            words += [f"d{d}w{rng.randrange(10**6)}" for _ in range(rng.randrange(4))] + shared[rng.randrange(5)][rng.randrange(3) :] + shared[rng.randrange(5)]
        rows.append((d, " ".join(words)))
    order = [*rows, *rows[10:20]]  # some rows twice, in another chunk
    rng.shuffle(order)
    got = suffix_dedup.repeated_passages(table(spark, order).coalesce(1), 20).collect()
    assert sorted(map(tuple, got)) == passages_brute(rows, 20)


def test_cut_passages(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = table(spark, [(1, "a  b\n" + passage), (2, "c  d " + passage + "\te  f"), (3, passage), (4, None), (5, "")])
    out = suffix_dedup.cut_passages(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "a  b\n" + passage, 2: "c  d\ne  f", 4: None, 5: ""}


def jaccard_brute(rows, n, percent):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    top = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and top[a] != top[b]:
                    top[a] = top[b] = min(top[a], top[b])
                    changed = True
    return {d: (len(sets[d]), top[d]) for d in sets}


@pytest.mark.parametrize("hubs", [20, 1000])
def test_near_duplicates(spark, monkeypatch, hubs):
    monkeypatch.setattr(near_dup, "HUBS", hubs)
    rows = corpus(3)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(table(spark, rows)).collect()}
    assert got == {d: (n, top, d == top) for d, (n, top) in jaccard_brute(rows, 2, 80).items()}


@pytest.mark.parametrize(("hubs", "share"), [(8, 4), (1000, 512)])
def test_near_duplicates_of_a_table_that_stands_twice(spark, monkeypatch, hubs, share):
    """Few, broad buckets: most links are those that stars miss and prefixes have to recover."""
    monkeypatch.setattr(near_dup, "HUBS", hubs)
    monkeypatch.setattr(near_dup, "SHARE", share)
    rng = random.Random(8)
    base = [[f"b{k}w{i}" for i in range(60)] for k in range(4)]
    rows = []
    for d in range(80):
        t = list(base[d % 4])
        for i in rng.sample(range(60), rng.randrange(2, 7)):
            t[i] = f"x{rng.randrange(3)}"
        rows.append((d, " ".join(t)))
    expected = {d: (n, top, d == top) for d, (n, top) in jaccard_brute(rows, 2, 80).items()}
    got = near_dup.near_duplicates(table(spark, rows * 2), bands=14, rows=1).collect()
    assert len(got) == 2 * len(rows) and {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == expected


def test_components(spark, monkeypatch):
    """Long chains, stars around the greatest node, and blocks of a few edges only."""
    monkeypatch.setattr(near_dup, "EDGES", 5)
    rng = random.Random(3)
    nodes = list(range(400))
    rng.shuffle(nodes)
    edges = [(a, b) for a, b in zip(nodes[:100], nodes[1:101])] + [(999, x) for x in nodes[150:220]] + [(x, nodes[300]) for x in nodes[301:350]] + [(5000, 5000)]
    top = {x: x for e in edges for x in e}
    for _ in edges:
        for a, b in edges:
            top[a] = top[b] = min(top[a], top[b])
    got = near_dup.components(spark.createDataFrame(edges * 2, "leaf long, hub long").repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted((x, t) for x, t in top.items() if x != t)


def test_near_duplicates_with_shared_ids(spark):
    a, b = "these are the words of one text " * 3, "another text that has nothing in common " * 3
    rows = [(3, a), (5, a.upper()), (5, b), (5, b), (None, b + " x"), (7, "  "), (7, None), (None, "alone here"), (None, "alone  HERE")]
    got = near_dup.near_duplicates(table(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles > 0, str(r.component_id), r.kept) for r in got) == sorted(
        [("3", True, "3", True), ("5", True, "3", False), ("5", True, "5", True), ("5", True, "5", True), ("None", True, "5", False), ("7", False, "7", True), ("7", False, "7", True), ("None", True, "None", True), ("None", True, "None", True)]
    )
    kept = near_dup.drop_near_duplicates(table(spark, rows), shingle=2).collect()
    assert sorted((str(r.doc_id), (r.text or "").split()[:2]) for r in kept if (r.text or "").lower().split()[:1] != ["alone"]) == [("3", ["these", "are"]), ("5", ["another", "text"]), ("7", []), ("7", [])]
    assert len(kept) == 5 and list(kept[0].asDict()) == table(spark, []).columns


def test_near_duplicates_without_ids(spark):
    text = "some words that are here twice and more"
    got = near_dup.near_duplicates(table(spark, [(None, text), (5, text), (9, text.upper()), (None, "alone and lonely here"), (9, text)])).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in got) == [("5", "5", True), ("9", "5", False), ("9", "5", False), ("None", "5", False), ("None", "None", True)]
    kept = near_dup.drop_near_duplicates(table(spark, [(4, text), (4, text), (6, text), (None, "q")]), shingle=2)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["4", "None"]


def test_near_duplicate_signatures_find_small_sets():
    rng = random.Random(5)
    found = 0
    for _ in range(200):
        words = [f"w{rng.randrange(10**6)}" for _ in range(12)]
        a, b = " ".join(words).encode(), " ".join(words[:10]).encode()
        h, c, _ = near_dup.shingle_sets([a, b], 2)
        keys = near_dup.band_keys(near_dup.signatures(h, c, 392, near_dup.probe_order(392)), 56, 7)
        found += bool((keys[0] == keys[1]).any())
    assert found == 200


def test_packing(spark):
    from tokenizers import Tokenizer

    path = packing.public_path(packing.TOKENIZER_FILE)
    plain = Tokenizer.from_file(path)
    rows = [(1, "Hello  world,\n\n it's\t“fine” … 12,3\xa0x"), (2, ""), (3, None), (None, "a b"), (4, "word " * 5000), (4, "word " * 5000)]
    packed = packing.pack(table(spark, rows), path).withColumn("crc", F.crc32("ids")).collect()
    assert len({r.sequence_id for r in packed}) == len(packed) and all(r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= 2048 and r.bucket == r.length.bit_length() - 1 for r in packed)
    for d in (1, 2, 3, None):
        ids = [*plain.encode(dict(rows)[d] or "", add_special_tokens=False).ids, 1]
        mine = sorted((r for r in packed if r.doc_id == d), key=lambda r: r.start)
        assert [r.start for r in mine] == [sum(x.length for x in mine[:i]) for i in range(len(mine))]
        assert b"".join(r.ids for r in mine) == b"".join(i.to_bytes(4, "little") for i in ids) and all(r.doc_tokens == len(ids) and r.crc == zlib.crc32(r.ids) for r in mine)
    assert sum(r.length for r in packed if r.doc_id == 4) == 2 * (len(plain.encode("word " * 5000, add_special_tokens=False).ids) + 1)


def test_encoder_cuts_long_texts_at_boundaries(monkeypatch):
    e = packing.Encoder(packing.public_path(packing.TOKENIZER_FILE), known_units=20)
    texts = ["a b  c\n d's, (e) …f!? ", "", " lead", "x" * 50, "tab\there", "don't…'s 'll"] * 3
    assert [x.tolist() for x in e.encode(texts)] == e.whole(texts)


def test_license_scan(spark):
    text = "All rights reserved. CC BY cc-by GNU General Public License\nALL RIGHTS RESERVED"
    rows = [(1, text), (2, None), (3, ""), (4, "Relased under the MIT Licence."), (5, "Ällrights reserved é"), (6, "permission is herby granted, free of charge to any person obtaining copy"), (7, "x " * 20000 + "cc by " * 3)]
    got = {r.doc_id: r for r in license_scan.license_summary(table(spark, rows)).collect()}
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels, got[1].score) == (14, 5, 0, 11, "cc-by,gpl,reserved", 1.0)
    assert [(got[d].n_words, got[d].n_base, got[d].first_word, got[d].labels, got[d].score) for d in (2, 3)] == [(0, 0, None, "", 0.0)] * 2
    assert got[4].labels == "mit" and got[4].base_labels == "" and 0.9 < got[4].score < 1
    assert got[5].n_words == 3 and got[6].labels == "mit" and got[7].n_base == 3 and got[7].first_word == 20000
    places = license_scan.license_places(table(spark, rows)).filter("doc_id = 4").first().places
    assert [(p.label, p.kind, p.start_word, p.n_words, p.edits) for p in places] == [("mit", "notice", 0, 5, 2)]


def test_license_scan_base_on_documents(spark):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op4_license_scan"](spark, SF).collect():
        w = word.findall((texts[r.doc_id] or "").translate(lower))
        at = [(i, label) for p, label in license_scan.BASE.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at})))


def test_license_seeds_lose_no_notice():
    """Edited notices in random words: the seeds' windows against the pattern over the whole text."""
    rng = random.Random(13)
    letters = "abcdefghijklmnop qrstuvwxyz"
    found = 0
    for _ in range(400):
        words = [rng.choice(["the", "license", "granted", "of", "free", "under", "mit", "cc", "by", "xq", "use"]) for _ in range(rng.randrange(30))]
        _, notice, edits = rng.choice(license_scan.NOTICES)
        text = list(notice)
        for _ in range(rng.randrange(edits + 2)):
            at = rng.randrange(len(text))
            text[at : at + 1] = rng.choice(([], [rng.choice(letters)], [text[at], rng.choice(letters)]))
        at = rng.randrange(len(words) + 1)
        whole = " ".join([*words[:at], "".join(text), *words[at:]]).encode()
        body = b" ".join(whole.lower().translate(license_scan.SPACED).split())
        every = {label for label, n, e in license_scan.NOTICES if license_scan.matcher(n, e).search(body)}
        got = {p[0] for p in license_scan.scan(whole)[1] if p[1] == "notice"}
        assert got == every
        found += bool(every)
    assert found > 200


def test_license_scan_of_long_texts_is_linear():
    import time

    began = time.time()
    words, places = license_scan.scan(b"cc by " * 100_000)
    assert words == 200_000 and sum(p[1] == "base" for p in places) == 100_000
    license_scan.scan(b"thelicense" * 100_000)
    assert time.time() - began < 20


def test_quality_counts(spark):
    rows = [*corpus(4), (200, "a#*$ b\na#*$ b\n\n \n x&|<>% " + "r s t " * 30)]
    word, three = re.compile(r"[^\x20\x09-\x0D]+"), {}
    model = quality_rules.Model(None)
    for r in quality_rules.judge(table(spark, rows), model).collect():
        t = dict(rows)[r.doc_id] or ""
        w = word.findall(t)
        three = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        repeat = {i + k for i in range(len(w) - 2) if three[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if word.search(x)]
        expected = (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeat))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (len(w) < 50 or 100 * len(repeat) > 50 * len(w)) and r.kept == (not r.base_failed)


def align_brute(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (2 if x == y else -1), row[j + 1] - 1, new[j] - 1))
        row, best = new, max(best, *new)
    return best


def test_alignment():
    import numpy as np

    rng = random.Random(7)
    for _ in range(60):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 12))] for _ in range(2))
        assert decontaminate.align(np.array(a), np.array(b))[0] == align_brute(a, b)


def test_leaks(spark):
    rng = random.Random(9)
    item = [f"w{i}" for i in range(40)]
    edited = [w if rng.random() > 0.2 else "zz" for w in item]
    dropped = [w for w in item if rng.random() > 0.15]
    noise = [f"n{i}" for i in range(200)]
    rows = [(1, " ".join(noise[:80] + item + noise[80:])), (2, " ".join(noise[:50] + edited)), (3, " ".join(dropped).upper()), (4, " ".join(noise)), (5, None), (6, ""), (7, " ".join(item[:6] + noise)), (1, " ".join(item)), (None, " ".join(item))]
    bench = spark.createDataFrame([(10, " ".join(item)), (11, "too short"), (12, None), (13, " ".join(item[::-1]))], "item_id long, text string")
    found = decontaminate.leaks(table(spark, rows), bench).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in found) == [("1", 10), ("1", 10), ("2", 10), ("3", 10), ("None", 10)]
    whole = next(r for r in found if r.doc_id == 1 and r.start_word == 80)
    assert (whole.score, whole.end_word) == (1.0, 120)
    kept = decontaminate.drop_leaks(table(spark, rows), bench)
    assert kept.columns == table(spark, []).columns and sorted(r.doc_id for r in kept.collect()) == [4, 5, 6, 7]
    assert decontaminate.leaks(table(spark, rows), bench.limit(0)).count() == 0


@pytest.mark.parametrize("hits", [1, 1 << 20])
def test_leaks_against_every_alignment(spark, monkeypatch, hits):
    """Every document with every item: substituted and inserted words, many edited copies of one item."""
    monkeypatch.setattr(decontaminate, "HITS", hits)
    rng = random.Random(21)
    items = [[f"i{k}w{i}" for i in range(length)] for k, length in enumerate((15, 24, 40, 59))]
    rows, noise = [(0, ""), (1, None)], iter(range(10**6))
    for d in range(2, 150):
        item = items[d % 4] if d % 3 else items[3]
        copy = []
        for w in item:
            copy += [f"n{next(noise)}"] * (rng.random() < 0.15)  # one more word
            copy.append(f"n{next(noise)}" if rng.random() < 0.35 else w)
        rows.append((d, " ".join([*(f"n{next(noise)}" for _ in range(rng.randrange(40))), *copy, *(f"n{next(noise)}" for _ in range(rng.randrange(40)))])))
    item = items[2]
    spread = item[:14] + [f"n{next(noise)}" for _ in range(30)] + item[14:40]
    rows += [(200, " ".join(spread)), (201, " ".join(item[:3])), (202, " ".join(item[:4] + [f"n{next(noise)}" for _ in range(40)]))]
    threes = lambda w: {tuple(w[i : i + 3]) for i in range(len(w) - 2)}
    expected = {}
    for d, t in rows:
        for k, item in enumerate(items):
            words = (t or "").split()
            score = align_brute(item, words) / (2 * len(item))
            if len(threes(item) & threes(words)) >= 2 and score >= 0.4:
                expected[d, k] = score
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    assert {(r.doc_id, r.item_id): r.score for r in decontaminate.leaks(table(spark, rows), bench).collect()} == expected and len(expected) > 40


PAGES = {
    "plain": ("<html><body><nav><a>Home</a></nav><article><h1>Title</h1><p>First &amp; <b>bold</b>\n text.</p><p>Be.</p></article><footer>&copy; x</footer></body></html>", "Title\nFirst & bold text.\nBe."),
    "divs": ("<body><div class='menu'>One Two</div><div id=content><p>A long paragraph of words that says something at length here.</p><p>Short.</p></div><div class=sidebar>links links links</div><div class='comments'><p>A reader says a lot of words in this very long comment, too.</p></div></body>", "A long paragraph of words that says something at length here.\nShort."),
    "forms": ("<article><form><p>Your mail address please</p></form><script>var a='</p>'</script><style>p{}</style><p>Text<br>more&nbsp;text</p><aside>side</aside><div class='cookie-notice'>We use cookies</div></article>", "Text more text"),
    "unclosed": ("<article><p>one<p>two<ul><li>x<li>y</ul>", "one\ntwo\nx\ny"),
    "no names": ("<body><div><div><a>Start</a></div><div><a>News</a></div><div><a>Map</a></div></div><div><h2>A heading</h2><p>A long paragraph with many words that tells us something about the matter at hand, at length.</p><p>So.</p><p>Another long paragraph with many words, so that the ratios alone say where the content of this page lies.</p></div><div><b>Site</b> <i>of</i> <b>us</b></div></body>", "A heading\nA long paragraph with many words that tells us something about the matter at hand, at length.\nSo.\nAnother long paragraph with many words, so that the ratios alone say where the content of this page lies."),
    "anchors": ("<body class='has-sidebar'><nav>x</nav><main class='no-comments'><h2 id='related'>Related work</h2><p class='legal'>The law of the land says a lot about things like these, and so do we.</p><section id='search'><p>A search begins with a question, and ends with more of them than before.</p></section><div id='comments'><p>First! A reader has some words to say on this as well.</p></div></main><div>Unnamed words that are about as long as a line of the article itself is.</div></body>", "Related work\nThe law of the land says a lot about things like these, and so do we.\nA search begins with a question, and ends with more of them than before."),
    "two": ("<article class='post social'><p>" + "The first of two articles is long. " * 9 + "</p></article><article><p>The second one is short, but is an article too.</p></article>", " ".join(["The first of two articles is long."] * 9) + "\nThe second one is short, but is an article too."),
    "dense block": ("<article><p>Some words of an article that go on for a while, as they do.</p><div class='notice'><p>" + "A notice that is the story itself and goes on and on. " * 12 + "</p></div><p>And more words of an article that go on for a while.</p></article>", "Some words of an article that go on for a while, as they do.\n" + " ".join(["A notice that is the story itself and goes on and on."] * 12) + "\nAnd more words of an article that go on for a while."),
    "empty": ("", ""), "no text": ("<html><nav>menu</nav></html>", ""),
}


def test_html(spark):
    rows = [(i, f"u{i}", h) for i, (h, _) in enumerate(PAGES.values())] + [(99, None, None)]
    got = {r.page_id: r.text for r in html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{i: t for i, (_, t) in enumerate(PAGES.values())}, 99: ""}


def test_html_on_pages(spark):
    import html as lib

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in QUERIES["op2_html_text"](spark, SF).collect():
        body = pages[r.page_id].split("<article>")[1].split("</article>")[0].replace("<br>", " ")
        blocks = [" ".join(lib.unescape(re.sub("<[^>]+>", "", x)).split()) for x in re.split("</?(?:p|h1)>", body)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


ARTICLE = "<article><h1>News</h1><p>" + "A long paragraph of the article goes here and on. " * 4 + "</p>{}<p>" + "Another long paragraph of the article goes here. " * 4 + "</p></article>"
AROUND = "<body><div class='ad'>Buy this thing now and here.</div><nav><a>Home</a></nav>{}<div class='share-bar'>Tell all your friends.</div><footer>imprint</footer></body>"


@pytest.mark.parametrize("name", ["divs", "forms", "no names", "anchors", *(f"around {n}" for n in ("plain", "two", "dense block"))])
def test_html_is_chosen_by_ratios(monkeypatch, name):
    """With flat ratios the text is another one, on every page that holds more than its content."""
    html, text = PAGES[name.removeprefix("around ")]
    html = AROUND.format(html) if name.startswith("around") else html
    assert html_text.main_text(html) == text
    monkeypatch.setattr(html_text, "smoothed", lambda r, sigma: r * 0 + 1)
    assert html_text.main_text(html) != text


def test_html_ratios_decide_on_given_pages(spark, monkeypatch):
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    texts = [html_text.main_text(h) for h in pages]
    monkeypatch.setattr(html_text, "smoothed", lambda r, sigma: r * 0 + 1)
    assert sum(html_text.main_text(h) != t for h, t in zip(pages, texts, strict=True)) > len(pages) / 2


@pytest.mark.parametrize(("block", "lines"), [
    ("<div class='share-price'><p>Price: 4 euro</p></div>", ["Price: 4 euro"]), ("<dl class='search-terms'><dt>Term</dt><dd>Its meaning</dd></dl>", ["Term", "Its meaning"]), ("<p>Be.</p>", ["Be."]),
    ("<ul><li><a href=a>First source</a></li><li><a href=b>Second source</a></li></ul>", ["First source", "Second source"]), ("<div class='ad-box'>Buy</div>", []), ("<div class='comment-list'><p>First!</p></div>", []), ("<nav><a>x</a></nav><form>mail</form>", []),
])
def test_html_short_blocks(block, lines):
    assert html_text.main_text(AROUND.format(ARTICLE.format(block))).split("\n")[2:-1] == lines


def test_html_second_column():
    page = "<body><div class=menu>a b</div><div><div><p>" + "Some words of a column that is long enough. " * 6 + "</p><p>" + "More of it. " * 20 + "</p></div><div><p>Short second column.</p></div></div><div class=footer>imprint</div></body>"
    assert html_text.main_text(page).split("\n")[1:] == [("More of it. " * 20).strip(), "Short second column."]


@pytest.mark.parametrize("page", ["<article>" + "<div>" * 4000 + "<p>Some text that is deep inside.</p>" * 50 + "</div>" * 4000 + "</article>", "<article><ul>" + "<li><b>Some text that is deep inside." * 2000])
def test_html_deep_pages(page):
    import time

    began = time.process_time()
    assert html_text.main_text(page).count("deep inside") in (50, 2000)
    assert time.process_time() - began < 5


def test_empty_table_of_pages(spark):
    assert html_text.extract_text(spark.createDataFrame([], "page_id long, url string, html string, text string")).collect() == []


@pytest.mark.parametrize("run", [substring_dedup.substring_dedup, suffix_dedup.repeated_passages, suffix_dedup.cut_passages, near_dup.near_duplicates, near_dup.drop_near_duplicates, license_scan.license_summary])
def test_empty_tables(spark, run):
    assert run(table(spark, [])).collect() == []


def test_queries_against_sql(spark):
    import os

    import duckdb

    from wordlake.llm.queries import SQL

    c = duckdb.connect()
    p = f"{SF}/documents.parquet"
    c.sql(f"create view documents as select * from read_parquet('{p}{'/*.parquet' if os.path.isdir(p) else ''}')")
    for name, sql in SQL.items():
        df, want = QUERIES[name](spark, SF), c.sql(sql)
        cols = sorted(df.columns)
        assert sorted(want.columns) == cols
        assert sorted(tuple(str(r[x]) for x in cols) for r in df.collect()) == sorted(tuple(str(dict(zip(want.columns, r, strict=True))[x]) for x in cols) for r in want.fetchall()), name


def test_digest_is_of_the_kept_words():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_near_duplicates_leave_few_shuffle_files(spark):
    """The files of finished steps and rounds go while the job still runs."""
    import time

    def shuffles():
        top = spark.conf.get("spark.local.dir")
        return {n.split("_")[1] for _, _, names in os.walk(top) for n in names if n.startswith("shuffle_")}

    words = [f"w{i}" for i in range(60)]
    docs = table(spark, [(i, " ".join(words[i % 7 : 50 + i % 7])) for i in range(40)])
    before = shuffles()
    found = near_dup.near_duplicates(docs)
    for _ in range(50):
        if len(left := shuffles() - before) <= 12:
            break
        time.sleep(0.2)
    assert len(left) <= 12
    assert found.count() == 40


def test_freed_memory_is_given_back():
    import re

    import pyarrow as pa

    from wordlake.llm.common import pieces

    def resident():
        with open("/proc/self/smaps_rollup") as f:
            return int(re.search(r"Rss:\s+(\d+)", f.read())[1]) // 1024

    held = [b"x" * 100_000 for _ in range(2000)]
    last = held[-1]
    del held
    before = resident()
    batch = pa.record_batch([pa.array(["a b", None])], names=["text"])
    assert sum(p.num_rows for p in pieces(iter([batch]), "text", 1)) == 2
    assert before - resident() > 100 and len(last) == 100_000


def test_components_take_few_tasks(spark):
    """The driver keeps what it knows of each task: a round is one join, not three."""
    rng = random.Random(3)
    nodes = list(range(400))
    rng.shuffle(nodes)
    edges = spark.createDataFrame(list(zip(nodes, nodes[1:])), "leaf long, hub long").repartition(7)
    sc, held = spark.sparkContext, spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sc.setJobGroup("components", "")
    try:
        got = near_dup.components(edges)
        tracker = sc.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup("components") for s in tracker.getJobInfo(j).stageIds}
        tasks = sum(i.numTasks for i in map(tracker.getStageInfo, stages) if i and i.numCompletedTasks)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", held)
    assert sorted(map(tuple, got.collect())) == [(i, 0) for i in range(1, 400)]
    assert tasks <= 200, tasks


def test_counts_of_a_sample_stand_once(spark):
    """The sample's table is the driver's largest: no wider copy of it is held beside it, and what is left is given back."""
    import tracemalloc

    import numpy as np

    from wordlake.llm.training import hashed_counts

    rng = np.random.RandomState(3)
    keys = [rng.randint(0, 4096, n) for n in rng.randint(0, 300, 700)]
    tracemalloc.start()
    got = hashed_counts(iter(keys), 4096)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    plain = np.array([np.sqrt(np.bincount(k, minlength=4096)) for k in keys], np.float32)
    plain = plain / np.maximum(np.sqrt((plain * plain).sum(1, keepdims=True)), 1e-9)
    assert (got == plain).all() and got.dtype == np.float32
    assert peak < 2.5 * got.nbytes
