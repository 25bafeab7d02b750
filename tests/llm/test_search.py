"""Operators 11 to 13 against brute force, and texts whose polynomial hashes agree."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.test_exact import table
from wordlake.llm import decontaminate, hard_negatives, lexical_search, near_dup, ngram_join, quality_rules, suffix_dedup


def thue_morse():
    """Two words of 1,024 letters that a polynomial hash modulo 2**64 cannot tell apart."""
    word = "a"
    for _ in range(10):
        word += word.translate({97: 98, 98: 97})
    return word, word.translate({97: 98, 98: 97})


def test_words_of_one_polynomial_hash(spark):
    a, b = thue_morse()
    got = {r.doc_id: (r.component_id, r.kept) for r in near_dup.near_duplicates(table(spark, [(1, a), (2, b), (3, a)])).collect()}
    assert got == {1: (1, True), 2: (2, True), 3: (1, False)}
    assert {r.doc_id: r.component_id for r in ngram_join.jaccard_components(table(spark, [(1, a), (2, b), (3, a)])).collect()} == {1: 1, 2: 2, 3: 1}
    assert int(quality_rules.describe([f"{a} x y {b} x y".encode()], False)[0][0, 4]) == 0
    assert int(quality_rules.describe([f"{a} x y {a} x y".encode()], False)[0][0, 4]) == 6
    rest = " ".join(f"w{i}" for i in range(49))
    assert suffix_dedup.repeated_passages(table(spark, [(1, f"{a} {rest}"), (2, f"{b} {rest}")])).collect() == []
    assert [(r.doc_id, r.n_words) for r in suffix_dedup.repeated_passages(table(spark, [(1, f"{a} {rest}"), (2, f"{a} {rest}")])).collect()] == [(2, 50)]
    item = spark.createDataFrame([(1, f"{a} {a} {a} {a}")], "item_id long, text string")
    assert decontaminate.leaks(table(spark, [(1, f"{b} {b} {b} {b}")]), item).collect() == []


def links_brute(rows, shingle, percent):
    """component_id per (doc_id, text) by comparing all pairs."""
    def elements(t):
        w = (t or "").lower().split()
        return frozenset(tuple(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))) if w else frozenset()

    sets = [elements(t) for _, t in rows]
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                top[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return sorted((str(d), len(sets[i]), str(least[root(i)])) for i, (d, _) in enumerate(rows))


def near_copies(seed, n=150):
    rng = random.Random(seed)
    bases = [[f"w{rng.randrange(3000)}" for _ in range(rng.choice((1, 2, 4, 9, 10, 11, 12, 20, 40, 120, 700)))] for _ in range(25)]
    rows = []
    for i in range(n):
        t = list(rng.choice(bases))
        for _ in range(rng.choice((0, 0, 1, 1, 2, 3)) * max(1, len(t) // 60)):
            k = rng.randrange(len(t))
            t[k : k + rng.choice((0, 1))] = [f"x{rng.randrange(5000)}"]
        if rng.random() < 0.1:
            t = t + t[: len(t) // 20]
        rows.append((i, rng.choice((" ", "\n", "\t ")).join(t)))
    return [*rows, (200, None), (201, ""), (202, " \n"), (203, "One Word"), (204, "one word"), (205, "a b c a b c a b"), (206, "a b c a b c a b c a b"), (7, "another text of this id"), (7, rows[7][1]), (None, rows[3][1]), (None, "alone here"), (None, None)]


@pytest.mark.parametrize(("seed", "shingle", "percent"), [(1, 3, 90), (2, 3, 90), (3, 2, 80), (4, 1, 95)])
def test_join_against_all_pairs(spark, seed, shingle, percent):
    rows = near_copies(seed)
    got = ngram_join.jaccard_components(table(spark, rows), shingle, percent).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == links_brute(rows, shingle, percent)


def test_join_of_a_large_block(spark, monkeypatch):
    """A group around the threshold in many small shares and rounds; stars alone do not settle it."""
    monkeypatch.setattr(ngram_join, "SHARE", 16)
    monkeypatch.setattr(ngram_join, "ROUNDS", (1, 3, 1 << 62))
    rng = random.Random(5)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(150):
        t = list(base)
        for k in rng.sample(range(100), rng.choice((1, 2, 3, 4, 5))):
            t[k] = f"y{rng.randrange(400)}"
        rows.append((i, " ".join(t)))
    want = links_brute(rows, 1, 93)
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_join.jaccard_components(table(spark, rows), 1, 93).collect()) == want
    assert 3 < len({c for _, _, c in want}) < 150


def test_cells_of_sets_with_empty_groups():
    """Sets of the similarity share a cell, also where most groups are empty."""
    import numpy as np

    rng = np.random.RandomState(3)
    for n in (1, 5, 9, 10, 11, 19, 20, 60, 300):
        for _ in range(60):
            a = np.unique(rng.randint(0, 1 << 62, n).astype(np.uint64))
            unlike = int(ngram_join.most_unlike(np.array([len(a)]), 90)[0])
            drop = min(unlike // 2, len(a) - 1)
            b = np.unique(np.concatenate([a[drop:], rng.randint(0, 1 << 62, drop).astype(np.uint64)]))
            if 100 * len(np.intersect1d(a, b)) < 90 * len(np.union1d(a, b)):
                continue
            of, keys = ngram_join.cell_keys(np.concatenate([a, b]), np.array([len(a), len(b)]), 90)
            assert set(keys[of == 0].tolist()) & set(keys[of == 1].tolist())


def test_tree_finds_what_the_bound_leaves():
    import numpy as np

    rng = np.random.RandomState(1)
    points = rng.poisson(3, (700, 16)).astype(np.int32)
    points[300:] = np.maximum(0, points[:400] + rng.randint(-1, 2, (400, 16)) * (rng.rand(400, 16) < 0.2))
    sizes = points.sum(1)
    tree = ngram_join.Tree(points, sizes)
    for i in range(0, 700, 23):
        common = np.minimum(points, points[i]).sum(1)
        want = np.flatnonzero((100 * common >= 90 * (sizes + sizes[i] - common)) & (100 * np.minimum(sizes, sizes[i]) >= 90 * np.maximum(sizes, sizes[i])))
        at, bound = tree.near(points[i], int(sizes[i]), 90)
        assert set(want.tolist()) <= set(at.tolist()) and (bound == common[at]).all()


def vectors(seed, n=400, dim=6):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = [rng.gauss(0, 0.3) for _ in range(dim)]
        if i % 11 == 3:
            v = rows[i - 1][1] if rows[i - 1][1] else v
        rows.append((i, v, rng.randrange(4)))
    rows += [(500, None, 1), (501, [0.1] * dim, None), (502, [0.1] * (dim - 1) + [None], 1), (503, [float("nan")] * dim, 1), (504, [float("inf")] * dim, 2), (600, [0.0] * dim, 1), (None, [0.4] * dim, 1), (700, [0.2, 0.1], 1), (701, [0.3, 0.1], 1), (702, [0.25, 0.1], 2), rows[5], rows[5], (5, [0.5] * dim, 2), (800, [3e5] * dim, 3), (801, [2.9e5] * dim, 3), (802, [2.6e5] * dim, 0)]
    return rows


def negatives_brute(rows, every):
    last = 1 << 63
    fine = [(i, tuple(math.floor(256 * x) for x in v), c) for i, v, c in rows if v is not None and c is not None and all(x is not None and math.isfinite(x) for x in v)]
    fine = sorted(set(fine), key=lambda r: (r[0] is None, r[0] or 0, r[2], r[1]))
    out = []
    for anchor in fine:
        if anchor[0] is None or anchor[0] % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(anchor[1], r[1], strict=True)), last if r[0] is None else r[0], r[2] == anchor[2]) for r in fine if r != anchor and len(r[1]) == len(anchor[1]))
        for s, i, _ in [x for x in scored if x[2]][:5]:
            hard = [x for x in scored if not x[2] and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(anchor[0], None if i == last else i, k + 1, None if n == last else n, -s, -t) for k, (t, n, _) in enumerate(hard)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1 << 14, 60])
def test_hard_negatives_against_all_scores(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block)
    rows = vectors(4)
    df = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "vec_id long, embedding array<double>, label int, block int, score double")
    got = hard_negatives.hard_negatives(df, "vec_id % 20 = 0").collect()
    want = negatives_brute(rows, 20)
    key = lambda r: (r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score)
    assert sorted(map(key, got), key=str) == want and len(want) > 100
    assert hard_negatives.hard_negatives(df.limit(0)).collect() == []


def test_tree_skips_nodes():
    """Clustered points: a search reads a part of them, and what it finds is what all scores give."""
    import numpy as np

    rng = np.random.RandomState(2)
    centres = np.round(rng.randn(40, 8) * 200)
    points = np.round(centres[rng.randint(0, 40, 6000)] + rng.randn(6000, 8) * 4)
    labels = rng.randint(0, 3, 6000)
    tree = hard_negatives.CoverTree(np.arange(6000), labels, np.arange(6000), points)
    read = []
    for i in range(20):
        anchor = {"vector": points[i], "label": labels[i], "row": i, "vec_id": i}
        scores = (points @ points[i]).astype(int)
        take = hard_negatives.scores_of
        hard_negatives.scores_of = lambda p, v, m: read.append(len(p)) or take(p, v, m)
        try:
            found = hard_negatives.positives_in(tree, anchor, 5)
        finally:
            hard_negatives.scores_of = take
        same = sorted((-scores[j], j) for j in range(6000) if labels[j] == labels[i] and j != i)[:5]
        assert [(-s, j) for s, j, _ in found] == same
        low, high = sorted((int(scores.mean()), int(scores.max() * 0.9)))
        inside = sorted((-scores[j], j) for j in range(6000) if labels[j] != labels[i] and low <= scores[j] <= high)[:5]
        assert [(-s, j) for s, j, _ in hard_negatives.negatives_in(tree, anchor, [(low, high)], 5)[0]] == inside
    assert sum(read) < 20 * 6000 / 4


TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def ranks_brute(docs, items, k):
    words = [TERM.findall((t or "").translate(LOWER)) for _, t in docs]
    n_docs, n_terms = sum(map(bool, words)), sum(map(len, words))
    out = []
    for item, text in sorted(set(items), key=str):
        scored = {}
        for term in set(TERM.findall((text or "").translate(LOWER))):
            df = sum(term in w for w in words)
            if not df:
                continue
            w = math.floor(1000 * math.log((2.0 * n_docs + 2) / (2 * df + 1)))
            for d, own in enumerate(words):
                if tf := own.count(term):
                    m = 50 + 50 * len(own) * n_docs // n_terms
                    scored[d] = scored.get(d, 0) + w * (1000000000 * tf // (1000 * tf + 20 * m))
        best = sorted((-s, docs[d][0] is None, docs[d][0] or 0, d) for d, s in scored.items() if s > 0)[:k]
        out += [(item, r + 1, docs[d][0], -s) for r, (s, _, _, d) in enumerate(best)]
    return sorted(out, key=str)


@pytest.mark.parametrize(("shard", "block", "k"), [(1 << 21, 128, 50), (2000, 4, 5), (300, 8, 1)])
def test_search_against_all_scores(spark, monkeypatch, shard, block, k):
    monkeypatch.setattr(lexical_search, "SHARD_POSTINGS", shard)
    monkeypatch.setattr(lexical_search, "BLOCK", block)
    monkeypatch.setattr(lexical_search, "BLOCKS_AT_ONCE", 2)
    rng = random.Random(6)
    words = [f"Wo{i}" for i in range(60)] + ["été", "ÉTÉ", "naïve", "x1", "漢字", "of", "the", "a_b", "c-d"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.choice((1, 5, 30, 80))))) for i in range(250)]
    docs += [(300, None), (301, ""), (302, " .,; "), (None, "wo0 wo1 wo1"), (3, "wo1 wo2 wo3"), docs[4], docs[4], (303, thue_morse()[0]), (304, "Wo0 " * 5000)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice((1, 3, 12))))) for i in range(25)] + [(30, None), (31, ""), (32, "zzz"), (33, "zzz wo1"), (33, "zzz wo1"), (33, "wo2"), (34, thue_morse()[1]), (None, "wo3 wo4")]
    frame = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = [(r.item_id, r.rank, r.doc_id, r.score) for r in lexical_search.search(table(spark, docs), frame, k).collect()]
    assert sorted(got, key=str) == ranks_brute(docs, items, k) and len(got) > 20


def test_search_of_empty_tables(spark):
    some, items = table(spark, [(1, "a b"), (2, None)]), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search.search(some.limit(0), items).collect() == []
    assert lexical_search.search(some, items.limit(0)).collect() == []
    assert [tuple(r) for r in lexical_search.search(some, items).select("item_id", "rank", "doc_id").collect()] == [(1, 1, 1)]
    assert ngram_join.jaccard_components(some.limit(0)).collect() == []
    assert ngram_join.jaccard_components(some.withColumn("keys", F.lit(1))).count() == 2
