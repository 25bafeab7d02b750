import pytest
from pyspark.sql import functions as F

from wordlake.operators import aggregates, joins, lookup, rank, sets


def test_global_rank_equals_a_sort(spark):
    df = spark.range(500).withColumn("v", F.col("id") * 7919 % 101)
    got = {r["id"]: r["rank"] for r in rank.global_rank(df, [F.desc("v"), F.asc("id")], parts=5).collect()}
    order = sorted(range(500), key=lambda i: (-(i * 7919 % 101), i))
    assert got == {i: n + 1 for n, i in enumerate(order)}


@pytest.mark.parametrize(("limit", "phrases"), [(7, 2), (10, 5), (20, 1), (9, 9), (13, 0), (200, 37)])
def test_interleave_is_dense_and_even(spark, limit, phrases):
    rows = [("phrase", k) for k in range(1, limit + 1)] + [("word", k) for k in range(1, limit + 1)]
    df = spark.createDataFrame(rows, "kind string, stream_rank long")
    got = sorted((r["selected_rank"], r["kind"]) for r in rank.interleave(df, F.col("kind") == "phrase", limit, phrases).collect())
    assert [n for n, _ in got] == list(range(1, limit + 1))
    assert [n for n, k in got if k == "phrase"] == [n for n in range(1, limit + 1) if n * phrases // limit > (n - 1) * phrases // limit]


def test_choose_counts():
    assert rank.choose_counts(5, 1, 4, 8) == (4, 1)
    assert rank.choose_counts(20000, 5000, 20000, 5000, 15000) == (15000, 5000)
    with pytest.raises(ValueError, match="at least 15000 words"):
        rank.choose_counts(20000, 6000, 20000, 6000, 15000)


def test_zigzag(spark):
    got = {r["id"]: r["slot"] for r in rank.zigzag(spark.range(5), [F.desc("id")]).collect()}
    assert got == {4: 0, 0: 1, 3: 2, 1: 3, 2: 4}


def test_runs_and_breaks(spark):
    df = spark.createDataFrame(list(enumerate("aabba")), "o long, k string").withColumn("s", F.lit(1))
    assert [r["run"] for r in rank.run_id(df, ["k"], ["s"], [F.col("o")]).orderBy("o").collect()] == [1, 1, 2, 2, 3]
    df = spark.createDataFrame([("w", 1, 5), ("w", 2, 4), ("w", 3, 9)], "kind string, p long, r long")
    assert [r["p"] for r in rank.order_breaks(df, "kind", "p", "r").collect()] == [2]


def test_dedupe(spark):
    df = spark.createDataFrame([("k", 1, "aa"), ("k", 2, "bbb"), ("k", 3, "ccc")], "k string, line long, d string")
    assert aggregates.dedupe(df, ["k"], F.col("line")).first()["d"] == "aa"
    assert aggregates.dedupe(df, ["k"], F.col("line"), "longest", F.length("d")).first()["d"] == "bbb"


def test_checks(spark):
    ok = spark.createDataFrame([(1, "a"), (2, "b")], "r long, w string")
    assert aggregates.check_dense_rank(ok, "r").count() == 0 and aggregates.check_unique(ok, ["r", "w"]).count() == 0
    bad = spark.createDataFrame([(1, "a"), (3, "a")], "r long, w string")
    assert aggregates.check_dense_rank(bad, "r").count() == 1
    assert [r["code"] for r in aggregates.check_unique(bad, ["r", "w"]).collect()] == ["w"]


def test_progress(spark):
    shards = spark.createDataFrame([(0, 40, 9000, "v"), (1, 55, 9999, "v")], "shard int, finished long, complete long, version string")
    r = aggregates.progress_rollup(shards, 2, ["finished", "complete"], ["version"]).first()
    assert (r["finished"], r["complete"], r["consistent"]) == (95, 18999, True)
    assert not aggregates.progress_rollup(shards.withColumn("version", F.col("shard").cast("string")), 2, ["finished"], ["version"]).first()["consistent"]


def test_lookup(spark):
    entries = spark.createDataFrame([("apple", 1), ("application", 2), ("banana", 3), ("berry", 4)], "word string, rank long")
    terms = spark.createDataFrame([("apple",), ("appl",), ("banama",), ("zzz",), ("b%",)], "term string")
    got = {r["term"]: (r["word"], r["kind"]) for r in lookup.lookup(terms, entries).collect()}
    assert got == {"apple": ("apple", "exact"), "appl": ("apple", "prefix"), "banama": ("banana", "fuzzy"), "zzz": (None, "missing"), "b%": (None, "missing")}


def test_prefix_join_plan_has_no_nested_loop(spark):
    entries = spark.createDataFrame([("apple", 1)], "word string, rank long")
    plan = joins.prefix_join(spark.createDataFrame([("ap",)], "prefix string"), entries)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_links(spark):
    links = spark.createDataFrame([("k", 2, "b", None), ("k", 1, "a", "own"), ("k", 3, "b", "late"), ("k", 4, "c", None)], "key string, ord long, word string, definition string")
    entries = spark.createDataFrame([("b", "from entries")], "key string, definition string")
    assert [tuple(x) for x in joins.resolve_links(links, entries).first()["links"]] == [("a", "own"), ("b", "from entries")]


def test_chunks_round_trip():
    text = " ".join(f"segment-{i:04d}" for i in range(1500))
    parts = lookup.chunks(text, 480)
    assert len(parts) > 32 and all(1 <= len(p) <= 480 for p in parts) and " ".join(parts) == text
    assert lookup.chunks("x" * 1000, 480) == ["x" * 480, "x" * 480, "x" * 40] and lookup.chunks(None, 5) == []


def test_title_variants(spark):
    df = spark.createDataFrame([("people-to-people",), ("pre-",)], "t string")
    got = [r["v"] for r in df.select(lookup.title_variants(F.col("t")).alias("v")).collect()]
    assert got == [["people-to-people", "people to people"], ["pre-"]]


def test_html_text(spark):
    pages = spark.createDataFrame([("<p>A &amp; <script>x('</p>')</script>B<!-- c -->&amp;lt;</p>",), (None,)], "html string")
    # the rule decodes what the parser has decoded once more, and tags leave nothing behind
    assert [r[0] for r in pages.select(lookup.html_text("html")).collect()] == ["A & B<", ""]


def test_strict_html_text_leaves_broken_references(spark):
    pages = spark.createDataFrame([("<p>A&amp</p><p>&amp;&am</p>&#65;&#65 &amp;lt; &copy&copy;",)], "html string")
    assert pages.select(lookup.html_text("html", lenient=False)).first()[0] == "A&amp&&amA&#65 &lt; &copy©"


def rows(spark, *values):
    return spark.createDataFrame(values, "id long, a string, b string")


def test_shard_merge(spark):
    e = rows(spark, (1, "x", "y"), (2, "x", "y"), (3, "x", "y"))
    out = sets.merge_shards(e, [rows(spark, (1, "p", None)), rows(spark, (3, "q", "r"))], "id", ["a", "b"])
    assert sorted(map(tuple, out.collect())) == [(1, "p", None), (2, "x", "y"), (3, "q", "r")]
    with pytest.raises(sets.MergeRefused, match="overlap"):
        sets.merge_shards(e, [rows(spark, (1, "p", "p")), rows(spark, (1, "q", "r"))], "id", ["a"])
    with pytest.raises(sets.MergeRefused, match="unknown"):
        sets.merge_shards(e, [rows(spark, (999, "p", "p"))], "id", ["a"])


def test_three_way(spark):
    base, central = rows(spark, (1, "old", "old"), (2, "old", "old")), rows(spark, (1, "old", "newer"), (2, "other", "old"))
    delta = rows(spark, (1, "fixed", "x"), (2, "fixed", "x")).withColumn("changed_columns", F.array(F.lit("a")))
    got = {r["id"]: (r["a"], r["b"], r["conflicts"]) for r in sets.three_way(base, delta, central, "id", ["a", "b"]).collect()}
    assert got == {1: ("fixed", "newer", []), 2: ("fixed", "old", ["a"])}


def test_exact_union(spark):
    expected = spark.createDataFrame([(i,) for i in range(1, 6)], "id long")
    deltas = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 0), (4, 0), (9, 1)], "id long, owner int")
    got = {(r["code"], r["example"]) for r in sets.check_exact_union(expected, deltas, "id", "owner", 2).collect()}
    assert got == {("wrong_owner", "3"), ("overlap", "4"), ("extra", "9"), ("missing", "5")}


def test_chunks_need_no_python(spark):
    """The expression equals the plain loop on odd white space, long words, characters of four bytes and empty texts; its plan calls no Python."""
    import random

    rng = random.Random(5)
    signs = " \n\t\r  　\x1c\x85​" + "abé中\U0001f600" * 4
    texts = [None, "", " \n ", "x" * 25, " a" * 30, "\U0001f600" * 23, *("".join(rng.choice(signs) for _ in range(rng.randrange(90))) for _ in range(400))]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    for limit in (1, 7, 10):
        found = lookup.chunk_text(df, "i", "t", limit)
        assert sorted(map(tuple, found.collect())) == [(i, n, c) for i, t in enumerate(texts) for n, c in enumerate(lookup.chunks(t, limit))]
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
