import random

from pyspark.sql import functions as F

from wordlake.functions import collect, digest, normalize


def one(spark, column, **values):
    types = {str: "string", int: "long", float: "double", bool: "boolean"}
    schema = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else types.get(type(v), 'string')}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


def test_keys(spark):
    assert one(spark, normalize.norm_key(F.col("t")), t="  Don’t\t Go ") == "don't go"
    assert one(spark, normalize.norm_key(F.col("t"), "edge"), t="Don’t") == "don’t"
    assert one(spark, normalize.norm_key(F.col("t"), "term_key"), t="Ｕ.Ｓ.") == "u.s."
    assert one(spark, normalize.norm_key(F.col("t"), "lookup"), t=" A  b ") == "a  b"


def test_phrases(spark):
    for term, pos, expected in [("look after", "", True), ("people-to-people", "", True), ("entry", "prep_phrase", True), ("pre-", "prefix", False), ("word", "noun", False)]:
        assert one(spark, normalize.is_phrase(F.col("t"), F.col("p")), t=term, p=pos) is expected, term


def test_lexical_reasons(spark):
    none = F.lit(None).cast("string")
    cases = [("u.s.", "abbreviation", None), ("people-to-people", "", None), ("as of...", "", "ellipsis"), ("pre-", "prefix", "affix"), ("c--", "", "invalid_hyphen"), ("c'", "", "unsupported_punctuation"), ("students'", "", None), ("b", "", "single_letter_noise"), ("a", "", None), ("", "", "invalid_length"), ("a b c d e f g h i", "", "too_many_tokens")]
    rows = spark.createDataFrame(cases, "t string, p string, e string")
    got = rows.select("t", "e", normalize.lexical_reason(F.col("t"), F.col("p"), F.array(F.lit("kaikki")), none, none).alias("r")).collect()
    assert all(r["r"] == r["e"] for r in got), got


def test_phonetics_and_bands(spark):
    assert one(spark, normalize.normalize_phonetic(F.col("t")), t="/wә:d'/") == "wəːdˈ"
    assert [one(spark, normalize.phonetic_unreliable(F.col("t")), t=t) for t in ("W ER1 D", "w�rd", "", "wɜːd")] == [True, True, True, False]
    assert [one(spark, normalize.difficulty_band(F.col("t")), t=t) for t in (6.0, 5.0, 3.4, 1.0)] == ["A1–A2", "B1–B2", "C1–C2", "C2+"]
    assert [one(spark, normalize.frequency_corrupt(F.col("t")), t=t) for t in ("", "3.2", "11", "x")] == [False, False, True, True]


def test_translation_rule(spark):
    rule = normalize.needs_translation(F.col("s"), F.col("t"))
    copied = "one two three four five six seven eight nine"
    for s, t, expected in [("", "", False), ("a word", "", True), ("word", "word", True), (copied, "中文 " + copied, True), ("uses CSS on an iPhone", "在 iPhone 上使用 CSS", False), ("a", "中�", True), ("x " * 80, "短", True)]:
        assert one(spark, rule, s=s, t=t) is expected, (s, t)


def test_gaps(spark):
    gaps = normalize.quality_gaps(*[F.col(c) for c in ("w", "d", "z", "us", "uk", "p")])
    assert one(spark, gaps, w="look after", d="to care for", z="照顾", us="", uk="", p="") == []
    assert one(spark, gaps, w="word", d="a unit", z="词", us="", uk="", p="") == ["pos", "phonetic"]


def test_ordered_lists_against_a_loop(spark):
    rng = random.Random(3)
    rows = [(g, i, rng.choice([" a", "a ", "b  c", "", "d", "e f", "  "])) for g in range(30) for i in range(12)]
    got = spark.createDataFrame(rows, "g long, o long, v string").groupBy("g").agg(collect.collect_ordered(F.col("v"), F.col("o"), cap=3).alias("x")).collect()
    for r in got:
        seen = []
        for g, _, v in rows:
            v = " ".join(v.split())
            if g == r["g"] and v and v not in seen and len(seen) < 3:
                seen.append(v)
        assert r["x"] == seen


def test_fold_and_appends(spark):
    assert one(spark, collect.fold_text(F.col("v")), v=["a\nb", "c\nd", "e"]) == "a b c d\ne"
    assert one(spark, collect.append_capped(F.col("a"), F.col("b"), 4), a=["x", "x"], b=["x", "y", "y", "z", "w"]) == ["x", "x", "y", "z"]
    named = spark.sql("select array(struct('A' as word, 'short' as definition)) a, array(struct('a' as word, 'a longer one' as definition), struct('b' as word, '' as definition)) b")
    assert [tuple(x) for x in named.select(collect.merge_named(F.col("a"), F.col("b")).alias("x")).first()["x"]] == [("A", "a longer one")]


def test_digests(spark):
    import hashlib

    assert one(spark, digest.row_digest(F.col("a"), F.col("b")), a="xy", b=7) == hashlib.sha256(b"2:xy1:7").hexdigest()
    t = spark.range(5000)
    a = digest.table_digest(t, "id", digest.row_digest(F.col("id")), 100, 10).first()
    b = digest.table_digest(t.repartition(7), "id", digest.row_digest(F.col("id")), 100, 10).first()
    c = digest.table_digest(t.filter("id <> 77"), "id", digest.row_digest(F.col("id")), 100, 10).first()
    assert a == b and a["n_rows"] == 5000 and a["digest"] != c["digest"]


def test_shards(spark):
    ids = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "id long")
    assert sorted(r[0] for r in normalize.shard_filter(ids, "id", 1, 2).collect()) == [3, 4]
    assert sorted(r[0] for r in normalize.shard_filter(ids, "id", 1, 2, "owner").collect()) == [1, 3]
    wide = spark.range(3, 80)
    parts = [{r[0] for r in normalize.shard_filter(wide, "id", i, 7).collect()} for i in range(7)]
    assert sum(map(len, parts)) == 77 and set.union(*parts) == set(range(3, 80))


def test_references_as_the_standard_library_decodes_them(spark):
    import html
    import random

    from wordlake.functions.references import decoded

    rng = random.Random(3)
    names = sorted(html.entities.html5)
    pieces = ["&", "&;", "&#;", "&#x;", "&#xZ;", "a b", "AT&T", "&amp;amp;", "&notit;", "&noti;", "&unknown;", "&ampx", "é&eacute"]
    rows = [(i, "".join(rng.choice((f"&{rng.choice(names)}", f"&#{rng.randrange(70000)};", f"&#x{rng.randrange(1 << 21):x}", f"&#{rng.randrange(300)}", rng.choice(pieces), " ")) for _ in range(6))) for i in range(700)]
    rows += [(9000 + i, f"&#{i};") for i in range(200)] + [(9900, "&#x110000;&#99999999999999999999;&#xFFFFFFFFFFFFF;&#0000000000000000065;"), (9901, None), (9902, "")]
    got = {r.i: r.t for r in spark.createDataFrame(rows, "i int, t string").select("i", decoded(F.col("t")).alias("t")).collect()}
    wrong = {t: (got[i], html.unescape(t)) for i, t in rows if t is not None and got[i] != html.unescape(t) and not any(0xD800 <= ord(c) < 0xE000 for c in html.unescape(t))}
    assert not wrong and got[9901] is None


def test_fold_text_is_the_plain_fold_and_linear(spark):
    import random
    import time

    from pyspark.sql import functions as F

    from wordlake.functions.collect import fold_text

    def plain(values):
        text = ""
        for v in values:
            item, line = " ".join((v or "").split()), " ".join(text.split())
            text = line if item in ("", line) else f"{line}\n{item}" if line else item
        return text

    rng = random.Random(3)
    rows = [[rng.choice(["a", "b", "a b", "b a", "a a", "a b a", "a a a", "ü", " ", None, "a  b a b"]) for _ in range(rng.randint(0, 9))] for _ in range(1500)]
    rows += [["x"] * 50, [], [None], ["a", "a", "b", "a b", "a b", "", "c", "a b c", "d"], ["a", "b", ""]]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v array<string>")
    found = dict(df.select("i", fold_text(F.col("v"))).collect())
    assert [found[i] for i in range(len(rows))] == [plain(r) for r in rows]

    def seconds(n):
        began = time.time()
        spark.range(1).select(F.length(fold_text(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit("some definition of this number "), i.cast("string")))))).collect()
        return time.time() - began

    seconds(100)
    assert seconds(20_000) < 5
