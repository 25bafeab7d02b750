"""Jobs on small inputs of their own: what the driver queries do not reach."""

import json
import random

import pytest
from pyspark.sql import functions as F

from wordlake.operators import joins, lookup
from wordlake.operators.rank import global_rank
from wordlake.operators.sets import MergeRefused, verified_owner_merge
from wordlake.plans import assemble, enrich, relations, select
from wordlake.schema import ENTRIES, conform
from wordlake.sources import files, snapshots

TOOLS = "anvil chisel hammer mallet pliers rasp sander vice".split()


def entries(spark, *rows):
    """Rows of (id, word, changes) as canonical entries without gaps."""
    base = dict.fromkeys(ENTRIES) | {c: [] for c, t in ENTRIES.items() if t.startswith("array")} | {"pos": "noun", "us_phonetic": "tuːl", "sources": ["ecdict"], "scope": "{}", "frequency": 3.0, "definition": "Something to work with.", "definition_zh": "工具"}
    out = [tuple((base | {"id": i, "word": w, "normalized_word": w.lower(), "frequency_rank": i} | more)[c] for c in ENTRIES) for i, w, more in rows]
    return spark.createDataFrame(out, ", ".join(f"{c} {t}" for c, t in ENTRIES.items()))


def records(spark, *rows):
    return files.parse_dump(spark.createDataFrame([(i, r if isinstance(r, str) else json.dumps({"lang_code": "en", "pos": "noun"} | r)) for i, r in enumerate(rows)], "line long, value string"))


def test_global_rank_of_a_wide_table(spark):
    """Columns beside the order columns must not change the dealing."""
    rows = spark.range(250_000).select("id", (F.xxhash64("id") % 5000).alias("score"), F.repeat(F.lit("x"), 30).alias("wide"), F.array(F.col("id")).alias("list"))
    got = global_rank(rows, [F.desc("score"), F.asc("id")], parts=9)
    wrong = got.orderBy("rank").selectExpr("rank", "score", "id", "wide", "list[0] AS l").agg(
        F.count("*").alias("n"), F.countDistinct("rank").alias("different"), F.min("rank").alias("low"), F.max("rank").alias("high"), F.count_if((F.length("wide") != 30) | (F.col("l") != F.col("id"))).alias("odd")
    )
    assert tuple(wrong.first()) == (250_000, 250_000, 1, 250_000, 0)
    expected = {r.id: k for k, r in enumerate(sorted(rows.select("id", "score").collect(), key=lambda r: (-r.score, r.id)), 1)}
    assert all(expected[r.id] == r["rank"] for r in got.select("id", "rank").collect())


def test_assembled_ids_are_unique(spark):
    n = 30_000
    csv = spark.range(n).select(F.concat(F.lit("tool "), "id").alias("word"), F.concat(F.lit("tool "), "id").alias("key"), F.lit("n").alias("pos"), F.repeat(F.lit("d"), 20).alias("definition"), F.lit("").alias("translation"), F.lit("").alias("phonetic"), (F.col("id") % 50).cast("string").alias("frq"), F.lit("").alias("bnc"), F.col("id").alias("line"))
    got = assemble.assemble_entries(csv, records(spark, {"word": "tool 7", "senses": [{"glosses": ["the seventh"]}]})[0], spark.createDataFrame([], "key string, zipf double"))
    assert tuple(got.agg(F.count("*"), F.countDistinct("id"), F.min("id"), F.max("id")).first()) == (n, n, 1, n)


def test_dictionary_file_with_a_mark_and_quotes(spark, tmp_path):
    path = tmp_path / "tools.csv"
    path.write_text('﻿word,definition,frq\nRasp,"a ""rough"" file,\nfor wood",12\nVice,,\n', encoding="utf-8")
    got = [(r.key, r.definition, r.frq, r.oxford) for r in files.read_dictionary_csv(spark, str(path)).orderBy("line").collect()]
    assert got == [("rasp", 'a "rough" file,\nfor wood', "12", None), ("vice", None, None, None)]


def test_compressed_dump_is_dealt_out(spark, tmp_path):
    import gzip

    path = str(tmp_path / "tools.jsonl.gz")
    with gzip.open(path, "wt") as f:
        f.write("".join(json.dumps({"word": w, "lang_code": "en"}) + "\n" for w in TOOLS) + "{\n")
    rows, counts = files.read_dump_jsonl(spark, path)
    assert tuple(counts.first()) == (len(TOOLS) + 1, 1, len(TOOLS)) and rows.rdd.getNumPartitions() > 1
    assert [r.word for r in rows.orderBy("line").collect()] == TOOLS


def wordnet_file(tmp_path, seed=5):
    """Tools in random synsets as a WordNet file, and what was written."""
    rng = random.Random(seed)
    member = {w: sorted(rng.sample(range(4), 2)) for w in TOOLS}
    lines = ['<LexicalResource><Lexicon id="tools" label="Tools" version="7">']
    for i, w in enumerate(TOOLS):
        senses = "".join(f'<Sense id="{w}-{y}" synset="group-{y}" n="{n + 1}"><SenseExample>{w} in group {y}</SenseExample></Sense>' for n, y in enumerate(member[w]))
        lines.append(f'<LexicalEntry id="entry-{i}"><Lemma writtenForm="{w.title()}" partOfSpeech="n"/>{senses}</LexicalEntry>')
    lines.append('<LexicalEntry id="entry-x"><Lemma writtenForm="stray" partOfSpeech="n"/><Sense id="stray-1"/></LexicalEntry>')
    lines += [f'<Synset id="group-{y}" ili="i{y}" partOfSpeech="n"><Definition>Tools of group {y}.</Definition></Synset>' for y in range(4)]
    path = tmp_path / "tools.xml"
    path.write_text("\n".join([*lines, "</Lexicon></LexicalResource>"]), encoding="utf-8")
    return str(path), member


def test_wordnet_file(spark, tmp_path):
    path, member = wordnet_file(tmp_path)
    wn = files.read_wordnet_xml(spark, path, {"id": "tools", "version": "7"})
    with pytest.raises(ValueError, match="another release"):
        files.read_wordnet_xml(spark, path, {"id": "tools", "version": "8"})
    patch = {r.key: r for r in assemble.wordnet_patch(wn).collect()}
    assert set(patch) == set(TOOLS)  # the stray word has no synset
    for w, groups in member.items():
        assert patch[w].definition == "\n".join(f"Tools of group {y}." for y in groups) and patch[w].examples == [f"{w} in group {y}" for y in groups]
        assert sorted(patch[w].synonyms) == sorted({v.title() for v in TOOLS if v != w and set(member[v]) & set(groups)})


def test_patch_twice_is_patch_once(spark, tmp_path):
    patch = assemble.wordnet_patch(files.read_wordnet_xml(spark, wordnet_file(tmp_path)[0]))
    e = entries(spark, *[(i, w, {"definition": "" if i % 2 else "own words"}) for i, w in enumerate([*TOOLS, "other"], 1)])
    once, stats = assemble.apply_patch(e, patch)
    twice, again = assemble.apply_patch(once, patch)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect())) and once.count() == e.count()
    assert (stats.first().matched, stats.first().definition_filled) == (8, 4) and (again.first().definition_filled, again.first().synonyms_added) == (0, 0)


def test_relation_lists_stay_within_their_room(spark):
    """A row whose named list is full takes no more flat words; senses still grow."""
    full = [(f"w{i}", "x") for i in range(relations.CAP)]
    e = entries(spark, (1, "anvil", {"related_entries": full}), (2, "chisel", {"related_entries": full[:-1]}), (3, "metal tool", {}), (4, "hand tool", {}))
    link = [{"word": "metal tool"}, {"word": "hand tool"}, {"word": "unheard of"}]
    delta = relations.relation_delta(e, records(spark, *[{"word": w, "senses": [{"glosses": [f"a {w}"], "hypernyms": link}]} for w in ("anvil", "chisel", "missing")])[0])
    assert {r.id: ([x.word for x in r.related], len(r.patches)) for r in delta.collect()} == {1: ([], 1), 2: (["metal tool"], 1)}
    out, _ = relations.apply_relation_delta(e, delta, id_range=(2, 9))
    got = {r.id: r for r in out.collect()}
    assert len(got[2].related_entries) == relations.CAP and got[1].senses == [] and got[2].senses[0].relations == {"hypernyms": [x["word"] for x in link]}
    with pytest.raises(ValueError, match="unpaired_value"):
        relations.apply_relation_delta(e, delta.withColumn("related", F.transform("related", lambda x: F.struct(x["word"].alias("word"), F.lit("").alias("definition")))))


def paired_brute(words, named, candidates, build):
    """Both lists after all candidates, one by one, and the pairs taken."""
    words, named, pairs = list(words), list(named), []
    word_top, named_top = max(relations.CAP, len(words)), max(relations.CAP, len(named))
    for word, definition in candidates:
        key = word.lower()
        lacks_word = key not in {w.lower() for w in words}
        here = [d for w, d in named if w.lower() == key]
        lacks_entry = not any(here)
        if key in {w.lower() for w, _ in pairs} or (build and not lacks_word) or not (lacks_word or lacks_entry) or (lacks_entry and here):
            continue
        if (lacks_word and len(words) >= word_top) or (lacks_entry and len(named) >= named_top):
            continue
        pairs.append((word, definition))
        words += [word] * lacks_word
        named += [(word, definition)] * lacks_entry
    return words, named, pairs


def test_pairs_against_one_by_one(spark):
    """Rich-only words, entries without a definition, case variants, full lists, and no cap on candidates."""
    rng = random.Random(8)
    names = [f"tool {i}" if i % 3 == 0 else f"Tool{i}" for i in range(70)]
    known = [(100 + i, n, {"definition": "" if i % 10 == 9 else f"d{i}"}) for i, n in enumerate(names)]
    rows, dump, wanted = [], [], {}
    for i, word in enumerate(TOOLS):
        size = rng.choice((0, 3, 38, 39, 40, 41))
        words = rng.sample([*names, *(f"f{k}" for k in range(60))], size)
        named = [(n, rng.choice(("", "own", "own"))) for n in rng.sample([*names, *(f"g{k}" for k in range(60))], rng.choice((0, 5, 36, 39, 40)))]
        rows.append((i, word, {"related_words": words, "related_entries": named}))
        links = [rng.choice((str.lower, str.upper, str))(n) for n in rng.choices([*names, "unheard of", word], k=rng.choice((3, 30, 90)))]
        senses = [{"glosses": [f"sense {k}"], "hypernyms": [{"word": x} for x in links[k::2]]} for k in range(2)]
        dump.append({"word": word, "senses": senses})
        order = [x for k in range(2) for x in links[k::2]]
        defined = {n.lower(): (n, f"d{k}") for k, n in enumerate(names) if k % 10 != 9}
        wanted[i] = (words, named, [defined[x.lower()] for x in order if x.lower() in defined and x.lower() != word])
    e = entries(spark, *rows, *known)
    delta = relations.relation_delta(e, records(spark, *dump)[0])
    got = {r.id: [tuple(x) for x in r.related] for r in delta.collect()}
    assert got == {i: paired_brute(w, n, c, True)[2] for i, (w, n, c) in wanted.items()} and sum(map(len, got.values())) > 30
    # another copy of the entries, with other lists, takes what it has room for; a second time nothing
    other = entries(spark, *[(i, w, {"related_words": x["related_words"][::2] + ["mine"], "related_entries": x["related_entries"][:38] if i % 2 else x["related_entries"]}) for i, w, x in rows], *known)
    out, _ = relations.apply_relation_delta(other, delta)
    have = {r.id: (list(r.related_words), [tuple(x) for x in r.related_entries]) for r in out.filter("id < 100").collect()}
    before = {r.id: (list(r.related_words), [tuple(x) for x in r.related_entries]) for r in other.filter("id < 100").collect()}
    assert have == {i: paired_brute(*before[i], got[i], False)[:2] for i in before}
    again, stats = relations.apply_relation_delta(out, delta)
    assert stats.first().changed == 0


def test_an_edition_that_cannot_be_filled(spark):
    e = entries(spark, *[(i, w, {}) for i, w in enumerate(TOOLS, 1)])
    with pytest.raises(ValueError, match="only 8 rows"):
        select.select(e, 9, 2)
    c = select.select(e, 6, 2)  # without phrases, words fill their places
    assert {r.kind for r in c.provenance.collect()} == {"word"} and select.gate(c, e, 6)[1] == {"structural": True, "ready": True}


def test_duplicate_keys_count_once(spark):
    e = entries(spark, (1, "vice", {}), (2, "Vice", {"normalized_word": "vice"}), (3, "ｖｉｃｅ", {"normalized_word": "ｖｉｃｅ"}), (4, "rasp", {}))
    pool, refused = select.candidate_pool(e)
    assert sorted(r.id for r in pool.collect()) == [1, 4] and {(r.id, r.reason) for r in refused.collect()} == {(2, "duplicate_term_key"), (3, "duplicate_term_key")}


def test_refusals_of_the_repair(spark):
    e = entries(spark, *[(i, w, {"definition_zh": "" if i < 4 else "工具"}) for i, w in enumerate(TOOLS, 1)])
    c = select.select(e, 8, 0, 2)
    with pytest.raises(MergeRefused, match="gaps"):
        select.export_repair(e, c, 0, 2)
    fixed = e.withColumn("definition_zh", F.lit("工具"))
    deltas = select.export_repair(fixed, c, 0, 2).unionByName(select.export_repair(fixed, c, 1, 2))
    edited = e.withColumn("definition_zh", F.when(F.col("id") == 2, "别的").otherwise(F.col("definition_zh")))
    with pytest.raises(MergeRefused, match="conflict"):
        select.apply_union(edited, c, deltas, 2)
    with pytest.raises(MergeRefused, match="missing"):
        select.apply_union(e, c, deltas.filter("id <> 3"), 2)
    with pytest.raises(MergeRefused, match="identity"):
        select.refresh(e.withColumn("word", F.upper("word")), c, 2)


def test_snapshots_are_never_replaced(spark, tmp_path):
    e = entries(spark, (1, "rasp", {}))
    snapshots.write_snapshot(e, str(tmp_path / "s"))
    with pytest.raises(Exception, match="exists"):
        snapshots.write_snapshot(e, str(tmp_path / "s"))
    with pytest.raises(ValueError, match="refused"):
        snapshots.write_bundle({"entries": e}, str(tmp_path / "b"), e.select("id"))
    with pytest.raises(ValueError, match="sources"):
        conform(e.drop("sources"))
    snapshots.write_delta(e, str(tmp_path / "d"), "abc", "CC0")
    assert snapshots.read_delta(spark, str(tmp_path / "d"), "abc", "CC0").count() == 1
    with pytest.raises(ValueError, match="another source"):
        snapshots.read_delta(spark, str(tmp_path / "d"), "abd")


def test_owner_merge_refuses_other_identities(spark):
    a = spark.range(30).select("id", F.lit("w").alias("word"), F.lit(1).alias("n"))
    assert verified_owner_merge([a, a.withColumn("n", F.lit(2))], "id", ["word"], ["id", "n"]).agg(F.sum("n")).first()[0] == 45
    with pytest.raises(MergeRefused, match="identity"):
        verified_owner_merge([a, a.filter("id < 29")], "id", ["word"], ["id", "n"])


def test_ready_or_not(spark):
    e = entries(spark, *[(i, w, {"definition": "" if w == "rasp" else "A tool."}) for i, w in enumerate(TOOLS, 1)])
    report, verdict = select.gate(select.select(e, 8, 0), e, 8, phrases=0)
    assert verdict == {"structural": True, "ready": False}
    with pytest.raises(MergeRefused, match="definition 1"):
        select.assert_ready(report, verdict)
    assert {r.code for r in select.gate(select.select(e, 8, 0), e, 8, phrases=1)[0].collect()} == {"definition", "selection_counts"}


def test_fuzzy_join_against_difflib(spark):
    import difflib

    rng = random.Random(31)
    words = sorted({"".join(rng.choice("abcd") for _ in range(rng.randrange(1, 9))) for _ in range(120)})
    asked = sorted({"".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 9))) for _ in range(80)})
    known = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, rank long")
    got = {r.term: round(r.score, 9) for r in lookup.fuzzy_join(spark.createDataFrame([(t,) for t in asked], "term string"), known, cutoff=0.6).collect()}
    expected = {}
    for t in asked:
        best = max((difflib.SequenceMatcher(None, t, w).ratio() for w in words if w[0] == t[0]), default=0)
        if best >= 0.6:
            expected[t] = round(best, 9)
    assert got == expected and len(got) > 20


def test_prefixes_of_any_number_of_lengths(spark):
    long = "x" * 1300
    prefixes = spark.createDataFrame([(long[:n],) for n in range(1, 1202)] + [("",), ("y",)], "prefix string")
    got = joins.prefix_join(prefixes, spark.createDataFrame([(long, 1), ("", 2), ("z", 3)], "word string, rank long"))
    assert got.count() == 1201


def test_term_lists_of_any_length(spark):
    letters = lambda i: "".join(chr(97 + int(c)) for c in str(i))
    docs = spark.createDataFrame([(1, "\r".join(letters(i) for i in range(12_000)) + "\rA b;a  B；c\r\n")], "id long, text string")
    terms = lookup.import_terms(docs, "id", "text").first().terms
    assert len(terms) == 12_001 and terms[-1] == "a b" and terms[2] == "c"


def test_chunks_against_a_plain_loop(spark):
    rng = random.Random(8)
    texts = ["", "   ", None, "x" * 1000] + ["".join(rng.choice("ab  \n\t") for _ in range(rng.randrange(200))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {}
    for r in lookup.chunk_text(df, "id", "text", 30).orderBy("id", "pos").collect():
        got.setdefault(r.id, []).append(r.chunk)
    for i, t in enumerate(texts):
        pieces = got.get(i, [])
        assert "".join("".join(pieces).split()) == "".join((t or "").split()) and all(0 < len(p) <= 30 and p == p.strip() for p in pieces[:-1])
    assert len(got[3]) == 34 and 0 not in got and 2 not in got


def test_dictionary_responses_never_guess_a_dialect(spark):
    sounds = [{"text": "/ræsp/", "audio": ""}, {"text": "/rɑːsp/", "audio": "https://x/rasp-uk.mp3"}]
    d = enrich.dictionary_fields(spark.createDataFrame([("rasp", json.dumps([{"word": "rasp", "phonetics": sounds, "meanings": []}])), ("vice", "[]"), ("anvil", None)], "term string, response string"))
    assert {r.term: (r.us, r.uk, r.definition) for r in d.collect()} == {"rasp": ("", "rɑːsp", ""), "vice": ("", "", ""), "anvil": ("", "", "")}


def test_growing_tables_are_not_broadcast(spark):
    """However small the tables look when the plan is made: packed lists unpack to many times their size in the driver."""
    e = entries(spark, *[(i, w, {}) for i, w in enumerate(TOOLS, 1)])
    held = files.WordNet(*[spark.createDataFrame([], t) for t in (
        "entry_id string, written string, pos string, sounds array<struct<_VALUE:string,_variety:string>>, key string", "entry_id string, sense_id string, synset_id string, sense_order int, examples array<string>", "sense_id string, ord int, relation string, target string",
        "synset_id string, ili string, pos string, definitions array<struct<text:string,source_sense:string>>, examples array<string>", "synset_id string, ord int, relation string, target string",
    )])
    senses = assemble.wordnet_senses(held)
    delta = relations.relation_delta(e, records(spark, {"word": "rasp", "senses": [{"glosses": ["a file"], "hypernyms": [{"word": "vice"}]}]})[0])
    for made in (senses, assemble.wordnet_patch(held), assemble.apply_senses(e, senses), delta, relations.check_relation_delta(delta, e), relations.apply_relation_delta(e, delta)[0]):
        assert "BroadcastHashJoin" not in made._jdf.queryExecution().executedPlan().toString()


def test_terms_are_judged_once_per_row(spark):
    """One pass judges and places the rows: no second scan of the entries, no join; results as by the rules one by one."""
    named = [(i, w, {}) for i, w in enumerate([*TOOLS, "Rasp", "rasp", "x1", "two words", "\uff52asp", "x1"], 1)]
    e = entries(spark, *named).withColumn("sources", F.when(F.col("id") % 2 == 0, F.array(F.lit("kaikki"))).otherwise(F.col("sources")))
    pool, refused = select.candidate_pool(e)
    for made in (pool, refused):
        assert "Join" not in made._jdf.queryExecution().optimizedPlan().toString()
    assert pool.columns == [*ENTRIES, "term_key", "evidence", "kind"]
    kept = {r.id: (r.term_key, r.kind, r.evidence) for r in pool.collect()}
    assert kept == {**{i: (w, "word", "") for i, w in enumerate(TOOLS, 1)}, 12: ("two words", "phrase", "kaikki-entry")}
    assert {r.id: r.reason for r in refused.collect()} == {9: "duplicate_term_key", 10: "duplicate_term_key", 11: "unsupported_punctuation", 13: "duplicate_term_key", 14: "unsupported_punctuation"}


def test_wordnet_patch_where_first_and_second_senses_share_synsets(spark, tmp_path):
    """Part numbers from 750,000 on have first senses in the synsets that the second senses of the first parts are in."""
    import duckdb

    from wordlake.queries.jobs import QUERIES, SQL

    part = spark.range(40).select((F.col("id") % 20 + F.when(F.col("id") < 20, 0).otherwise(750_000)).alias("p_partkey"), F.concat(F.lit("name "), "id").alias("p_name"))
    part.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    c = duckdb.connect()
    c.sql(f"create view part as select * from read_parquet('{tmp_path}/part.parquet/*.parquet')")
    want = c.sql(f"select key, synonyms from ({SQL['wordnet_patch']})").fetchall()
    assert sorted(map(tuple, QUERIES["wordnet_patch"](spark, str(tmp_path)).select("key", "synonyms").collect())) == sorted(want)
    assert any("part 7500" in synonyms and not key.startswith("part 7500") for key, synonyms in want)


def test_selection_judges_no_more_ranks_than_it_needs(spark, monkeypatch):
    words = [f"{a} {b}" if i % 3 == 0 else f"{a}{b}" for i, (a, b) in enumerate((a, b) for a in TOOLS for b in TOOLS)]
    rows = entries(spark, *[(i + 1, w, {"frequency_rank": i // 2 + 1, "sources": ["kaikki"]}) for i, w in enumerate(words)])
    whole, _ = select.candidate_pool(rows)
    want = sorted((r["id"], r["stream_rank"]) for r in select.stream_rank(whole, "kind", [F.col("frequency_rank"), F.col("id")], 4).collect())
    judged, pool = [], select.candidate_pool
    monkeypatch.setattr(select, "candidate_pool", lambda e: (judged.append(e.count()), pool(e))[1])
    assert len(want) == 8
    assert len(select.select(rows, 4, 2).entries.collect()) == 4
    assert max(judged) <= len(words)
    for reach, counts in ((2, [4, 64]), (8, [16]), (100, [64])):
        judged.clear()
        assert sorted((r["id"], r["stream_rank"]) for r in select.first_of_kinds(rows, 4, reach).collect()) == want
        assert judged == counts


def test_relation_delta_parses_the_dump_once(spark):
    from tests.conftest import SF
    from wordlake.plans import relations
    from wordlake.queries import jobs

    delta = relations.relation_delta(*jobs.relation_inputs(spark, SF))
    assert "from_json" not in delta._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("reach", [5, 40, 10**6])
def test_frequent_terms_are_the_first_of_all(spark, monkeypatch, reach):
    """The ranks are those among all terms, ties at the bound included; pairs of rarer words are not counted."""
    from wordlake.queries import base, jobs

    docs = spark.createDataFrame([(" ".join(TOOLS[j % (1 + i % len(TOOLS))] for j in range(3 * i)).upper() + f" rare{i} {'x' * (i % 3 + 1)}",) for i in range(60)] + [(None,), ("",)], "text string")
    monkeypatch.setattr(jobs, "table", lambda *_: docs)
    ranked = lambda e: sorted((r.frequency_rank, r.word, r.definition) for r in e.select("frequency_rank", "word", "definition").collect())
    whole, some = ranked(jobs.term_entries(spark, "")), ranked(jobs.term_entries(spark, "", reach))
    assert some == whole[: len(some)] and len(some) >= min(reach, len(whole))
    found = base.frequent_terms(docs, reach).collect()
    assert reach != 5 or len(found) < base.terms(docs).count() / 2
    assert reach != 10**6 or len(some) == len(whole)


def test_selection_of_a_function_asks_no_further_than_it_needs(spark):
    words = [f"{a} {b}" if i % 3 == 0 else f"{a}{b}" for i, (a, b) in enumerate((a, b) for a in TOOLS for b in TOOLS)]
    rows = entries(spark, *[(i + 1, w, {"frequency_rank": i + 1, "sources": ["kaikki"]}) for i, w in enumerate(words)])
    asked = []
    given = lambda reach: (asked.append(reach), rows if reach is None else rows.filter(F.col("frequency_rank") <= reach + 1))[1]
    got, want = select.select(given, 4, 2), select.select(rows, 4, 2)
    assert got.entries.columns == rows.columns and asked == [64]
    assert sorted(map(str, got.entries.collect())) == sorted(map(str, want.entries.collect()))
    assert sorted(map(str, got.queue.collect())) == sorted(map(str, want.queue.collect()))
