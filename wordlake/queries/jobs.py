"""Queries that run the library's jobs on sources, editions, deltas and responses made from the given tables.

The tables hold no dictionary files or provider responses, so each query turns rows of parts,
documents, conversations or events into such input and sends all of it through the job.
"""

from __future__ import annotations

import html

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordlake.functions import collect, normalize
from wordlake.operators import aggregates, joins, lookup, rank
from wordlake.operators.lineage import cut_lineage, fresh_path
from wordlake.plans import assemble, contract, enrich, relations, select
from wordlake.queries.base import LEXICON_SQL, TOKENS_SQL, frequent_terms, lexicon, table, terms
from wordlake.schema import ENTRIES, NAMED, conform
from wordlake.sources import files, snapshots

STRINGS = "array<string>"


def pick(n: Column | str, *values: Column | str | None) -> Column:
    """The value whose place is n modulo their number."""
    out = F.lit(None).cast("string")
    for i, v in enumerate(values):
        out = F.when(F.pmod(F.col(n) if isinstance(n, str) else n, F.lit(len(values))) == i, F.lit(v) if v is None or isinstance(v, str) else v).otherwise(out)
    return out


def entries_of(df: DataFrame, **columns: Column) -> DataFrame:
    """Entries with the given columns; the others are empty."""
    base = {c: F.array().cast(t) if t.startswith("array") else F.lit(None).cast(t) for c, t in ENTRIES.items()}
    return df.select(*[columns.get(c, d).cast(ENTRIES[c]).alias(c) for c, d in base.items()])


def part_entries(spark: SparkSession, sf: str) -> DataFrame:
    """An entry per part; every third lacks a definition, every fourth a translation, every fifth a part of speech."""
    k = F.col("p_partkey")
    word = F.concat(F.lit("part "), F.translate(k.cast("string"), "0123456789", "abcdefghij"))
    return entries_of(
        table(spark, sf, "part"), id=k, word=word, normalized_word=word, frequency_rank=k + 1, frequency=F.lit(4.0), definition=F.when(k % 3 == 0, "").otherwise(F.col("p_name")),
        definition_zh=F.when(k % 4 == 0, "").otherwise("中文"), pos=F.when(k % 5 == 0, "").otherwise("noun"), sources=F.array(F.lit("kaikki")), scope=F.lit("{}"),
    )


# --- sources and snapshots


def dictionary_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as dictionary CSV (quotes and line ends inside) and read again."""
    path = fresh_path(spark, "dictionary-csv")
    docs = table(spark, sf, "documents")
    rows = docs.select(F.concat_ws("  ", F.upper("lang"), "doc_id").alias("word"), F.coalesce("text", F.lit("")).alias("definition"), F.col("source").alias("pos"))
    rows.write.csv(path, header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    back = files.read_dictionary_csv(spark, path)
    return back.select("key", "pos", F.sha2(F.regexp_replace(F.coalesce("definition", F.lit("")), r"\r\n?", "\n"), 256).alias("digest"))


#: Parts that one task writes as dump lines and parses.
SHARE = 25_000


def dealt(parts: DataFrame) -> DataFrame:
    """Parts in shares of about ``SHARE`` rows: packed they are one small file, their lines are not."""
    return parts.repartition(1 + parts.count() // SHARE, "p_partkey")


def part_records(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Parts as dump lines: every 11th is broken, every 7th of another language."""
    named = lambda *words: F.array(*[F.struct(w.alias("word")) for w in words])
    sense = F.struct(F.array(F.col("p_name")).alias("glosses"), F.array(F.struct(F.col("p_brand").alias("text"), F.when(F.col("p_size") % 2 == 0, "example").otherwise("quotation").alias("type"))).alias("examples"), named(F.lower("p_type")).alias("hypernyms"))
    record = F.struct(
        F.concat_ws(" ", "p_type", "p_size").alias("word"), F.when(F.col("p_partkey") % 7 == 0, "fr").otherwise("en").alias("lang_code"), F.lit("noun").alias("pos"), named(F.col("p_brand"), F.lit(" ")).alias("synonyms"),
        named(F.col("p_name"), F.col("p_brand")).alias("derived"), F.array(F.struct(F.concat(F.lit("s"), F.col("p_size")).alias("ipa"), F.array(F.when(F.col("p_partkey") % 2 == 0, "US").otherwise("British")).alias("tags"))).alias("sounds"), F.array(sense).alias("senses"),
    )
    lines = dealt(table(spark, sf, "part")).select(F.col("p_partkey").alias("line"), F.when(F.col("p_partkey") % 11 == 0, "{broken").otherwise(F.to_json(record)).alias("value"))
    return files.parse_dump(lines)


def dump_counts(spark: SparkSession, sf: str) -> DataFrame:
    return part_records(spark, sf)[1]


def dump_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Per key of the dump its united lists and first sounds."""
    groups = assemble.group_dump(assemble.extract_dump(part_records(spark, sf)[0]))
    lists = [F.array_join(c, "|").alias(c) for c in ("examples", "synonyms", "related_words", "phrases")]
    return groups.select("key", "pos", *lists, F.size("senses").cast("long").alias("n_senses"), "us_phonetic", "uk_phonetic")


def entries_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """A snapshot of part entries without optional columns, written, read again, and its manifest's sums."""
    path = fresh_path(spark, "snapshot")
    snapshots.write_snapshot(part_entries(spark, sf).drop("phrase_entries", "related_entries"), path, {"made": "from parts"})
    m = snapshots.read_manifest(spark, path).select("n_rows", "min_id", "max_id", F.col("provenance.made").alias("made"))
    rows = snapshots.read_entries(spark, path)
    return rows.filter(F.size("phrase_entries") == 0).agg(F.count("*").alias("read"), F.countDistinct("normalized_word").alias("words")).join(F.broadcast(m))


def bundle_and_delta(spark: SparkSession, sf: str) -> DataFrame:
    """Two tables of a bundle and one delta, written and read again: their rows."""
    c = edition(spark, sf)
    path, other = fresh_path(spark, "bundle"), fresh_path(spark, "delta")
    snapshots.write_bundle({"entries": c.entries, "provenance": c.provenance}, path)
    snapshots.write_delta(c.queue, other, "0" * 64, "CC BY-SA 4.0")
    counted = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in (*snapshots.read_bundle(spark, path).items(), ("queue", snapshots.read_delta(spark, other)))]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def term_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as text files of a few hundred rows, read as term lists: every different term."""
    path = fresh_path(spark, "term-lists")
    docs = table(spark, sf, "documents").select(F.coalesce("text", F.lit("")).alias("value"))
    docs.write.option("maxRecordsPerFile", 500).text(path)
    return files.read_term_lists(spark, path).select(F.explode("terms").alias("term")).distinct()


def report_check(spark: SparkSession, sf: str) -> DataFrame:
    """Reports per user, some negative and some that do not add up, written, read again and checked."""
    path = fresh_path(spark, "report")
    good = F.count_if(F.col("value") > 20)
    reports = table(spark, sf, "events").groupBy(F.col("user_id").alias("shard")).agg(F.count("*").alias("total"), good.alias("complete"), F.count_if(~(F.col("value") > 20)).alias("incomplete"))
    reports = reports.withColumn("complete", F.when(F.col("shard") % 9 == 0, -1).otherwise(F.col("complete"))).withColumn("total", F.when(F.col("shard") % 7 == 0, F.col("total") + 1).otherwise(F.col("total")))
    snapshots.write_report(reports, path)
    return aggregates.check_report(spark.read.json(path))


# --- row rules


def row_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Part-of-speech codes, phonetic signs and frequencies of parts by the row rules."""
    parts = table(spark, sf, "part")
    sound = F.concat(F.lit("/"), pick("p_partkey", F.col("p_name"), F.translate("p_name", "ae", "ә'"), F.concat("p_name", F.lit(":")), F.lit(""), F.lit("HH AH0 L OW1"), F.lit("''x")), F.lit("/"))
    frequency = pick("p_partkey", "", "abc", "11.5", "3.25", None, "10", "0")
    return parts.select(
        "p_partkey", normalize.map_pos(pick("p_partkey", "n", " V ", "a", "s", "r", "adverb", "x", None)).alias("pos"), normalize.normalize_phonetic(sound).alias("sound"), normalize.phonetic_unreliable(sound).alias("unreliable"),
        normalize.frequency_corrupt(frequency).alias("corrupt"),
    )


def named_union(spark: SparkSession, sf: str) -> DataFrame:
    """Per part size the (word, definition) lists of even and odd parts united: the longer definition wins."""
    item = F.struct(F.col("p_type").alias("word"), F.col("p_name").alias("definition"))
    both = table(spark, sf, "part").groupBy("p_size").agg(*[F.array_sort(F.collect_set(F.when(F.col("p_partkey") % 2 == i, item))).alias(f"l{i}") for i in (0, 1)])
    merged = collect.merge_named(F.col("l0"), F.col("l1"))
    return both.select("p_size", F.size(merged).cast("long").alias("n_words"), F.array_join(F.array_sort(F.transform(merged, lambda e: F.concat_ws("=", e["word"], F.length(e["definition"])))), "|").alias("words"))


def missing_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Which tables' columns the entries' schema lacks, as the refusal names them."""
    e = part_entries(spark, sf)
    out = None
    for name in ("definition", "pos", "sources"):
        try:
            conform(e.drop(name))
            said = ""
        except ValueError as error:
            said = str(error)
        row = e.agg(F.count("*").alias("n_rows")).select("n_rows", F.lit(name).alias("dropped"), F.lit(said).alias("refusal"))
        out = row if out is None else out.unionByName(row)
    return out


def attempt_totals(spark: SparkSession, sf: str) -> DataFrame:
    state = table(spark, sf, "events").groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("status"), F.count("*").alias("attempts"))
    return aggregates.attempt_totals(state)


def list_change_stats(spark: SparkSession, sf: str) -> DataFrame:
    """What apply_patch changed, by comparing before and after."""
    before, (after, _) = part_entries(spark, sf), patched(spark, sf)
    return aggregates.change_stats(before, after, "id", ["pos", "definition"], ["synonyms", "examples", "sources"])


def top_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The hundred best ranked part entries; those without a rank never count."""
    e = part_entries(spark, sf).withColumn("frequency_rank", F.when(F.col("id") % 6 != 0, F.col("frequency_rank")))
    return rank.top_n(e, "frequency_rank", 100, "id").select("id", "frequency_rank")


def queue_identity(spark: SparkSession, sf: str) -> DataFrame:
    """A queue with unknown ids and changed words against its entries."""
    e = part_entries(spark, sf)
    queue = e.withColumn("id", F.when(F.col("id") % 13 == 0, F.col("id") + 10_000_000).otherwise(F.col("id"))).withColumn("word", F.when(F.col("id") % 17 == 0, "other").otherwise(F.col("word")))
    return joins.identity_violations(queue, e, "id", ["word", "frequency_rank"])


def term_book(spark: SparkSession, sf: str) -> DataFrame:
    """A request list of part names and unknown ones, looked up in request order."""
    parts = table(spark, sf, "part")
    asked = parts.select(F.col("p_partkey").alias("pos"), F.when(F.col("p_partkey") % 10 == 0, F.concat(F.lit("zz"), F.col("p_partkey"))).otherwise(F.col("p_type")).alias("term"))
    known = parts.groupBy(F.col("p_type").alias("word")).agg(F.min("p_partkey").alias("rank"))
    return lookup.book(asked, known)


# --- assembly and WordNet


def scored_words(spark: SparkSession, sf: str) -> DataFrame:
    """Words of the test items scored by a frequency table of half the documents' words, else by made-up ranks."""
    words = lexicon(table(spark, sf, "benchmark")).select(F.col("word").alias("key"), pick(F.length("word"), F.lit("0"), F.length("word").cast("string"), F.lit(None)).alias("frq"), pick("n", F.lit("9"), F.lit("x")).alias("bnc"))
    zipf = lexicon(table(spark, sf, "documents")).filter("n > 20").select(F.col("word").alias("key"), F.log10(F.col("n").cast("double")).alias("zipf"))
    return assemble.score_frequency(words, zipf).select("key", F.round("score", 6).alias("score"))


def assembled(spark: SparkSession, sf: str) -> DataFrame:
    """Dictionary rows and dump records of parts assembled to ranked entries."""
    parts = table(spark, sf, "part")
    csv = parts.filter("p_partkey % 3 <> 1").select(
        F.concat_ws(" ", "p_type", "p_size").alias("word"), F.lower(F.concat_ws(" ", "p_type", "p_size")).alias("key"), F.lit("n").alias("pos"), F.when(F.col("p_size") % 2 == 0, F.col("p_name")).alias("definition"),
        F.lit("译").alias("translation"), F.lit("").alias("phonetic"), F.col("p_size").cast("string").alias("frq"), F.lit("0").alias("bnc"), F.col("p_partkey").alias("line"),
    )
    zipf = parts.groupBy(F.lower(F.concat_ws(" ", "p_type", "p_size")).alias("key")).agg(F.count("*").cast("double").alias("zipf")).filter("zipf > 10")
    return assemble.assemble_entries(csv, part_records(spark, sf)[0], zipf)


def assembled_entries(spark: SparkSession, sf: str) -> DataFrame:
    return assembled(spark, sf).select("id", "normalized_word", "frequency_rank", F.round("frequency", 6).alias("frequency"), F.array_join("sources", "+").alias("sources"), F.array_join("synonyms", "|").alias("synonyms"))


def part_wordnet(spark: SparkSession, sf: str) -> files.WordNet:
    """Parts as words with two senses each, in synsets of neighbours, and links between them."""
    parts = table(spark, sf, "part").select("p_partkey", "p_name", F.concat(F.lit("part "), F.col("p_partkey")).alias("written"))
    k = F.col("p_partkey")
    entries = parts.select(F.format_string("e%08d", k).alias("entry_id"), "written", pick(k, "n", "v").alias("pos"), F.array(F.struct(F.concat(F.lit("ˈ"), k).alias("_VALUE"), pick(k, "US", "GB", "AU").alias("_variety"))).alias("sounds"), normalize.norm_key(F.col("written")).alias("key"))
    one = lambda letter, order, synset: parts.select(F.format_string("e%08d", k).alias("entry_id"), F.format_string(f"{letter}%08d", k).alias("sense_id"), F.format_string("y%08d", synset).alias("synset_id"), F.lit(order).alias("sense_order"), F.array(F.concat_ws(" ", F.lit(letter), "p_name")).alias("examples"))
    senses = one("s", 1, F.floor(k / 3)).unionByName(one("t", 2, F.floor((k + 1_000_000) / 4)))
    sense_relations = parts.select(F.format_string("s%08d", k).alias("sense_id"), F.lit(0).alias("ord"), pick(k, "antonym", "similar", "exemplifies").alias("relation"), F.format_string("t%08d", k + 5).alias("target"))
    synset_ids = senses.select("synset_id").distinct()
    synsets = synset_ids.select("synset_id", F.lit(None).cast("string").alias("ili"), F.lit("n").alias("pos"), F.array(F.struct(F.concat(F.lit("meaning of "), F.col("synset_id")).alias("text"), F.lit(None).cast("string").alias("source_sense"))).alias("definitions"), F.array(F.col("synset_id")).alias("examples"))
    number = F.substring("synset_id", 2, 20).cast("long")
    synset_relations = synset_ids.select("synset_id", F.lit(0).alias("ord"), pick(number, "hypernym", "domain_topic").alias("relation"), F.format_string("y%08d", number + 1).alias("target"))
    return files.WordNet(entries, senses, sense_relations, synsets, synset_relations)


def wordnet_senses(spark: SparkSession, sf: str) -> DataFrame:
    return assemble.sense_rows(part_wordnet(spark, sf)).select("key", "sense_id", "synset_id", "sense_order")


RELEASE = {"id": "parts", "label": "Parts", "version": "1"}


def wordnet_xml(spark: SparkSession, sf: str, changed: bool = False) -> str:
    """Parts as WordNet XML files in a folder; with ``changed`` the same but for one letter."""
    path = fresh_path(spark, "wordnet-xml")
    k, parts = F.col("p_partkey"), table(spark, sf, "part")
    strings = lambda *c: F.array(*c).cast(STRINGS)
    relation = F.array(F.struct(F.lit("antonym").alias("_relType"), F.format_string("s%08d", k + 1).alias("_target")))
    sense = lambda letter, synset, n, shown, links: F.struct(F.format_string(f"{letter}%08d", k).alias("_id"), F.format_string("y%08d", synset).alias("_synset"), n.cast("string").alias("_n"), shown.alias("SenseExample"), links.alias("SenseRelation"))
    first = sense("s", F.floor(k / 3), F.when(k % 2 == 0, 5).otherwise(0), strings("p_name"), F.when(k % 3 == 0, relation))
    second = sense("t", F.floor(k / 4), F.lit(0), strings(), F.lit(None))
    nameless = F.struct(F.lit(None).alias("_id"), F.lit("y0").alias("_synset"), F.lit("0").alias("_n"), strings().alias("SenseExample"), F.lit(None).alias("SenseRelation"))
    senses = F.filter(F.array(F.when(k % 50 == 0, nameless), first, second), lambda x: x.isNotNull())
    sound = F.array(F.struct(F.concat(F.lit("ˈ"), k).alias("_VALUE"), F.lit("US").alias("_variety")))
    lemma = F.struct(F.concat(F.lit("part "), k).alias("_writtenForm"), F.lit("n").alias("_partOfSpeech"), sound.alias("Pronunciation"))
    entries = parts.select(F.format_string("e%08d", k).alias("_id"), lemma.alias("Lemma"), senses.alias("Sense"))
    text = F.concat(F.when(F.lit(changed) & (k == 1), "Meaning").otherwise("meaning"), F.lit(" <"), k.cast("string"), F.lit(">"))
    synsets = parts.select(F.format_string("y%08d", k).alias("_id"), F.lit("n").alias("_partOfSpeech"), F.array(text).alias("Definition"))
    root = "Lexicon " + " ".join(f'{name}="{html.escape(value)}"' for name, value in RELEASE.items())
    for rows, tag in ((entries, "LexicalEntry"), (synsets, "Synset")):
        rows.write.format("xml").options(rootTag=root, rowTag=tag, maxRecordsPerFile=5000).mode("append").save(path)
    return path


def wordnet_file(spark: SparkSession, sf: str) -> DataFrame:
    """Senses read from XML files, with relations, examples and definitions; whether files with one other letter were refused, and another release."""
    path = wordnet_xml(spark, sf)
    digest = files.file_digest(spark, path)
    wn = files.read_wordnet_xml(spark, path, RELEASE, digest)
    refused = []
    for other, release in ((wordnet_xml(spark, sf, changed=True), RELEASE), (path, RELEASE | {"version": "2"})):
        try:
            files.read_wordnet_xml(spark, other, release, digest)
            refused.append(False)
        except ValueError:
            refused.append(True)
    links = wn.sense_relations.groupBy("sense_id").agg(F.min("target").alias("target"))
    rows = assemble.sense_rows(wn).join(links, "sense_id", "left")
    return rows.select("key", "sense_id", "synset_id", "sense_order", F.array_join("examples", "|").alias("examples"), F.array_join(F.transform("definitions", lambda d: d["text"]), "|").alias("definition"), "target", F.lit(refused[0]).alias("changed_refused"), F.lit(refused[1]).alias("release_refused"))


def attempt_staleness(spark: SparkSession, sf: str) -> DataFrame:
    """The newest attempt per event type's state and its age at two times, under a limit of ten minutes."""
    state = table(spark, sf, "events").select("user_id", "event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    last = state.agg(F.max("ts")).first()[0]
    ages = [aggregates.staleness(state, ["user_id", "event_id"], "ts", F.lit(last) + F.expr(f"interval {n} seconds"), 600).select(F.lit(n).alias("after"), "user_id", "event_id", "event_type", "stale_seconds", "stale") for n in (-5, 59, 600, 601)]
    return ages[0].unionByName(ages[1]).unionByName(ages[2]).unionByName(ages[3])


def report_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Reports per user as shards, some of another version, shard or candidate, some twice: what is wrong with each."""
    digest, other = "ab" * 32, "cd" * 32
    k = F.col("shard")
    good = F.count_if(F.col("value") > 20)
    reports = table(spark, sf, "events").groupBy(F.col("user_id").alias("shard")).agg(F.count("*").alias("total"), good.alias("complete"), F.count_if(~(F.col("value") > 20)).alias("incomplete"))
    reports = reports.withColumns({"version": F.when(k % 4 == 0, 1).otherwise(2), "digest": F.when(k % 5 == 0, other).when(k % 7 == 0, "AB").otherwise(digest), "finished": F.when(k % 3 == 0, F.col("total") + 5).when(k % 3 == 1, -1).otherwise(F.col("complete"))})
    twice = reports.unionByName(reports.filter(k % 6 == 0))
    wrong = aggregates.check_report(twice, 2, digest, 40).groupBy(F.col("example").cast("long").alias("shard")).agg(F.array_join(F.array_sort(F.collect_set("code")), "|").alias("codes"))
    return aggregates.clamped(reports).select("shard", "finished", "percent").join(wrong, "shard", "left")


def wordnet_sense_links(spark: SparkSession, sf: str) -> DataFrame:
    return assemble.sense_links(part_wordnet(spark, sf)).select("key", "relation", "target_key", "target_definition")


def wordnet_synset_links(spark: SparkSession, sf: str) -> DataFrame:
    return assemble.synset_links(part_wordnet(spark, sf)).select("key", "sense_id", "relation", "target_key", "target_definition")


def wordnet_synonyms(spark: SparkSession, sf: str) -> DataFrame:
    return assemble.synonyms(part_wordnet(spark, sf)).select("key", "synset_id", "target_key")


def wordnet_patch(spark: SparkSession, sf: str) -> DataFrame:
    patch = assemble.wordnet_patch(part_wordnet(spark, sf), target_order=False)
    return patch.select("key", "pos", "definition", F.array_join("examples", "|").alias("examples"), "us_phonetic", "uk_phonetic", F.array_join("synonyms", "|").alias("synonyms"), F.array_join("antonyms", "|").alias("antonyms"), F.size("related_entries").cast("long").alias("n_related"))


def wordnet_sense_patch(spark: SparkSession, sf: str) -> DataFrame:
    """Senses of WordNet with their typed relations, as the entries will hold them."""
    s = assemble.wordnet_senses(part_wordnet(spark, sf))
    typed = F.array_join(F.transform(F.map_entries(F.coalesce("sense.relations", F.create_map().cast("map<string,array<string>>"))), lambda e: F.concat_ws("=", e["key"], F.array_join(e["value"], "/"))), "|")
    json = lambda path: F.get_json_object("sense.extra", path)
    return s.select("key", "synset", "pos", json("$.order").cast("int").alias("place"), F.array_join("sense.definitions", "|").alias("definition"), typed.alias("relations"), F.coalesce(json("$.examples[0]"), F.lit("")).alias("example"), F.coalesce(json("$.synonyms"), F.lit("[]")).alias("synonyms"))


def patched_senses(spark: SparkSession, sf: str) -> DataFrame:
    """Entries with senses of their own, some of WordNet's already, and open keys: after the patch, and after a second one."""
    # stored: both patches and the entries' own senses are taken from them
    senses = cut_lineage(assemble.wordnet_senses(part_wordnet(spark, sf)))
    k = F.col("id")
    own = F.struct(F.lit("noun").alias("pos"), F.array(F.lit("own")).alias("definitions"), F.lit(None).cast(STRINGS).alias("sense_ids"), F.lit(None).cast("map<string,array<string>>").alias("relations"), F.lit(None).cast("map<string,array<string>>").alias("relation_sources"), F.lit('{"custom":{"a":[1,2]}}').alias("extra"))
    held = senses.filter("place.sense_order = 1").select("key", F.array("sense").cast(ENTRIES["senses"]).alias("held"))
    e = part_entries(spark, sf).withColumn("normalized_word", F.concat(F.lit("part "), k)).withColumn("scope", F.when(k % 4 == 0, F.lit('{"flag":{"x":1}}')).when(k % 4 == 1, F.lit("broken")).otherwise(F.lit(None)))
    e = e.join(joins.unbroadcast(held), F.col("normalized_word") == F.col("key"), "left").withColumn("senses", F.when(k % 3 == 0, F.array(own)).when(k % 3 == 1, F.coalesce("held", F.array().cast(ENTRIES["senses"]))).otherwise(F.array().cast(ENTRIES["senses"])))
    e = e.select(*ENTRIES)
    said = ("oewn", '{"license":"CC BY 4.0"}')
    once = cut_lineage(assemble.apply_senses(e, senses.filter("key <> 'part 7'"), provenance=said))
    twice = assemble.apply_senses(once, senses.filter("key <> 'part 7'"), provenance=said)
    forms = F.array_join(F.transform("senses", lambda x: F.coalesce(F.get_json_object(x["extra"], "$.synset"), F.get_json_object(x["extra"], "$.custom.a"))), "|")
    return once.select("id", forms.alias("senses"), "scope").join(joins.unbroadcast(twice.select("id", F.size("senses").alias("n_again"))), "id")


def patched(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Part entries with a patch for every second one."""
    e = part_entries(spark, sf)
    one = lambda *values: F.array(*[F.lit(v) if isinstance(v, str) else v for v in values])
    patch = e.filter("id % 2 = 0").select(
        F.col("normalized_word").alias("key"), F.lit("verb").alias("pos"), F.lit("ˈx").alias("us_phonetic"), F.lit("").alias("uk_phonetic"), F.concat(F.lit("patched "), F.col("word")).alias("definition"),
        one("a", "b", "a").alias("synonyms"), F.array().cast(STRINGS).alias("antonyms"), one(F.col("word")).alias("examples"), F.array().cast(STRINGS).alias("phrases"), F.array().cast(STRINGS).alias("related_words"),
    )
    return assemble.apply_patch(e, patch)


def patched_entries(spark: SparkSession, sf: str) -> DataFrame:
    return patched(spark, sf)[0].select("id", "pos", "definition", F.array_join("synonyms", "|").alias("synonyms"), F.array_join("examples", "|").alias("examples"), F.array_join("sources", "|").alias("sources"))


def patch_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """The dry run: what the patch would change."""
    return patched(spark, sf)[1].select("n_rows", "matched", "pos_filled", "definition_filled", "synonyms_added", "examples_added", "conflicts_kept")


def finalized(spark: SparkSession, sf: str) -> DataFrame:
    """Entries ranked anew by frequency, the best 500 as an edition with its counts."""
    e = part_entries(spark, sf).withColumn("frequency", (F.col("id") * 37 % 101) / 10.0).withColumn("enrichment", F.when(F.col("id") % 3 == 0, '{"status":"completed"}').when(F.col("id") % 3 == 1, '{"status":"partial"}'))
    edition_rows, counts = assemble.finalize(e, 500)
    return edition_rows.select("id", "frequency_rank").join(F.broadcast(counts))


# --- relation deltas


def relation_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Part entries with one sense, and dump records that relate each part to its neighbours."""
    k = F.col("p_partkey")
    e = part_entries(spark, sf).drop("senses").join(joins.unbroadcast(table(spark, sf, "part").select(k.alias("id"), "p_type")), "id")
    sense = F.struct(F.lit("noun").alias("pos"), F.array("p_type").alias("definitions"), F.lit(None).cast(STRINGS).alias("sense_ids"), F.lit(None).cast("map<string,array<string>>").alias("relations"), F.lit(None).cast("map<string,array<string>>").alias("relation_sources"), F.lit(None).cast("string").alias("extra"))
    e = e.withColumn("senses", F.array(sense)).select(*ENTRIES)
    word = lambda n: F.concat(F.lit("part "), F.translate(n.cast("string"), "0123456789", "abcdefghij"))
    link = lambda n: F.array(F.struct(word(n).alias("word")))
    # the same sense for odd parts, another one for even ones
    s = F.struct(F.array(F.when(k % 2 == 1, F.col("p_type")).otherwise("another sense")).alias("glosses"), link(k + 1).alias("hypernyms"), F.when(k % 4 == 0, link(k + 2)).alias("alt_of"))
    lines = dealt(table(spark, sf, "part")).select(k.alias("line"), F.to_json(F.struct(word(k).alias("word"), F.lit("en").alias("lang_code"), F.lit("noun").alias("pos"), F.array(s).alias("senses"))).alias("value"))
    return e, files.parse_dump(lines)[0]


def relation_senses(spark: SparkSession, sf: str) -> DataFrame:
    """Senses of the dump with relations: per key the fields and their words."""
    senses = relations.relation_senses(relation_inputs(spark, sf)[1])
    return senses.select("key", F.array_join("definitions", "|").alias("definitions"), F.explode("relations").alias("field", "words")).withColumn("words", F.array_join("words", "|"))


def relation_delta(spark: SparkSession, sf: str) -> DataFrame:
    """What the entries lack: flat words with a definition, and the sense that takes the relations."""
    delta = relations.relation_delta(*relation_inputs(spark, sf))
    p = F.get("patches", F.lit(0))
    return delta.select("id", F.array_join(F.transform("related", lambda x: F.concat_ws("=", x["word"], x["definition"])), "|").alias("related"), F.size("patches").cast("long").alias("n_patches"), p["index"].cast("long").alias("sense"), F.length(p["fingerprint"]).cast("long").alias("n_fingerprint"))


def relation_applied(spark: SparkSession, sf: str) -> DataFrame:
    """Entries with the delta, and the statistics of this and of a second run (which changes nothing)."""
    e, records = relation_inputs(spark, sf)
    # stored, as a delta is: it is checked and applied twice
    delta = cut_lineage(relations.relation_delta(e, records))
    once, stats = relations.apply_relation_delta(e, delta)
    once = cut_lineage(once)
    _, again = relations.apply_relation_delta(once, delta)
    return stats.select("n_rows", "changed", "related_added").join(F.broadcast(again.select(F.col("changed").alias("changed_again"))))


def relation_capacity(spark: SparkSession, sf: str) -> DataFrame:
    """Parts that name three neighbours in several cases, while their lists are full, hold rich entries only, or entries without a definition."""
    e, k = part_entries(spark, sf), F.col("id")
    word = lambda n: F.concat(F.lit("part "), F.translate(n.cast("string"), "0123456789", "abcdefghij"))
    filler = lambda n, c: F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit(c), i.cast("string")))
    flat = F.when(k % 5 == 0, filler(39, "w")).when(k % 5 == 1, filler(38, "w")).otherwise(F.array().cast(STRINGS))
    own = F.array(F.when(k % 4 == 0, F.struct(F.upper(word(k + 1)).alias("word"), F.lit("own").alias("definition"))).when(k % 4 == 1, F.struct(word(k + 1).alias("word"), F.lit(" ").alias("definition"))))
    named = F.concat(F.filter(own, lambda x: x.isNotNull()), F.when(k % 7 == 0, F.transform(filler(39, "e"), lambda w: F.struct(w.alias("word"), F.lit("x").alias("definition")))).otherwise(F.array().cast(NAMED)))
    e = e.withColumns({"related_words": flat, "related_entries": named})
    links = F.array(*[F.struct(x.alias("word")) for x in (F.upper(word(k + 1)), word(k), word(k + 2), F.initcap(word(k + 1)), F.upper(word(k + 4)), word(k + 2))])
    sense = F.struct(F.array(F.lit("a part")).alias("glosses"), links.alias("hypernyms"))
    lines = e.select(k.alias("line"), F.to_json(F.struct("word", F.lit("en").alias("lang_code"), F.lit("noun").alias("pos"), F.array(sense).alias("senses"))).alias("value"))
    delta = cut_lineage(relations.relation_delta(e, files.parse_dump(lines)[0]))
    once = cut_lineage(relations.apply_relation_delta(e, delta)[0])
    again = relations.apply_relation_delta(once, delta)[1].select(F.col("changed").alias("changed_again"), F.col("related_added").alias("again"))
    sizes = once.select("id", F.size("related_words").alias("n_words"), F.size("related_entries").alias("n_entries"))
    pairs = delta.select("id", F.array_join(F.transform("related", lambda x: F.concat_ws("=", x["word"], x["definition"])), "|").alias("related"))
    return sizes.join(joins.unbroadcast(pairs), "id", "left").join(F.broadcast(again))


def relation_violations(spark: SparkSession, sf: str) -> DataFrame:
    """A delta with unknown ids, other keys and moved senses, checked."""
    e, records = relation_inputs(spark, sf)
    delta = relations.relation_delta(e, records)
    bad = delta.withColumn("key", F.when(F.col("id") % 10 == 1, "other").otherwise(F.col("key"))).withColumn("id", F.when(F.col("id") % 10 == 3, F.col("id") + 10_000_000).otherwise(F.col("id")))
    moved = e.withColumn("senses", F.when(F.col("id") % 10 == 5, F.array().cast(ENTRIES["senses"])).otherwise(F.col("senses")))
    return aggregates.rejections(relations.check_relation_delta(bad, moved), "code")


# --- the edition and its gate


def term_entries(spark: SparkSession, sf: str, reach: int | None = None) -> DataFrame:
    """Words and word pairs that stand twice or more in the documents, as ranked entries; with ``reach``
    the first of them, up to that rank at least."""
    docs = table(spark, sf, "documents")
    found = (terms(docs) if reach is None else frequent_terms(docs, reach)).filter("n > 1")
    ranked = rank.global_rank(found, [F.desc("n"), F.asc("term")])
    k = F.col("rank")
    return entries_of(
        ranked, id=k, word=F.col("term"), normalized_word=F.when(k % 50 == 0, "other").otherwise(F.col("term")), frequency_rank=k, frequency=F.lit(4.0), definition=F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("seen "), F.col("n"))),
        definition_zh=F.when(k % 9 == 0, "").otherwise("中文"), pos=F.when(k % 11 == 0, "").otherwise("noun"), us_phonetic=F.lit("x"), sources=F.when(k % 40 == 0, F.array().cast(STRINGS)).when(F.col("kind") == "phrase", F.when(k % 6 == 0, F.array(F.lit("web"))).otherwise(F.array(F.lit("kaikki")))).otherwise(F.array(F.lit("ecdict"))), scope=F.lit("{}"),
    )


def pool_of_terms(spark: SparkSession, sf: str) -> DataFrame:
    return select.candidate_pool(term_entries(spark, sf))[0].select("id", "kind", "term_key", "evidence")


def refused_terms(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.rejections(select.candidate_pool(term_entries(spark, sf))[1])


EDITION_ROWS, EDITION_PHRASES, SHARDS = 600, 120, 3


def edition(spark: SparkSession, sf: str, entries: DataFrame | None = None) -> select.Candidate:
    """The edition of the entries; its three bounded tables are stored, as a candidate is."""
    c = select.select((lambda reach: term_entries(spark, sf, reach)) if entries is None else entries, EDITION_ROWS, EDITION_PHRASES, SHARDS)
    return select.Candidate(cut_lineage(c.entries), cut_lineage(c.provenance), cut_lineage(c.queue))


def edition_provenance(spark: SparkSession, sf: str) -> DataFrame:
    return edition(spark, sf).provenance.select("id", "selected_rank", "kind", "term_key", "canonical_rank")


def edition_queue(spark: SparkSession, sf: str) -> DataFrame:
    return edition(spark, sf).queue.select("id", "frequency_rank", "owner", F.array_join("gaps", "|").alias("gaps"))


def edition_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Words and phrases of the edition, and its rows whose canonical rank lies beyond its size."""
    c = edition(spark, sf)
    counts = c.provenance.groupBy("kind").agg(F.count("*").alias("n"))
    return counts.join(F.broadcast(select.backfilled_beyond(c, EDITION_ROWS)))


def changed_canonical(entries: DataFrame) -> DataFrame:
    """The entries of a later day: some translated, some renamed, some gone."""
    out = entries.withColumn("definition_zh", F.when(F.col("id") % 8 == 0, "新").otherwise(F.col("definition_zh"))).filter("id % 29 <> 0")
    return out.withColumn("word", F.when(F.col("id") % 31 == 0, F.concat("word", F.lit("x"))).otherwise(F.col("word")))


def edition_gate(spark: SparkSession, sf: str) -> DataFrame:
    """What the gate says of the edition against the entries of a later day, and of a queue with wrong owners."""
    e = term_entries(spark, sf)
    c = edition(spark, sf, e)
    wrong = c.queue.withColumn("owner", F.when(F.col("id") % 5 == 0, (F.col("owner") + 1) % SHARDS).otherwise(F.col("owner")))
    report, verdict = select.gate(select.Candidate(c.entries, c.provenance, wrong), changed_canonical(e), EDITION_ROWS, SHARDS, EDITION_PHRASES)
    return report.select("code", "n", F.lit(verdict["structural"]).alias("structural"))


def edition_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """The edition's rows of owner 1 with the translations of a later day, and the queue that is left."""
    e = term_entries(spark, sf)
    c = edition(spark, sf, e)
    later = e.withColumn("definition_zh", F.when(F.col("id") % 8 == 0, "新").otherwise(F.lit("中文")))
    new = select.refresh(later, c, SHARDS, owner=1)
    gaps = new.queue.select("id", F.array_join("gaps", "|").alias("gaps"))
    return new.entries.select("id", "frequency_rank", "definition_zh").join(gaps, "id", "left")


def owner_preflight(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of owner 2 that changed without being queued, or are gone; queued ones carry their marker."""
    e = term_entries(spark, sf)
    marked = contract.with_marker(changed_canonical(e), "of this test", F.pmod(F.col("id"), F.lit(SHARDS)))
    return select.preflight_owner(marked, edition(spark, sf, e), "of this test", SHARDS, 2)


def edition_internal(spark: SparkSession, sf: str) -> DataFrame:
    """What an edition with changed words, lost provenance and broken JSON says against itself."""
    c = edition(spark, sf)
    e = c.entries.withColumn("scope", F.when(F.col("id") % 8 == 0, "{broken").otherwise(F.col("scope"))).withColumn("pos", F.when(F.col("id") % 5 == 0, "verb").otherwise(F.col("pos")))
    report = aggregates.issue_rollup(select.internal_violations(select.Candidate(e, c.provenance.filter("id % 13 <> 0"), c.queue), EDITION_ROWS, SHARDS, EDITION_PHRASES))
    return report.select("code", "n")


def queue_flags(spark: SparkSession, sf: str) -> DataFrame:
    """The edition's rows with their kind and whether they are queued."""
    c = edition(spark, sf)
    flags = select.with_queue_flag(c.provenance, c.queue).select("id", "queued")
    return select.with_provenance(c.entries, c.provenance.filter("id % 13 <> 0")).select("id", "kind").join(flags, "id")


def repaired(spark: SparkSession, sf: str) -> tuple[select.Candidate, DataFrame, DataFrame]:
    """The edition, its entries, and the deltas of all owners that fill every gap."""
    e = term_entries(spark, sf)
    c = edition(spark, sf, e)
    fixed = e.withColumn("definition", F.when(F.col("definition") == "", "filled").otherwise(F.col("definition"))).withColumn("definition_zh", F.lit("中文")).withColumn("pos", F.lit("noun"))
    deltas = [select.export_repair(fixed, c, i, SHARDS) for i in range(SHARDS)]
    return c, e, cut_lineage(deltas[0].unionByName(deltas[1]).unionByName(deltas[2]))


def repair_deltas(spark: SparkSession, sf: str) -> DataFrame:
    return repaired(spark, sf)[2].select("id", "owner", F.array_join("changed_columns", "|").alias("changed"))


def repair_check(spark: SparkSession, sf: str) -> DataFrame:
    """Deltas with rows missing, twice, of wrong owners, or with gaps left."""
    c, _, deltas = repaired(spark, sf)
    bad = deltas.filter("id % 10 <> 0").withColumn("owner", F.when(F.col("id") % 10 == 1, (F.col("owner") + 1) % SHARDS).otherwise(F.col("owner"))).withColumn("definition", F.when(F.col("id") % 10 == 3, "").otherwise(F.col("definition")))
    return select.check_union(c, bad.unionByName(bad.filter("id % 10 = 2")), SHARDS)


def repair_applied(spark: SparkSession, sf: str) -> DataFrame:
    c, e, deltas = repaired(spark, sf)
    return select.apply_union(e, c, deltas, SHARDS).select("id", "definition", "definition_zh", "pos")


def shard_exports(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of a contiguous shard, exported once all are finished; another that has to wait."""
    mine = select.export_shard(part_entries(spark, sf), 1, 4)
    done = select.export_if_ready(mine, F.lit(True), ["pos", "definition"])
    waits = select.export_if_ready(mine, F.col("id") % 2 == 0, ["pos"])
    return done[1].withColumn("said", F.lit(done[0])).withColumn("other", F.lit(waits[0]))


# --- provider responses


def responses(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Parts as landed responses of a dictionary and of an association service."""
    parts, k = table(spark, sf, "part").withColumn("term", F.concat(F.lit("part "), F.col("p_partkey"))), F.col("p_partkey")
    definition = F.struct(F.col("p_name").alias("definition"), F.col("p_type").alias("example"), F.array(F.col("p_brand")).alias("synonyms"), F.array().cast(STRINGS).alias("antonyms"))
    meaning = F.struct(pick(k, "noun", "verb").alias("partOfSpeech"), F.array(F.lit("same"), F.col("p_brand")).alias("synonyms"), F.array(F.lit("other")).alias("antonyms"), F.array(definition, definition).alias("definitions"))
    sound = F.struct(F.concat(F.lit("/s"), k, F.lit("/")).alias("text"), pick(k, "a-us.mp3", "b-uk.mp3", "").alias("audio"))
    word = F.struct("term", F.array(sound).alias("phonetics"), F.array(meaning).alias("meanings"))
    dictionary = parts.select("term", F.when(k % 5 == 0, "{}").otherwise(F.to_json(F.array(word))).alias("response"))
    item = lambda w: F.struct(w.alias("word"), F.array(F.concat(F.lit("n\t"), F.col("p_type"))).alias("defs"), F.array(F.lit("n"), F.concat(F.lit("ipa_pron:x"), k), F.concat(F.lit("f:"), F.col("p_size"))).alias("tags"))
    association = parts.select("term", F.to_json(F.array(item(F.lit("neighbour")), item(F.col("term")))).alias("response"))
    return dictionary, association


def provider_fields(spark: SparkSession, sf: str) -> DataFrame:
    dictionary = enrich.dictionary_fields(responses(spark, sf)[0])
    return dictionary.select("term", "definition", "pos", "us", "uk", *[F.array_join(c, "|").alias(c) for c in ("examples", "synonyms", "antonyms")])


def association_fields(spark: SparkSession, sf: str) -> DataFrame:
    a = enrich.association_fields(responses(spark, sf)[1], exact="term")
    return a.select("term", "definition", "pos", "phonetic", F.round("frequency", 6).alias("frequency"), F.array_join("words", "|").alias("words"))


def combined_fields(spark: SparkSession, sf: str) -> DataFrame:
    dictionary, association = responses(spark, sf)
    c = enrich.combine_fields(enrich.dictionary_fields(dictionary), enrich.association_fields(association, exact="term"), "term")
    return c.select("term", "definition", "pos", "us", "uk")


def merged_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    """Part entries filled by fields for every second one."""
    e = part_entries(spark, sf)
    new = e.filter("id % 2 = 0").select("id", F.lit("found").alias("definition"), F.array(F.lit("s"), F.lit("t")).alias("synonyms"), (F.col("id") % 8).cast("double").alias("frequency"))
    return enrich.merge_enrichment(e, new, "id").select("id", "definition", F.array_join("synonyms", "|").alias("synonyms"), "frequency", "difficulty", F.array_join("filled", "|").alias("filled"))


def part_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Part entries some of which have phonetics, lists, examples, or a frequency on another scale; every sixth is a phrase."""
    e, k = part_entries(spark, sf), F.col("id")
    filled = lambda n, c: F.when(k % n == 0, F.array(F.lit("x"))).otherwise(F.col(c))
    lists = {c: filled(n, c) for c, n in (("synonyms", 2), ("antonyms", 3), ("phrases", 5), ("related_words", 7), ("examples", 4))}
    term = F.when(k % 6 == 0, F.col("word")).otherwise(F.replace(F.col("word"), F.lit(" "), F.lit("")))
    return e.withColumns({**lists, "term": term, "us_phonetic": F.when(k % 8 == 1, "wɜːd").when(k % 8 == 2, "W ER1 D"), "uk_phonetic": F.when(k % 8 == 3, "wɜːd"), "frequency": F.when(k % 9 == 0, 250.0).otherwise(F.col("frequency"))})


def work_plan(spark: SparkSession, sf: str) -> DataFrame:
    """What each row asks for by what it lacks, in a deep pass, and the requests that come of it; the same for repairs alone."""
    rows = part_rows(spark, sf)
    needs, repairs = enrich.plan_needs(rows, deep=True), enrich.plan_needs(rows, deep=True, repair_only=True)
    asked = enrich.request_plan(needs).withColumnRenamed("requests", "all").join(enrich.request_plan(repairs, repair_only=True).withColumnRenamed("requests", "repair"), "term")
    flags = ["definition", "translation", "pos", "us_phonetic", "examples", "frequency", *enrich.DEEP_LISTS, "relations", "network"]
    return needs.select("term", *flags).join(asked.select("term", F.array_join("all", "|").alias("requests"), F.array_join("repair", "|").alias("repairs")), "term")


def repair_worklist(spark: SparkSession, sf: str) -> DataFrame:
    """Part entries with made-up attempts: which are due, with the status that a repair gives them."""
    full = lambda c: F.when(F.col("id") % 20 == 1, F.array(F.lit("x"))).otherwise(F.col(c))
    e = part_entries(spark, sf).withColumns({
        "status": pick(F.col("id"), None, "completed", "partial", "not_found"), "last_attempt": F.timestamp_seconds(F.lit(1_700_000_000) - F.pmod("id", F.lit(48)) * 3600), "g": select.gaps_of(), **{c: full(c) for c in enrich.DEEP_LISTS},
    })
    due = enrich.worklist(e, F.timestamp_seconds(F.lit(1_700_000_000)), 24, F.col("g"), F.col("id") % 10 != 1)
    return due.select("id", enrich.repair_marker(F.array(F.when(F.col("id") % 2 == 0, "ok").otherwise("not_found")), F.col("g")).alias("repaired"))


def markers(spark: SparkSession, sf: str) -> DataFrame:
    """Status of each user from the states of its event types."""
    states = table(spark, sf, "events").groupBy("user_id").agg(F.array_sort(F.collect_set(F.when(F.col("value") > 30, "ok").when(F.col("value") > 10, "not_found").otherwise("failed"))).alias("s"))
    return states.select("user_id", enrich.marker(F.col("s")).alias("status"))


def enrichment_progress(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.progress(markers(spark, sf).withColumn("status", F.when(F.col("user_id") % 4 != 0, F.col("status"))))


def page_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with a language heading put in: the first sound of the English section, and definitions of structured responses."""
    pages = table(spark, sf, "pages").select("page_id", F.concat(pick("page_id", "<h2 id=\"English\">E</h2>", "<h2 class='x' id='French'>F</h2>"), F.lit("<p><span lang='en' class='a IPA'>/s"), F.col("page_id"), F.lit("/</span></p><h2>Next</h2><span class='IPA'>late</span>"), F.coalesce("html", F.lit(""))).alias("html"), "url")
    one = lambda text: F.struct(text.alias("definition"))
    entry = F.struct(F.lit("Noun").alias("partOfSpeech"), F.array(one(F.concat(F.lit("<b>page</b>  "), F.col("page_id"))), one(F.repeat(F.lit("long "), 200)), one(F.concat(F.lit("page "), F.col("page_id"))), one(F.lit("a &amp; b"))).alias("definitions"))
    landed = pages.withColumn("response", F.to_json(F.struct(F.when(F.col("page_id") % 3 != 0, F.array(entry)).alias("en"))))
    return landed.select("page_id", enrich.page_ipa(F.col("html")).alias("ipa"), enrich.page_definitions(F.col("response"))["definition"].alias("definition"), enrich.page_definitions(F.col("response"))["pos"].alias("pos"))


QUERIES = {
    f.__name__: f
    for f in (
        dictionary_csv, dump_counts, dump_groups, entries_snapshot, bundle_and_delta, term_lists, report_check, row_rules, named_union, missing_columns, attempt_totals, list_change_stats, top_parts, queue_identity, term_book,
        scored_words, assembled_entries, wordnet_file, attempt_staleness, report_rules, wordnet_senses, wordnet_sense_links, wordnet_synset_links, wordnet_synonyms, wordnet_patch, wordnet_sense_patch, patched_senses, patched_entries, patch_statistics, finalized, relation_senses, relation_delta, relation_applied, relation_capacity,
        relation_violations, pool_of_terms, refused_terms, edition_provenance, edition_queue, edition_counts, edition_gate, edition_refresh, owner_preflight, repair_deltas, repair_check, repair_applied, shard_exports,
        provider_fields, association_fields, combined_fields, merged_enrichment, work_plan, markers, enrichment_progress, page_fields, edition_internal, queue_flags, repair_worklist,
    )
}

WORD = "'part ' || translate(CAST({} AS VARCHAR), '0123456789', 'abcdefghij')"
GROUP = "lower(p_type || ' ' || p_size)"
LISTS_SQL = f"""
  r AS (SELECT {GROUP} AS key, p_partkey AS k, p_name, p_brand, p_size FROM part WHERE p_partkey % 11 <> 0 AND p_partkey % 7 <> 0),
  v AS (SELECT key, 's' AS kind, p_brand AS v, 2 * k AS o FROM r UNION ALL SELECT key, 'e', p_brand, 2 * k FROM r WHERE p_size % 2 = 0 UNION ALL SELECT key, 'r', p_name, 2 * k FROM r UNION ALL SELECT key, 'r', p_brand, 2 * k + 1 FROM r),
  f AS (SELECT key, kind, v, min(o) AS o FROM v GROUP BY ALL), c AS (SELECT *, row_number() OVER (PARTITION BY key, kind ORDER BY o) AS n FROM f),
  l AS (SELECT key, coalesce(string_agg(v, '|' ORDER BY o) FILTER (kind = 'e' AND n <= 12), '') AS examples, coalesce(string_agg(v, '|' ORDER BY o) FILTER (kind = 's' AND n <= 40), '') AS synonyms,
    coalesce(string_agg(v, '|' ORDER BY o) FILTER (kind = 'r' AND n <= 40), '') AS related_words, coalesce(string_agg(v, '|' ORDER BY o) FILTER (kind = 'r' AND n <= 40 AND contains(v, ' ')), '') AS phrases FROM c GROUP BY key)"""
SENSES_SQL = """
  s AS (SELECT p_partkey AS k, 'part ' || p_partkey AS key, printf('s%08d', p_partkey) AS sense_id, p_partkey // 3 AS y, 1 AS sense_order, p_name FROM part
    UNION ALL SELECT p_partkey, 'part ' || p_partkey, printf('t%08d', p_partkey), (p_partkey + 1000000) // 4, 2, p_name FROM part),
  sl AS (SELECT a.k, a.key, CASE a.k % 3 WHEN 0 THEN 'antonym' ELSE 'similar' END AS relation, b.key AS target_key, b.k AS target, 'meaning of ' || printf('y%08d', b.y) AS target_definition
    FROM s a JOIN s b ON b.sense_id = printf('t%08d', a.k + 5) WHERE a.sense_order = 1 AND a.k % 3 < 2),
  yl AS (SELECT a.k, a.key, a.sense_id, 'hypernym' AS relation, b.key AS target_key, b.k AS target, 'meaning of ' || printf('y%08d', b.y) AS target_definition FROM s a JOIN s b ON b.y = a.y + 1 WHERE a.y % 2 = 0 AND a.k <> b.k),
  syn AS (SELECT a.k, a.key, a.y, a.sense_order, b.key AS target_key, b.k AS target FROM s a JOIN s b ON b.y = a.y AND a.k <> b.k)"""
POOL_SQL = f"""
  terms AS MATERIALIZED (SELECT term, kind, count(*) AS n FROM (
    SELECT unnest(w) AS term, 'word' AS kind FROM (SELECT {TOKENS_SQL} AS w FROM documents)
    UNION ALL SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])), 'phrase' FROM (SELECT {TOKENS_SQL} AS w FROM documents)) GROUP BY ALL HAVING count(*) > 1),
  t AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY n DESC, term) AS k FROM terms),
  judged AS (SELECT *, CASE WHEN k % 40 = 0 THEN 'missing_source_provenance' WHEN k % 50 = 0 AND term <> 'other' THEN 'normalized_word_mismatch' WHEN length(term) > 120 THEN 'invalid_length'
    WHEN NOT regexp_full_match(term, '[a-z]+( [a-z]+)*') THEN 'unsupported_punctuation' WHEN length(term) = 1 AND term NOT IN ('a', 'i') THEN 'single_letter_noise'
    WHEN kind = 'phrase' AND k % 6 = 0 THEN 'phrase_evidence_insufficient' END AS reason FROM t),
  pool AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY k) AS j FROM judged WHERE reason IS NULL)"""
WORDS = EDITION_ROWS - EDITION_PHRASES
EDITION_SQL = f"""{POOL_SQL},
  e AS MATERIALIZED (SELECT k AS id, kind, term, n, CASE kind WHEN 'phrase' THEN CAST(ceil(j * {EDITION_ROWS} / CAST({EDITION_PHRASES} AS DOUBLE)) AS BIGINT) ELSE (j - 1) * {EDITION_ROWS} // {WORDS} + 1 END AS selected_rank
    FROM pool WHERE j <= CASE kind WHEN 'phrase' THEN {EDITION_PHRASES} ELSE {WORDS} END),
  g AS MATERIALIZED (SELECT *, id % 7 = 0 AS g1, id % 7 <> 0 AND id % 9 = 0 AS g2, kind = 'word' AND id % 11 = 0 AS g3 FROM e),
  q AS MATERIALIZED (SELECT *, concat_ws('|', CASE WHEN g1 THEN 'definition' END, CASE WHEN g2 THEN 'definition_zh' END, CASE WHEN g3 THEN 'pos' END) AS gaps FROM g WHERE g1 OR g2 OR g3)"""
PATCHED_SQL = f"""SELECT p_partkey AS id, CASE WHEN p_partkey % 5 <> 0 THEN 'noun' WHEN p_partkey % 2 = 0 THEN 'verb' ELSE '' END AS pos,
  CASE WHEN p_partkey % 3 <> 0 THEN p_name WHEN p_partkey % 2 = 0 THEN 'patched ' || {WORD.format('p_partkey')} ELSE '' END AS definition, CASE WHEN p_partkey % 2 = 0 THEN 'a|b' ELSE '' END AS synonyms,
  CASE WHEN p_partkey % 2 = 0 THEN {WORD.format('p_partkey')} ELSE '' END AS examples, CASE WHEN p_partkey % 2 = 0 THEN 'kaikki|oewn' ELSE 'kaikki' END AS sources FROM part"""
MARKERS_SQL = """WITH s AS (SELECT user_id, bool_or(coalesce(value > 30, FALSE)) AS ok, bool_or(coalesce(value <= 10, TRUE)) AS failed FROM events GROUP BY user_id)
  SELECT user_id, CASE WHEN ok AND NOT failed THEN 'completed' WHEN ok OR failed THEN 'partial' ELSE 'not_found' END AS status FROM s"""

SQL = {
    "dictionary_csv": r"SELECT lower(concat_ws(' ', lang, doc_id)) AS key, source AS pos, sha256(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g')) AS digest FROM documents",
    "dump_counts": "SELECT count(*) AS n_lines, count(*) FILTER (p_partkey % 11 = 0) AS n_invalid, count(*) FILTER (p_partkey % 11 <> 0 AND p_partkey % 7 <> 0) AS n_language FROM part",
    "dump_groups": f"""WITH {LISTS_SQL}, g AS (SELECT key, least(count(*), 24) AS n_senses, coalesce(max('s' || p_size) FILTER (k % 2 = 0), '') AS us_phonetic, coalesce(max('s' || p_size) FILTER (k % 2 = 1), '') AS uk_phonetic FROM r GROUP BY key)
      SELECT key, 'noun' AS pos, examples, synonyms, related_words, phrases, n_senses, us_phonetic, uk_phonetic FROM l JOIN g USING (key)""",
    "entries_snapshot": "SELECT count(*) AS read, count(*) AS words, count(*) AS n_rows, min(p_partkey) AS min_id, max(p_partkey) AS max_id, 'from parts' AS made FROM part",
    "bundle_and_delta": f"WITH {EDITION_SQL} SELECT 'entries' AS name, count(*) AS n FROM e UNION ALL SELECT 'provenance', count(*) FROM e UNION ALL SELECT 'queue', count(*) FROM q",
    "wordnet_file": """
      WITH s AS (SELECT p_partkey AS k, printf('s%08d', p_partkey) AS sense_id, p_partkey // 3 AS y, CASE WHEN p_partkey % 2 = 0 THEN 5 WHEN p_partkey % 50 = 0 THEN 2 ELSE 1 END AS sense_order, p_name AS examples, CASE WHEN p_partkey % 3 = 0 THEN printf('s%08d', p_partkey + 1) END AS target FROM part
        UNION ALL SELECT p_partkey, printf('t%08d', p_partkey), p_partkey // 4, CASE WHEN p_partkey % 50 = 0 THEN 3 ELSE 2 END, '', NULL FROM part)
      SELECT 'part ' || k AS key, sense_id, printf('y%08d', y) AS synset_id, sense_order, examples, 'meaning <' || y || '>' AS definition, target, TRUE AS changed_refused, TRUE AS release_refused FROM s JOIN part p ON p.p_partkey = y""",
    "attempt_staleness": """
      WITH n AS (SELECT user_id, event_id, event_type FROM events WHERE ts = (SELECT max(ts) FROM events) ORDER BY user_id DESC, event_id DESC LIMIT 1)
      SELECT after, user_id, event_id, event_type, CAST(greatest(after, 0) AS DOUBLE) AS stale_seconds, after > 600 AS stale FROM n, (VALUES (-5), (59), (600), (601)) t(after)""",
    "report_rules": """
      WITH r AS (SELECT user_id AS k, count(*) AS total, count(*) FILTER (value > 20) AS complete, count(*) FILTER (NOT value > 20) AS incomplete FROM events GROUP BY user_id), f AS (SELECT *, CASE k % 3 WHEN 0 THEN total WHEN 1 THEN 0 ELSE complete END AS finished FROM r)
      SELECT k AS shard, finished, round(100.0 * finished / total, 3) AS percent, nullif(concat_ws('|', CASE WHEN k % 5 <> 0 AND k % 7 = 0 THEN 'digest_malformed' END, CASE WHEN k % 5 = 0 THEN 'digest_mismatch' END, CASE WHEN k NOT BETWEEN 0 AND 39 THEN 'shard_mismatch' END,
        CASE WHEN k % 6 = 0 THEN 'shard_repeated' END, CASE WHEN complete + incomplete <> total THEN 'sum_mismatch' END, CASE WHEN k % 4 = 0 THEN 'version_mismatch' END), '') AS codes FROM f""",
    "term_lists": """SELECT DISTINCT term FROM (SELECT trim(regexp_replace(lower(unnest(string_split_regex(coalesce(text, ''), '[\\r\\n,，;；\\t]+'))), '\\s+', ' ', 'g')) AS term FROM documents)
      WHERE regexp_full_match(term, '[a-z][a-z'' .-]*') AND length(term) <= 120""",
    "report_check": """
      WITH u AS (SELECT user_id, count(*) + CASE WHEN user_id % 7 = 0 THEN 1 ELSE 0 END AS total, CASE WHEN user_id % 9 = 0 THEN -1 ELSE count(*) FILTER (value > 20) END AS complete, count(*) FILTER (NOT value > 20) AS incomplete FROM events GROUP BY user_id)
      SELECT CASE WHEN complete < 0 THEN 'negative_count' ELSE 'sum_mismatch' END AS code, CAST(user_id AS VARCHAR) AS example FROM u WHERE complete < 0 OR complete + incomplete <> total""",
    "row_rules": """SELECT p_partkey, ['noun', 'verb', 'adj', 'adj', 'adv', 'adv', '', ''][p_partkey % 8 + 1] AS pos,
      [p_name, replace(translate(p_name, 'ae', 'əˈ'), 'ˈˈ', 'ˈ'), p_name || 'ː', '', 'HH AH0 L OW1', 'ˈx'][p_partkey % 6 + 1] AS sound, [FALSE, contains(p_name, 'a'), TRUE, TRUE, TRUE, FALSE][p_partkey % 6 + 1] AS unreliable,
      p_partkey % 7 IN (1, 2) AS corrupt FROM part""",
    "named_union": """WITH w AS (SELECT p_size, p_type, max(length(p_name)) AS n FROM part GROUP BY ALL) SELECT p_size, count(*) AS n_words, string_agg(p_type || '=' || n, '|' ORDER BY p_type || '=' || n) AS words FROM w GROUP BY p_size""",
    "missing_columns": "SELECT (SELECT count(*) FROM part) AS n_rows, d AS dropped, 'entries lack ' || d AS refusal FROM (VALUES ('definition'), ('pos'), ('sources')) t(d)",
    "attempt_totals": "SELECT status, count(*) AS n, sum(attempts) AS attempts FROM (SELECT user_id, arg_max(event_type, (ts, event_id)) AS status, count(*) AS attempts FROM events GROUP BY user_id) GROUP BY status",
    "list_change_stats": """SELECT count(*) AS n_rows, count(*) FILTER (p_partkey % 10 = 0) AS pos_changed, count(*) FILTER (p_partkey % 6 = 0) AS definition_changed, 2 * count(*) FILTER (p_partkey % 2 = 0) AS synonyms_added,
      count(*) FILTER (p_partkey % 2 = 0) AS examples_added, count(*) FILTER (p_partkey % 2 = 0) AS sources_added FROM part""",
    "top_parts": "SELECT p_partkey AS id, p_partkey + 1 AS frequency_rank FROM part WHERE p_partkey % 6 <> 0 ORDER BY p_partkey LIMIT 100",
    "queue_identity": """SELECT CASE WHEN p_partkey % 13 = 0 THEN p_partkey + 10000000 ELSE p_partkey END AS id, CASE WHEN p_partkey % 13 = 0 THEN 'canonical_missing' ELSE 'canonical_identity_mismatch' END AS code FROM part
      WHERE p_partkey % 13 = 0 OR p_partkey % 17 = 0""",
    "term_book": "SELECT p_partkey AS pos, CASE WHEN p_partkey % 10 = 0 THEN 'zz' || p_partkey ELSE p_type END AS term, CASE WHEN p_partkey % 10 <> 0 THEN p_type END AS word, CASE WHEN p_partkey % 10 = 0 THEN 'missing' ELSE 'exact' END AS kind FROM part",
    "scored_words": f"""
      WITH b AS (SELECT word, count(*) AS n FROM (SELECT unnest({TOKENS_SQL}) AS word FROM benchmark) GROUP BY word), z AS (SELECT word, log10(n) AS zipf FROM ({LEXICON_SQL}) WHERE n > 20)
      SELECT b.word AS key, round(CASE WHEN zipf > 0 THEN zipf WHEN length(b.word) % 3 = 1 THEN -log10(length(b.word) + 1) WHEN b.n % 2 = 0 THEN -10 - log10(10) ELSE 0 END, 6) AS score FROM b LEFT JOIN z ON z.word = b.word""",
    "assembled_entries": f"""
      WITH {LISTS_SQL}, csv AS (SELECT DISTINCT {GROUP} AS key, p_size FROM part WHERE p_partkey % 3 <> 1), z AS (SELECT {GROUP} AS key, count(*) AS zipf FROM part GROUP BY 1 HAVING count(*) > 10),
      b AS (SELECT coalesce(csv.key, l.key) AS key, CASE WHEN csv.key IS NULL THEN 0 ELSE coalesce(CAST(zipf AS DOUBLE), -log10(p_size + 1)) END AS frequency, concat_ws('+', CASE WHEN csv.key IS NOT NULL THEN 'ecdict' END, CASE WHEN l.key IS NOT NULL THEN 'kaikki' END) AS sources,
        coalesce(synonyms, '') AS synonyms FROM csv FULL JOIN l ON l.key = csv.key LEFT JOIN z ON z.key = csv.key)
      SELECT row_number() OVER o AS id, key AS normalized_word, row_number() OVER o AS frequency_rank, round(frequency, 6) AS frequency, sources, synonyms FROM b WINDOW o AS (ORDER BY CASE WHEN frequency = 0 THEN -20 ELSE frequency END DESC, key)""",
    "wordnet_senses": f"WITH {SENSES_SQL} SELECT key, sense_id, printf('y%08d', y) AS synset_id, sense_order FROM s",
    "wordnet_sense_links": f"WITH {SENSES_SQL} SELECT key, relation, target_key, target_definition FROM sl",
    "wordnet_synset_links": f"WITH {SENSES_SQL} SELECT key, sense_id, relation, target_key, target_definition FROM yl",
    "wordnet_synonyms": f"WITH {SENSES_SQL} SELECT key, printf('y%08d', y) AS synset_id, target_key FROM syn",
    "wordnet_patch": f"""
      WITH {SENSES_SQL}, d AS (SELECT k, string_agg('meaning of ' || printf('y%08d', y), chr(10) ORDER BY sense_order) AS definition, string_agg(substr(sense_id, 1, 1) || ' ' || p_name || '|' || printf('y%08d', y), '|' ORDER BY sense_order) AS examples FROM s GROUP BY k),
      f AS (SELECT k, target_key, min((sense_order, target)) AS o FROM syn GROUP BY ALL), sy AS (SELECT k, string_agg(target_key, '|' ORDER BY o) AS synonyms FROM f GROUP BY k),
      a AS (SELECT k, string_agg(target_key, '|') AS antonyms FROM sl WHERE relation = 'antonym' GROUP BY k),
      n AS (SELECT k, least(count(DISTINCT target_key), 40) AS n_related FROM (SELECT k, target_key FROM sl WHERE relation = 'similar' UNION ALL SELECT k, target_key FROM yl) GROUP BY k)
      SELECT 'part ' || k AS key, CASE k % 2 WHEN 0 THEN 'noun' ELSE 'verb' END AS pos, definition, examples, CASE k % 3 WHEN 0 THEN 'ˈ' || k ELSE '' END AS us_phonetic, CASE k % 3 WHEN 1 THEN 'ˈ' || k ELSE '' END AS uk_phonetic,
        coalesce(synonyms, '') AS synonyms, coalesce(antonyms, '') AS antonyms, coalesce(n_related, 0) AS n_related FROM d LEFT JOIN sy USING (k) LEFT JOIN a USING (k) LEFT JOIN n USING (k)""",
    "patched_entries": PATCHED_SQL,
    "wordnet_sense_patch": f"""
      WITH {SENSES_SQL}, l AS (SELECT key, k, printf('s%08d', k) AS sense_id, relation, target_key, target FROM sl UNION ALL SELECT key, k, sense_id, relation, target_key, target FROM yl),
      w AS (SELECT sense_id, relation, string_agg(target_key, '/' ORDER BY target) FILTER (n <= 40) AS words FROM (SELECT *, row_number() OVER (PARTITION BY sense_id, relation ORDER BY target) AS n FROM (SELECT DISTINCT sense_id, relation, target_key, target FROM l)) GROUP BY ALL),
      r AS (SELECT sense_id, string_agg(relation || '=' || words, '|' ORDER BY relation) AS relations FROM w GROUP BY sense_id),
      y AS (SELECT k, y, '[' || string_agg('"' || target_key || '"', ',' ORDER BY target_order, target) || ']' AS synonyms FROM (SELECT a.k, a.y, b.key AS target_key, min(b.sense_order) AS target_order, b.k AS target FROM s a JOIN s b ON b.y = a.y AND a.k <> b.k GROUP BY ALL) GROUP BY ALL)
      SELECT s.key, printf('y%08d', s.y) AS synset, CASE s.k % 2 WHEN 0 THEN 'n' ELSE 'v' END AS pos, sense_order AS place, 'meaning of ' || printf('y%08d', s.y) AS definition, coalesce(relations, '') AS relations, substr(s.sense_id, 1, 1) || ' ' || p_name AS example, coalesce(synonyms, '[]') AS synonyms
      FROM s LEFT JOIN r USING (sense_id) LEFT JOIN y ON y.k = s.k AND y.y = s.y""",
    "patched_senses": """
      WITH p AS (SELECT p_partkey AS k, printf('y%08d', p_partkey // 3) AS a, printf('y%08d', (p_partkey + 1000000) // 4) AS b FROM part)
      SELECT k AS id, CASE WHEN k = 7 THEN a WHEN k % 3 = 0 THEN '[1,2]|' || a || '|' || b ELSE a || '|' || b END AS senses,
        CASE WHEN k = 7 THEN NULL WHEN k % 4 = 0 THEN '{"flag":{"x":1},"oewn":{"license":"CC BY 4.0"}}' WHEN k % 4 = 1 THEN 'broken' ELSE '{"oewn":{"license":"CC BY 4.0"}}' END AS scope,
        CASE WHEN k = 7 THEN 1 WHEN k % 3 = 0 THEN 3 ELSE 2 END AS n_again FROM p""",
    "patch_statistics": """SELECT count(*) AS n_rows, count(*) FILTER (e) AS matched, count(*) FILTER (e AND k % 5 = 0) AS pos_filled, count(*) FILTER (e AND k % 3 = 0) AS definition_filled, 2 * count(*) FILTER (e) AS synonyms_added, count(*) FILTER (e) AS examples_added,
      count(*) FILTER (e AND k % 5 <> 0) + count(*) FILTER (e AND k % 3 <> 0) AS conflicts_kept FROM (SELECT p_partkey AS k, p_partkey % 2 = 0 AS e FROM part)""",
    "finalized": f"""
      WITH f AS (SELECT p_partkey AS id, p_partkey * 37 % 101 AS f, {WORD.format('p_partkey')} AS w FROM part), r AS (SELECT id, row_number() OVER (ORDER BY CASE WHEN f = 0 THEN -200 ELSE f END DESC, w) AS frequency_rank FROM f)
      SELECT id, frequency_rank, n_rows, enriched, completed FROM r, (SELECT count(*) AS n_rows, count(*) FILTER (p_partkey % 3 < 2) AS enriched, count(*) FILTER (p_partkey % 3 = 0) AS completed FROM part) WHERE frequency_rank <= 500""",
    "relation_senses": f"""SELECT {WORD.format('p_partkey')} AS key, CASE WHEN p_partkey % 2 = 1 THEN p_type ELSE 'another sense' END AS definitions, field, CASE field WHEN 'hypernyms' THEN {WORD.format('p_partkey + 1')} ELSE {WORD.format('p_partkey + 2')} END AS words
      FROM part, (VALUES ('hypernyms'), ('alt_of')) t(field) WHERE field = 'hypernyms' OR p_partkey % 4 = 0""",
    "relation_delta": f"""SELECT a.p_partkey AS id, CASE WHEN b.p_partkey % 3 <> 0 THEN {WORD.format('b.p_partkey')} || '=' || b.p_name ELSE '' END AS related, 1 AS n_patches, CASE WHEN a.p_partkey % 2 = 1 THEN 0 END AS sense, CASE WHEN a.p_partkey % 2 = 1 THEN 24 END AS n_fingerprint
      FROM part a LEFT JOIN part b ON b.p_partkey = a.p_partkey + 1""",
    "relation_applied": "SELECT count(*) AS n_rows, count(*) AS changed, count(*) FILTER (b.p_partkey % 3 <> 0) AS related_added, 0 AS changed_again FROM part a LEFT JOIN part b ON b.p_partkey = a.p_partkey + 1",
    "relation_capacity": f"""
      WITH e AS (SELECT p_partkey AS k, CASE p_partkey % 5 WHEN 0 THEN 39 WHEN 1 THEN 38 ELSE 0 END AS words, CASE WHEN p_partkey % 4 < 2 THEN 1 ELSE 0 END + CASE WHEN p_partkey % 7 = 0 THEN 39 ELSE 0 END AS entries FROM part),
      t AS (SELECT e.*, d.step, p.p_partkey AS t, p.p_name, step = 1 AND k % 4 = 0 AS rich, step = 1 AND k % 4 = 1 AS blank
        FROM e, (VALUES (1), (2), (4)) d(step) JOIN part p ON p.p_partkey = k + step WHERE p.p_partkey % 3 <> 0),
      o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY step) AS n FROM t WHERE NOT blank),
      one AS (SELECT k, max(t) FILTER (n = 1) AS t1, max(t) FILTER (n = 2) AS t2, max(t) FILTER (n = 3) AS t3, coalesce(bool_or(rich) FILTER (n = 1), FALSE) AS r1, max(words) AS w, max(entries) AS x FROM o GROUP BY k),
      a1 AS (SELECT *, t1 IS NOT NULL AND w < 40 AND (r1 OR x < 40) AS y1 FROM one), b1 AS (SELECT *, w + y1::INT AS w1, x + (y1 AND NOT r1)::INT AS x1 FROM a1),
      a2 AS (SELECT *, t2 IS NOT NULL AND w1 < 40 AND x1 < 40 AS y2 FROM b1), b2 AS (SELECT *, w1 + y2::INT AS w2, x1 + y2::INT AS x2 FROM a2),
      a3 AS (SELECT *, t3 IS NOT NULL AND w2 < 40 AND x2 < 40 AS y3 FROM b2)
      SELECT e.k AS id, coalesce(w2 + y3::INT, e.words) AS n_words, coalesce(x2 + y3::INT, e.entries) AS n_entries,
        coalesce(concat_ws('|', CASE WHEN y1 THEN {WORD.format('t1')} || '=' || p1.p_name END, CASE WHEN y2 THEN {WORD.format('t2')} || '=' || p2.p_name END, CASE WHEN y3 THEN {WORD.format('t3')} || '=' || p3.p_name END), '') AS related,
        0 AS changed_again, 0 AS again
      FROM e LEFT JOIN a3 USING (k) LEFT JOIN part p1 ON p1.p_partkey = t1 LEFT JOIN part p2 ON p2.p_partkey = t2 LEFT JOIN part p3 ON p3.p_partkey = t3""",
    "relation_violations": "SELECT CASE p_partkey % 10 WHEN 1 THEN 'identity_mismatch' WHEN 3 THEN 'canonical_missing' ELSE 'sense_mismatch' END AS code, count(*) AS n FROM part WHERE p_partkey % 10 IN (1, 3, 5) GROUP BY 1",
    "pool_of_terms": f"WITH {POOL_SQL} SELECT k AS id, kind, term AS term_key, CASE kind WHEN 'phrase' THEN 'kaikki-entry' ELSE '' END AS evidence FROM pool",
    "refused_terms": f"WITH {POOL_SQL} SELECT reason, count(*) AS n FROM judged WHERE reason IS NOT NULL GROUP BY reason",
    "edition_provenance": f"WITH {EDITION_SQL} SELECT id, selected_rank, kind, term AS term_key, id AS canonical_rank FROM e",
    "edition_queue": f"WITH {EDITION_SQL} SELECT id, selected_rank AS frequency_rank, id % {SHARDS} AS owner, gaps FROM q",
    "edition_counts": f"WITH {EDITION_SQL} SELECT kind, count(*) AS n, (SELECT count(*) FROM e WHERE id > {EDITION_ROWS}) AS backfilled FROM e GROUP BY kind",
    "edition_gate": f"""
      WITH {EDITION_SQL}, v AS (SELECT 'canonical_missing' AS code FROM e WHERE id % 29 = 0 UNION ALL SELECT 'canonical_identity_mismatch' FROM e WHERE id % 29 <> 0 AND id % 31 = 0 UNION ALL SELECT 'canonical_content_mismatch' FROM e WHERE id % 29 <> 0 AND id % 8 = 0
        UNION ALL SELECT 'shard_owner_mismatch' FROM q WHERE id % 5 = 0 UNION ALL SELECT 'definition' FROM g WHERE g1 UNION ALL SELECT 'definition_zh' FROM g WHERE g2 UNION ALL SELECT 'pos' FROM g WHERE g3)
      SELECT code, count(*) AS n, bool_and(code IN ('definition', 'definition_zh', 'pos')) OVER () AS structural FROM v GROUP BY code""",
    "edition_refresh": f"""
      WITH {EDITION_SQL}, m AS (SELECT *, id % {SHARDS} = 1 AS mine FROM g), x AS (SELECT *, g2 AND NOT mine AS g2x FROM m)
      SELECT id, selected_rank AS frequency_rank, CASE WHEN mine THEN CASE WHEN id % 8 = 0 THEN '新' ELSE '中文' END WHEN id % 9 = 0 THEN '' ELSE '中文' END AS definition_zh,
        nullif(concat_ws('|', CASE WHEN g1 THEN 'definition' END, CASE WHEN g2x THEN 'definition_zh' END, CASE WHEN g3 THEN 'pos' END), '') AS gaps FROM x""",
    "owner_preflight": f"""WITH {EDITION_SQL} SELECT CASE WHEN id % 29 = 0 THEN 'canonical_missing' ELSE 'canonical_content_mismatch' END AS code, CAST(id AS VARCHAR) AS example FROM g
      WHERE id % {SHARDS} = 2 AND (id % 29 = 0 OR (id % 8 = 0 AND NOT (g1 OR g2 OR g3)))""",
    "repair_deltas": f"WITH {EDITION_SQL} SELECT id, id % {SHARDS} AS owner, concat_ws('|', CASE WHEN g3 THEN 'pos' END, CASE WHEN g1 THEN 'definition' END, CASE WHEN g2 THEN 'definition_zh' END) AS changed FROM q",
    "repair_check": f"WITH {EDITION_SQL} SELECT ['missing', 'wrong_owner', 'overlap', 'gap_left'][id % 10 + 1] AS code, CAST(id AS VARCHAR) AS example FROM q WHERE id % 10 < 4",
    "repair_applied": f"""
      WITH {EDITION_SQL} SELECT t.k AS id, CASE WHEN t.k % 7 <> 0 THEN 'seen ' || t.n WHEN q.g1 THEN 'filled' ELSE '' END AS definition, CASE WHEN t.k % 9 <> 0 OR q.g2 THEN '中文' ELSE '' END AS definition_zh, CASE WHEN t.k % 11 <> 0 OR q.g3 THEN 'noun' ELSE '' END AS pos
      FROM t LEFT JOIN q ON q.id = t.k""",
    "shard_exports": """
      WITH b AS (SELECT min(p_partkey) AS low, max(p_partkey) - min(p_partkey) + 1 AS n FROM part), s AS (SELECT * FROM part, b WHERE p_partkey >= low + n // 4 AND p_partkey < low + 2 * n // 4),
      c AS (SELECT count(*) AS total, count(*) FILTER (p_partkey % 2 = 0) AS done FROM s)
      SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'noun' END AS pos, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_name END AS definition, 'ready' AS said, 'waiting finished=' || done || ' total=' || total AS other FROM s, c""",
    "provider_fields": """SELECT 'part ' || p_partkey AS term, CASE WHEN a THEN p_name ELSE '' END AS definition, CASE WHEN NOT a THEN '' WHEN p_partkey % 2 = 0 THEN 'noun' ELSE 'verb' END AS pos, CASE WHEN a AND p_partkey % 3 = 0 THEN 's' || p_partkey ELSE '' END AS us,
      CASE WHEN a AND p_partkey % 3 = 1 THEN 's' || p_partkey ELSE '' END AS uk, CASE WHEN a THEN p_type ELSE '' END AS examples, CASE WHEN a THEN p_brand || '|same' ELSE '' END AS synonyms, CASE WHEN a THEN 'other' ELSE '' END AS antonyms FROM (SELECT *, p_partkey % 5 <> 0 AS a FROM part)""",
    "association_fields": "SELECT 'part ' || p_partkey AS term, 'n ' || p_type AS definition, 'noun' AS pos, 'x' || p_partkey AS phonetic, round(3 + log10(p_size), 6) AS frequency, 'part ' || p_partkey AS words FROM part",
    "combined_fields": """SELECT 'part ' || p_partkey AS term, CASE WHEN a THEN p_name ELSE 'n ' || p_type END AS definition, CASE WHEN a AND p_partkey % 2 = 1 THEN 'verb' ELSE 'noun' END AS pos, CASE WHEN a AND p_partkey % 3 = 0 THEN 's' ELSE 'x' END || p_partkey AS us,
      CASE WHEN a AND p_partkey % 3 = 1 THEN 's' || p_partkey ELSE '' END AS uk FROM (SELECT *, p_partkey % 5 <> 0 AS a FROM part)""",
    "merged_enrichment": """SELECT p_partkey AS id, CASE WHEN p_partkey % 3 <> 0 THEN p_name WHEN p_partkey % 2 = 0 THEN 'found' ELSE '' END AS definition, CASE WHEN p_partkey % 2 = 0 THEN 's|t' ELSE '' END AS synonyms, f AS frequency,
      concat_ws('|', CASE WHEN p_partkey % 6 = 0 THEN 'definition' END, CASE WHEN p_partkey % 2 = 0 THEN 'synonyms' END, CASE WHEN f > 4 THEN 'frequency' END, 'difficulty') AS filled, CASE WHEN f >= 6 THEN 'A1–A2' WHEN f >= 4.8 THEN 'B1–B2' ELSE 'C1–C2' END AS difficulty FROM (SELECT *, CAST(CASE WHEN p_partkey % 2 = 0 THEN greatest(4, p_partkey % 8) ELSE 4 END AS DOUBLE) AS f FROM part)""",
    "work_plan": f"""
      WITH p AS (SELECT p_partkey AS k, p_partkey % 6 = 0 AS phrase, p_partkey % 3 = 0 AS d, p_partkey % 3 <> 0 AND p_partkey % 4 = 0 AS t, p_partkey % 9 = 0 AS f, p_partkey % 4 <> 0 AS x,
        p_partkey % 2 <> 0 AS s, p_partkey % 3 <> 0 AS a, p_partkey % 5 <> 0 AS h, p_partkey % 7 <> 0 AS r FROM part),
      n AS (SELECT *, NOT phrase AND k % 5 = 0 AS o, NOT phrase AND k % 8 NOT IN (1, 3) AS u FROM p)
      SELECT CASE WHEN phrase THEN {WORD.format('k')} ELSE replace({WORD.format('k')}, ' ', '') END AS term, d AS definition, t AS translation, o AS pos, u AS us_phonetic, x AS examples, f AS frequency, s AS synonyms, a AS antonyms, h AS phrases, r AS related_words,
        s OR a OR h OR r AS relations, d OR o OR u OR x OR f OR s OR a OR h OR r AS network,
        concat_ws('|', CASE WHEN d OR u OR x THEN 'dictionary' END, CASE WHEN r OR h THEN 'related' END, CASE WHEN d OR o OR f THEN 'exact' END, CASE WHEN s THEN 'synonyms' END, CASE WHEN a THEN 'antonyms' END) AS requests,
        concat_ws('|', CASE WHEN d OR u THEN 'dictionary' END, CASE WHEN d OR o THEN 'exact' END, CASE WHEN d OR o OR u THEN 'page' END) AS repairs FROM n""",
    "edition_internal": f"""WITH {EDITION_SQL}, v AS (SELECT 'malformed_json' AS code FROM e WHERE id % 8 = 0 UNION ALL SELECT 'provenance_count' FROM e WHERE id % 13 = 0
        UNION ALL SELECT 'candidate_digest_mismatch' FROM e WHERE id % 5 = 0 AND id % 13 <> 0 UNION ALL SELECT 'phrase_evidence' FROM e WHERE id % 13 = 0 UNION ALL SELECT 'repair_queue_mismatch' FROM g WHERE g3 AND id % 5 = 0
        UNION ALL SELECT 'definition' FROM g WHERE g1 UNION ALL SELECT 'definition_zh' FROM g WHERE g2 UNION ALL SELECT 'pos' FROM g WHERE g3 AND id % 5 <> 0
        UNION ALL SELECT 'selection_counts' FROM e WHERE kind = 'phrase' HAVING count(*) FILTER (id % 13 <> 0) <> {EDITION_PHRASES}) SELECT code, count(*) AS n FROM v GROUP BY code""",
    "queue_flags": f"WITH {EDITION_SQL} SELECT id, CASE WHEN id % 13 <> 0 THEN kind END AS kind, g1 OR g2 OR g3 AS queued FROM g",
    "repair_worklist": """WITH p AS (SELECT p_partkey AS id, p_partkey % 3 = 0 OR p_partkey % 4 = 0 AS gap, p_partkey % 48 >= 24 AS old FROM part)
      SELECT id, CASE WHEN NOT gap THEN 'completed' WHEN id % 2 = 0 THEN 'partial' ELSE 'not_found' END AS repaired FROM p WHERE id % 4 = 0 OR (id % 4 > 1 AND old) OR (gap AND old) OR (id % 4 = 1 AND id % 10 = 1 AND id % 20 <> 1)""",
    "markers": MARKERS_SQL,
    "enrichment_progress": f"SELECT count(*) AS total, count(*) FILTER (user_id % 4 <> 0) AS finished, round(100.0 * count(*) FILTER (user_id % 4 <> 0) / count(*), 3) AS percent FROM ({MARKERS_SQL})",
    "page_fields": "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 's' || page_id ELSE '' END AS ipa, CASE WHEN page_id % 3 <> 0 THEN 'page ' || page_id || chr(10) || 'a & b' ELSE '' END AS definition, CASE WHEN page_id % 3 <> 0 THEN 'noun' ELSE '' END AS pos FROM pages",
}
