"""Assembly of entries from dictionary rows, dump records and WordNet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordlake.functions.collect import append_capped, clean_list, fold_text, ordered_lists, ordered_words
from wordlake.functions.digest import table_digest
from wordlake.functions.normalize import RELATED_RELATIONS, blank, fill_empty, keep_relation_types, map_pos
from wordlake.functions.overlay import is_object, put_members
from wordlake.operators.aggregates import dedupe
from wordlake.operators.joins import resolve_links, unbroadcast
from wordlake.operators.lineage import written
from wordlake.operators.rank import global_rank, top_n
from wordlake.plans import contract
from wordlake.schema import ENTRIES
from wordlake.sources.files import WordNet
from wordlake.sources.snapshots import manifest, read_bundle, write_bundle

STRINGS = "array<string>"
LINKS = "array<struct<word:string>>"
# Dump fields that make related words, caps, and dialect tags.
RELATED_FIELDS = ["derived", "related", "hypernyms", "hyponyms", "coordinate_terms", "meronyms"]
CAPS = {"definitions": 24, "examples": 12, "senses": 24}
US_TAGS = ["us", "general-american", "american"]
UK_TAGS = ["received-pronunciation", "british", "uk"]


def words(links: Column) -> Column:
    return F.transform(F.coalesce(links, F.array().cast(LINKS)), lambda x: x["word"])


def score_frequency(rows: DataFrame, frequency: DataFrame) -> DataFrame:
    """``score`` of rows (key, frq, bnc): Zipf if known, else negative logs of the ranks, else 0."""
    joined = rows.join(unbroadcast(frequency.select("key", "zipf")), "key", "left")
    frq, bnc = F.col("frq").try_cast("double"), F.col("bnc").try_cast("double")
    return joined.withColumn("score", F.when(F.col("zipf") > 0, F.col("zipf")).when(frq > 0, -F.log10(frq + 1)).when(bnc > 0, -10 - F.log10(bnc + 1)).otherwise(0.0))


def extract_dump(records: DataFrame) -> DataFrame:
    """Per dump record its lists: definitions, examples, synonyms, antonyms, related, senses, us, uk."""
    none = F.array().cast(STRINGS)
    senses = F.coalesce("senses", F.array())
    rows = records.withColumn("__s", senses)
    glosses = lambda s: F.when(F.size(F.coalesce(s["glosses"], none)) > 0, s["glosses"]).otherwise(F.coalesce(s["raw_glosses"], none))
    per_sense = lambda name: F.flatten(F.transform("__s", lambda s: words(s[name])))
    shown = F.flatten(F.transform("__s", lambda s: F.transform(F.filter(F.coalesce(s["examples"], F.array().cast("array<struct<text:string,type:string>>")), lambda e: F.coalesce(e["type"], F.lit("example")) == "example"), lambda e: e["text"])))
    sound = F.coalesce("sounds", F.array().cast("array<struct<ipa:string,enpr:string,tags:array<string>>>"))
    lowered = lambda x: F.transform(F.coalesce(x["tags"], none), lambda t: F.lower(t))
    tagged = lambda x, tags: F.arrays_overlap(lowered(x), F.array(*[F.lit(t) for t in tags]))
    ipa = lambda hits: F.coalesce(F.get(clean_list(F.transform(hits, lambda x: F.coalesce(F.nullif(x["ipa"], F.lit("")), x["enpr"])), 3), F.lit(0)), F.lit(""))
    return rows.select(
        "key", "line", "word", F.coalesce("pos", F.lit("")).alias("pos"),
        F.array_join(clean_list(F.flatten(F.transform("__s", glosses)), CAPS["definitions"]), "\n").alias("definition"),
        clean_list(shown, CAPS["examples"]).alias("examples"),
        clean_list(F.concat(words(F.col("synonyms")), per_sense("synonyms"))).alias("synonyms"),
        clean_list(F.concat(words(F.col("antonyms")), per_sense("antonyms"))).alias("antonyms"),
        clean_list(F.concat(*[words(F.col(c)) for c in RELATED_FIELDS], per_sense("related"))).alias("related_words"),
        F.slice(F.transform(F.filter("__s", lambda s: F.size(glosses(s)) > 0), lambda s: F.struct(F.coalesce("pos", F.lit("")).alias("pos"), clean_list(glosses(s), 12).alias("definitions"))), 1, CAPS["senses"]).alias("senses"),
        ipa(F.filter(sound, lambda x: tagged(x, US_TAGS))).alias("us_phonetic"),
        ipa(F.filter(sound, lambda x: tagged(x, UK_TAGS) & ~tagged(x, US_TAGS))).alias("uk_phonetic"),
    )


def ordered(column: str, line: str = "line") -> Column:
    """Aggregate: the group's values of a column in line order."""
    return F.transform(F.array_sort(F.collect_list(F.struct(F.col(line), F.col(column).alias("v")))), lambda r: r["v"])


def group_dump(extracted: DataFrame) -> DataFrame:
    """One row per key: lists united in line order under one cap, definitions folded.

    Lists and senses are cut to their caps before they are collected; a definition is all that the
    key's records say, so it grows with them.  The records are stored once, as every list reads them.
    """
    extracted = written(extracted, "dump-records")
    lists = {"examples": CAPS["examples"], "synonyms": 40, "antonyms": 40, "related_words": 40}
    first = lambda c: F.coalesce(F.min_by(c, F.when(~blank(F.col(c)), F.col("line"))), F.lit("")).alias(c)
    out = extracted.groupBy("key").agg(F.min_by("word", "line").alias("word"), first("pos"), fold_text(ordered("definition")).alias("definition"), first("us_phonetic"), first("uk_phonetic"))
    for c, n in lists.items():
        values = extracted.select("key", "line", F.posexplode(c).alias("at", "v"))
        out = out.join(unbroadcast(ordered_lists(values, ["key"], F.col("v"), F.col("line"), F.col("at"), cap=n, out=c)), "key", "left").withColumn(c, F.coalesce(c, F.array().cast(STRINGS)))
    senses = extracted.select("key", "line", F.posexplode("senses").alias("at", "s")).withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("line", "at"))).filter(F.col("n") <= CAPS["senses"])
    kept = senses.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "s"))), lambda r: r["s"]).alias("senses"))
    none = F.array().cast(extracted.schema["senses"].dataType)
    out = out.join(unbroadcast(kept), "key", "left").withColumn("senses", F.coalesce("senses", none))
    return out.withColumn("phrases", F.filter("related_words", lambda w: w.contains(" ") | w.contains("-")))


def assemble_entries(csv: DataFrame, dump: DataFrame, frequency: DataFrame) -> DataFrame:
    """Ranked entries: the dictionary's rows overlaid with the dump's, new keys added."""
    base = dedupe(csv, ["key"], F.col("line"), "longest", F.length(F.coalesce("definition", F.lit(""))))
    scored = score_frequency(base, frequency)
    b, d = scored.alias("b"), group_dump(extract_dump(dump)).alias("d")
    joined = b.join(d, F.col("b.key") == F.col("d.key"), "full_outer")
    both = lambda c: F.coalesce(fill_empty(F.col(f"b.{c}"), F.col(f"d.{c}"))["value"], F.lit("")).alias(c)
    none = F.array().cast(STRINGS)
    rows = joined.select(
        F.coalesce("b.key", "d.key").alias("normalized_word"),
        F.coalesce("b.word", "d.word").alias("word"),
        both("pos"),
        F.coalesce(fold_text(F.array(F.coalesce("b.definition", F.lit("")), F.coalesce("d.definition", F.lit("")))), F.lit("")).alias("definition"),
        F.coalesce("b.translation", F.lit("")).alias("definition_zh"),
        F.when(~blank(F.col("d.us_phonetic")), F.col("d.us_phonetic")).otherwise("").alias("us_phonetic"),
        F.when(~blank(F.col("b.phonetic")), F.col("b.phonetic")).otherwise(F.coalesce("d.uk_phonetic", F.lit(""))).alias("uk_phonetic"),
        *[F.coalesce(f"d.{c}", none).alias(c) for c in ("examples", "synonyms", "antonyms", "related_words", "phrases")],
        F.coalesce("d.senses", F.array().cast("array<struct<pos:string,definitions:array<string>>>")).alias("senses"),
        F.filter(F.array(F.when(F.col("b.key").isNotNull(), "ecdict"), F.when(F.col("d.key").isNotNull(), "kaikki")), lambda s: s.isNotNull()).alias("sources"),
        F.coalesce("b.score", F.lit(0.0)).alias("frequency"),
    )
    return ranked_by_frequency(rows).withColumn("id", F.col("frequency_rank").cast("long"))


def ranked_by_frequency(rows: DataFrame) -> DataFrame:
    """Rows with ``frequency_rank``: by frequency (0 last), then key."""
    order = F.when(F.coalesce("frequency", F.lit(0.0)) == 0, -20.0).otherwise(F.col("frequency"))
    return global_rank(rows.drop("frequency_rank"), [F.desc(order), F.asc("normalized_word")], "frequency_rank")


def finalize(entries: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """(the n best of the entries ranked anew, one row of counts: all rows, enriched and completed ones)."""
    ranked = ranked_by_frequency(entries)
    status = F.get_json_object("enrichment", "$.status")
    counts = entries.agg(F.count("*").alias("n_rows"), F.count_if(status.isNotNull()).alias("enriched"), F.count_if(status == "completed").alias("completed"))
    return top_n(ranked, "frequency_rank", n, "normalized_word"), counts


def publish(entries: DataFrame, n: int, path: str) -> None:
    """The n best entries as a bundle: rows ranked anew, their index built anew, and a manifest of both."""
    top, counts = finalize(entries, n)
    write_bundle({"entries": top, "index": contract.entry_index(top), "counts": counts}, path)
    rows = entries.sparkSession.read.parquet(f"{path}/entries")
    index = contract.posting_digests(entries.sparkSession.read.parquet(f"{path}/index"))
    about = manifest(rows).join(F.broadcast(table_digest(index, "id", F.col("digest")).select(F.col("digest").alias("index_digest"))))
    about.write.mode("errorifexists").json(f"{path}/manifest")


def published(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of a published bundle; refused if rows or index are not those of its manifest."""
    tables = read_bundle(spark, path)
    said = spark.read.json(f"{path}/manifest").first()
    now = manifest(tables["entries"]).first()
    index = table_digest(contract.posting_digests(tables["index"]), "id", F.col("digest")).first()
    if now["digest"] != said["digest"] or index["digest"] != said["index_digest"]:
        raise ValueError("the bundle is not that of its manifest")
    return tables


def sense_rows(wn: WordNet) -> DataFrame:
    """Entry, sense and synset of every sense."""
    return wn.entries.select("entry_id", "key", "written", "pos").join(unbroadcast(wn.senses), "entry_id").join(unbroadcast(wn.synsets.select("synset_id", "ili", F.col("definitions"), F.col("examples").alias("synset_examples"))), "synset_id")


def targets(wn: WordNet) -> DataFrame:
    """Every sense as a link's target: its written form, synset and the synset's first definition."""
    own = F.filter("definitions", lambda d: d["source_sense"].isNull() | (d["source_sense"] == F.col("sense_id")))
    return sense_rows(wn).select(F.col("sense_id").alias("target_sense"), F.col("synset_id").alias("target_synset"), F.col("entry_id").alias("target_entry"), F.col("key").alias("target_key"), F.col("written").alias("target_word"), F.coalesce(F.get(F.transform(own, lambda d: d["text"]), F.lit(0)), F.lit("")).alias("target_definition"))


def sense_links(wn: WordNet) -> DataFrame:
    """Links between words over sense relations, one row per source key and target."""
    edges = keep_relation_types(wn.sense_relations)
    source = sense_rows(wn).select("key", "sense_id", "sense_order", "entry_id")
    return source.join(unbroadcast(edges), "sense_id").join(unbroadcast(targets(wn)), F.col("target") == F.col("target_sense")).filter("key <> target_key").withColumn("kind", F.lit(0))


def synset_links(wn: WordNet) -> DataFrame:
    """Links between words over synset relations."""
    edges = keep_relation_types(wn.synset_relations)
    source = sense_rows(wn).select("key", "sense_id", "sense_order", "entry_id", "synset_id")
    return source.join(unbroadcast(edges), "synset_id").join(unbroadcast(targets(wn)), F.col("target") == F.col("target_synset")).filter("key <> target_key").withColumn("kind", F.lit(1))


def synonyms(wn: WordNet) -> DataFrame:
    """Pairs of words that share a synset."""
    a = sense_rows(wn).select("key", "entry_id", "sense_order", "synset_id")
    b = sense_rows(wn).select("synset_id", F.col("key").alias("target_key"), F.col("written").alias("target_word"), F.col("sense_order").alias("target_order"), F.col("entry_id").alias("target_entry"))
    return a.join(unbroadcast(b), "synset_id").filter("key <> target_key")


def own_texts() -> Column:
    """The definitions of a sense's synset that are meant for the sense."""
    own = F.filter("definitions", lambda d: d["source_sense"].isNull() | (d["source_sense"] == "") | (d["source_sense"] == F.col("sense_id")))
    return F.transform(own, lambda d: d["text"])


def wordnet_patch(wn: WordNet, target_order: bool = True) -> DataFrame:
    """Per key what WordNet says: pos, phonetics, definitions, examples, synonyms, antonyms, links.

    Every list is cut to its cap before it is collected, so no key gathers more.  Synonyms of one
    sense stand by their own senses' order and then by entry; without ``target_order`` by entry alone.
    """
    rows = sense_rows(wn)
    place = [F.col(c) for c in ("sense_order", "entry_id", "sense_id", "at")]
    values = lambda c: rows.select("key", "sense_order", "entry_id", "sense_id", F.posexplode(c).alias("at", "v"))
    listed = lambda c, cap, out: ordered_lists(values(c), ["key"], F.col("v"), *place, cap=cap, out=out)
    base = listed(F.array(map_pos(F.col("pos"))), 8, "pos").join(unbroadcast(listed(own_texts(), 24, "definition")), "key", "left").join(unbroadcast(listed(F.concat("examples", "synset_examples"), 12, "examples")), "key", "left")
    lines = lambda c, by: F.coalesce(F.array_join(c, by), F.lit("")).alias(c)
    empty = F.array().cast(STRINGS)
    base = base.select("key", lines("pos", ", "), lines("definition", "\n"), F.coalesce("examples", empty).alias("examples"))
    sound = wn.entries.select("key", "entry_id", F.posexplode("sounds").alias("ord", "s"))
    variety = lambda names: F.coalesce(F.min_by("s._VALUE", F.when(F.lower(F.col("s._variety")).isin(*names) & ~blank(F.col("s._VALUE")), F.struct("entry_id", "ord"))), F.lit(""))
    sounds = sound.groupBy("key").agg(variety(["us", "en-us", "ga"]).alias("us_phonetic"), variety(["gb", "uk", "en-gb", "rp"]).alias("uk_phonetic"))
    same = ordered_lists(synonyms(wn), ["key"], F.col("target_word"), F.col("sense_order"), *([F.col("target_order")] if target_order else []), F.col("target_entry"), out="synonyms")
    columns = ["key", "kind", "sense_order", "ord", "target_entry", "relation", "target_word", "target_definition"]
    links = sense_links(wn).select(*columns).unionByName(synset_links(wn).select(*columns)).withColumn("o", F.struct("kind", "sense_order", "ord", "target_entry"))
    against = ordered_lists(links.filter("relation = 'antonym'"), ["key"], F.col("target_word"), F.col("o"), out="antonyms")
    near = links.filter(F.col("relation").isin(*RELATED_RELATIONS)).select("key", F.col("o").alias("ord"), F.col("target_word").alias("word"), F.col("target_definition").alias("definition"))
    known = base.select("key", "definition")
    related = resolve_links(near, known).withColumnRenamed("links", "related_entries")
    out = base
    for more in (sounds, same, against, related):
        out = out.join(unbroadcast(more), "key", "left")
    named = F.coalesce("related_entries", F.array().cast("array<struct<word:string,definition:string>>"))
    return out.select(
        "key", "pos", "definition", "examples", F.coalesce("us_phonetic", F.lit("")).alias("us_phonetic"), F.coalesce("uk_phonetic", F.lit("")).alias("uk_phonetic"),
        F.coalesce("synonyms", empty).alias("synonyms"), F.coalesce("antonyms", empty).alias("antonyms"), named.alias("related_entries"), F.transform(named, lambda e: e["word"]).alias("related_words"),
    ).withColumn("phrases", F.filter("related_words", lambda w: w.contains(" ") | w.contains("-")))


def wordnet_senses(wn: WordNet, source: str = "oewn") -> DataFrame:
    """One row per sense: key, place, source, synset, form, and ``sense`` as the entries hold it.

    Relations are typed: per type the words named by the sense, then by its synset.  What the
    entries' senses have no column for (synset, form, order, ili, examples, synonyms) is in the
    sense's ``extra``, an open JSON object.
    """
    rows = sense_rows(wn).withColumn("texts", clean_list(own_texts(), 24))
    columns = ["key", "sense_id", "kind", "ord", "target_entry", "relation", "target_word"]
    links = sense_links(wn).select(*columns).unionByName(synset_links(wn).select(*columns))
    typed = ordered_words(links, ["key", "sense_id", "relation"], F.col("target_word"), F.col("kind"), F.col("ord"), F.col("target_entry"), out="words")
    relations = typed.groupBy("key", "sense_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("relation", "words")))).alias("relations"))
    same = ordered_words(synonyms(wn), ["key", "synset_id"], F.col("target_word"), F.col("target_order"), F.col("target_entry"), out="synonyms")
    joined = rows.join(unbroadcast(relations), ["key", "sense_id"], "left").join(unbroadcast(same), ["key", "synset_id"], "left")
    shown = clean_list(F.concat("examples", "synset_examples"), 40)
    filled = lambda c: F.when(F.size(c) > 0, c)
    extra = F.to_json(F.struct(
        F.lit(source).alias("source"), F.col("synset_id").alias("synset"), F.col("written").alias("writtenForm"), F.col("sense_order").alias("order"),
        F.when(~blank(F.col("ili")), F.col("ili")).alias("ili"), filled(shown).alias("examples"), filled(F.col("synonyms")).alias("synonyms"),
    ))
    sense = F.struct(F.coalesce("pos", F.lit("")).alias("pos"), F.col("texts").alias("definitions"), F.lit(None).cast(STRINGS).alias("sense_ids"), F.col("relations"), F.lit(None).cast("map<string,array<string>>").alias("relation_sources"), extra.alias("extra"))
    return joined.select("key", F.struct("sense_order", "entry_id", "sense_id").alias("place"), F.lit(source).alias("source"), F.col("synset_id").alias("synset"), F.col("written").alias("form"), F.coalesce("pos", F.lit("")).alias("pos"), sense.alias("sense"))


def apply_senses(entries: DataFrame, senses: DataFrame, key: str = "normalized_word", cap: int = 40, provenance: tuple[str, str] | None = None) -> DataFrame:
    """Entries with the senses they lack, by (source, synset, form, pos): at most ``cap`` new ones each.

    What is there stays as it is, keys of ``extra`` that nobody knows too.  With ``provenance`` (a
    key and a JSON object) rows that have a patch say so in their scope; a scope that is no JSON
    object is left alone.
    """
    of = ["source", "synset", "form", "pos"]
    said = lambda path: F.coalesce(F.get_json_object("s.extra", path), F.lit(""))
    known = entries.select(F.col(key).alias("key"), F.explode("senses").alias("s")).select("key", said("$.source").alias("source"), said("$.synset").alias("synset"), said("$.writtenForm").alias("form"), F.coalesce("s.pos", F.lit("")).alias("pos")).distinct()
    first = senses.groupBy("key", *of).agg(F.min("place").alias("place"), F.min_by("sense", "place").alias("sense"))
    new = first.join(unbroadcast(known), ["key", *of], "left_anti").withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("place"))).filter(F.col("n") <= cap)
    lists = new.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", F.to_json("sense").alias("sense")))), lambda r: F.from_json(r["sense"], ENTRIES["senses"][len("array<"):-1])).alias("__new"))
    patched = senses.select("key").distinct().join(unbroadcast(lists), "key", "left").withColumnRenamed("key", "__key")
    joined = entries.join(unbroadcast(patched), F.col(key) == F.col("__key"), "left")
    none = F.array().cast(ENTRIES["senses"])
    out = {"senses": F.concat(F.coalesce("senses", none), F.coalesce("__new", none).cast(ENTRIES["senses"]))}
    if provenance:
        fine = F.col("__key").isNotNull() & (is_object(F.col("scope")) | blank(F.col("scope")))
        out["scope"] = F.when(fine, put_members(F.col("scope"), {provenance[0]: F.lit(provenance[1])})).otherwise(F.col("scope"))
    return joined.select(*[out[c].alias(c) if c in out else F.col(c) for c in entries.columns])


def apply_patch(entries: DataFrame, patch: DataFrame, key: str = "normalized_word", source: str = "oewn") -> tuple[DataFrame, DataFrame]:
    """(entries with blanks filled and lists appended, statistics); rows are never added."""
    scalars = [c for c in ("pos", "us_phonetic", "uk_phonetic", "definition") if c in entries.columns]
    lists = [c for c in ("synonyms", "antonyms", "examples", "phrases", "related_words") if c in entries.columns]
    p = patch.select(F.col("key").alias("__key"), *[F.col(c).alias(f"p_{c}") for c in scalars + lists])
    joined = entries.join(unbroadcast(p), F.col(key) == F.col("__key"), "left")
    filled = {c: fill_empty(F.col(c), F.col(f"p_{c}")) for c in scalars}
    grown = {c: append_capped(F.col(c), F.col(f"p_{c}"), 40) for c in lists}
    hit = F.col("__key").isNotNull()
    out = {c: f["value"] for c, f in filled.items()} | {c: F.when(hit, g).otherwise(F.col(c)) for c, g in grown.items()}
    if "sources" in entries.columns:
        out["sources"] = F.when(hit, append_capped(F.col("sources"), F.array(F.lit(source)), 40)).otherwise(F.col("sources"))
    stats = joined.agg(
        F.count("*").alias("n_rows"), F.count_if(hit).alias("matched"),
        *[F.count_if(blank(F.col(c)) & ~blank(F.col(f"p_{c}"))).alias(f"{c}_filled") for c in scalars],
        *[F.coalesce(F.sum(F.size(grown[c]) - F.size(F.coalesce(F.col(c), F.array().cast(STRINGS)))), F.lit(0)).alias(f"{c}_added") for c in lists],
        sum((F.count_if(f["conflict"]) for f in filled.values()), F.lit(0)).alias("conflicts_kept"),
    )
    return joined.select(*[out[c].alias(c) if c in out else F.col(c) for c in entries.columns]), stats
