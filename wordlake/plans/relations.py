"""Sense-relation deltas: build, check, apply.

A delta holds, per entry, only what the entry lacks: typed relations per sense (found again by
part of speech, definitions and sense ids) and related words that name an entry, each with that
entry's definition and only while both capped lists have room.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordlake.functions.collect import append_capped, clean_list
from wordlake.functions.digest import framed
from wordlake.functions.normalize import blank, norm_key
from wordlake.operators.joins import unbroadcast
from wordlake.operators.lineage import written
from wordlake.sources.files import RELATION_FIELDS

# Relations that become related words, in this order.
SEMANTIC_FIELDS = ["hypernyms", "hyponyms", "coordinate_terms", "meronyms", "holonyms", "troponyms"]
CAP = 40
STRINGS = "array<string>"
NAMED = "array<struct<word:string,definition:string>>"


def strings(c: Column) -> Column:
    return F.coalesce(c, F.array().cast(STRINGS))


def relation_senses(records: DataFrame) -> DataFrame:
    """One row per dump sense that has typed relations: key, line, ord, pos, definitions, sense_ids, relations."""
    rows = records.select("key", "line", F.coalesce("pos", F.lit("")).alias("pos"), F.posexplode("senses").alias("ord", "s"))
    names = lambda f: clean_list(F.transform(F.coalesce(F.col(f"s.{f}"), F.array().cast("array<struct<word:string>>")), lambda x: x["word"]))
    full = F.map_from_arrays(F.array(*[F.lit(f) for f in RELATION_FIELDS]), F.array(*[names(f) for f in RELATION_FIELDS]))
    glosses = F.when(F.size(strings(F.col("s.glosses"))) > 0, F.col("s.glosses")).otherwise(strings(F.col("s.raw_glosses")))
    out = rows.select("key", "line", "ord", "pos", clean_list(glosses, 12).alias("definitions"), clean_list(strings(F.col("s.senseid")), 12).alias("sense_ids"), F.map_filter(full, lambda k, v: F.size(v) > 0).alias("relations"))
    return out.filter(F.size("relations") > 0)


def merged_patches(senses: DataFrame) -> DataFrame:
    """Per key its patches, one per sense: repeated senses are merged in file order under one cap."""
    items = senses.select("key", "pos", "definitions", "sense_ids", F.struct("line", "ord").alias("o"), F.explode("relations").alias("field", "words"))
    per = items.groupBy("key", "pos", "definitions", "sense_ids", "field").agg(F.min("o").alias("o"), F.array_sort(F.collect_list(F.struct("o", "words"))).alias("w"))
    per = per.withColumn("words", clean_list(F.flatten(F.transform("w", lambda x: x["words"])), CAP))
    sense = per.groupBy("key", "pos", "definitions", "sense_ids").agg(F.min("o").alias("o"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "words")))).alias("relations"))
    rows = F.array_sort(F.collect_list(F.struct("o", "pos", "definitions", "sense_ids", F.map_entries("relations").alias("relations"))))
    patches = F.transform(rows, lambda r: F.struct(r["pos"].alias("pos"), r["definitions"].alias("definitions"), r["sense_ids"].alias("sense_ids"), F.map_from_entries(r["relations"]).alias("relations")))
    return sense.groupBy("key").agg(patches.alias("patches"))


def same_sense(sense: Column, patch: Column) -> Column:
    """Equal part of speech, cleaned definitions, and sense ids where both have some."""
    ids, own = strings(patch["sense_ids"]), clean_list(strings(sense["sense_ids"]), 12)
    return (F.coalesce(sense["pos"], F.lit("")) == patch["pos"]) & (clean_list(strings(sense["definitions"])) == patch["definitions"]) & ((F.size(ids) == 0) | (F.size(own) == 0) | (own == ids))


def fingerprint(sense: Column) -> Column:
    """24 hex digits that name a sense."""
    return F.substring(F.sha2(F.concat(framed(sense["pos"]), framed(F.array_join(strings(sense["definitions"]), "\n")), framed(F.array_join(strings(sense["sense_ids"]), "\n"))), 256), 1, 24)


def flat_links(senses: DataFrame) -> DataFrame:
    """(key, ord, word) of the semantic relations in the order of their fields."""
    fields = F.array(*[F.struct(F.lit(i).alias("f"), F.col("relations")[name].alias("w")) for i, name in enumerate(SEMANTIC_FIELDS)])
    rows = senses.select("key", "line", "ord", F.explode(fields).alias("x")).select("key", "line", "ord", "x.f", F.posexplode(strings(F.col("x.w"))).alias("p", "word"))
    return rows.select("key", F.struct("line", "f", "ord", "p").alias("ord"), "word", F.lit(None).cast("string").alias("definition"))


def keys_of(flat: Column, named: Column) -> Column:
    """struct(words, entries, defined): normalized keys of a flat list, of a named list, and of its items with a definition."""
    named = F.coalesce(named, F.array().cast(NAMED))
    items = lambda c: F.transform(c, lambda e: norm_key(e["word"]))
    return F.struct(F.transform(strings(flat), lambda w: norm_key(w)).alias("words"), items(named).alias("entries"), items(F.filter(named, lambda e: ~blank(e["definition"]))).alias("defined"))


def paired(candidates: Column, flat: str, named: str, keys: str) -> Column:
    """struct(words, entries, pairs) that a flat and a named list take from candidates, one after the other.

    A candidate lacks its word, its entry, or both (by normalized key; ``keys`` is a column of
    ``keys_of``) and is taken only if every list that lacks it has room, so the lists stay a pair.
    An entry without a definition is neither replaced nor joined by a flat word.
    """
    room = lambda c: F.greatest(F.lit(0), F.lit(CAP) - F.size(c)).alias
    start = F.struct(room(strings(F.col(flat)))("words"), room(F.coalesce(F.col(named), F.array().cast(NAMED)))("entries"), F.array().cast(NAMED).alias("pairs"), F.array().cast(NAMED).alias("new_words"), F.array().cast(NAMED).alias("new_entries"))

    def step(state: Column, c: Column) -> Column:
        key = norm_key(c["word"])
        word, entry = ~F.array_contains(F.col(keys)["words"], key), ~F.array_contains(F.col(keys)["defined"], key)
        fine = (word | entry) & ~(entry & F.array_contains(F.col(keys)["entries"], key)) & (~word | (state["words"] > 0)) & (~entry | (state["entries"] > 0))
        fine = fine & ~blank(c["word"]) & ~blank(c["definition"]) & ~F.exists(state["pairs"], lambda x: norm_key(x["word"]) == key)
        pair = F.array(F.struct(c["word"].alias("word"), c["definition"].alias("definition"))).cast(NAMED)
        less = lambda n, lacks: (state[n] - F.when(fine & lacks, 1).otherwise(0)).alias(n)
        more = lambda n, lacks: F.when(fine & lacks, F.concat(state[n], pair)).otherwise(state[n]).alias(n)
        return F.struct(less("words", word), less("entries", entry), more("pairs", F.lit(True)), more("new_words", word), more("new_entries", entry))

    done = lambda s: F.struct(F.transform(s["new_words"], lambda x: x["word"]).alias("words"), s["new_entries"].alias("entries"), s["pairs"].alias("pairs"))
    return F.aggregate(F.coalesce(candidates, F.array().cast(NAMED)), start, step, done)


def link_candidates(senses: DataFrame, entries: DataFrame) -> DataFrame:
    """key, target, word, definition, ord, phrase_ord: the entries that a key's links name by normalized key, each once, with where it is named first."""
    e = entries.select(F.col("normalized_word").alias("target"), F.col("word").alias("found"), "definition").filter(~blank(F.col("found")) & ~blank(F.col("definition")))
    links = flat_links(senses).select("key", "ord", "word", norm_key(F.col("word")).alias("target")).filter((F.col("target") != F.col("key")) & (F.col("target") != ""))
    part = lambda c: F.col(c).contains(" ") | F.col(c).contains("-")
    named = links.join(unbroadcast(e), "target")
    return named.groupBy("key", "target").agg(F.first("found").alias("word"), F.first("definition").alias("definition"), F.min("ord").alias("ord"), F.min(F.when(part("word") | part("found"), F.col("ord"))).alias("phrase_ord"))


def list_candidates(candidates: DataFrame, entries: DataFrame, flat: str, named: str, order: str) -> DataFrame:
    """key and its candidates for one pair of lists, in order: no more than the lists could take.

    Words that the flat list has, and entries without a definition, are left out first; of the
    others the first ``CAP`` with an entry and the first ``CAP`` without one are all that the lists
    could take, so no key gathers more.
    """
    has = entries.select(F.col("normalized_word").alias("key"), keys_of(F.col(flat), F.col(named)).alias("k"))
    words = has.select("key", F.explode("k.words").alias("target")).distinct()
    known = has.select("key", F.explode(F.arrays_zip(F.col("k.entries").alias("target"), F.transform("k.entries", lambda t: F.array_contains(F.col("k.defined"), t)).alias("defined"))).alias("x")).select("key", "x.*").groupBy("key", "target").agg(F.max("defined").alias("defined"))
    open_ = candidates.filter(F.col(order).isNotNull()).join(unbroadcast(words), ["key", "target"], "left_anti").join(unbroadcast(known), ["key", "target"], "left").filter(F.coalesce("defined", F.lit(True)))
    place = F.row_number().over(Window.partitionBy("key", F.col("defined").isNotNull()).orderBy(order, "target"))
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), "target", "word", "definition")))
    return open_.withColumn("place", place).filter(F.col("place") <= CAP).groupBy("key").agg(F.transform(rows, lambda r: F.struct(r["word"].alias("word"), r["definition"].alias("definition"))).cast(NAMED).alias("c"))


def relation_delta(entries: DataFrame, records: DataFrame) -> DataFrame:
    """Delta rows: id, key, related, phrases (named lists), patches (index, fingerprint, sense).

    The senses are stored once, as lists and patches are both made of them.
    """
    senses = written(relation_senses(records).join(unbroadcast(entries.select(F.col("normalized_word").alias("key"))), "key", "left_semi"), "relation-senses")
    candidates = link_candidates(senses, entries)
    joined = entries.join(unbroadcast(merged_patches(senses)), F.col("normalized_word") == F.col("key"), "inner").drop("key")
    for name, flat, named, order in (("related", "related_words", "related_entries", "ord"), ("phrases", "phrases", "phrase_entries", "phrase_ord")):
        found = list_candidates(candidates, entries, flat, named, order).select(F.col("key").alias("k"), F.col("c").alias(f"__{name}"))
        joined = joined.join(unbroadcast(found), F.col("normalized_word") == F.col("k"), "left").drop("k").withColumn(f"__{name}_keys", keys_of(F.col(flat), F.col(named)))
    room = lambda name, flat, named: paired(F.col(f"__{name}"), flat, named, f"__{name}_keys")["pairs"].alias(name)
    own = F.coalesce("senses", F.array())

    def lacking(p: Column) -> Column:
        at = F.try_element_at(F.filter(F.transform(own, lambda s, i: F.when(same_sense(s, p), i)), lambda i: i.isNotNull()), F.lit(1))
        known = F.try_element_at(F.filter(own, lambda s: same_sense(s, p)), F.lit(1))
        fresh = F.map_filter(F.transform_values(p["relations"], lambda f, w: F.filter(w, lambda x: ~F.array_contains(strings(F.coalesce(known["relations"], F.create_map().cast("map<string,array<string>>"))[f]), x))), lambda f, w: F.size(w) > 0)
        return F.struct(at.alias("index"), F.when(at.isNotNull(), fingerprint(known)).alias("fingerprint"), p["pos"].alias("pos"), p["definitions"].alias("definitions"), p["sense_ids"].alias("sense_ids"), fresh.alias("relations"))

    patches = F.filter(F.transform("patches", lacking), lambda p: F.size(p["relations"]) > 0)
    out = joined.select("id", F.col("normalized_word").alias("key"), room("related", "related_words", "related_entries"), room("phrases", "phrases", "phrase_entries"), patches.alias("patches"))
    return out.filter((F.size("related") > 0) | (F.size("phrases") > 0) | (F.size("patches") > 0))


def check_relation_delta(delta: DataFrame, entries: DataFrame) -> DataFrame:
    """(code, example) rows, all that a row breaks: repeated rows, unknown ids, other keys, undefined or repeated words, unknown relations, moved senses."""
    e = entries.select("id", F.col("normalized_word").alias("k"), F.coalesce("senses", F.array()).alias("senses"))
    joined = delta.join(unbroadcast(e), "id", "left")
    repeated = delta.groupBy("id").count().filter("count > 1").select(F.lit("duplicate_row").alias("code"), F.col("id").cast("string").alias("example"))
    keys = lambda c: F.transform(c, lambda x: norm_key(x["word"]))
    twice = (F.size(F.array_distinct(keys("related"))) < F.size("related")) | (F.size(F.array_distinct(keys("phrases"))) < F.size("phrases"))
    undefined = F.exists(F.concat("related", "phrases"), lambda x: blank(x["word"]) | blank(x["definition"]))
    unknown = F.exists("patches", lambda p: F.exists(F.map_keys(p["relations"]), lambda f: ~f.isin(*RELATION_FIELDS)))
    moved = F.exists("patches", lambda p: p["index"].isNotNull() & ~F.coalesce(fingerprint(F.try_element_at(F.col("senses"), (p["index"] + 1).cast("int"))), F.lit("")).eqNullSafe(p["fingerprint"]))
    there = F.col("k").isNotNull()
    rules = {"canonical_missing": ~there, "identity_mismatch": there & (F.col("k") != F.col("key")), "unpaired_value": undefined, "duplicate_value": twice, "unknown_relation": unknown, "sense_mismatch": there & moved}
    codes = F.filter(F.array(*[F.when(F.coalesce(rule, F.lit(False)), code) for code, rule in rules.items()]), lambda c: c.isNotNull())
    return joined.select(F.explode(codes).alias("code"), F.col("id").cast("string").alias("example")).unionByName(repeated)


def check_delta_manifest(delta: DataFrame, manifest: DataFrame, licence: str) -> DataFrame:
    """(code, example): a manifest that is no single row, or of another licence, digest form or number of rows than the delta's."""
    one = manifest.agg(F.count("*").alias("rows"), *[F.min(c).alias(c) for c in ("licence", "source_digest", "n_rows")]).join(F.broadcast(delta.agg(F.count("*").alias("found"))))
    rules = {
        "metadata": (F.col("rows") != 1, F.col("rows").cast("string")), "licence_mismatch": (~F.col("licence").eqNullSafe(F.lit(licence)), F.col("licence")),
        "digest_malformed": (~F.coalesce(F.col("source_digest").rlike("^[0-9a-f]{64}$"), F.lit(False)), F.col("source_digest")), "row_count": (~F.col("n_rows").eqNullSafe(F.col("found")), F.col("found").cast("string")),
    }
    codes = F.array(*[F.when(rule, F.struct(F.lit(code).alias("code"), example.alias("example"))) for code, (rule, example) in rules.items()])
    return one.select(F.explode(F.filter(codes, lambda c: c.isNotNull())).alias("c")).select("c.code", "c.example")


def apply_relation_delta(entries: DataFrame, delta: DataFrame, id_range: tuple[int, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """(entries with the delta appended, statistics); a second run changes nothing.

    Refused as a whole if ``check_relation_delta`` finds anything.
    """
    if id_range:
        delta = delta.filter(F.col("id").between(*id_range))
    if bad := check_relation_delta(delta, entries).limit(5).collect():
        raise ValueError(f"delta refused: {bad}")
    d = delta.select(F.col("id").alias("__id"), F.col("related").alias("__r"), F.col("phrases").alias("__p"), F.col("patches").alias("__s"))
    joined = entries.join(unbroadcast(d), F.col("id") == F.col("__id"), "left")
    joined = joined.withColumns({f"__{name}_keys": keys_of(F.col(flat), F.col(named)) for name, flat, named in (("r", "related_words", "related_entries"), ("p", "phrases", "phrase_entries"))})
    joined = joined.withColumns({f"__{name}_new": paired(F.col(f"__{name}"), flat, named, f"__{name}_keys") for name, flat, named in (("r", "related_words", "related_entries"), ("p", "phrases", "phrase_entries"))})

    def grown(flat: str, named: str, name: str) -> tuple[Column, Column]:
        return F.concat(strings(F.col(flat)), F.col(f"{name}_new.words")), F.concat(F.coalesce(F.col(named), F.array().cast(NAMED)), F.col(f"{name}_new.entries"))

    relations = "map<string,array<string>>"
    own = F.coalesce("senses", F.array())
    given = F.col("__s")
    empty_map = F.create_map().cast(relations)

    def merged(s: Column) -> Column:
        p = F.try_element_at(F.filter(given, lambda x: same_sense(s, x)), F.lit(1))
        old, new = F.coalesce(s["relations"], empty_map), F.coalesce(p["relations"], empty_map)
        both = F.map_zip_with(old, new, lambda k, a, b: append_capped(a, b, CAP))
        sources = F.map_zip_with(F.coalesce(s["relation_sources"], empty_map), new, lambda k, a, b: F.when(b.isNotNull(), F.array_union(strings(a), F.array(F.lit("kaikki")))).otherwise(a))
        hit = p.isNotNull()
        return F.struct(s["pos"].alias("pos"), s["definitions"].alias("definitions"), s["sense_ids"].alias("sense_ids"), F.when(hit, both).otherwise(s["relations"]).alias("relations"), F.when(hit, sources).otherwise(s["relation_sources"]).alias("relation_sources"), s["extra"].alias("extra"))

    fresh = F.filter(given, lambda p: ~F.exists(own, lambda s: same_sense(s, p)))
    added = F.transform(fresh, lambda p: F.struct(p["pos"].alias("pos"), p["definitions"].alias("definitions"), F.when(F.size(p["sense_ids"]) > 0, p["sense_ids"]).alias("sense_ids"), p["relations"].alias("relations"), F.transform_values(p["relations"], lambda k, v: F.array(F.lit("kaikki"))).alias("relation_sources"), F.lit(None).cast("string").alias("extra")))
    hit = F.col("__id").isNotNull()
    related, related_entries = grown("related_words", "related_entries", "__r")
    phrases, phrase_entries = grown("phrases", "phrase_entries", "__p")
    out = {
        "related_words": related, "related_entries": related_entries, "phrases": phrases, "phrase_entries": phrase_entries, "senses": F.concat(F.transform(own, merged), added),
        "sources": append_capped(F.col("sources"), F.array(F.lit("kaikki"))),
    }
    # under names of their own first: an alias that hides a column would be seen inside later lambdas
    joined = joined.withColumns({f"__new_{c}": F.when(hit, x).otherwise(F.col(c)) for c, x in out.items() if c in entries.columns})
    result = joined.select(*[F.col(f"__new_{c}").alias(c) if c in out else F.col(c) for c in entries.columns], F.struct(*[F.col(c).alias(c) for c in ("related_words", "phrases", "senses")]).alias("__old"))
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    as_text = lambda c: F.to_json(F.struct(c))
    changed = (as_text(F.col("related_words")) != as_text(F.col("__old.related_words").alias("related_words"))) | (as_text(F.col("phrases")) != as_text(F.col("__old.phrases").alias("phrases"))) | (as_text(F.col("senses")) != as_text(F.col("__old.senses").alias("senses")))
    stats = result.agg(F.count("*").alias("n_rows"), F.count_if(changed).alias("changed"), F.sum(size("related_words") - size("__old.related_words")).alias("related_added"), F.sum(size("phrases") - size("__old.phrases")).alias("phrases_added"))
    return result.drop("__old"), stats
