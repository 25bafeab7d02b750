"""Enrichment from landed provider responses, and the work that is due."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordlake.functions.collect import append_capped, clean_list, merge_named
from wordlake.functions.normalize import blank, fill_empty, norm_key, normalize_phonetic, quality_gaps, resolved_difficulty
from wordlake.operators.lookup import html_text

DICTIONARY_SCHEMA = (
    "array<struct<word:string,phonetic:string,phonetics:array<struct<text:string,audio:string>>,meanings:array<struct<partOfSpeech:string,synonyms:array<string>,antonyms:array<string>,"
    "definitions:array<struct<definition:string,example:string,synonyms:array<string>,antonyms:array<string>>>>>>>"
)
ASSOCIATION_SCHEMA = "array<struct<word:string,defs:array<string>,tags:array<string>>>"
# Part-of-speech tags, finished states, the top of the frequency scale, lists that a deep pass fills.
TAG_POS = {"n": "noun", "v": "verb", "adj": "adjective", "adv": "adverb"}
FINISHED = ["completed", "partial", "not_found"]
HIGHEST_FREQUENCY = 10
DEEP_LISTS = ["synonyms", "antonyms", "related_words", "phrases"]


def each(values: Column, get) -> Column:  # noqa: ANN001
    """All values of a nested list in order, nulls as empty lists."""
    return F.flatten(F.transform(values, get))


def dictionary_fields(responses: DataFrame, json_col: str = "response") -> DataFrame:
    """Definition, examples, relations, parts of speech and phonetics of dictionary responses.

    A phonetic counts as US or UK only where its audio link says so.
    """
    rows = responses.withColumn("__r", F.coalesce(F.from_json(json_col, DICTIONARY_SCHEMA), F.from_json(F.lit("[]"), DICTIONARY_SCHEMA)))
    meanings = F.flatten(F.transform("__r", lambda e: F.coalesce(e["meanings"], F.array().cast("array<struct<partOfSpeech:string,synonyms:array<string>,antonyms:array<string>,definitions:array<struct<definition:string,example:string,synonyms:array<string>,antonyms:array<string>>>>>"))))
    rows = rows.withColumn("__m", meanings)
    strings, senses, sounds = "array<string>", "array<struct<definition:string,example:string,synonyms:array<string>,antonyms:array<string>>>", "array<struct<text:string,audio:string>>"
    defs = F.flatten(F.transform("__m", lambda m: F.coalesce(m["definitions"], F.array().cast(senses))))
    rows = rows.withColumn("__d", defs).withColumn("__s", F.flatten(F.transform("__r", lambda e: F.coalesce(e["phonetics"], F.array().cast(sounds)))))

    def related(name: str) -> Column:
        per_meaning = F.transform("__m", lambda m: F.concat(F.flatten(F.transform(F.coalesce(m["definitions"], F.array().cast(senses)), lambda d: F.coalesce(d[name], F.array().cast(strings)))), F.coalesce(m[name], F.array().cast(strings))))
        return clean_list(F.flatten(per_meaning))

    def dialect(name: str) -> Column:
        hits = F.filter("__s", lambda s: (F.lower(s["audio"]).contains(f"-{name}.") | F.lower(s["audio"]).contains(f"/{name}/")) & (normalize_phonetic(s["text"]) != ""))
        return F.coalesce(F.get(F.transform(hits, lambda s: normalize_phonetic(s["text"])), F.lit(0)), F.lit(""))

    keep = [c for c in responses.columns if c != json_col]
    return rows.select(
        *keep,
        F.array_join(clean_list(F.transform("__d", lambda d: d["definition"]), 24), "\n").alias("definition"),
        clean_list(F.transform("__d", lambda d: d["example"]), 8).alias("examples"),
        related("synonyms").alias("synonyms"),
        related("antonyms").alias("antonyms"),
        F.array_join(clean_list(F.transform("__m", lambda m: m["partOfSpeech"]), 8), ", ").alias("pos"),
        dialect("us").alias("us"),
        dialect("uk").alias("uk"),
    )


def association_fields(responses: DataFrame, json_col: str = "response", exact: str | None = None) -> DataFrame:
    """Words, definitions, frequency (3 + log10 per million), phonetic and parts of speech of
    association responses; with ``exact``, only items whose word equals that column."""
    empty = F.from_json(F.lit("[]"), ASSOCIATION_SCHEMA)
    rows = responses.withColumn("__r", F.coalesce(F.from_json(json_col, ASSOCIATION_SCHEMA), empty))
    if exact:
        rows = rows.withColumn("__r", F.filter("__r", lambda i: norm_key(i["word"]).eqNullSafe(norm_key(F.col(exact)))))
    strings = F.array().cast("array<string>")
    tags = F.flatten(F.transform("__r", lambda i: F.coalesce(i["tags"], strings)))
    names = F.create_map(*[F.lit(x) for pair in TAG_POS.items() for x in pair])
    rows = rows.withColumn("__t", tags)
    per_million = F.transform(F.filter("__t", lambda t: t.startswith("f:")), lambda t: F.substring(t, 3, 40).try_cast("double"))
    entries = F.filter(
        F.transform("__r", lambda i: F.struct(i["word"].alias("word"), F.array_join(clean_list(F.transform(F.coalesce(i["defs"], strings), lambda d: F.regexp_replace(d, "^[^\\t]*\\t", "")), 3), "\n").alias("definition"))),
        lambda e: e["definition"] != "",
    )
    keep = [c for c in responses.columns if c != json_col]
    return rows.select(
        *keep,
        clean_list(F.transform("__r", lambda i: i["word"])).alias("words"),
        entries.alias("entries"),
        F.array_join(clean_list(F.flatten(F.transform("__r", lambda i: F.coalesce(i["defs"], strings))), 24), "\n").alias("definition"),
        F.coalesce(F.array_max(F.transform(F.filter(per_million, lambda f: f > 0), lambda f: 3 + F.log10(f))), F.lit(0.0)).alias("frequency"),
        F.coalesce(F.get(F.filter(F.transform(F.filter("__t", lambda t: t.startswith("ipa_pron:")), lambda t: normalize_phonetic(F.substring(t, 10, 200))), lambda p: p != ""), F.lit(0)), F.lit("")).alias("phonetic"),
        F.array_join(clean_list(F.filter(F.transform("__t", lambda t: names[t]), lambda p: p.isNotNull()), 8), ", ").alias("pos"),
    )


# The landed page's layout, and bounds on its definitions.
PAGE_SCHEMA = "struct<en:array<struct<partOfSpeech:string,definitions:array<struct<definition:string>>>>>"
SECTION = r"(?is)<h2\b[^>]*\bid=[\"']English[\"'][^>]*>(.*?)(?:<h2\b|\z)"
IPA_SPAN = r"(?is)<span\b[^>]*\bclass=[\"'](?:[^\"']*\s)?IPA(?:\s[^\"']*)?[\"'][^>]*>(.*?)</span>"
LONGEST_DEFINITION, MOST_DEFINITIONS = 800, 8


def page_ipa(html: Column) -> Column:
    """The first pronunciation in the English section of a page, '' if there is none."""
    spans = F.regexp_extract_all(F.regexp_extract(F.coalesce(html, F.lit("")), SECTION, 1), F.lit(IPA_SPAN))
    return F.coalesce(F.get(F.filter(F.transform(spans, lambda s: normalize_phonetic(html_text(s))), lambda p: p != ""), F.lit(0)), F.lit(""))


def page_definitions(response: Column) -> Column:
    """struct(definition, pos) of a landed page's English entries: short, different definitions, one per line."""
    entries = F.coalesce(F.from_json(response, PAGE_SCHEMA)["en"], F.from_json(F.lit("{\"en\":[]}"), PAGE_SCHEMA)["en"])
    texts = F.transform(each(entries, lambda e: e["definitions"]), lambda d: html_text(d["definition"]))
    fine = F.filter(texts, lambda t: F.length(t) <= LONGEST_DEFINITION)
    pos = F.transform(entries, lambda e: F.lower(e["partOfSpeech"]))
    return F.struct(F.array_join(clean_list(fine, MOST_DEFINITIONS), "\n").alias("definition"), F.array_join(clean_list(pos, MOST_DEFINITIONS), ", ").alias("pos"))


def combine_fields(dictionary: DataFrame, exact: DataFrame, key: str) -> DataFrame:
    """Dictionary fields first, the exact association as fallback; its phonetic is a US one."""
    e = exact.select(key, *[F.col(c).alias(f"__{c}") for c in ("definition", "pos", "phonetic", "frequency")])
    first = lambda c, other: F.when(~blank(F.col(c)), F.col(c)).otherwise(F.coalesce(F.col(other), F.lit(""))).alias(c)
    return dictionary.join(e, key, "left").select(
        key, first("definition", "__definition"), "examples", "synonyms", "antonyms", first("pos", "__pos"), first("us", "__phonetic"), "uk", F.coalesce("__frequency", F.lit(0.0)).alias("frequency")
    )


def merge_enrichment(entries: DataFrame, fields: DataFrame, key: str) -> DataFrame:
    """Entries with blank scalars filled, lists appended, frequency raised and the band renewed.

    ``filled`` names the columns that took something new, in order.
    """
    new = fields.select(key, *[F.col(c).alias(f"new_{c}") for c in fields.columns if c != key])
    joined = entries.join(new, key, "left")
    scalars = [c for c in ("definition", "pos", "us_phonetic", "uk_phonetic") if f"new_{c}" in joined.columns and c in entries.columns]
    lists = [c for c in ("synonyms", "antonyms", "examples") if f"new_{c}" in joined.columns and c in entries.columns]
    out = {c: fill_empty(F.col(c), F.col(f"new_{c}"))["value"] for c in scalars}
    out |= {c: append_capped(F.col(c), F.col(f"new_{c}")) for c in lists}
    if "related_entries" in entries.columns and "new_related_entries" in joined.columns:
        out["related_entries"] = merge_named(F.col("related_entries"), F.col("new_related_entries"))
    if "frequency" in entries.columns and "new_frequency" in joined.columns:
        best = F.greatest(F.when(F.col("frequency") <= 10, F.col("frequency")), F.col("new_frequency"))
        out["frequency"] = F.coalesce(best, F.lit(0.0))
        if "difficulty" in entries.columns:
            out["difficulty"] = resolved_difficulty(F.col("difficulty"), F.col("frequency"), best)
    # under names of their own first: an alias that hides a column would be seen inside later lambdas
    joined = joined.withColumns({f"__out_{c}": x for c, x in out.items()})
    took = [F.when(~F.to_json(F.struct(F.col(f"__out_{c}").alias("v"))).eqNullSafe(F.to_json(F.struct(F.col(c).alias("v")))), c) for c in out]
    filled = F.filter(F.array(*took), lambda c: c.isNotNull()) if took else F.array().cast("array<string>")
    return joined.select(*[F.col(f"__out_{c}").alias(c) if c in out else F.col(c) for c in entries.columns], filled.alias("filled"))


def marker(statuses: Column) -> Column:
    """Status of an attempt from its sources' statuses."""
    ok = F.exists(statuses, lambda s: s == "ok")
    failed = F.exists(statuses, lambda s: ~s.isin("ok", "not_found"))
    return F.when(ok & ~failed, "completed").when(ok | failed, "partial").otherwise("not_found")


def repair_marker(statuses: Column, gaps: Column) -> Column:
    """Status of a repair: completed once no gap is left, whatever the sources said; else partial or not_found."""
    answered = F.exists(statuses, lambda s: s != "not_found")
    return F.when(F.size(gaps) == 0, "completed").when(answered, "partial").otherwise("not_found")


def lacks_any(columns: list[str]) -> Column:
    """Whether one of the lists is empty or absent."""
    return reduce(lambda a, b: a | b, [F.coalesce(F.size(c), F.lit(0)) <= 0 for c in columns])


def worklist(entries: DataFrame, now: Column, retry_hours: float, gaps: Column | None = None, deep: Column | None = None) -> DataFrame:
    """Rows without a status, or unfinished ones whose last attempt is old enough.

    With ``gaps``, finished rows that still have some are due again after the same time; with
    ``deep`` (whether a row has had its deep pass), completed rows without one are due at once if
    one of their deep lists is empty.
    """
    age = F.unix_timestamp(now) - F.unix_timestamp("last_attempt")
    old = F.col("last_attempt").isNull() | (age >= retry_hours * 3600)
    due = F.col("status").isNull() | ((F.col("status") != "completed") & old)
    if gaps is not None:
        due = due | ((F.size(gaps) > 0) & old)
    if deep is not None:
        due = due | ((F.col("status") == "completed") & ~deep & lacks_any(DEEP_LISTS))
    return entries.filter(due)


def plan_needs(entries: DataFrame, deep: bool = False, repair_only: bool = False) -> DataFrame:
    """Per row what it asks of the providers, by what it lacks; phrases ask for no part of speech and no phonetic.

    Examples and a frequency on another scale count unless only repairs are wanted; the four lists
    that associations give, each where it is empty, only with ``deep``.  ``network`` says whether
    anything but a translation is asked for.
    """
    gaps = quality_gaps(F.col("term"), F.col("definition"), F.col("definition_zh"), F.col("us_phonetic"), F.col("uk_phonetic"), F.col("pos"))
    rows = entries.withColumn("__g", gaps)
    has = lambda g: F.array_contains("__g", g)
    wide = F.lit(deep and not repair_only)
    lists = {c: wide & lacks_any([c]) for c in DEEP_LISTS}
    needs = {
        "definition": has("definition"), "translation": has("definition_zh"), "pos": has("pos"), "us_phonetic": has("phonetic") | has("phonetic_unreliable"),
        "examples": F.lit(not repair_only) & lacks_any(["examples"]), "frequency": F.lit(not repair_only) & F.coalesce(F.col("frequency") > HIGHEST_FREQUENCY, F.lit(False)),
        **lists, "relations": reduce(lambda a, b: a | b, lists.values()),
    }
    # under names of their own first: an alias that hides a column would be seen inside later ones
    rows = rows.withColumns({f"__need_{c}": x for c, x in needs.items()})
    network = reduce(lambda a, b: a | b, [F.col(f"__need_{c}") for c in ("definition", "pos", "us_phonetic", "examples", "frequency", "relations")])
    return rows.select("term", *[F.col(f"__need_{c}").alias(c) for c in needs], network.alias("network"))


def request_plan(needs: DataFrame, repair_only: bool = False) -> DataFrame:
    """term, requests: which sources a row's needs go to, in order."""
    any_of = lambda *names: reduce(lambda a, b: a | b, [F.col(n) for n in names])
    asked = [
        F.when(any_of("definition", "us_phonetic", "examples"), "dictionary"), F.when(any_of("related_words", "phrases"), "related"), F.when(any_of("definition", "pos", "frequency"), "exact"),
        F.when(F.col("synonyms"), "synonyms"), F.when(F.col("antonyms"), "antonyms"), F.when(F.lit(repair_only) & any_of("definition", "pos", "us_phonetic"), "page"),
    ]
    return needs.select("term", F.filter(F.array(*asked), lambda x: x.isNotNull()).alias("requests"))


def provider_plan(needs: DataFrame, found: DataFrame) -> DataFrame:
    """Requests per term: dictionary for a definition or a phonetic, exact where the dictionary lacks
    it, relations as three more; and what they cost."""
    joined = needs.join(found, "term", "left")
    lacks = lambda c: ~F.coalesce(F.col(c), F.lit(False))
    plan = joined.select(
        "term", (F.col("definition") | F.col("us_phonetic")).alias("dictionary"), ((F.col("definition") & lacks("has_definition")) | (F.col("us_phonetic") & lacks("has_us"))).alias("exact"), F.col("relations").alias("related")
    )
    return plan.withColumn("cost", F.col("dictionary").cast("long") + F.col("exact").cast("long") + 3 * F.col("related").cast("long"))


def progress(entries: DataFrame, status: str = "status") -> DataFrame:
    """Total, finished and the share that is finished (percent, 3 decimals)."""
    s = entries.agg(F.count("*").alias("total"), F.count_if(F.col(status).isin(*FINISHED)).alias("finished"))
    return s.withColumn("percent", F.when(F.col("total") == 0, 100.0).otherwise(F.round(100.0 * F.col("finished") / F.col("total"), 3)))
