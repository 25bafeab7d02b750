"""Batch lookup (exact, prefix, fuzzy), suggestions, keyword index, and text jobs."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from wordlake.functions.collect import clean_list
from wordlake.functions.normalize import collapse
from wordlake.functions.references import decoded
from wordlake.operators.joins import best_per_key, prefix_join
from wordlake.operators.rank import stream_rank


@F.pandas_udf(DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity of two strings by their matching blocks, 0 to 1."""
    return pd.Series([SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def suggest(prefixes: DataFrame, entries: DataFrame, n: int = 10) -> DataFrame:
    """Per prefix its n best ranked words, with their place."""
    return best_per_key(prefix_join(prefixes, entries), ["prefix"], [F.col("rank"), F.col("word")], n)


LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: What bounds give way for rounding; pairs that only just reach the cutoff must stay.
SLACK = 1e-6


def letter_counts(word: str, prefix: str) -> list[Column]:
    """How often each of a-z stands in a word, and all other characters together, as columns."""
    counts = [(F.length(word) - F.length(F.replace(F.col(word), F.lit(c)))).alias(f"{prefix}{i}") for i, c in enumerate(LETTERS)]
    return [*counts, F.length(F.regexp_replace(word, "[a-z]", "")).alias(f"{prefix}{len(LETTERS)}")]


def fuzzy_join(terms: DataFrame, entries: DataFrame, block: int = 5000, cutoff: float = 0.72) -> DataFrame:
    """Per term the most similar word of the same first character among the block's best ranked.

    The block is a part of the rule; it is cut by a tournament, so no task sorts all words of a letter.  Words meet terms of the same first character and of a length
    that leaves the cutoff possible; bounds by common letters and by edits turn most of these away
    before the UDF.
    """
    near = stream_rank(entries.select("word", "rank", F.substring("word", 1, 1).alias("letter")), "letter", [F.col("rank"), F.col("word")], block)
    # 2 * min / (a + b) >= cutoff bounds the other length by this share
    reach = cutoff / (2 - cutoff)
    lengths = F.explode(F.sequence(F.ceil(F.length("word") * reach - SLACK), F.floor(F.length("word") / reach + SLACK)))
    near = near.select("letter", "word", F.length("word").alias("word_length"), *letter_counts("word", "w")).withColumn("length", lengths)
    asked = terms.select("term", F.substring("term", 1, 1).alias("letter"), F.length("term").cast("long").alias("length"), *letter_counts("term", "t"))
    n = range(len(LETTERS) + 1)
    shared = sum((F.least(f"t{i}", f"w{i}") for i in n), F.lit(0))
    pairs = asked.join(near.withColumn("length", F.col("length").cast("long")), ["letter", "length"]).filter(2.0 * shared >= cutoff * (F.col("length") + F.col("word_length")) - SLACK)
    # matching blocks are a common subsequence, so the ratio is at most 1 - edits / length of both
    pairs = pairs.filter(F.levenshtein("term", "word") <= (1 - cutoff) * (F.col("length") + F.col("word_length")) + SLACK).select("term", "word")
    scored = pairs.withColumn("score", ratio("term", "word")).filter(F.col("score") >= cutoff)
    return scored.groupBy("term").agg(F.max(F.struct("score", "word")).alias("b")).select("term", F.col("b.word").alias("word"), F.col("b.score").alias("score"))


def lookup(terms: DataFrame, entries: DataFrame, fuzzy: bool = True) -> DataFrame:
    """Each distinct term with the word found and how: exact, else best prefix, else most similar."""
    asked = terms.select("term").filter("term <> ''").distinct()
    words = entries.select("word", "rank")
    exact = asked.join(words.withColumn("term", F.col("word")), "term").select("term", "word", F.lit("exact").alias("kind"))
    rest = asked.join(exact, "term", "left_anti")
    prefix = suggest(rest.withColumnRenamed("term", "prefix"), words, 1).select(F.col("prefix").alias("term"), "word", F.lit("prefix").alias("kind"))
    out = exact.unionByName(prefix)
    if fuzzy:
        left = rest.join(prefix, "term", "left_anti")
        out = out.unionByName(fuzzy_join(left, words).select("term", "word", F.lit("fuzzy").alias("kind")))
    return asked.join(out, "term", "left").select("term", "word", F.coalesce("kind", F.lit("missing")).alias("kind"))


def build_index(entries: DataFrame, id_col: str, fields: list[str], token: str = r"[\p{L}\p{N}]+") -> DataFrame:
    """Postings: term, field, id, position, and how often."""
    texts = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("text")) for f in fields]))
    rows = entries.select(F.col(id_col).alias("id"), texts.alias("t")).select("id", "t.field", F.posexplode(F.regexp_extract_all(F.lower("t.text"), F.lit(f"({token})"))).alias("pos", "term"))
    return rows.groupBy("term", "field", "id").agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"))


def search(index: DataFrame, terms: list[str]) -> DataFrame:
    """Ids whose fields hold all the terms, with the number of hits."""
    terms = sorted({t.lower() for t in terms})
    hits = index.filter(F.col("term").isin(terms))
    return hits.groupBy("id").agg(F.countDistinct("term").alias("found"), F.sum("n").alias("hits")).filter(F.col("found") == len(terms)).select("id", "hits")


def import_terms(docs: DataFrame, id_col: str, text: str, max_len: int = 120) -> DataFrame:
    """Term lists: split at line ends, commas, semicolons and tabs; clean, valid, distinct in order."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), "[\\r\\n,，;；\\t]+"), lambda t: F.lower(collapse(t)))
    fine = F.filter(parts, lambda t: t.rlike(r"^[a-z][a-z' .-]*$") & (F.length(t) <= max_len))
    return docs.select(id_col, clean_list(fine, None).alias("terms"))


def title_variants(term: Column) -> Column:
    """The term and its twin with hyphens and spaces swapped; none where a hyphen is at the edge."""
    edge = term.startswith("-") | term.endswith("-")
    twin = F.when(term.contains("-"), F.translate(term, "-", " ")).when(term.contains(" "), F.translate(term, " ", "-")).otherwise(term)
    return F.when(edge, F.array(term)).otherwise(F.array_distinct(F.array(term, twin)))


def html_text(html: Column | str, lenient: bool = True) -> Column:
    """Text of a page: no scripts, styles, comments or tags (these part no words), references decoded, white space collapsed.

    References are decoded twice, so what was escaped twice is plain, too; without ``lenient`` once, and only those that end in a semicolon.
    """
    out = F.coalesce(F.col(html) if isinstance(html, str) else html, F.lit(""))
    for pattern in (r"(?is)<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)", r"(?s)<!--.*?-->", r"(?s)</?[A-Za-z!?][^>]*>"):
        out = F.regexp_replace(out, pattern, "")
    return collapse(decoded(decoded(out)) if lenient else decoded(out, bare=False))


def copied_runs(left: DataFrame, right: DataFrame, n: int = 8) -> DataFrame:
    """Pairs (left_id, right_id) that share a run of n words, and how many different runs.

    Both inputs have id and words; the right one is meant to be small.  Runs of the left side meet
    the right side's by their first words' hash first, so that only places where a run may begin are
    spelled out as text and compared.
    """
    last = F.size("words") - (n - 1)
    run = F.array_join(F.slice("words", F.col("at"), n), " ")
    places = lambda df, name: df.filter(F.size("words") >= n).select(F.col("id").alias(name), "words", F.posexplode(F.slice("words", F.lit(1), last)).alias("at", "first")).withColumn("at", F.col("at") + 1)
    other = places(right, "right_id").select("right_id", run.alias("run")).distinct()
    pair = lambda at: F.xxhash64(F.get("words", at - 1), F.get("words", at), F.get("words", at + (n - 2)))
    starts = places(right, "right_id").select(pair(F.col("at")).alias("start")).distinct()
    mine = places(left, "left_id").withColumn("start", pair(F.col("at"))).join(starts, "start", "left_semi").select("left_id", run.alias("run")).distinct()
    return mine.join(other, "run").groupBy("left_id", "right_id").agg(F.count("*").alias("n_runs"))


#: What Python's ``strip`` takes away.
WHITE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def chunks(text: str | None, limit: int) -> list[str]:
    """Ordered pieces of at most ``limit`` characters, cut at the last space, newline or tab."""
    rest, out = (text or "").strip(), []
    while len(rest) > limit:
        cut = max(rest.rfind(c, 0, limit + 1) for c in " \n\t")
        cut = cut if cut > 0 else limit
        out.append(rest[:cut].strip())
        rest = rest[cut:].lstrip()
    return [*out, rest] if rest else out


def chunk_text(df: DataFrame, id_col: str, text: str, limit: int = 480) -> DataFrame:
    """(id, pos, chunk) rows: ``chunks`` as one expression, so no batch of long texts goes to Python."""
    bare = lambda c: F.btrim(c, F.lit(WHITE))
    # the rest if it fits, else up to the last space that a piece can end before, else cut hard
    piece = rf"(?s)(.{{1,{limit}}}+\z|.{{1,{limit}}}(?=[ \n\t])|.{{{limit}}})[{WHITE}]*+"
    found = F.regexp_extract_all(bare(F.coalesce(F.col(text), F.lit(""))), F.lit(piece), F.lit(1))
    return df.select(F.col(id_col).alias("id"), F.posexplode(F.transform(found, bare)).alias("pos", "chunk"))


def reassemble(chunks_df: DataFrame, expected: DataFrame, joiner: str = "\n") -> DataFrame:
    """Texts joined from their chunks, only where all ``n_chunks`` of the expected table are there."""
    rows = F.array_sort(F.collect_list(F.struct("pos", "chunk")))
    joined = chunks_df.groupBy("id").agg(F.count("*").alias("n"), F.array_join(F.transform(rows, lambda r: r["chunk"]), joiner).alias("text"))
    return joined.join(expected, "id").filter("n = n_chunks").select("id", "text")


def book(terms: DataFrame, entries: DataFrame) -> DataFrame:
    """Requested (pos, term) rows with the word found, in request order, misses marked."""
    return terms.join(lookup(terms, entries), "term", "left").orderBy("pos")


def postings_of(index: DataFrame, one_field: bool = False) -> DataFrame:
    """Per term: documents and hits.  An index of one field has one row per term and document already."""
    docs = F.count("*") if one_field else F.countDistinct("id")
    return index.groupBy("term").agg(docs.alias("docs"), F.sum("n").alias("hits"))
