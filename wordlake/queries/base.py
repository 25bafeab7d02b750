"""What the driver queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordlake.operators.lineage import cut_lineage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokens(text: str | Column = "text") -> Column:
    """Runs of letters of any script of the lower-cased text, in order."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"(\p{L}+)"))


def lexicon(docs: DataFrame) -> DataFrame:
    """word, n over all documents."""
    return docs.select(F.explode(tokens()).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def ordered_lexicon(docs: DataFrame) -> DataFrame:
    """word, n and a ``rank`` that orders words by count; words tie in it, and no numbering of the table is needed."""
    return lexicon(docs).withColumn("rank", -F.col("n"))


def neighbours(docs: DataFrame) -> DataFrame:
    """a, b: every pair of neighbouring tokens, as often as it stands."""
    pairs = F.arrays_zip(F.slice("w", F.lit(1), F.greatest(F.size("w") - 1, F.lit(0))).alias("a"), F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))).alias("b"))
    return docs.select(tokens().alias("w")).select(F.explode(pairs).alias("p")).select("p.a", "p.b")


def both_kinds(single: DataFrame, double: DataFrame) -> DataFrame:
    """term, kind, n of counted words (word, n) and pairs (a, b, n)."""
    words = single.select(F.col("word").alias("term"), F.lit("word").alias("kind"), "n")
    return words.unionByName(double.select(F.concat_ws(" ", "a", "b").alias("term"), F.lit("phrase").alias("kind"), "n"))


def terms(docs: DataFrame) -> DataFrame:
    """term, kind (word or phrase), n: single tokens and pairs of neighbours."""
    # pairs are counted as two words; the phrase is put together once per different pair
    return both_kinds(lexicon(docs), neighbours(docs).groupBy("a", "b").agg(F.count("*").alias("n")))


def frequent_terms(docs: DataFrame, reach: int) -> DataFrame:
    """The rows of ``terms`` that stand at least as often as some bound: ``reach`` rows or more, none left
    out that is as frequent; all rows if there are not as many words.

    The bound is what the word of that place has, so ``reach`` terms at least meet it.  A pair stands no
    oftener than either word: only pairs of two words that meet the bound are counted, by the words'
    numbers.  These words are broadcast; where ties make them more than four times ``reach``, all
    terms are counted.
    """
    words = cut_lineage(lexicon(docs))
    # one row per different count: fewer than the root of twice the number of tokens
    up_to = F.sum("words").over(Window.orderBy(F.desc("n")))
    place = words.groupBy("n").agg(F.count("*").alias("words")).withColumn("up_to", up_to).filter(F.col("up_to") >= reach).orderBy(F.desc("n")).select("n", "up_to").first()
    if place is None or place["up_to"] > 4 * reach:
        return both_kinds(words, neighbours(docs).groupBy("a", "b").agg(F.count("*").alias("n")))
    least = F.col("n") >= place["n"]
    often = cut_lineage(words.filter(least).withColumn("k", F.monotonically_increasing_id()))
    numbered = lambda c: F.broadcast(often.select(F.col("word").alias(c), F.col("k").alias(f"{c}_k")))
    pairs = neighbours(docs).join(numbered("a"), "a").join(numbered("b"), "b").groupBy("a_k", "b_k").agg(F.count("*").alias("n")).filter(least)
    return both_kinds(often, pairs.join(numbered("a"), "a_k").join(numbered("b"), "b_k"))


TOKENS_SQL = r"regexp_extract_all(lower(coalesce(text, '')), '\p{L}+')"
LEXICON_SQL = f"SELECT word, count(*) AS n FROM (SELECT unnest({TOKENS_SQL}) AS word FROM documents) GROUP BY word"
