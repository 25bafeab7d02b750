"""Joins: matches, overlays, links with fallback, prefixes, index comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordlake.functions.collect import clean_list
from wordlake.functions.normalize import blank, fill_empty


def unbroadcast(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that Spark must not broadcast: for tables that grow with the input.

    Sizes are judged by packed bytes, and lists of alike strings unpack to a hundred times as much.
    """
    return df.hint("merge")


def split_matches(source: DataFrame, target: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of source whose key the target has, and the others."""
    keys = target.select(key)
    return source.join(keys, key, "left_semi"), source.join(keys, key, "left_anti")


def overlay(base: DataFrame, patch: DataFrame, key: str, fill: list[str], union: list[str], insert_new: bool = True, cap: int = 40) -> DataFrame:
    """Base rows with blank fields filled and lists united from the patch; new keys are inserted."""
    b, p = base.alias("b"), patch.alias("p")
    joined = b.join(p, F.col(f"b.{key}") == F.col(f"p.{key}"), "full_outer" if insert_new else "left")
    both = [fill_empty(F.col(f"b.{c}"), F.col(f"p.{c}"))["value"].alias(c) for c in fill]
    empty = F.array().cast("array<string>")
    lists = [clean_list(F.concat(F.coalesce(F.col(f"b.{c}"), empty), F.coalesce(F.col(f"p.{c}"), empty)), cap).alias(c) for c in union]
    return joined.select(F.coalesce(F.col(f"b.{key}"), F.col(f"p.{key}")).alias(key), *both, *lists)


def resolve_links(links: DataFrame, entries: DataFrame, cap: int = 40) -> DataFrame:
    """Per key its links (key, ord, word, definition) with a definition of their own, else that of
    the entry of the word; links without either go; first seen wins."""
    known = entries.select(F.col("key").alias("word"), F.col("definition").alias("known"))
    found = links.join(unbroadcast(known), "word", "left").withColumn("definition", F.when(~blank(F.col("definition")), F.col("definition")).otherwise(F.col("known"))).filter(~blank(F.col("definition")))
    first = found.groupBy("key", "word").agg(F.min(F.struct("ord", "definition")).alias("f"))
    n = F.row_number().over(Window.partitionBy("key").orderBy("f.ord", "word"))
    kept = first.withColumn("n", n).filter(F.col("n") <= cap)
    rows = F.array_sort(F.collect_list(F.struct("n", "word", F.col("f.definition").alias("definition"))))
    return kept.groupBy("key").agg(F.transform(rows, lambda r: F.struct(r["word"].alias("word"), r["definition"].alias("definition"))).alias("links"))


def index_diff(entries: DataFrame, index: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys that the index lacks, has too many, or has with other content."""
    e, i = entries.select(key, F.struct(*columns).alias("e")), index.select(key, F.struct(*columns).alias("i"))
    joined = e.join(i, key, "full_outer")
    kind = F.when(F.col("i").isNull(), "missing").when(F.col("e").isNull(), "extra").when(~F.col("e").eqNullSafe(F.col("i")), "different")
    return joined.select(key, kind.alias("kind")).filter("kind is not null")


def prefix_join(prefixes: DataFrame, entries: DataFrame, prefix: str = "prefix", word: str = "word") -> DataFrame:
    """Pairs of a prefix and a word that starts with it, as one equi-join.

    Each word is exploded to its beginnings, of the lengths that prefixes have, so there is neither
    a nested loop nor a range join.  Empty prefixes match nothing.
    """
    lengths = prefixes.select(F.length(prefix).alias("__n")).distinct()
    begins = entries.filter(F.length(word) > 0).withColumn("__n", F.explode(F.sequence(F.lit(1), F.length(word)))).join(lengths, "__n")
    return prefixes.join(begins.withColumn(prefix, F.expr(f"substring({word}, 1, __n)")).drop("__n"), prefix)


def best_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each key, with their place in ``place``."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("place") <= n)


def identity_violations(queue: DataFrame, canonical: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """Queue rows whose id is unknown or whose identity columns differ from the canonical row."""
    c = canonical.select(F.col(id_col).alias("__id"), F.struct(*columns).alias("__c"))
    joined = queue.join(c, F.col(id_col) == F.col("__id"), "left")
    code = F.when(F.col("__id").isNull(), "canonical_missing").when(~F.struct(*columns).eqNullSafe(F.col("__c")), "canonical_identity_mismatch")
    return joined.select(id_col, code.alias("code")).filter("code is not null")
