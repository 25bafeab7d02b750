"""Digests of rows, ordered streams and whole tables.

A value is framed as its length, a colon and its text; null is ``\\N``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def framed(c: Column) -> Column:
    text = F.coalesce(c.cast("string"), F.lit("\\N"))
    return F.concat(F.length(text).cast("string"), F.lit(":"), text)


def row_digest(*columns: Column) -> Column:
    """sha256 over the framed columns."""
    return F.sha2(F.concat(*[framed(c) for c in columns]), 256)


def stream_digest(order: Column, digest: Column) -> Column:
    """Aggregate: sha256 over the group's row digests, one per line, in order.  For bounded groups."""
    rows = F.array_sort(F.collect_list(F.struct(order.alias("o"), digest.alias("d"))))
    return F.sha2(F.concat(F.array_join(F.transform(rows, lambda r: r["d"]), "\n"), F.lit("\n")), 256)


def bucket_digest(df: DataFrame, id_col: str, digest: Column, width: int = 1000) -> DataFrame:
    """Per bucket of ``width`` ids: rows, least and greatest id, and the digest of its rows in order."""
    return df.groupBy(F.floor(F.col(id_col) / width).cast("long").alias("bucket")).agg(
        F.count("*").alias("n_rows"), F.min(id_col).alias("min_id"), F.max(id_col).alias("max_id"), stream_digest(F.col(id_col), digest).alias("digest")
    )


def table_digest(df: DataFrame, id_col: str, digest: Column, width: int = 1000, fan: int = 1000) -> DataFrame:
    """One row for the table: rows, min and max id, and a digest over the digests of its buckets.

    Buckets are digested in levels of ``fan``, so no group grows with the table.
    """
    level = bucket_digest(df, id_col, digest, width).select(F.col("bucket").alias("k"), "n_rows", "min_id", "max_id", "digest")
    low, high = df.agg(F.min(id_col), F.max(id_col)).first()
    span = ((high or 0) - (low or 0)) // width + 2
    while span > 1:
        level = level.groupBy(F.floor(F.col("k") / fan).cast("long").alias("up")).agg(
            F.sum("n_rows").alias("n_rows"), F.min("min_id").alias("min_id"), F.max("max_id").alias("max_id"), stream_digest(F.col("k"), F.col("digest")).alias("digest")
        ).withColumnRenamed("up", "k")
        span = span // fan + (1 if span > fan else 0)
    return level.agg(F.sum("n_rows").alias("n_rows"), F.min("min_id").alias("min_id"), F.max("max_id").alias("max_id"), stream_digest(F.col("k"), F.col("digest")).alias("digest"))
