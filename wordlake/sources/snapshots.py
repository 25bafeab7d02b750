"""Snapshots, bundles, deltas and reports as Parquet folders with a manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordlake.functions.digest import row_digest, table_digest
from wordlake.schema import IDENTITY, conform


def manifest(df: DataFrame, id_col: str = "id", identity: list[str] | None = None) -> DataFrame:
    """One row: rows, least and greatest id, identity digest and schema digest."""
    columns = [c for c in (identity or IDENTITY) if c in df.columns]
    return table_digest(df, id_col, row_digest(*[F.col(c) for c in columns])).withColumn("schema_digest", F.sha2(F.lit(df.schema.json()), 256))


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a snapshot, with optional columns filled in."""
    return conform(spark.read.parquet(f"{path}/rows"))


def write_snapshot(df: DataFrame, path: str, provenance: dict[str, str] | None = None, id_col: str = "id") -> None:
    """Rows, then their manifest; an existing snapshot is never replaced."""
    df.write.mode("errorifexists").parquet(f"{path}/rows")
    rows = df.sparkSession.read.parquet(f"{path}/rows")
    about = F.create_map(*[F.lit(x) for pair in (provenance or {}).items() for x in pair]) if provenance else F.lit(None).cast("map<string,string>")
    manifest(rows, id_col).withColumn("provenance", about).write.mode("errorifexists").json(f"{path}/manifest")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(f"{path}/manifest")


def write_bundle(tables: dict[str, DataFrame], path: str, violations: DataFrame | None = None) -> None:
    """Several tables as one bundle; refused while there are structural violations.

    The marker ``complete`` is written last; readers ask for it.
    """
    if violations is not None and (bad := violations.limit(5).collect()):
        raise ValueError(f"bundle refused: {bad}")
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{path}/{name}")
    counts = [(name, spark.read.parquet(f"{path}/{name}").count()) for name in tables]
    spark.createDataFrame(counts, "name string, n_rows long").coalesce(1).write.mode("errorifexists").json(f"{path}/complete")


def read_bundle(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The bundle's tables; their row counts must be those of its marker."""
    out = {}
    for r in spark.read.json(f"{path}/complete").collect():
        out[r["name"]] = spark.read.parquet(f"{path}/{r['name']}")
        if out[r["name"]].count() != r["n_rows"]:
            raise ValueError(f"{r['name']} has lost rows")
    return out


def rows_digest(df: DataFrame, id_col: str) -> str:
    """A digest over all columns of all rows in the order of their ids, by levels of buckets; rows of one id by their contents."""
    rest = sorted(c for c in df.columns if c != id_col)
    rows = table_digest(df, id_col, row_digest(F.col(id_col), *[F.to_json(F.struct(c)) for c in rest])).select("digest").first()
    return rows["digest"]


def write_delta(df: DataFrame, path: str, source_digest: str, licence: str, id_col: str = "id") -> None:
    """A delta with its source's digest, its licence and the digest of its own rows."""
    df.write.mode("errorifexists").parquet(f"{path}/rows")
    rows = df.sparkSession.read.parquet(f"{path}/rows")
    about = [(source_digest, licence, rows.count(), id_col, rows_digest(rows, id_col))]
    df.sparkSession.createDataFrame(about, "source_digest string, licence string, n_rows long, id_column string, rows_digest string").coalesce(1).write.json(f"{path}/manifest")


def read_delta(spark: SparkSession, path: str, source_digest: str | None = None, licence: str | None = None) -> DataFrame:
    """A delta's rows, after its manifest was found whole, of these very rows and, if given, of this source and licence."""
    m = spark.read.json(f"{path}/manifest").first()
    rows = spark.read.parquet(f"{path}/rows")
    if not m["source_digest"] or not m["licence"] or rows.count() != m["n_rows"] or rows_digest(rows, m["id_column"]) != m["rows_digest"]:
        raise ValueError("the delta's manifest does not fit its rows")
    if source_digest not in (None, m["source_digest"]) or licence not in (None, m["licence"]):
        raise ValueError("the delta is of another source or licence")
    return rows


def write_report(df: DataFrame, path: str) -> None:
    """A small report as JSON with the time it was made."""
    df.withColumn("updated_at", F.current_timestamp()).coalesce(1).write.mode("overwrite").json(path)
