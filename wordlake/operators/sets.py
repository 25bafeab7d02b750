"""Set operations over shards and snapshots, all-or-nothing merges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class MergeRefused(ValueError):
    """A merge whose inputs break its contract; nothing is returned."""


def union_disjoint(parts: list[DataFrame], id_col: str) -> tuple[DataFrame, DataFrame]:
    """The union of the parts, and the ids that stand in more than one."""
    out = reduce(DataFrame.unionByName, parts)
    return out, out.groupBy(id_col).agg(F.count("*").alias("n")).filter("n > 1")


def check_exact_union(expected: DataFrame, deltas: DataFrame, id_col: str, owner: str, n: int) -> DataFrame:
    """(code, example) rows unless the deltas hold each expected id once, under its owner, and no other."""
    e = expected.select(F.col(id_col), F.lit(True).alias("wanted")).distinct()
    d = deltas.groupBy(id_col).agg(F.count("*").alias("n"), F.min(owner).alias("low"), F.max(owner).alias("high"))
    joined = e.join(d, id_col, "full_outer")
    home = F.pmod(F.col(id_col), F.lit(n))
    code = F.when(F.col("n").isNull(), "missing").when(F.col("wanted").isNull(), "extra").when(F.col("n") > 1, "overlap").when((F.col("low") != home) | (F.col("high") != home), "wrong_owner")
    return joined.select(code.alias("code"), F.col(id_col).cast("string").alias("example")).filter("code is not null")


def owner_merge(snapshots: list[DataFrame], id_col: str) -> DataFrame:
    """Row i comes from snapshot i modulo n."""
    n = len(snapshots)
    return reduce(DataFrame.unionByName, [s.filter(F.pmod(F.col(id_col), F.lit(n)) == i) for i, s in enumerate(snapshots)])


def verified_owner_merge(snapshots: list[DataFrame], id_col: str, identity: list[str], columns: list[str]) -> DataFrame:
    """``owner_merge`` of replicas: refused unless all hold the same ids and identities, and unless
    each owner's rows come out as they stand in its snapshot.

    One aggregate per side by snapshot and owner, however many snapshots there are.
    """
    n = len(snapshots)
    owner = F.pmod(F.col(id_col), F.lit(n)).alias("owner")
    total = lambda names: F.sum(F.xxhash64(*names).cast("decimal(38,0)"))
    both = reduce(DataFrame.unionByName, [s.select(*dict.fromkeys([id_col, *identity, *columns])).withColumn("__i", F.lit(i)) for i, s in enumerate(snapshots)])
    sides = both.groupBy("__i", owner).agg(F.count("*").alias("n"), total([id_col, *identity]).alias("identity"), total(columns).alias("content")).collect()
    for o in {r["owner"] for r in sides}:
        same = {(r["n"], r["identity"]) for r in sides if r["owner"] == o}
        if len(same) > 1 or sum(r["owner"] == o for r in sides) != n:
            raise MergeRefused("snapshots differ in identity")
    out = owner_merge(snapshots, id_col)
    merged = {r["owner"]: (r["n"], r["content"]) for r in out.groupBy(owner).agg(F.count("*").alias("n"), total(columns).alias("content")).collect()}
    for r in sides:
        if r["__i"] == r["owner"] and merged.get(r["owner"]) != (r["n"], r["content"]):
            raise MergeRefused(f"rows of owner {r['owner']} have changed")
    return out


def merge_shards(entries: DataFrame, shards: list[DataFrame], id_col: str, columns: list[str]) -> DataFrame:
    """Entries with the shards' columns, null too, in place of their own.

    Refused if an id stands in two shards or is unknown.
    """
    union, twice = union_disjoint([s.select(id_col, *columns) for s in shards], id_col)
    if twice.limit(1).count():
        raise MergeRefused("shards overlap")
    if union.join(entries.select(id_col), id_col, "left_anti").limit(1).count():
        raise MergeRefused("shards hold unknown ids")
    new = union.select(F.col(id_col).alias("__id"), F.struct(*columns).alias("__new"))
    joined = entries.join(new, F.col(id_col) == F.col("__id"), "left")
    take = lambda c: F.when(F.col("__id").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c)
    return joined.select(*[take(c) if c in columns else c for c in entries.columns])


def three_way(baseline: DataFrame, delta: DataFrame, central: DataFrame, id_col: str, columns: list[str], changed: str = "changed_columns") -> DataFrame:
    """Central rows with the delta's changed columns, and the columns in conflict.

    A changed column conflicts where central is neither the baseline's value nor the delta's.
    """
    b = baseline.select(F.col(id_col).alias("__b"), F.struct(*columns).alias("__base"))
    d = delta.select(F.col(id_col).alias("__d"), F.struct(*columns).alias("__delta"), F.col(changed).alias("__changed"))
    joined = central.join(b, F.col(id_col) == F.col("__b"), "left").join(d, F.col(id_col) == F.col("__d"), "left")

    def touched(c: str) -> Column:
        return F.coalesce(F.array_contains("__changed", c), F.lit(False))

    def clash(c: str) -> Column:
        return touched(c) & ~F.col(c).eqNullSafe(F.col(f"__base.{c}")) & ~F.col(c).eqNullSafe(F.col(f"__delta.{c}"))

    conflicts = F.filter(F.array(*[F.when(clash(c), c) for c in columns]), lambda c: c.isNotNull())
    merged = [F.when(touched(c), F.col(f"__delta.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in central.columns]
    return joined.select(*merged, conflicts.alias("conflicts"))


def compare_replicas(snapshots: DataFrame) -> DataFrame:
    """Per replica whether rows, ids and digest equal those of the first replica."""
    first = snapshots.orderBy("replica").limit(1).select(F.struct("n_rows", "min_id", "max_id", "digest").alias("f"))
    return snapshots.join(F.broadcast(first)).select("replica", F.struct("n_rows", "min_id", "max_id", "digest").eqNullSafe(F.col("f")).alias("same"))
