"""Every driver query against its DuckDB SQL on the smallest tables."""

import datetime
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from wordlake.queries import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def text(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return f"{float(v):.9g}" if type(v).__name__ == "Decimal" else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        c.sql(f"create view {t} as select * from read_parquet('{p}{'/*.parquet' if os.path.isdir(p) else ''}')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    expected = duck.sql(SQL[name])
    assert sorted(expected.columns) == cols
    want = sorted(tuple(text(dict(zip(expected.columns, r, strict=True))[c]) for c in cols) for r in expected.fetchall())
    assert sorted(tuple(text(r[c]) for c in cols) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_global_rank_of_nulls_and_ties(spark, tmp_path):
    """Nulls stand last as in the SQL, and lines that its order leaves tied get the same ranks however they are dealt."""
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").limit(40)
    k = F.col("l_partkey")
    lines = lines.withColumns({"l_orderkey": F.when(k % 3 > 0, k % 5), "l_linenumber": F.when(k % 4 > 0, 1), "l_extendedprice": F.when(k % 7 > 0, k % 2 + 0.5)}).localCheckpoint()
    found = []
    for n in (1, 3):
        lines.repartition(n, "l_suppkey").write.parquet(f"{tmp_path}/{n}/lineitem.parquet")
        found.append(sorted(QUERIES["global_rank"](spark, f"{tmp_path}/{n}").collect(), key=lambda r: r["rank"]))
    assert found[0] == found[1]
    order = [(r["l_extendedprice"], r["l_orderkey"], r["l_linenumber"]) for r in found[0]]
    c = duckdb.connect()
    c.sql(f"create view lineitem as select * from read_parquet('{tmp_path}/3/lineitem.parquet/*.parquet')")
    assert order == c.sql(f"select l_extendedprice, l_orderkey, l_linenumber from ({SQL['global_rank']}) order by rank").fetchall()


def test_synonym_self_join_deals_orders_by_their_number(spark, duck, monkeypatch):
    from wordlake.queries import tables

    monkeypatch.setattr(tables, "SHARE", 100, raising=False)
    found = QUERIES["synonym_self_join"](spark, SF)
    n = duck.sql("select count(*) from lineitem").fetchall()[0][0]
    assert "hashpartitioning(k#" in (plan := found._jdf.queryExecution().executedPlan().toString()) and f", {1 + n // 100}), REPARTITION_BY_NUM" in plan
    assert sorted(map(tuple, found.collect())) == sorted(duck.sql(SQL["synonym_self_join"]).fetchall())


def test_relation_expand_deals_lines_by_their_number(spark, duck, monkeypatch):
    from wordlake.queries import tables

    monkeypatch.setattr(tables, "SHARE", 100)
    found = QUERIES["relation_expand"](spark, SF)
    n = duck.sql("select count(*) from lineitem").fetchall()[0][0]
    assert "hashpartitioning(l_orderkey#" in (plan := found._jdf.queryExecution().executedPlan().toString()) and plan.count(f", {1 + n // 100}), REPARTITION_BY_NUM") >= 3
    assert sorted(map(tuple, found.collect())) == sorted(duck.sql(SQL["relation_expand"]).fetchall())


def test_relation_expand_counts_parts_that_stand_twice(spark, tmp_path):
    c = duckdb.connect()
    for t in ("region", "nation", "customer", "part", "orders", "lineitem"):
        p = f"{SF}/{t}.parquet"
        c.sql(f"create table {t} as select * from read_parquet('{p}{'/*.parquet' if os.path.isdir(p) else ''}')")
    c.sql("insert into part select * from part where p_partkey % 3 = 0")
    c.sql("insert into part select * replace ('other' as p_brand) from part where p_partkey % 5 = 0")
    c.sql("update lineitem set l_partkey = null where l_linenumber = 3")
    c.sql("update lineitem set l_extendedprice = null where l_linenumber = 2")
    for t in ("region", "nation", "customer", "part", "orders", "lineitem"):
        c.sql(f"copy {t} to '{tmp_path}/{t}.parquet' (format parquet)")
    assert sorted(map(tuple, QUERIES["relation_expand"](spark, str(tmp_path)).collect())) == sorted(c.sql(SQL["relation_expand"]).fetchall())
