"""Every registered event query against its SQL in DuckDB."""

import math
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from eventloom.plans import queries as _, scan_queries as __  # noqa: F401
from eventloom.plans.registry import ORACLE_SQL, QUERIES

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    out = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        out.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return out


def plain(v):
    return None if v is None or isinstance(v, float) and math.isnan(v) else f"{v:.9g}" if isinstance(v, float) else str(v)


def rows(found, order):
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_against_sql(spark, duck, name):
    df, sql = QUERIES[name](spark, str(DATA)), duck.sql(ORACLE_SQL[name])
    names = sorted(df.columns)
    assert names == sorted(sql.columns)
    assert rows(df.collect(), [df.columns.index(n) for n in names]) == rows(sql.fetchall(), [sql.columns.index(n) for n in names])


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_detail_pages_are_parsed_by_many_tasks(spark):
    # the file of customers is small and one task's, its pages aren't
    assert QUERIES["detail_fields"](spark, str(DATA)).select(F.spark_partition_id()).distinct().count() >= 4
