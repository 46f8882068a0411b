"""Every registered job against its DuckDB twin on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from cohortloom.plans.oracle import SQL
from cohortloom.plans.registry import REGISTRY
from tools.compare import TABLES, digest, duck_kind, spark_kind

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_parity(spark, duck, name):
    df = REGISTRY[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    kinds = {d[0]: duck_kind(d[1]) for d in cur.description}
    assert {f.name: spark_kind(f.dataType) for f in df.schema.fields} == kinds
    assert len(srows) == len(orows)
    assert digest(df.columns, srows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:2] == ["cohort_date", "country_code"]
