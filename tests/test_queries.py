"""Every registered query against its SQL in DuckDB, and the driver contract."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from checks.registry import ORACLES, QUERIES

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in sorted(os.listdir(FOLDER)):
        table = name.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{name}'")
    yield con
    con.close()


def comparable(rows):
    return sorted(tuple(repr(v) for v in row) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    df = contract.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    ours = df.select(*[f"`{c}`" for c in columns]).collect()
    if name not in ORACLES:
        assert ours
        return
    result = tables.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    theirs = [[row[i] for i in places] for row in result.fetchall()]
    assert comparable(ours) == comparable(theirs)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_contract_holds_the_registry():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "methylation_level_pat_count" in df.columns


def test_pileups_of_all_members_come_from_one_scan(spark):
    from checks.registry import MEMBERS, Inputs
    from checks.views import PILEUPS

    staged, plain = Inputs(spark, FOLDER, staged=True, members=MEMBERS), Inputs(spark, FOLDER)
    for name in PILEUPS:
        ours, theirs = staged.pileup(*name), plain.pileup(*name)
        assert comparable(ours.collect()) == comparable(theirs.select(*ours.columns).collect())
    assert len([step for step in staged.steps if "pileups" in step]) == 1
