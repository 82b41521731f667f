"""Queries against their SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from screenloom import catalog

FOLDER = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def rows(frame):
    columns = sorted(frame.columns)
    plain = frame[columns].astype(object).where(frame[columns].notna(), None)
    return columns, sorted(map(tuple, plain.values.tolist()), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    got = catalog.queries()[name](spark, str(FOLDER)).toPandas()
    assert len(got.columns)
    if name in catalog.oracle_sql():
        assert rows(got) == rows(duck.execute(catalog.oracle_sql()[name]).df())
