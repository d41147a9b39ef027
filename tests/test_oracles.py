"""Every query with SQL gives what DuckDB gives for it on the same tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from lumenreel import catalog

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def values(df: pd.DataFrame) -> list[str]:
    """The rows as sorted text; whole numbers and floats alike."""
    df = df[sorted(df.columns)].astype(object)

    def one(v):
        if v is None or v != v:
            return None
        return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted(str([one(v) for v in r]) for r in df.where(df.notna(), None).values.tolist())


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    ours, theirs = catalog.queries()[name](spark, SF).toPandas(), duck.execute(catalog.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert values(ours) == values(theirs)
