import os

import duckdb
import pandas as pd
import pytest

from quern.plans import catalog, parts, rulebook, upkeep  # noqa: F401

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows_of(frame: pd.DataFrame) -> list[str]:
    def clean(v):
        if v is None or v is pd.NA or (isinstance(v, float) and v != v):
            return None
        v = v.item() if hasattr(v, "item") else v
        return round(float(v), 6) if isinstance(v, float) else v

    frame = frame[sorted(frame.columns)]
    return sorted(repr(tuple(clean(v) for v in r)) for r in frame.itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_oracle(spark, duck, name):
    want, got = duck.sql(catalog.ORACLE_SQL[name]).df(), catalog.QUERIES[name](spark, SF).toPandas()
    assert sorted(want.columns) == sorted(got.columns)
    assert len(want) == len(got) and len(got) > 0
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0
