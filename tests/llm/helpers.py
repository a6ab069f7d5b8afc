"""Comparing a query with its oracle, and small tables."""

from __future__ import annotations

import os

import duckdb
import pandas as pd

SF = "/root/testdata/sf0.001"


def oracle(sql: str, sf_dir: str = SF) -> pd.DataFrame:
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    return con.sql(sql).df()


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    clean = lambda v: None if v is None or v is pd.NA or (isinstance(v, float) and v != v) else (v.item() if hasattr(v, "item") else v)
    return sorted((tuple(clean(v) for v in r) for r in frame.itertuples(index=False)), key=repr)


def assert_same(spark_df, sql: str, sf_dir: str = SF) -> None:
    want, got = oracle(sql, sf_dir), spark_df.toPandas()
    assert sorted(want.columns) == sorted(got.columns)
    assert rows_of(got) == rows_of(want)


def docs_of(spark, texts, more=()):
    """documents with doc_id from 0, and two columns whose names clash with what operators make."""
    rows = [(i, t, "en", f"src{i % 2}", None if t is None else len(t), "x", "y") for i, t in enumerate(texts)] + list(more)
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row string, words string")
