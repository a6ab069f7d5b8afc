"""Columns that passes add, keys of rows, and labels derived from codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import text


def ensure_columns(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """``df`` with a default for each column that it lacks."""
    return df.withColumns({name: F.lit(value) for name, value in defaults.items() if name not in df.columns})


def snapshot(df: DataFrame, names: list[str], suffix: str = "_raw") -> DataFrame:
    """A copy of each column as it was first read; one that is there already stays."""
    return df.withColumns({n + suffix: F.col(n) for n in names if n + suffix not in df.columns})


def row_key(*columns: Column, limit: int = 80) -> Column:
    """A composite key of a row; the last column is cut to ``limit`` characters."""
    *whole, last = columns
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in whole], F.left(F.coalesce(last, F.lit("")), F.lit(limit)))


def fulltext_status(df: DataFrame, cached: DataFrame, key: str = "pmid") -> DataFrame:
    """``df`` with ``fulltext_status``: what a record was read from, else whether a text with some section is at hand."""
    has = F.greatest(F.length(text.clean(F.col("methods_text"))), F.length(text.clean(F.col("results_text")))) > 0
    held = cached.filter(has).select(F.col(key).alias("__held")).distinct()
    status = F.when(F.col("source") == "fulltext", "used").when(F.col("__held").isNotNull(), "cached").otherwise("none")
    return df.join(held, F.col(key) == F.col("__held"), "left").withColumn("fulltext_status", status).drop("__held")


def blank_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Empty columns for people to fill in."""
    return df.withColumns({n: F.lit("") for n in names})
