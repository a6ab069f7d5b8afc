"""Deterministic samples: rows are ordered by a hash of a seed and their key, the same on every run and cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.operators.schema import blank_columns


def order(seed: int, key: str = "row_id") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def stratified(df: DataFrame, stratum: str, sizes: dict[str, int], seed: int = 1, key: str = "row_id") -> DataFrame:
    """So many rows of each named stratum, numbered over the whole sample in hash order.

    Spark keeps the first rows of a stratum in each task before it shuffles, so a large one is not sorted whole.
    """
    most = max(sizes.values(), default=0)
    wanted = df.filter(F.col(stratum).isin(*sizes))
    placed = wanted.withColumn("__n", F.row_number().over(Window.partitionBy(stratum).orderBy(order(seed, key), key))).filter(F.col("__n") <= most)
    size = F.create_map(*[F.lit(x) for kv in sizes.items() for x in kv])
    sample = placed.filter(F.col("__n") <= size[F.col(stratum)]).drop("__n")
    return sample.withColumn("no", F.row_number().over(Window.orderBy(order(seed + 1, key), key)))  # the sample is small by its definition


def equal_allocation(df: DataFrame, stratum: str, total: int, seed: int = 1, key: str = "row_id") -> DataFrame:
    """``total`` rows: equally many of each stratum, filled up by hash order from what is left."""
    share = df.select(stratum).distinct().count()
    each = max(1, total // share) if share else 0
    # Only the first rows of a stratum are kept in each task, and the rest is a top-k: no stratum is sorted whole.
    ranked = df.withColumn("__n", F.row_number().over(Window.partitionBy(stratum).orderBy(order(seed, key), key)))
    first = ranked.filter(F.col("__n") <= each).drop("__n")
    rest = df.join(first.select(key), key, "left_anti").select(df.columns).orderBy(order(seed + 1, key), key).limit(total)
    both = first.withColumn("__first", F.lit(0)).unionByName(rest.withColumn("__first", F.lit(1)))
    return both.orderBy("__first", order(seed + 1, key), key).limit(total).drop("__first")


def review_sample(tracks: dict[str, DataFrame], stratum: str, each: int, blanks: list[str], seed: int = 1, key: str = "row_id") -> DataFrame:
    """``each`` rows of every track, allocated equally to its strata, with ``track`` and empty columns for people to fill in."""
    out = None
    for name, rows in tracks.items():
        one = blank_columns(equal_allocation(rows, stratum, each, seed, key).withColumn("track", F.lit(name)), blanks)
        out = one if out is None else out.unionByName(one)
    return out


def simple(df: DataFrame, n: int, seed: int = 1, key: str = "row_id") -> DataFrame:
    return df.orderBy(order(seed, key), key).limit(n)


def by_risk(df: DataFrame, score: Column, n: int, seed: int = 1, key: str = "row_id") -> DataFrame:
    """The ``n`` rows of most risk; rows without any fill up in hash order."""
    risk = score.alias("risk")
    return df.select("*", risk).orderBy(F.desc("risk"), order(seed, key), key).limit(n)


def checked_answers(df: DataFrame, column: str, allowed: tuple[str, ...], required: list[str]) -> DataFrame:
    """Annotated rows, answers in lower case. A column that is missing, or a sheet without any answer, is an error at once, an answer that isn't allowed when it is read."""
    missing = [c for c in [column, *required] if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}")
    low = {c: F.lower(F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))) for c in [column, *required]}
    wrong = F.raise_error(F.concat(F.lit("unexpected answer: "), F.col(column)))
    given = df.withColumns(low).filter(F.col(column) != "")
    if given.isEmpty():
        raise ValueError(f"no row has an answer in {column}")
    return given.withColumn(column, F.when(F.col(column).isin(*allowed), F.col(column)).otherwise(wrong.cast("string")))


def invalid_answers(df: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """Rows whose answer is none of the allowed ones."""
    return df.filter(~F.lower(F.trim(F.coalesce(column, F.lit("")))).isin("", *allowed))
