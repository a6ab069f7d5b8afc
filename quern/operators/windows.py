"""First claims, caps and evidence of order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_claims(found: DataFrame, key: str, query_no: str, position: str) -> DataFrame:
    """(key, query_no): each id belongs to the first query, in list order, that returned it."""
    return found.groupBy(key).agg(F.min_by(query_no, F.struct(query_no, position)).alias(query_no))


def capped(found: DataFrame, query: str, position: str, most: int) -> DataFrame:
    """At most ``most`` rows of each query, the first by position."""
    n = F.row_number().over(Window.partitionBy(query).orderBy(position))
    return found.withColumn("__n", n).filter(F.col("__n") <= most).drop("__n")
