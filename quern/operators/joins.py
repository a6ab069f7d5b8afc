"""Joins with known tables, donors and annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import text
from quern.operators.duplicates import first_rows


def enrich(df: DataFrame, dimension: DataFrame, key: str, column: str) -> DataFrame:
    """``df`` with a column of ``dimension``, blank where there is none; a repeated key there counts once."""
    one = dimension.groupBy(key).agg(F.min(column).alias(column))
    return df.join(one, key, "left").withColumn(column, F.coalesce(column, F.lit("")))


def override(df: DataFrame, new: DataFrame, key: str, column: str) -> DataFrame:
    """``df`` with the new value where there is one."""
    one = new.groupBy(key).agg(F.max(column).alias("__new"))
    return df.join(one, key, "left").withColumn(column, F.coalesce("__new", F.col(column))).drop("__new")


def unseen(df: DataFrame, key: str, *known: DataFrame) -> DataFrame:
    """Rows whose key is in none of the known tables."""
    for k in known:
        df = df.join(k.select(key), key, "left_anti")
    return df


def known(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows whose key is in ``keys``, each once."""
    return df.join(keys.select(key), key, "left_semi")


def membership(df: DataFrame, key: str, tables_: dict[str, DataFrame]) -> DataFrame:
    """``df`` with a flag for each table: whether it has the key."""
    for name, t in tables_.items():
        keys = t.select(F.col(key).alias("__k")).distinct()
        df = df.join(keys, F.col(key) == F.col("__k"), "left").withColumn(name, F.col("__k").isNotNull()).drop("__k")
    return df


def expand(df: DataFrame, edges: DataFrame, key: str, child: str) -> DataFrame:
    """A row for each child of a row; one with a blank child where there is none."""
    return df.join(edges.select(key, child), key, "left").withColumn(child, F.coalesce(F.col(child).cast("string"), F.lit("")))


def strict_copy(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """``df`` with missing values taken from rows of the same keys, where those have exactly one value between them.

    Donors are as they were before, so a copy is no donor.
    """
    missing = text.is_unspecified(F.col(column))
    donors = df.filter(~missing).groupBy(*keys).agg(F.count_distinct(column).alias("kinds"), F.min(column).alias("donor")).filter("kinds = 1").drop("kinds")
    joined = df.join(donors, keys, "left")
    take = missing & F.col("donor").isNotNull()
    return joined.withColumn("copied", take).withColumn(column, F.when(take, F.col("donor")).otherwise(F.col(column))).drop("donor")


def annotate(df: DataFrame, notes: DataFrame, keys: list[str], fields: list[str], order: str = "no") -> DataFrame:
    """``df`` with the fields of the annotation that fits on all (trimmed) keys; for each field the last that isn't blank counts."""
    trimmed = notes.select(*[text.clean(F.col(k)).alias(f"__{k}") for k in keys], order, *fields)
    last = trimmed.groupBy(*[f"__{k}" for k in keys]).agg(*[F.max_by(F.when(F.col(f) != "", F.col(f)), F.when(F.col(f) != "", F.col(order))).alias(f"__new_{f}") for f in fields])
    on = [text.clean(F.col(k)) == F.col(f"__{k}") for k in keys]
    joined = df.join(last, on, "left").drop(*[f"__{k}" for k in keys])
    return joined.withColumns({f: F.coalesce(f"__new_{f}", F.col(f) if f in df.columns else F.lit("")) for f in fields}).drop(*[f"__new_{f}" for f in fields])


def unmatched(notes: DataFrame, df: DataFrame, keys: list[str]) -> DataFrame:
    """Annotations that fit no row."""
    return notes.alias("n").join(df.alias("d"), [text.clean(F.col(f"n.{k}")) == text.clean(F.col(f"d.{k}")) for k in keys], "left_anti")


def optional_match(df: DataFrame, notes: DataFrame, key: str, optional: list[str], *carried: str) -> DataFrame:
    """Pairs of rows and annotations of the same key, where each optional column is blank in the annotation or equal."""
    n = notes.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in optional], *carried)
    condition: Column = F.col(key) == F.col("__key")
    for c in optional:
        condition = condition & ((F.col(f"__{c}") == "") | (F.col(f"__{c}") == F.col(c)))
    return df.join(n, condition).drop("__key", *[f"__{c}" for c in optional])


def restore(df: DataFrame, old: DataFrame, keys: list[str], column: str, where: Column | None = None) -> DataFrame:
    """``df`` with a blank column filled from an older table, the last of its rows for each key; with ``where``, in those rows alone, whatever they have."""
    kept = first_rows(old.select(*keys, "row_id", F.col(column).alias("__old")), keys, last=True).drop("row_id")
    empty = text.clean(F.col(column)) == "" if where is None else where
    return df.join(kept, keys, "left").withColumn(column, F.when(empty, F.coalesce("__old", F.lit(""))).otherwise(F.col(column))).drop("__old")


def choose_text(df: DataFrame, abstracts: DataFrame, fulltexts: DataFrame, key: str = "pmid", always_full: bool = False) -> DataFrame:
    """``df`` with the text that a record was read from: full text if it came from there (or ``always_full``) and there is one, else the abstract."""
    joined = df.join(abstracts.select(key, F.col("text").alias("__a")), key, "left").join(fulltexts.select(key, F.col("text").alias("__f")), key, "left")
    full = text.clean(F.col("__f")) != ""
    use = full if always_full else full & (F.col("source") == "fulltext")
    return joined.withColumn("text", F.when(use, F.col("__f")).otherwise(F.coalesce("__a", F.lit("")))).drop("__a", "__f")
