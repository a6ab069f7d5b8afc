"""Reading and writing record tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import text
from quern.sources.manifest import Conflict, Versions, current, write_first, write_version  # noqa: F401
from quern.sources.markup import scan_articles, sections  # noqa: F401
from quern.sources.splits import csv_records, json_records


def scan_text(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV of which every column is text and none is null; quoted cells may hold line ends, and a file is read by any number of tasks.

    Each file has a header, which must name ``columns``; empty lines are no rows.
    """
    record = F.when((F.col("split") == 0) & (F.col("at") == 0), F.regexp_replace("record", "^\ufeff", "")).otherwise(F.col("record"))
    cells = F.from_csv(record, ", ".join(f"`{c}` string" for c in columns), {"escape": '"', "maxCharsPerColumn": "-1"})
    rows = csv_records(spark, path).filter("record <> ''").select("split", "at", cells.alias("c")).select("split", "at", *[F.coalesce(F.col(f"c.`{c}`"), F.lit("")).alias(c) for c in columns])
    header = (F.col("split") == 0) & (F.col("at") == 0)
    named = F.lit(True)
    for c in columns:
        named = named & (F.col(f"`{c}`") == c)
    checked = rows.filter(F.when(header, F.when(named, False).otherwise(F.raise_error(F.lit(f"a file of {path} has no header of {columns}")).cast("boolean"))).otherwise(True))
    return checked.select(*[F.col(f"`{c}`") for c in columns])


def scan_optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A parquet table, or an empty one where there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan_json(spark: SparkSession, path: str, schema: str, form: str = "lines", key: str = "key") -> DataFrame:
    """Rows of JSON files: an object a line, one ``array`` of objects, or one ``object`` of objects by ``key``, which becomes the first column.

    Arrays and objects are read by any number of tasks a file. An entry that is no object, or can't be read, has no row.
    """
    if form == "lines":
        return spark.read.schema(schema).json(path)
    found = json_records(spark, path, level=1 if form == "object" else 0)
    named = F.regexp_extract("record", r'(?s)^(?:\s*\{)?\s*,?\s*("(?:[^"\\]|\\.)*")\s*:\s*\{', 1) if form == "object" else F.lit("")
    parsed = found.select(named.alias("k"), "record")
    start = F.when(F.col("k") != "", F.expr("substring(record, locate('{', record, locate(k, record) + length(k)))")).otherwise(F.regexp_replace("record", r"(?s)^[^{]*", ""))
    rows = parsed.select("k", F.from_json(start, schema).alias("r")).filter("r is not null")
    if form == "array":
        return rows.select("r.*")
    return rows.filter("k <> ''").select(F.get(F.from_json(F.concat(F.lit("["), "k", F.lit("]")), "array<string>"), F.lit(0)).alias(key), "r.*")


def text_lookup(df: DataFrame, key: str, fields: list[str], limit: int | None = None, order: str = "row_id") -> DataFrame:
    """(key, text): the fields of the last row of each key, blank ones left out, each cut to ``limit`` characters."""
    parts = [text.clean(F.col(f)) if limit is None else F.left(text.clean(F.col(f)), F.lit(limit)) for f in fields]
    return df.groupBy(key).agg(F.max_by(text.joined(*parts), F.col(order)).alias("text"))


def requested(spark: SparkSession, keys: list[str]) -> DataFrame:
    """(key, pos): keys asked for, each once, in their order."""
    return spark.createDataFrame([(k, i) for i, k in enumerate(dict.fromkeys(k.strip() for k in keys if k.strip()))], "key string, pos int")


def requested_from(lines: DataFrame, key: str, place: str) -> DataFrame:
    """(key, pos) from a table of keys (read from a text file or a CSV) and their places: each once, where it first stands."""
    trimmed = lines.select(text.clean(F.col(key)).alias("key"), F.col(place).alias("pos")).filter("key <> ''")
    return trimmed.groupBy("key").agg(F.min("pos").alias("pos"))


def append_rows(df: DataFrame, path: str, columns: list[str], exact: bool = False) -> None:
    """Append rows of known columns; missing ones are an error, and with ``exact`` extra ones too."""
    missing, extra = [c for c in columns if c not in df.columns], [c for c in df.columns if c not in columns]
    if missing or (exact and extra):
        raise ValueError(f"missing columns {missing}, extra columns {extra if exact else []}")
    df.select(*columns).write.mode("append").parquet(path)


def residual_queue(df: DataFrame, unresolved: Column, columns: list[str]) -> DataFrame:
    """The rows that a pass left open, with those of ``columns`` that there are."""
    return df.filter(unresolved).select(*[c for c in columns if c in df.columns])


def sheets(views: dict[str, DataFrame]) -> DataFrame:
    """All views as one table with a ``sheet`` column, to be written by it."""
    named = [v.withColumn("sheet", F.lit(n)) for n, v in views.items()]
    out = named[0]
    for v in named[1:]:
        out = out.unionByName(v, allowMissingColumns=True)
    return out


def write_sheets(views: dict[str, DataFrame], path: str) -> None:
    """A folder for each view."""
    sheets(views).write.partitionBy("sheet").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """As text that ``scan_text`` reads back: quotes doubled, white space kept."""
    df.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def union_filled(*frames: DataFrame) -> DataFrame:
    """All rows; a column that a table lacks is blank in its rows."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.na.fill("")
