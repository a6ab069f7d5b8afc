"""Standard names: rule tables over cells and factors, and folding within a column's own vocabulary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import tables, text


def standard_factor(c: Column) -> Column:
    return text.first_match(c, tables.FACTOR_RULES)


def standard_factors(c: Column) -> Column:
    """Each item of a flat list under its usual name; parentheses don't protect commas here."""
    return F.array_join(F.transform(text.split_flat(c), standard_factor), ", ")


def standard_target(c: Column) -> Column:
    return text.first_match(c, tables.CELL_RULES, "(?iu)")


def standard_source(c: Column) -> Column:
    return text.first_match(c, tables.SOURCE_RULES, "(?iu)")


def by_distinct(df: DataFrame, column: str, to: str, rule) -> DataFrame:
    """``df`` with ``to``: the rule is applied once to each distinct value, and joined back."""
    values = df.select(F.col(column).alias("__v")).distinct().withColumn("__to", rule(F.col("__v")))
    return df.join(values, F.col(column).eqNullSafe(F.col("__v")), "left").withColumn(to, F.col("__to")).drop("__v", "__to")


def standard_cell(c: Column) -> Column:
    """Hyphens before "cell" as spaces, abbreviations spelled out (not within parentheses), synonyms, and no name twice."""
    name = F.regexp_replace(text.strip(c), r"(?U)\b(\w+)-[Cc]ells?\b", "$1 cell")
    # Outside and inside of parentheses alternate, whichever comes first.
    outside = F.split(name, r"\([^)]*\)")
    inside = F.regexp_extract_all(name, F.lit(r"\([^)]*\)"), 0)
    spell = lambda part: reduce(lambda x, kv: F.regexp_replace(x, rf"(?i)(?<![-A-Za-z0-9]){kv[0]}s?\b", kv[1]), tables.CELL_ABBREVIATIONS.items(), part)
    spelled = F.array_join(F.zip_with(F.transform(outside, spell), inside, lambda o, i: F.concat(F.coalesce(o, F.lit("")), F.coalesce(i, F.lit("")))), "")
    known = F.coalesce(text.literal_map(tables.CELL_SYNONYMS)[spelled], spelled)
    full = sorted(set(tables.CELL_ABBREVIATIONS.values()), key=len, reverse=True)
    return reduce(lambda x, n: F.regexp_replace(x, rf"(?i)\b({n}s?)\s*\(\s*{n}s?\s*\)", "$1"), full, known)


def without_abbreviation(c: Column) -> Column:
    return text.strip(F.regexp_replace(text.strip(c), tables.TRAILING_ABBREVIATION, ""))


def singular(c: Column) -> Column:
    """The last word in the singular, if it is one of the usual heads."""
    return reduce(lambda x, head: F.regexp_replace(x, rf"(?i)\b{head}s$", head), tables.PLURAL_HEADS, c)


def fold(df: DataFrame, column: str) -> DataFrame:
    """``df`` with names of ``column`` folded where the column itself has the other form.

    A name in s becomes the one without if that occurs. Of names that differ in case alone, the most frequent stays, of those the
    first in order.
    """
    counts = df.groupBy(F.col(column).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    short = counts.select(F.col("name").alias("short"))
    bare = F.regexp_replace("name", "s+$", "")
    stemmed = counts.join(short, (bare == F.col("short")) & (F.col("name") != F.col("short")), "left").withColumn("stem", F.coalesce("short", "name"))
    merged = stemmed.groupBy("stem").agg(F.sum("n").alias("n")).withColumn("low", F.lower("stem"))
    best = merged.groupBy("low").agg(F.min_by("stem", F.struct(-F.col("n"), F.col("stem"))).alias("best"))
    names = stemmed.withColumn("low", F.lower("stem")).join(best, "low").select(F.col("name").alias("__name"), "best")
    return df.join(names, F.col(column) == F.col("__name"), "left").withColumn(column, F.coalesce("best", F.col(column))).drop("__name", "best")


def single_status(factors: Column, target: Column) -> Column:
    """What a single factor is by itself: standalone_valid, cocktail_member or unclear; some depend on the target."""
    upper = F.upper(text.strip(F.regexp_replace(factors, r"(?U)\s+", " ")))
    chain = F.when(upper.rlike(tables.STANDALONE), "standalone_valid")
    for factor, targets in tables.STANDALONE_FOR:
        chain = chain.when(upper.rlike(factor), F.when(F.lower(target).rlike(targets), "standalone_valid").otherwise("unclear"))
    return chain.when(upper.rlike(tables.COCKTAIL), "cocktail_member").otherwise("unclear")


def paper_type(publication_types: Column) -> Column:
    """From a paper's publication types: review, other, or research."""
    has = lambda *kinds: F.arrays_overlap(F.transform(publication_types, F.lower), F.array(*map(F.lit, kinds)))
    return F.when(has("review", "systematic review", "meta-analysis"), "review").when(has("editorial", "comment", "letter", "news"), "other").otherwise("research")


def publication_year(year: Column, free_date: Column) -> Column:
    """The year given, else the first four characters of a free date, else unknown."""
    given = lambda c: F.when(text.clean(c) != "", text.clean(c))
    return F.coalesce(given(year), given(F.left(F.coalesce(free_date, F.lit("")), F.lit(4))), F.lit("unknown"))
