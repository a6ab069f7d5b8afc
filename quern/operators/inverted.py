"""An inverted index of search texts: which token stands where, sorted so that a search reads the places of its own tokens alone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import tables, text
from quern.operators.filters import normal_query, units
from quern.operators.graph import written


def postings(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """(token, key, place): the tokens of each row's search blob in order, the last one being the whole text without spaces."""
    blob = text.search_blob(*[F.col(c) for c in columns])
    each = df.select(F.col(key).alias("key"), F.posexplode(F.split(blob, " ")).alias("place", "token"))
    return each.filter("token <> ''").select("token", "key", "place")


def build(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """The index, written in order of tokens: files and row groups hold ranges of tokens, so most are skipped by their statistics.

    Ranges are cut by token and key, so a token in a third of all rows lies in many.
    """
    return written(postings(df, key, *columns).repartitionByRange("token", "key").sortWithinPartitions("token", "key", "place"), "index")


def _starts(token: str) -> Column:
    return F.col("token").startswith(token)


def _phrase(index: DataFrame, tokens: list[str]) -> DataFrame:
    """Rows in which ``tokens`` stand side by side; the last one may go on."""
    *whole, last = tokens
    found = index.filter(_starts(last)).select("key", (F.col("place") - len(whole)).alias("at")).distinct()
    for i, t in enumerate(whole):
        found = found.join(index.filter(F.col("token") == t).select("key", (F.col("place") - i).alias("at")), ["key", "at"], "left_semi")
    return found.select("key").distinct()


def _variant(index: DataFrame, words: str, phrase: bool) -> DataFrame:
    tokens = normal_query(words).split()
    if tokens and (phrase or " ".join(tokens) in tables.SEARCH_PHRASES):
        return _phrase(index, tokens)
    long = [t for t in tokens if len(t) > 1 or t.isdigit()]
    if not long:
        return index.filter(F.lit(False)).select("key")
    return reduce(lambda a, b: a.join(b, "key", "left_semi"), [index.filter(_starts(t)).select("key").distinct() for t in long])


def search(index: DataFrame, query: str) -> DataFrame:
    """(key): the rows that ``filters.search`` finds, from the places of the query's tokens: beginnings of tokens are ranges of the index, phrases joins of places.

    A query of digits alone is a key; one without a token finds all rows that have any.
    """
    if query.strip().isdigit():
        return index.filter(F.col("key").cast("string") == query.strip()).select("key").distinct()
    asked = units(normal_query(query))
    if not asked:
        return index.select("key").distinct()
    found = []
    for unit, phrase in asked:
        ways = [_variant(index, unit, phrase), *[_variant(index, s, False) for s in tables.SEARCH_SYNONYMS.get(unit, [])]]
        found.append(reduce(DataFrame.unionByName, ways).distinct())
    return reduce(lambda a, b: a.join(b, "key", "left_semi"), found)
