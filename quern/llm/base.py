"""What the operators share: reading tables, and writing intermediate tables where every executor sees them."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.graph import connected_components, shared_folder  # noqa: F401
from quern.operators.graph import written as stage  # noqa: F401

#: ASCII white space, the separator of words in the published contracts.
SPACES = r"[\x20\x09-\x0D]+"
#: Its characters, for trimming.
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, binary: bool = False) -> DataFrame:
    """``doc_id`` and ``text`` alone; a null text is empty. Binary text is UTF-8."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (text.cast("binary") if binary else text).alias("text"))


def slices(batch, most_bytes: int = 4_000_000):
    """(doc_ids, texts) of an Arrow batch in pieces of bounded size; one text is never split."""
    ids, body = batch.column(0), batch.column(1)
    start = size = 0
    for i in range(batch.num_rows):
        size += len(body[i].as_buffer()) if body[i].is_valid else 0
        if size >= most_bytes or i == batch.num_rows - 1:
            yield ids[start : i + 1].to_pylist(), body[start : i + 1].to_pylist()
            start, size = i + 1, 0


def shingle_hashes(text: bytes, words_per_shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of every word shingle of ``text``, repeats included; ASCII letters are lower-cased."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= words_per_shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(words_per_shingle)), strict=False))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), np.uint64, len(words) - words_per_shingle + 1)


def digest(text: bytes) -> int:
    """Tells texts of unlike words apart."""
    return xxhash.xxh3_64_intdigest(b" ".join(text.lower().split())) - 2**63


def join_dealt(rows: DataFrame, side: DataFrame, on: list[str], spread: str, most: int = 1_000) -> DataFrame:
    """``rows`` joined with ``side``, which has a row for each key ``on``; the rows of a key that has more than ``most`` are dealt by ``spread`` to copies of it.

    ``rows`` is read twice: write it first.
    """
    many = stage(rows.groupBy(*on).count().filter(F.col("count") > most).select(*on, F.ceil(F.col("count") / most).cast("int").alias("__tiles")), "many")
    if many.isEmpty():
        return rows.join(side.hint("merge"), on)
    tile = F.coalesce(F.pmod(F.xxhash64(spread), F.col("__tiles")).cast("int"), F.lit(0))
    dealt = rows.join(many, on, "left").withColumn("__tile", tile).drop("__tiles")
    copies = side.join(many, on, "left").withColumn("__tile", F.explode(F.sequence(F.lit(0), F.coalesce("__tiles", F.lit(1)) - 1))).drop("__tiles")
    return dealt.join(copies.hint("merge"), [*on, "__tile"]).drop("__tile")


def window_hashes(words: Column, size: int) -> Column:
    """Hashes of the windows of ``size`` elements of an array, of which there are so many at least.

    Elements are hashed once; hashes of longer windows are made of two shorter ones, so no window is built.
    """
    let = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))

    def beside(a: Column, b: Column, step: int) -> Column:
        n = F.greatest(F.size(b) - step, F.lit(0))
        return F.zip_with(F.slice(a, 1, n), F.slice(b, step + 1, n), lambda x, y: F.xxhash64(x, y))

    def grown(single: Column, made: Column, width: int, bits: str) -> Column:
        """``made`` has the hashes of windows of ``width``; each further bit of the size doubles them, and a one adds an element."""
        if not bits:
            return made
        if bits[0] == "1":
            return let(beside(made, made, width), lambda two: let(beside(two, single, 2 * width), lambda more: grown(single, more, 2 * width + 1, bits[1:])))
        return let(beside(made, made, width), lambda two: grown(single, two, 2 * width, bits[1:]))

    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda single: grown(single, single, 1, bin(size)[3:]))
