"""Benchmark decontamination, with DataFrame and SQL functions alone."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.base import stage, window_hashes

#: Words of a shingle, and the similarity from which a window counts as a copy of an item.
SHINGLE, SIMILARITY = 5, 0.8
#: Windows and items at so many differing bits of 64 are compared in full; the index has so many blocks.
RADIUS, BLOCKS = 14, 5

#: Everything below 0x80 but digits and small letters separates words.
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def shingles(text: Column, size: int = SHINGLE) -> Column:
    """Hashes of the word shingles of ``text`` in order, repeats included; fewer words make one shingle, none make none."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _SEPARATORS), lambda w: w != "")
    some = lambda held: F.when(F.size(held) >= size, window_hashes(held, size)).when(F.size(held) > 0, F.array(F.xxhash64(held))).otherwise(F.array().cast("array<long>"))
    return F.transform(F.array(words), some)[0]


def print_of(hashes: str) -> Column:
    """The SimHash of an array of hashes: a bit is set if it is in over half of them."""
    return F.expr(f"aggregate(sequence(0, 63), 0L, (made, b) -> made | if(2 * aggregate({hashes}, 0, (n, h) -> n + cast(shiftright(h, b) & 1 as int)) > size({hashes}), shiftleft(1L, b), 0L))")


def blocks(count: int = BLOCKS) -> list[tuple[int, int]]:
    """(first bit, width) of the index's blocks."""
    cuts = [i * 64 // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _block_value(first: int, width: int) -> Column:
    return F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1))


def block_keys(rows: DataFrame) -> DataFrame:
    """A row for each block of ``fp``: block, value."""
    keys = F.array(*[F.struct(F.lit(i).alias("block"), _block_value(a, w).alias("value")) for i, (a, w) in enumerate(blocks())])
    return rows.select("*", F.explode(keys).alias("__k")).select(*rows.columns, "__k.*")


def block_neighbours(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """A row for each value near a block of ``fp``.

    Of prints within ``radius``, some block differs in ``radius / BLOCKS`` bits at most, so it meets one of these values.
    """
    reach = radius // BLOCKS
    out = None
    for i, (a, w) in enumerate(blocks()):
        flips = [sum(1 << b for b in c) for n in range(reach + 1) for c in combinations(range(w), n)]
        near = F.explode(F.transform(F.array(*map(F.lit, flips)), lambda m: _block_value(a, w).bitwiseXOR(m.cast("long"))))
        part = rows.select("*", F.lit(i).alias("block"), near.alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


def weighted_similarity(a: str, b: str) -> Column:
    """Weighted Jaccard similarity of two arrays, a shingle's weight being how often it comes."""
    times = lambda array, x: F.size(F.filter(array, lambda y: y == x))
    common = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda n, x: n + F.least(times(F.col(a), x), times(F.col(b), x)))
    return common / (F.size(a) + F.size(b) - common)


def _shared(width: Column, share: float) -> Column:
    return F.greatest(F.ceil(width * share - 1e-9).cast("int"), F.lit(1))


def window_starts() -> Column:
    """Where windows of ``width`` begin that hold ``least`` or more of the sorted ``places``, each once, none behind ``last``.

    Those that hold the i-th place and so many from it on begin at or before it; those that hold the one before it too are left to that one.
    """

    def of(i: Column) -> Column:
        low = F.greatest(F.get("places", i + F.col("least") - 1) - F.col("width") + 1, F.coalesce(F.get("places", i - 1) + 1, F.lit(0)))
        high = F.least(F.get("places", i), F.col("last"))
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    firsts = F.size("places") - F.col("least")
    return F.flatten(F.transform(F.when(firsts >= 0, F.sequence(F.lit(0), firsts)).otherwise(F.array().cast("array<int>")), of))


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, similarity, first_shingle, n_windows): documents of which some window is like a benchmark item.

    Windows have an item's size and are taken at every place where so many shingles stand that any item of that size has as
    one like it must share; no other window can be alike, wherever its shingles stand in the item. Windows whose SimHash is
    within ``radius`` of an item's, which the block index finds
    whole, are compared with it exactly. Items and documents of null, empty or word-less text match nothing; texts of fewer
    words than a shingle match as a whole. Rows that share a doc_id, or a null one, are taken as one document.
    ``first_shingle`` is where the best window begins, the first of those; ``n_windows`` counts all that are alike.
    """
    items = stage(benchmark.select(F.col("item_id").cast("long").alias("item_id"), shingles(F.col("text")).alias("item")).filter(F.size("item") > 0), "items")
    index = items.select(F.size("item").alias("width"), F.explode("item").alias("h")).distinct()
    places = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(shingles(F.col("text"))).alias("place", "h")).join(index, "h")
    held_by = places.groupBy("doc_id", "width").agg(F.sort_array(F.collect_set("place")).alias("places")).filter(F.size("places") >= _shared(F.col("width"), similarity))
    wanted = stage(held_by.groupBy("doc_id").agg(F.collect_list(F.struct("width", "places")).alias("wanted")), "windows").withColumnRenamed("doc_id", "of")
    # First the few documents that have windows, by ids whose written size decides the join; then their windows.
    having = stage(wanted.select(F.col("of").alias("has")), "having")
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(having, F.col("doc_id").eqNullSafe(F.col("has")), "left_semi")
    held = some.join(wanted, F.col("doc_id").eqNullSafe(F.col("of")))
    cut = held.select("doc_id", shingles(F.col("text")).alias("all"), "wanted").select("doc_id", "all", F.explode("wanted").alias("w"))
    least = F.when(F.size("all") < F.col("w.width"), _shared(F.col("w.width"), similarity)).otherwise(_shared(F.col("w.width"), 2 * similarity / (1 + similarity)))
    begins = cut.select("doc_id", "all", F.col("w.width").alias("width"), F.col("w.places").alias("places"), least.alias("least"), F.greatest(F.size("all") - F.col("w.width"), F.lit(0)).alias("last"))
    cut = begins.select("doc_id", "all", "width", F.explode(window_starts()).alias("begin"))
    window = cut.select("doc_id", "width", F.col("begin").alias("start"), F.slice("all", F.col("begin") + 1, F.col("width")).alias("window"))
    prints = stage(window.filter(F.size("window") > 0).distinct().select("*", print_of("window").alias("fp")), "prints")
    sides = block_neighbours(items.select("item_id", "item", F.size("item").alias("of_width"), print_of("item").alias("fp")), radius).withColumnsRenamed({"fp": "item_fp", "block": "of_block", "value": "of_value"})
    met = (F.col("width") == F.col("of_width")) & (F.col("block") == F.col("of_block")) & (F.col("value") == F.col("of_value"))
    near = block_keys(prints).join(sides, met & (F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius))
    once = near.dropDuplicates(["doc_id", "start", "width", "item_id", "window"])
    alike = once.select("doc_id", "item_id", "start", weighted_similarity("window", "item").alias("similarity")).filter(F.col("similarity") >= similarity)
    return alike.groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"), F.min_by("start", F.struct(-F.col("similarity"), "start")).alias("first_shingle"), F.count(F.lit(1)).alias("n_windows"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``docs`` without the documents that ``contaminated`` lists."""
    found = stage(contaminated(docs, benchmark, **how).select(F.col("doc_id").alias("__of")).distinct(), "found")
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col("__of")), "left_anti")
