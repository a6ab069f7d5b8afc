"""Fuzzy title groups: an exact similarity join over a segment index, its components, and which record of a group to keep."""

from __future__ import annotations

from difflib import SequenceMatcher
from math import log

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions import tables, text
from quern.operators.graph import connected_components, written

SIMILARITY = 0.92
#: Against rounding where a bound is a whole number.
_EPS = 1e-9
#: Pieces that are looked at together, from one that stands unchanged on.
_BOXES = 8
#: Letters from which on a title's like pieces are one row.
_LONG = 2048


def distinct_titles(titles: DataFrame, key: str, title: str) -> DataFrame:
    """(t, a, z): each normal form of a title that is not empty, with the first and the last id that has it."""
    named = titles.select(F.col(key).alias("id"), text.title_key(F.col(title)).alias("t"))
    # Asked of an aggregate: a filter by the title itself would make each normal form a second time.
    return named.groupBy("t").agg(F.min("id").alias("a"), F.max("id").alias("z"), F.max(F.length("t")).alias("n")).filter("n > 0").drop("n")


def _pieces(length: str, slack: float) -> str:
    """Pieces of a title of ``length``: one more than a title no longer can differ in and still be alike."""
    return f"(cast(floor({2 * slack:.9f} * {length} + {_EPS}) as int) + 1)"


def _stretch(length: str, slack: float) -> str:
    """Place of a length on a logarithmic scale whose step is the largest ratio of lengths that can be alike."""
    return f"cast(floor(ln({length}) / {_step(slack)!r} + {_EPS}) as int)"


def _ratio(slack: float) -> float:
    return (1 + slack) / (1 - slack)


def _step(slack: float) -> float:
    return log(_ratio(slack))


def _padded(width: str) -> str:
    """A title's letters and blanks behind them, as many as are looked at behind a piece at its end."""
    return f"concat(t, cast(repeat('~', {_BOXES} * {width}) as binary))"


def _beside(rows: DataFrame, place: str) -> DataFrame:
    """``rows`` (padded, width, place) with ``after``, the letters behind the stretch of ``width`` letters at ``place``, and ``near``, hashes of the first ``width`` of them.

    Those are of their first half, and of as many as their second half has from one letter earlier, from there and from one letter later.
    """
    behind = rows.withColumn("after", F.expr(f"substring(padded, {place} + width + 1, {_BOXES - 1} * width)"))
    bits = lambda at, n, shift: f"shiftleft(xxhash64(substring(after, {at}, {n})) & 65535, {shift})"
    near = [bits("1", "width div 2", 0), *[bits(f"width div 2 + {1 + by}", "width - width div 2", 32 + 16 * by) for by in (-1, 0, 1)]]
    return behind.withColumns({"near": F.expr(" | ".join(near)), "after": F.col("after").cast("string")})


def _key(width: str, place: str, first: bool) -> str:
    start = "substring(padded, 1, 1), " if first else ""
    return f"xxhash64({start}stretch, substring(padded, {place} + 1, {width}))"


def _once(rows: DataFrame, place: str, size: str) -> DataFrame:
    """``rows`` with the last ``place`` of a piece as well: lines of thousands of letters repeat a few words, so their like pieces are one row each, from the first place to the last."""
    same = [c for c in rows.columns if c != place]
    short, long = rows.filter(f"{size} < {_LONG}"), rows.filter(f"{size} >= {_LONG}")
    return short.withColumn(f"{place}_to", F.col(place)).unionByName(long.groupBy(*same).agg(F.min(place).alias(place), F.max(place).alias(f"{place}_to")))


def piece_index(titles: DataFrame, slack: float, first: bool = True) -> DataFrame:
    """(k, at, at_to, id, length, most, near, after): the pieces of each title (id, t), by a hash of (first character,) stretch of the other title's length and letters.

    ``near`` and ``after`` are as in ``_beside``, ``most`` is how far the letters after a piece may be from those after its like, see ``candidates``.
    """
    # A row for each stretch of lengths that the other title can be in, as there are far fewer pieces than probes.
    others = f"sequence({_stretch(f'greatest(1, floor(length(t) / {_ratio(slack)!r}))', slack)}, {_stretch('length(t)', slack)})"
    cut = titles.withColumns({"length": F.length("t"), "n": F.expr(_pieces("length(t)", slack)), "stretch": F.explode(F.expr(others))})
    sized = cut.withColumn("width", F.expr("cast(length div n as int)")).withColumn("padded", F.expr(_padded("width"))).drop("t")
    each = sized.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    placed = each.withColumns({"at": F.expr("cast((cast(i as long) * length) div n as int)"), "most": F.expr(f"2 * (least({_BOXES}, n - i) - 1)")})
    return _once(_beside(placed.withColumn("k", F.expr(_key("width", "at", first))), "at").select("k", "at", "id", "length", "most", "near", "after"), "at", "length")


def piece_probes(titles: DataFrame, slack: float, first: bool = True) -> DataFrame:
    """(k, place, place_to, of, size, close, behind): every stretch of letters of each title (id, t) that can be a piece of a title that is as long or longer, and alike.

    ``close`` and ``behind`` are what ``near`` and ``after`` are to a piece.
    """
    sized = titles.withColumn("size", F.length("t"))
    widths = f"array_distinct(transform(sequence(size, cast(floor(size * {_ratio(slack)!r} + {_EPS}) as int)), l -> cast(l div {_pieces('l', slack)} as int)))"
    wide = sized.withColumns({"width": F.explode(F.expr(widths)), "stretch": F.expr(_stretch("size", slack))}).filter("width <= size")
    each = wide.withColumn("padded", F.expr(_padded("width"))).drop("t").withColumn("place", F.explode(F.expr("sequence(0, cast(size - width as int))")))
    return _once(_beside(each.withColumn("k", F.expr(_key("width", "place", first))), "place").select("k", "place", F.col("id").alias("of"), "size", F.col("near").alias("close"), F.col("after").alias("behind")), "place", "size")


def edit_distance(a: str, b: str, most: int) -> int:
    """Edits between two lines, or -1 if they are more than ``most``.

    A column of the table of distances is two long numbers: a bit for each letter of ``a`` where it rises, and where it falls (Myers, Hyyrö).
    """
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    every = (1 << len(a)) - 1
    up, down = every, 0
    for n, c in enumerate(b, 1):
        same = places.get(c, 0)
        level = ((same & up) + up ^ up) | same | down
        later = (down | ~(up | level)) << 1 | 1
        up, down = ((up & level) << 1 | ~(later | level)) & every, later & level & every
        if not n % 128 and n + up.bit_count() - down.bit_count() - (len(b) - n) > most:
            return -1
    edits = len(b) + up.bit_count() - down.bit_count()
    return edits if edits <= most else -1


@F.pandas_udf(T.BooleanType())
def edits_within(a: pd.Series, b: pd.Series, most: pd.Series) -> pd.Series:
    """Whether two lines are at most as many edits apart."""
    return pd.Series([edit_distance(x, y, int(n)) >= 0 for x, y, n in zip(a, b, most, strict=True)], dtype=bool)


def _most(slack: float) -> Column:
    return F.floor(slack * (F.length("ta") + F.length("tb")) + _EPS).cast("int")


def candidates(titles: DataFrame, key: str, title: str, similarity: float = SIMILARITY, first: bool = True, near: bool = True) -> DataFrame:
    """(a, b, ta, tb, za, zb): pairs of unlike titles (of the same first character, if ``first``) that can reach ``similarity``.

    A title stands once, under the first id that has it; a is the smaller id of the two, za and zb are the last ids. If matching
    blocks reach that share of both lengths, all letters outside them, d of both titles together, are at most (1 - similarity) of
    their sum. A letter outside spoils one piece of the longer title, so of d + 1 pieces one stands unchanged in the shorter one,
    moved by no more than the letters outside on either side. Pieces meet by equality, so the work of a title is a few rows for
    each of its letters; then the edit distance, which is at most d as well, decides (if ``near``; else some pairs more are left).

    A piece is a few letters, so most that meet are not alike. But where a title has fewer letters outside than pieces, there is a
    piece from which on, up to any later piece, fewer are outside than pieces passed (the one behind the last place where letters
    outside are furthest ahead of pieces). So next to an unchanged piece at most one letter of the next piece is outside, which leaves
    one of its halves as it was, and after n pieces at most n are, which bounds the distance of the letters behind both: n for
    what is changed, and as much again as the one may reach further than the other. Pieces that fail either go no further.
    """
    slack = 1 - similarity
    named = written(distinct_titles(titles, key, title), "titles")
    # Few rows make many: dealt to all tasks first. Letters are bytes, so pieces are cut without counting from the start.
    spread = int(titles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    single = named.select(F.col("a").alias("id"), F.col("t").cast("binary").alias("t")).repartition(spread, "id")
    outside = f"({slack:.9f} * (length + size) + {_EPS})"
    moved = F.expr(f"place_to - at >= -floor(({outside} + length - size) / 2) and place - at_to <= floor(({outside} - length + size) / 2)")
    longer = (F.col("length") > F.col("size")) | ((F.col("length") == F.col("size")) & (F.col("id") > F.col("of")))
    half, second = "(near ^ close) & 65535", "(shiftright(near, 32) & 65535)"
    halves = F.expr(f"{half} = 0 or " + " or ".join(f"{second} = (shiftright(close, {16 * n}) & 65535)" for n in (1, 2, 3)))
    behind = F.expr("after = behind or levenshtein(after, behind, most) >= 0")
    # A title's rows are many times its letters: neither side may be sent whole, however small the written titles are. Pieces are the right side, whose rows of a key are kept.
    pieces, probes = piece_index(single, slack, first).hint("merge"), piece_probes(single, slack, first).hint("merge")
    met = probes.join(pieces, "k").filter(longer & halves & moved & F.expr(f"length - size <= {outside}") & behind)
    pairs = met.select(F.least("id", "of").alias("a"), F.greatest("id", "of").alias("b")).distinct()
    one, other = named.select("a", F.col("t").alias("ta"), F.col("z").alias("za")), named.select(F.col("a").alias("b"), F.col("t").alias("tb"), F.col("z").alias("zb"))
    # Pairs are small and their distances are not: as many tasks as there are partitions.
    full = pairs.join(one.hint("merge"), "a").repartition(spread, "b").join(other.hint("merge"), "b")
    same = F.left("ta", F.lit(1)) == F.left("tb", F.lit(1)) if first else F.lit(True)
    found = full.filter(same).select("a", "b", "ta", "tb", "za", "zb")
    # Spark's own distance costs the square of a title, however close the two are.
    return found.filter(edits_within("ta", "tb", _most(slack))) if near else found


@F.pandas_udf(T.DoubleType())
def matched_share(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the length of the matching blocks over both lengths (Ratcliff and Obershelp)."""
    return pd.Series([SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype=float)


def _alike(found: DataFrame, similarity: float, blocks: bool) -> DataFrame:
    """(a, b) of the pairs (a, b, ta, tb, za, zb) that are alike."""
    spread = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.repartition(spread)  # not by a and b: behind a join by those Spark leaves that out, and makes few tasks of small rows
    if not blocks:
        return dealt.filter(edits_within("ta", "tb", _most(1 - similarity))).select("a", "b")
    tried = dealt.select("a", "b", F.explode(F.expr("if(b < za, array(struct(ta as x, tb as y), struct(tb as x, ta as y)), array(struct(ta as x, tb as y)))")).alias("p"))
    return tried.filter(matched_share("p.x", "p.y") >= similarity).select("a", "b").distinct()


def similar_titles(titles: DataFrame, key: str, title: str, similarity: float = SIMILARITY, blocks: bool = True, first: bool = True) -> DataFrame:
    """(a, b): the first ids of unlike titles that are alike: at ``similarity`` or more by matching blocks, or by edit distance alone.

    Matching blocks depend on which title comes first; a title with records on both sides of the other's is tried both ways.
    """
    return _alike(candidates(titles, key, title, similarity, first, near=False), similarity, blocks)


def _links(found: DataFrame, similarity: float, blocks: bool) -> DataFrame:
    """(src, dst): of the pairs that are alike, enough to link all that are linked.

    A group of n near copies has n * n / 2 pairs. The pair of each title with its first is tried, then only pairs whose titles aren't linked by those.
    """
    edges = lambda pairs: pairs.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    pairs = written(found, "pairs")
    firsts = pairs.groupBy("b").agg(F.min("a").alias("a"))
    linked = written(_alike(pairs.join(firsts, ["a", "b"], "left_semi"), similarity, blocks), "links")
    parts = written(connected_components(edges(linked)), "parts")
    of = lambda c: parts.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
    apart = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left").filter("of_a is null or of_b is null or of_a <> of_b").drop("of_a", "of_b")
    return edges(linked.unionByName(_alike(apart, similarity, blocks)))


def title_groups(titles: DataFrame, key: str, title: str, similarity: float = SIMILARITY, blocks: bool = True, first: bool = True) -> DataFrame:
    """(node, component) of ids whose titles are alike, directly or through others, or the same; ids must be of one comparable type.

    Titles of the same letters are one node until the end, so copies are never paired.
    """
    parts = connected_components(_links(candidates(titles, key, title, similarity, first, near=False), similarity, blocks))
    names = written(titles.select(F.col(key).alias("node"), text.title_key(F.col(title)).alias("t")).filter("t <> ''"), "named")
    first = names.groupBy("t").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("n"))
    grouped = first.join(parts, F.col("a") == F.col("node"), "left").select("t", F.coalesce("component", "a").alias("component"), (F.col("n") > 1).alias("again"), F.col("component").isNotNull().alias("linked"))
    return names.join(grouped.filter("again or linked"), "t").select("node", "component")


def _preprint() -> Column:
    return F.coalesce(F.col("journal").rlike(tables.PREPRINTS), F.lit(False))


def preprint_decisions(groups: DataFrame, papers: DataFrame, key: str) -> DataFrame:
    """(key, keep): for each preprint in a group that has reviewed papers, the latest of those, then the one of the largest id."""
    member = groups.join(papers.select(F.col(key).alias("node"), "year", "journal"), "node").withColumn("preprint", _preprint())
    keep = member.filter(~F.col("preprint")).groupBy("component").agg(F.max_by("node", F.struct(text.number(F.col("year"), 0), "node")).alias("keep"))
    return member.filter("preprint").join(keep, "component").select(F.col("node").alias(key), "keep")


def review_export(groups: DataFrame, papers: DataFrame, key: str) -> DataFrame:
    """(component, key, title, year, journal, preprint, keep): all papers of title groups, to be decided by hand.

    In a group with a preprint a keeper is suggested: the latest reviewed paper, then the one of the largest id; where all are
    preprints, the latest of those.
    """
    rows = groups.join(papers.select(F.col(key).alias("node"), "title", "year", "journal"), "node").withColumn("preprint", _preprint())
    latest = F.struct((~F.col("preprint")).alias("reviewed"), text.number(F.col("year"), 0).alias("year"), F.col("node").alias("node"))
    keep = rows.groupBy("component").agg(F.max_by("node", latest).alias("keep"), F.bool_or("preprint").alias("any")).filter("any").select("component", "keep")
    return rows.join(keep, "component", "left").select("component", F.col("node").alias(key), "title", "year", "journal", "preprint", "keep")
