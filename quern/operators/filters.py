"""The filtered, searched view: facets, visibility and search as one predicate."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions import tables, text


def isin(column: str, chosen) -> Column | None:
    """Equality with one of ``chosen``; no choice is no filter."""
    return F.col(column).isin(*chosen) if chosen else None


def labels_any(column: str, chosen) -> Column | None:
    """Whether a list in a cell has one of the labels."""
    return F.arrays_overlap(text.split_flat(F.col(column)), F.array(*map(F.lit, chosen))) if chosen else None


def factor_class(column: str, kind: str) -> Column | None:
    """By what labels contain: ``tf``, ``small``, or some label and no ``tf``."""
    labels = F.transform(text.split_flat(F.col(column)), F.lower)
    has = lambda part: F.exists(labels, lambda x: F.contains(x, F.lit(part)))
    return {"tf": has("tf"), "small": has("small"), "non_tf": (F.size(labels) > 0) & ~has("tf")}.get(kind)


def contains(column: str, pattern: str) -> Column | None:
    """A regular expression found in any case."""
    return F.col(column).rlike("(?iu)" + pattern) if pattern else None


def year_between(column: str, low: int, high: int) -> Column:
    """Years in range, and unknown ones always."""
    year = text.number(F.col(column), 0)
    return (year == 0) | year.between(low, high)


def count_between(count: Column, low: int, high: int, most: int) -> Column | None:
    """Counts in range; the full range, from 1 to the most there is, is no filter, and then zero stays too."""
    return None if (low, high) == (1, most) else count.between(low, high)


def rejected() -> Column:
    return F.lower("validation_action").isin(*tables.VIEW_HIDDEN) | (F.lower("validation_recipe_valid") == "no")


@dataclass
class View:
    """What a reader chose. ``column`` makes one predicate of it."""

    search: str = ""
    equal: dict[str, list[str]] = field(default_factory=dict)
    labels: dict[str, list[str]] = field(default_factory=dict)
    kind: str = "all"
    journal: str = ""
    years: tuple[int, int] | None = None
    factors: tuple[int, int, int] | None = None
    hide_duplicates: str | None = "is_broad_duplicate"
    hide_unspecified: bool = True
    hide_rejected: bool = True
    hide_review: bool = True
    hide_single: bool = False
    single_status: list[str] = field(default_factory=list)
    review_only: bool = False

    def column(self, blob: Column | None = None) -> Column:
        parts = [isin(c, v) for c, v in self.equal.items()] + [labels_any(c, v) for c, v in self.labels.items()]
        parts += [factor_class("factor_type", self.kind) if self.kind != "all" else None, contains("journal", self.journal)]
        if self.search.strip():
            parts.append(search(self.search, blob))
        review = text.is_true(F.col("validation_needs_review")) if self.review_only or self.hide_review else None
        if self.single_status:
            parts.append(F.col("single_tf_status").isin(*self.single_status))
        if self.review_only:
            parts.append(review)
        else:
            parts.append(~F.col(self.hide_duplicates) if self.hide_duplicates else None)
            parts.append(~text.is_unspecified(F.col("factors")) if self.hide_unspecified else None)
            parts.append(~F.col("single_tf_status").isin("cocktail_member", "unclear") if self.hide_single and not self.single_status else None)
            parts.append(~review if self.hide_review else None)
            parts.append(~rejected() if self.hide_rejected else None)
        parts.append(count_between(text.item_count(F.col("factors")), *self.factors) if self.factors else None)
        parts.append(year_between("year", *self.years) if self.years else None)
        return reduce(lambda a, b: a & b, [p for p in parts if p is not None], F.lit(True))


def normal_query(query: str) -> str:
    """A query in the spelling of search texts, with common plurals as singulars."""
    low = query.lower()
    for letter, name in tables.GREEK_NAMES.items():
        low = low.replace(letter, name)
    return " ".join(tables.SEARCH_SINGULARS.get(t, t) for t in re.sub(r"[^a-z0-9]+", " ", low).split())


def units(query: str) -> list[tuple[str, bool]]:
    """What a query asks for together: known phrases where they stand, the longest first, and single words."""
    phrases = {tuple(p.split()) for p in tables.SEARCH_PHRASES}
    words, out = query.split(), []
    while words:
        size = next((n for n in (3, 2) if tuple(words[:n]) in phrases), 1)
        out.append((" ".join(words[:size]), size > 1))
        words = words[size:]
    return out


def _variant(blob: Column, words: str, phrase: bool) -> Column:
    tokens = normal_query(words).split()
    if tokens and (phrase or " ".join(tokens) in tables.SEARCH_PHRASES):
        return text.found(blob, blob, r"\b" + r"\s+".join(tokens), "")
    long = [t for t in tokens if len(t) > 1 or t.isdigit()]
    return reduce(lambda a, b: a & b, [text.found(blob, blob, r"\b" + t, "") for t in long]) if long else F.lit(False)


def search(query: str, blob: Column, key: str = "pmid") -> Column:
    """All units of ``query``, each as itself or as one of its synonyms, from the start of a word; digits alone are a record's id."""
    if query.strip().isdigit():
        return F.col(key) == query.strip()
    found = [reduce(lambda a, b: a | b, [_variant(blob, u, p), *[_variant(blob, s, False) for s in tables.SEARCH_SYNONYMS.get(u, [])]]) for u, p in units(normal_query(query))]
    return reduce(lambda a, b: a & b, found, F.lit(True))
