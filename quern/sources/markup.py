"""Sections of marked-up pages and articles: a stack of open tags decides what stands in what."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import text

_TOKEN = re.compile(r"<!--.*?-->|<!\[CDATA\[|\]\]>|<(script|style)\b.*?</\1\s*>|<(/?)([a-z][\w:-]*)[^>]*?(/?)>", re.I | re.S)


def blocks_of(markup: str, block: str) -> list[tuple[list[str], str]]:
    """(titles, body) of each ``block`` element in a section, in order: the titles of the sections it stands in, innermost first, and its markup.

    Sections are ``sec`` elements, whose first ``title`` is theirs, and headings ``h1`` to ``h6``, which reach to the next of their rank or
    above. A block ends with its end tag; another beginning inside doesn't end it; one that a section's end or a heading cuts off is none.
    Comments, scripts and styles hold no tags.
    """
    out: list[tuple[list[str], str]] = []
    open_: list[list] = []  # [rank, title or None]: rank 0 is a sec element
    body, title, last = None, None, 0

    for m in _TOKEN.finditer(markup):
        said = markup[last : m.start()]
        last = m.end()
        name = (m[3] or "").lower()
        if body is not None:
            body.append(said)
        if title is not None:
            title.append(said)
        heading = len(name) == 2 and name[0] == "h" and name[1] in "123456"
        if name == "sec" or heading:
            body = None
            rank = 0 if name == "sec" else int(name[1])
            if m[2]:
                if heading and title is not None and open_:
                    open_[-1][1] = "".join(title)
                elif not heading and any(r == 0 for r, _ in open_):
                    while open_.pop()[0] != 0:
                        pass
                title = None
            elif not m[4]:
                while heading and open_ and open_[-1][0] >= rank:
                    open_.pop()
                open_.append([rank, "" if heading else None])
                title = [] if heading else None
        elif name == "title" and open_ and open_[-1][0] == 0:
            if m[2] and title is not None:
                open_[-1][1], title = "".join(title), None
            elif not m[2] and open_[-1][1] is None:
                title = []
        elif name == block:
            if m[2] and body is not None:
                out.append(([t or "" for _, t in reversed(open_)], "".join(body)))
                body = None
            elif not m[2] and not m[4] and open_:
                body = [] if body is None else [*body, " "]
        else:  # other tags stand for a space, as they part words
            for part in (body, title):
                if part is not None:
                    part.append(" " if m[3] or m[1] else "")
    return out


def pieces(pages: pa.Array, most_bytes: int = 1_000_000) -> Iterator[pa.Array]:
    """A batch in pieces of bounded size, so that memory doesn't follow the rows of a batch; one page is never split."""
    start = size = 0
    for i, page in enumerate(pages):
        size += len(page.as_buffer()) if page.is_valid else 0
        if size >= most_bytes or i == len(pages) - 1:
            yield pages.slice(start, i + 1 - start)
            start, size = i + 1, 0


def section_blocks(markup: Column, block: str = "p") -> Column:
    """``blocks_of`` a column, as an array of (titles, body)."""

    kind = pa.list_(pa.struct([("titles", pa.list_(pa.string())), ("body", pa.string())]))

    @F.arrow_udf("array<struct<titles: array<string>, body: string>>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            for few in pieces(pages):
                yield pa.array([[{"titles": t, "body": b} for t, b in blocks_of(p, block)] for p in few.to_pylist()], kind)

    return cut(F.coalesce(markup, F.lit("")))


def sections(pages: DataFrame, block: str = "p", limit: int = 10_000, **titles: str) -> DataFrame:
    """The ``pages`` (html) that have any of the kinds of section asked for, with a column for each: the text of its blocks, in order, cut to ``limit`` characters.

    A block counts for the innermost section around it whose title has a kind; a title's kind is the first of ``titles`` whose pattern it has.
    """
    kind = lambda title: text.first_found(F.lower(text.strip_html(title)), [(p, n) for n, p in titles.items()], F.lit(""))
    found = F.transform(section_blocks(F.col("html"), block), lambda x: F.struct(F.coalesce(F.get(F.filter(F.transform(x["titles"], kind), lambda k: k != ""), F.lit(0)), F.lit("")).alias("kind"), text.strip_html(x["body"]).alias("body")))
    made = pages.withColumn("__parts", found)
    of = lambda name: F.left(F.array_join(F.transform(F.filter("__parts", lambda x: (x["kind"] == name) & (x["body"] != "")), lambda x: x["body"]), " "), F.lit(limit))
    any_ = F.lit(False)
    for name in titles:
        any_ = any_ | (F.col(name) != "")
    return made.withColumns({name: of(name) for name in titles}).drop("__parts").filter(any_)


def scan_articles(spark: SparkSession, path: str, element: str = "article") -> DataFrame:
    """(html): every ``element`` of XML files that hold many, whole; files are cut at its end tags, so any number of tasks read one."""
    pieces = spark.read.option("lineSep", f"</{element}>").text(path)
    whole = F.regexp_extract("value", rf"(?s)<{element}[\s>].*", 0)
    return pieces.select(F.when(whole != "", F.concat(whole, F.lit(f"</{element}>"))).alias("html")).filter("html is not null")
