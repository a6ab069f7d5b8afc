"""Scalar functions on text and delimited lists, all ``Column -> Column``."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions import tables

NOT_SPECIFIED = "not specified"


#: White space of any script, as Unicode lists it.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without white space of any script at either end; only the ends are looked at."""
    return F.btrim(c, F.lit(WHITE))


def clean(c: Column) -> Column:
    """Null becomes empty; then ``strip``."""
    return strip(F.coalesce(c, F.lit("")))


def truncate(c: Column, limit: int) -> Column:
    """At most ``limit`` characters and a mark that more followed."""
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit(" ..."))).otherwise(c)


def number(c: Column, default: int) -> Column:
    """A whole number from text, ``default`` where it isn't one."""
    return F.coalesce(c.try_cast("double").try_cast("int"), F.lit(default))


def label(c: Column, names: dict[str, str]) -> Column:
    """The label of a code; a code without one stays."""
    return F.coalesce(literal_map(names)[c], c) if names else c


def literal_map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def url(prefix: str, c: Column) -> Column:
    return F.when(c != "", F.concat(F.lit(prefix), c, F.lit("/"))).otherwise("")


def let(value: Column, use) -> Column:
    """``use`` of ``value``, which is made once, however often it is looked at."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def is_true(c: Column, words: tuple[str, ...] = ("true", "1", "yes")) -> Column:
    """Whether text says so. Some writers accept "true" alone: pass ``words``."""
    return F.lower(clean(c)).isin(*words)


def joined(*columns: Column, by: str = " ") -> Column:
    """The columns that have text, joined."""
    return F.array_join(F.filter(F.array(*[F.coalesce(c, F.lit("")) for c in columns]), lambda x: x != ""), by)


# Lists in a cell


def split_flat(c: Column, separator: str = ",") -> Column:
    """Trimmed items between separators, without blank ones."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), separator), strip), lambda x: x != "")


def split_nested(c: Column, separators: str = ",;") -> Column:
    """Trimmed items between separators outside parentheses, without blank ones.

    A closing parenthesis without an open one is text; an open one that isn't closed keeps all that follows together.
    """
    text = F.coalesce(c, F.lit(""))
    start = F.struct(F.array().cast("array<string>").alias("parts"), F.lit("").alias("open"), F.lit(0).alias("depth"))

    def step(state: Column, ch: Column) -> Column:
        depth = F.when(ch == "(", state["depth"] + 1).when((ch == ")") & (state["depth"] > 0), state["depth"] - 1).otherwise(state["depth"])
        cut = ch.isin(*separators) & (depth == 0)
        return F.struct(
            F.when(cut, F.concat(state["parts"], F.array(state["open"]))).otherwise(state["parts"]).alias("parts"),
            F.when(cut, F.lit("")).otherwise(F.concat(state["open"], ch)).alias("open"),
            depth.alias("depth"),
        )

    nested = F.aggregate(F.split(text, ""), start, step, lambda s: F.concat(s["parts"], F.array(s["open"])))
    parts = F.when(F.contains(text, F.lit("(")), nested).otherwise(F.split(text, f"[{separators}]"))
    return F.filter(F.transform(parts, strip), lambda x: x != "")


def split_piped(c: Column) -> Column:
    """``split_nested`` where a bar separates as well."""
    return split_nested(F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit(",")))


def is_unspecified(c: Column, words: tuple[str, ...] = tables.UNSPECIFIED) -> Column:
    """Blank, or one of the words for "not given"."""
    return F.lower(clean(c)).isin("", *words)


def item_count(c: Column) -> Column:
    return F.when(is_unspecified(c), 0).otherwise(F.size(split_nested(c)))


def append_tag(existing: Column, tag: Column, by: str = ";") -> Column:
    """An ordered set of tags with one more."""
    parts = split_flat(existing, by)
    return F.array_join(F.when((clean(tag) == "") | F.array_contains(parts, tag), parts).otherwise(F.concat(parts, F.array(tag))), by)


def append_note(existing: Column, note: Column, by: str = " || ", repeat: bool = False) -> Column:
    """Notes with one more at the end. Unless ``repeat``, a note that the text already holds is not added."""
    old = clean(existing)
    new = F.when(old == "", note).otherwise(F.concat(old, F.lit(by), note))
    return new if repeat else F.when((note == "") | ((old != "") & F.contains(old, note)), old).otherwise(new)


def manual_note(reason: Column, auto_tag: str) -> Column:
    """What people wrote into a reason, without the tag that a job owns."""
    return F.array_join(F.filter(split_flat(reason, "[;|]"), lambda x: x != auto_tag), " | ")


def with_auto_tag(note: Column, auto_tag: str) -> Column:
    return F.when(clean(note) == "", F.lit(auto_tag)).otherwise(F.concat(F.lit(f"{auto_tag} | "), clean(note)))


def preview(items: Column, limit: int) -> Column:
    """The first items, and how many more there are."""
    more = F.concat(F.array_join(F.slice(items, 1, limit), "; "), F.lit("; ... (+"), (F.size(items) - limit).cast("string"), F.lit(" more)"))
    return F.when(F.size(items) > limit, more).otherwise(F.array_join(items, "; "))


def unique_in_order(items: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(items, clean), lambda x: x != ""))


# Keys


def spelled(c: Column, letters: dict[str, str] = tables.GREEK_NAMES) -> Column:
    return reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), letters.items(), c)


def key_text(c: Column, letters: dict[str, str] = tables.GREEK_NAMES) -> Column:
    """Lower case, Greek letters by name, dashes and slashes as spaces, single spaces."""
    return strip(F.regexp_replace(spelled(F.lower(clean(c)), letters), r"(?U)[-_/\s]+", " "))


def cell_key(standard: Column, raw: Column) -> Column:
    """The key of a name: its standard form, or what was read where there is none; only beta is spelled out."""
    value = F.when(F.coalesce(standard, F.lit("")) != "", standard).otherwise(raw)
    return F.regexp_replace(spelled(F.lower(clean(value)), {"β": "beta"}), r"(?U)[-_/\s]+", " ")


def search_text(c: Column) -> Column:
    """``key_text`` of letters a-z and digits alone."""
    return strip(F.regexp_replace(spelled(F.lower(clean(c))), r"[^a-z0-9]+", " "))


def search_blob(*columns: Column) -> Column:
    """The search texts of all columns, and the same without spaces."""
    text = F.concat_ws(" ", *[search_text(c) for c in columns])
    return F.concat(text, F.lit(" "), F.replace(text, F.lit(" "), F.lit("")))


def title_key(c: Column) -> Column:
    """Lower-case letters, digits and single spaces, without a leading article."""
    text = F.regexp_replace(strip(F.lower(F.coalesce(c, F.lit("")))), r"[^a-z0-9 ]+", "")
    return F.regexp_replace(F.trim(F.regexp_replace(text, "  +", " ")), r"^(a|an|the) ", "")


def factor_name(c: Column) -> Column:
    """A factor under its usual name, else in capitals: Greek letters as capitals, aliases by what is left without punctuation."""
    text = strip(c)
    latin = F.translate(text, "αβγδ", "ABGD")
    bare = F.regexp_replace(latin, tables.ALIAS_PARENTHESES, "")
    bare = strip(F.regexp_replace(bare, r"(?U)\s+", " "))
    compact = F.upper(F.regexp_replace(bare, r"[^A-Za-z0-9]+", ""))
    known = F.coalesce(literal_map(tables.FACTOR_ALIASES)[compact], F.upper(bare))
    return F.when(F.lower(text).isin(*tables.UNSPECIFIED), F.lit(NOT_SPECIFIED)).otherwise(known)


def factor_key(c: Column) -> Column:
    """The multiset of a cell's factors: their names in order, repeats included, joined by bars."""
    names = F.filter(F.transform(split_nested(c), factor_name), lambda x: x != "")
    return F.array_join(F.array_sort(names), " | ")


# Rule tables


def first_match(c: Column, rules: list[tuple[str, str]], flags: str = "") -> Column:
    """The value of the first rule whose pattern is the whole of the trimmed text, else the text."""
    text = strip(c)
    chain = reduce(lambda w, rule: w.when(text.rlike(f"{flags}^(?:{rule[0]})$"), F.lit(rule[1])), rules, F)
    return chain.otherwise(text)


def first_found(c: Column, rules: list[tuple[str, str]], default: Column, flags: str = "(?iu)") -> Column:
    """The value of the first rule whose pattern is found in the text."""
    return reduce(lambda w, rule: w.when(c.rlike(flags + rule[0]), F.lit(rule[1])), rules, F).otherwise(default)


def alternatives(pattern: str) -> list[str]:
    """The alternatives of a pattern outside of groups and classes."""
    out, depth, in_class, at = [""], 0, False, 0
    while at < len(pattern):
        ch = pattern[at : at + 2] if pattern[at] == "\\" else pattern[at]
        at += len(ch)
        in_class = (in_class or ch == "[") and ch != "]"
        depth += 0 if in_class else (ch == "(") - (ch == ")")
        if ch == "|" and depth == 0 and not in_class:
            out.append("")
        else:
            out[-1] += ch
    return out


def needed(pattern: str) -> str:
    """The longest word that every match of a pattern without alternatives holds as it stands; blank if none is plain to see."""
    bare = re.sub(r"\(\?[^():|]*\)|\([^()]*\)|\[[^\]]*\]", "\0", pattern)  # groups and classes
    if re.search(r"[()\[\]|]", bare):
        return ""
    bare = re.sub(r"\\\w|\{[^}]*\}", lambda m: m[0] if m[0][0] == "{" else "\0", bare)
    bare = re.sub(r"(?:\\.|[^\\])(?:[?*]|\{[^}]*\})|[.^$+]|\\.", "\0", bare)
    return max(bare.split("\0"), key=len)


#: Letters that stand for another one in a pattern for any case, though their lower case differs.
_FOLDED = {"İ": "i", "ı": "i", "ſ": "s", "ϐ": "β"}


def folded(c: Column) -> Column:
    """Lower case, so that it holds each word that a pattern for any case finds."""
    return F.lower(spelled(c, _FOLDED))


def found(c: Column, low: Column, pattern: str, flags: str = "(?iu)") -> Column:
    """Whether a pattern is found in ``c``, whose ``folded`` text is ``low``.

    Each alternative is looked for only in texts that hold a word it can't do without: words are found fast, alternatives are tried at every letter.
    """

    def one(p: str) -> Column:
        word = needed(p)
        return F.contains(low, F.lit(word.lower())) & c.rlike(flags + p) if word else c.rlike(flags + p)

    return reduce(lambda a, b: a | b, map(one, alternatives(pattern)))


def any_found(c: Column, patterns, flags: str = "(?iu)") -> Column:
    return reduce(lambda a, b: a | b, [c.rlike(flags + p) for p in patterns])


def labels_found(c: Column, rules: dict[str, str]) -> Column:
    """Every label whose pattern is found in the text, in the order of the rules."""
    hits = F.array(*[F.when(c.rlike(p), F.lit(name)) for name, p in rules.items()])
    return F.array_compact(hits)


def strip_html(c: Column) -> Column:
    """Without tags; the five named entities and the space entity resolved; single spaces."""
    text = F.regexp_replace(F.coalesce(c, F.lit("")), r"<[^>]+>", " ")
    for entity, ch in tables.ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(ch))
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def pair_key(a: Column, b: Column) -> Column:
    """Sixteen hexadecimal digits for a pair of sequences."""
    return F.left(F.sha1(F.concat_ws("|", a, b)), F.lit(16))


def sequence(c: Column) -> Column:
    return F.upper(F.translate(F.coalesce(c, F.lit("")), WHITE, ""))


def valid_sequence(c: Column) -> Column:
    return c.rlike("^[A-Z&&[^J]]+$")


def tolerant_number(c: Column) -> Column:
    """A number, or the first one in the text."""
    return F.coalesce(strip(c).try_cast("double"), F.regexp_extract(c, r"[-+]?\d*\.?\d+(?:[eE][-+]?\d+)?", 0).try_cast("double"))


def number_text(c: Column, digits: int = 8) -> Column:
    """``tolerant_number`` as text of so many significant digits, without zeros at the end; small and large ones with an exponent; blank where there is none."""
    bare = lambda x: F.when(F.contains(x, F.lit(".")), F.regexp_replace(x, r"\.?0+$", "")).otherwise(x)

    def written_out(value: Column, science: Column) -> Column:
        power = F.substring_index(science, "e", -1).cast("int")
        plain = bare(science.cast(f"decimal(38,{digits + 3})").cast("string"))
        return F.when(value.isNull(), "").when(value == 0, "0").when(power.between(-4, digits - 1), plain).otherwise(F.concat(bare(F.regexp_extract(science, "^(.*)e", 1)), F.regexp_extract(science, "(e.*)$", 1)))

    return let(tolerant_number(c), lambda value: let(F.format_string(f"%.{digits - 1}e", value), lambda science: written_out(value, science)))


def species(c: Column) -> Column:
    """Species under their usual names, each once, in a fixed order; others follow as they come. A single usual name, as most are, is not taken apart."""
    known = F.transform(split_flat(F.replace(F.lower(clean(c)), F.lit(";"), F.lit(",")), "[,/]"), lambda x: F.coalesce(literal_map(tables.SPECIES_ALIASES)[x], x))
    order = F.array(*map(F.lit, tables.SPECIES_ORDER))
    rank = lambda x: F.when(F.array_position(order, x) > 0, F.array_position(order, x)).otherwise(len(tables.SPECIES_ORDER) + 1)
    ranked = F.transform(F.array_distinct(known), lambda x, i: F.struct(rank(x).alias("rank"), i.alias("at"), x.alias("name")))
    return F.when(c.isin("", *tables.SPECIES_ORDER), c).otherwise(F.array_join(F.transform(F.array_sort(ranked), lambda x: x["name"]), ", "))


def percent(part: Column, whole: Column) -> Column:
    """One decimal; 0 of nothing."""
    return F.when(whole > 0, F.bround(part / whole * 100, 1)).otherwise(0.0)


def strict_species(c: Column) -> Column:
    """One of the species known, ``other`` or ``unclear``."""
    low = F.replace(F.replace(F.lower(clean(c)), F.lit(" and "), F.lit(", ")), F.lit("/"), F.lit(", "))
    known = species(low)
    return F.when(low.isin("", "unknown", "not specified", "na", "n, a", "unclear"), "unclear").when(known.isin(*tables.STRICT_SPECIES), known).otherwise("other")


def collapse_unspecified(c: Column) -> Column:
    """One wording for factors that aren't given; blank stays blank."""
    return F.when(F.lower(strip(c)).isin(*tables.UNSPECIFIED), F.lit(NOT_SPECIFIED)).otherwise(strip(c))
