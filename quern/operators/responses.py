"""Model responses as tables: work queues, contexts, parsing, and agreement of sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import tables, text

FIELDS = ("source_cell", "target_cell", "factors", "factor_type", "species", "culture_condition", "confidence", "recipe_status", "notes")
ENTRY = f"struct<{','.join(f'{x}:string' for x in FIELDS)}>"
ANSWER = f"struct<has_recipe:boolean,paper_type:string,entries:array<{ENTRY}>>"
SKIPPED = ("failed", "prior_work", "method_only", "enhancer_only")


def work_queue(df: DataFrame, wanted: Column, done: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Records that need a response and have none, in key order; ``limit`` is how many are asked for at once."""
    queue = df.filter(wanted).join(done.select(key), key, "left_anti")
    return queue if limit is None else queue.orderBy(key).limit(limit)


def json_part(raw: Column) -> Column:
    """The JSON of a response: without a code fence, and of other text around it only what lies between the outer braces."""
    return F.regexp_extract(F.coalesce(raw, F.lit("")), r"(?s)(\{.*\})", 1)


def parse(df: DataFrame, raw: str, schema: str = ANSWER) -> DataFrame:
    """``df`` with ``answer`` (null where the text isn't such JSON) and ``parsed``."""
    answer = F.from_json(json_part(F.col(raw)), schema)
    return df.withColumn("answer", answer).withColumn("parsed", F.try_parse_json(json_part(F.col(raw))).isNotNull())


def entries(parsed: DataFrame, key: str) -> DataFrame:
    """A row for each usable entry of answers that have some, with all ``FIELDS``; an unclear status makes it of low confidence and asks for a review.

    A field that the answer leaves out is empty, and a status left out is ``successful``.
    """
    rows = parsed.filter("answer.has_recipe").select(key, F.coalesce("answer.paper_type", F.lit("")).alias("paper_type"), F.explode("answer.entries").alias("e")).select(key, "paper_type", "e.*")
    status = F.trim(F.lower(F.coalesce("recipe_status", F.lit("successful"))))
    rows = rows.withColumns({c: F.coalesce(c, F.lit("")) for c in FIELDS if c != "recipe_status"} | {"recipe_status": status}).filter(~F.col("recipe_status").isin(*SKIPPED))
    unclear = F.col("recipe_status") == "unclear"
    return rows.withColumn("needs_review", unclear).withColumn("confidence", F.when(unclear, "low").otherwise(F.col("confidence")))


def clamp(c: Column, allowed: tuple[str, ...], default: str) -> Column:
    """One of the allowed values, in lower case, else the default."""
    low = F.lower(text.clean(c))
    return F.when(low.isin(*allowed), low).otherwise(default)


#: Values of an adjudication, with what stands for others.
DECISIONS = ("auto_accept", "auto_hide", "auto_merge_duplicate", "needs_manual")
LEVELS = ("high", "medium", "low")


def adjudication(parsed: DataFrame) -> DataFrame:
    """``parsed`` (answer: decision, confidence, assessments, suggestions, reasons) with plain columns of allowed values.

    Unknown decisions are for people, unknown confidence is low, and a suggestion of factors without a known type lowers it. Blank
    assessments are unclear; reasons are cut.
    """
    given = lambda f: text.clean(F.col(f"answer.{f}"))
    kinds = F.filter(text.split_flat(given("suggested_factor_type")), lambda x: x.isin(*tables.FACTOR_TYPES))
    typed = F.array_join(kinds, ", ")
    sure = F.when((given("suggested_factors") != "") & (typed == ""), "low").otherwise(clamp(F.col("answer.confidence"), LEVELS, "low"))
    assessed = {f: F.when(given(f) == "", "unclear").otherwise(F.lower(given(f))) for f in ("recipe_valid", "factor_assessment", "cell_assessment", "duplicate_assessment")}
    return parsed.withColumns(assessed | {
        "decision": clamp(F.col("answer.decision"), DECISIONS, "needs_manual"), "confidence": sure, "suggested_factors": given("suggested_factors"), "suggested_factor_type": typed,
        "manual_reason": text.truncate(given("manual_reason"), 160), "rationale": text.truncate(given("rationale"), 240),
    })


def context(**fields: Column) -> Column:
    """Labelled lines of a prompt, blank fields left out."""
    lines = F.array(*[F.when(text.clean(c) != "", F.concat(F.lit(f"{name}: "), c)) for name, c in fields.items()])
    return F.array_join(F.array_compact(lines), "\n")


def excerpt(body: Column, keywords: list[str], k: int, limit: int) -> Column:
    """The ``k`` sentences with most keywords (ties: earlier ones), in the order of the text, cut to ``limit`` characters.

    Sentences without a keyword aren't taken.
    """
    sentences = F.filter(F.split(F.coalesce(body, F.lit("")), r"(?<=[.!?])\s+"), lambda s: s != "")
    score = lambda s: sum((F.contains(F.lower(s), F.lit(w.lower())).cast("int") for w in keywords), F.lit(0))
    scored = F.transform(sentences, lambda s, i: F.struct((-score(s)).alias("less"), i.alias("at"), s.alias("s")))
    best = F.slice(F.array_sort(F.filter(scored, lambda x: x["less"] < 0)), 1, k)
    ordered = F.array_sort(F.transform(best, lambda x: F.struct(x["at"].alias("at"), x["s"].alias("s"))))
    return F.left(F.array_join(F.transform(ordered, lambda x: x["s"]), " "), F.lit(limit))


def keywords(name: Column, stop: tuple[str, ...], most: int = 8) -> Column:
    """The first distinct words of a name that say something."""
    words = F.regexp_extract_all(F.lower(F.coalesce(name, F.lit(""))), F.lit(r"[a-z0-9]{3,}"), 0)
    return F.slice(F.array_distinct(F.filter(words, lambda w: ~w.isin(*stop))), 1, most)


def peers(df: DataFrame, group: str, shown: Column, most: int = 10) -> DataFrame:
    """(row_id, peers): for each row up to ``most`` rows of its group, listed in row order.

    Spark keeps a group's first rows in each task before it shuffles, so a large group is never listed whole.
    """
    rows = df.select(group, "row_id", shown.alias("shown"))
    place = F.row_number().over(Window.partitionBy(group).orderBy("row_id"))
    first = rows.withColumn("n", place).filter(F.col("n") <= most).groupBy(group).agg(F.array_sort(F.collect_list(F.struct("row_id", "shown"))).alias("rows"))
    listed = first.select(group, F.array_join(F.transform("rows", lambda x: x["shown"]), "\n").alias("peers"))
    return rows.join(listed, group).select("row_id", "peers")


def source_agreement(df: DataFrame, key: str, source: str, value: Column, sources: list[str]) -> DataFrame:
    """(key, a column for each source, agree)."""
    given = df.select(key, source, value.alias("__v"))
    wide = given.groupBy(key).pivot(source, sources).agg(F.min("__v"))
    distinct = F.count_distinct(F.when(F.col("__v") != "", F.col("__v")))
    agree = given.groupBy(key).agg(F.when(distinct == 0, "n/a").when(distinct == 1, "yes").otherwise("no").alias("agree"))
    return wide.join(agree, key)


def field_agreement(df: DataFrame, key: str, fields: dict[str, Column], sets: dict[str, Column]) -> DataFrame:
    """(key, is_recipe_agree, ``<name>_agree``): whether several models' answers (is_recipe, error) to one record agree, in all and field by field.

    Answers with an error don't count. Of those with a recipe, ``fields`` agree if all that are given are the same, ``sets`` if all are, blank ones
    too; with fewer than two recipes there is nothing to compare, unless the only one is given.
    """
    recipe = F.coalesce(F.col("is_recipe"), F.lit(False))
    sound = F.coalesce(F.col("error"), F.lit("")) == ""
    # The least and the greatest are the same if all are: one row a record is shuffled, not one for each distinct answer to each field.
    same = lambda c: F.coalesce(F.min(c) == F.max(c), F.lit(False))
    said = same(F.when(sound, F.coalesce(F.col("is_recipe").cast("int"), F.lit(2))))
    recipes = F.count_if(recipe)

    def agree(value: Column, given: bool) -> Column:
        shown = F.coalesce(value, F.lit(""))
        one = same(F.when(recipe & ((shown != "") if given else F.lit(True)), shown))
        return F.when(one & (recipes > 0), "yes").when(recipes < 2, "n/a").otherwise("no")

    made = [agree(c, True).alias(f"{n}_agree") for n, c in fields.items()] + [agree(c, False).alias(f"{n}_agree") for n, c in sets.items()]
    return df.groupBy(key).agg(F.when(said, "yes").otherwise("no").alias("is_recipe_agree"), *made)


def agreement_totals(agreed: DataFrame) -> DataFrame:
    """(field, value, n): how often each field is agreed on."""
    columns = [c for c in agreed.columns if c.endswith("_agree")]
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in columns]))
    return agreed.select(each.alias("x")).groupBy("x.field", "x.value").agg(F.count(F.lit(1)).alias("n"))


def long_enough(c: Column, least: int = 50) -> Column:
    """Whether there is text to ask about."""
    return F.length(text.clean(c)) >= least


def split_answers(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose answer has records, the others); an answer that can't be read has none."""
    has = F.coalesce(F.col("answer.has_recipe"), F.lit(False))
    return parsed.filter(has), parsed.filter(~has)


def merged_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """``df`` with each field of its answer over its own, where the answer has one."""
    return df.withColumns({f: F.coalesce(F.when(text.clean(F.col(f"answer.{f}")) != "", F.col(f"answer.{f}")), F.col(f)) for f in fields})
