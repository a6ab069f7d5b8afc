"""Counts, metrics, votes and agreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import text


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, n), most frequent first, then by value; blank is a value."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value")


def item_counts(df: DataFrame, column: str) -> DataFrame:
    """(item, n) over the items of a list in a cell."""
    return df.select(F.explode(text.split_flat(F.col(column))).alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, year: str) -> DataFrame:
    """(year, n) for every year from the first to the last, with zero where there is none; unknown years don't count."""
    known = df.select(text.number(F.col(year), 0).alias("year")).filter("year > 0")
    counts = known.groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    span = counts.agg(F.min("year").alias("a"), F.max("year").alias("b")).filter("a is not null")
    every = span.select(F.explode(F.sequence("a", "b")).alias("year"))
    return every.join(counts, "year", "left").select("year", F.coalesce("n", F.lit(0)).alias("n"))


def header(df: DataFrame) -> DataFrame:
    """One row: records left after broad and exact merging, all records, first and last known year."""
    year = text.number(F.col("year"), 0)
    return df.agg(
        F.count_if(~F.col("is_broad_duplicate")).alias("broad_unique"),
        F.count_if(~F.col("is_duplicate")).alias("exact_unique"),
        F.count(F.lit(1)).alias("raw"),
        F.min(F.when(year > 0, year)).alias("first_year"),
        F.max(F.when(year > 0, year)).alias("last_year"),
    )


def composition(df: DataFrame, column: str) -> DataFrame:
    """One row of disjoint counts: only TF labels, only small-molecule labels, both, and the rest (blank too)."""
    labels = F.transform(text.split_flat(F.col(column)), F.lower)
    tf = lambda x: x.isin("tf", "transcription_factor", "transcription factor")
    small = lambda x: F.contains(x, F.lit("small")) | x.isin("chemical", "compound")
    some = F.size(labels) > 0
    kind = F.when(some & F.forall(labels, tf), "tf").when(some & F.forall(labels, small), "small").when(F.exists(labels, tf) & F.exists(labels, small), "mixed").otherwise("other")
    kinds = df.select(kind.alias("kind"))
    return kinds.agg(*[F.count_if(F.col("kind") == k).alias(f"{k}_only" if k in ("tf", "small") else k) for k in ("tf", "small", "mixed", "other")])


def metrics(df: DataFrame, source: str, target: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("records"), F.countDistinct("pmid").alias("papers"), F.countDistinct(target).alias("targets"), F.countDistinct(source).alias("sources"))


def papers_represented(df: DataFrame, column: str) -> DataFrame:
    """One row: distinct ids over the lists in a column."""
    return df.select(F.explode(text.split_flat(F.col(column))).alias("id")).agg(F.countDistinct("id").alias("papers"))


def group_summary(df: DataFrame, key: str, first: str, listed: str, limit: int = 8) -> DataFrame:
    """For each key: the first row's value, how many rows, and the first distinct values of ``listed`` in row order.

    Values are made distinct with their first place, and only the first ``limit`` of a key are collected.
    """
    heads = df.groupBy(key).agg(F.min_by(first, "row_id").alias(first), F.count(F.lit(1)).alias("n"))
    places = df.groupBy(key, listed).agg(F.min("row_id").alias("at"))
    first_ones = places.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy("at", listed))).filter(F.col("__n") <= limit)
    lists = first_ones.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__n", listed))), lambda x: x[listed]), "; ").alias(listed))
    return heads.join(lists, key)


def category_sums(df: DataFrame, category: str, measure: str) -> DataFrame:
    return df.groupBy(category).agg(F.sum(measure).alias("total")).orderBy(F.desc("total"), category)


def majority(df: DataFrame, key: str, value: Column) -> DataFrame:
    """(key, majority) where one value is most frequent alone; blank values don't vote."""
    votes = df.select(key, value.alias("v")).filter("v <> ''").groupBy(key, "v").agg(F.count(F.lit(1)).alias("n"))
    # Of the values with most votes the first and the last are the same only if there is one.
    ends = votes.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("less"), "v")).alias("first"), F.max(F.struct("n", "v")).alias("last"))
    return ends.filter("first.v = last.v").select(key, F.col("first.v").alias("majority"))


def agreement(df: DataFrame, key: str, value: Column) -> DataFrame:
    """(key, agree): yes if all values of a key are one, no if they differ, n/a if none is known."""
    distinct = F.count_distinct(F.when(value != "", value))
    return df.groupBy(key).agg(F.when(distinct == 0, "n/a").when(distinct == 1, "yes").otherwise("no").alias("agree"))


def validation_scores(df: DataFrame, strata: list[str]) -> DataFrame:
    """Precision of judged records, overall and for each value of each stratum: label, n, yes, partial, no, unclear, and two percentages.

    Blank judgements don't count; unclear ones count in n alone.
    """
    judged = df.filter("recipe_valid <> ''")
    label = F.expr("case " + " ".join(f"when grouping({s}) = 0 then concat('{s}=', if({s} = '', 'blank', {s}))" for s in strata) + " else 'overall' end")
    n = lambda v: F.count_if(F.col("recipe_valid") == v).alias(v)
    sets = judged.groupingSets([[], *[[s] for s in strata]], *strata).agg(label.alias("label"), F.count(F.lit(1)).alias("n"), n("yes"), n("partial"), n("no"), n("unclear"))
    return sets.select("label", "n", "yes", "partial", "no", "unclear", text.percent(F.col("yes"), F.col("n")).alias("strict_pct"), text.percent(F.col("yes") + F.col("partial"), F.col("n")).alias("relaxed_pct"))


def component_accuracy(df: DataFrame, components: list[str]) -> DataFrame:
    """(component, n, strict_pct, relaxed_pct) over answers that aren't blank."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("component"), F.col(c).alias("answer")) for c in components])).alias("x")).select("x.*").filter("answer <> ''")
    yes, n = F.count_if(F.col("answer") == "yes"), F.count(F.lit(1))
    return long.groupBy("component").agg(n.alias("n"), text.percent(yes, n).alias("strict_pct"), text.percent(yes + F.count_if(F.col("answer") == "partial"), n).alias("relaxed_pct"))


def changes(df: DataFrame, old: str, new: str) -> DataFrame:
    """(old, new, n): which values became which."""
    return df.filter(F.col(old) != F.col(new)).groupBy(F.col(old).alias("old"), F.col(new).alias("new")).agg(F.count(F.lit(1)).alias("n"))


def with_group_size(df: DataFrame, key: str, name: str = "group_size") -> DataFrame:
    """``df`` with the number of rows of each key, by an aggregate and a join."""
    return df.join(df.groupBy(key).agg(F.count(F.lit(1)).alias(name)), key)


def pass_report(df: DataFrame, method: str, column: str) -> DataFrame:
    """(method, n) of how values were got, and how many are still blank."""
    how = F.when(text.clean(F.col(column)) == "", "blank").when(F.col(method) == "", "unknown").otherwise(F.col(method))
    return df.groupBy(how.alias("method")).agg(F.count(F.lit(1)).alias("n"))


def proposal_counts(df: DataFrame) -> DataFrame:
    """One row: proposals by what their action says, and writes that are left, by risk."""
    action, writes = F.col("proposed_action"), F.col("proposed_updates") != "{}"
    says = lambda p: F.count_if(action.rlike(p))
    left = {f"{r}_risk_writes": F.count_if((F.col("write_risk") == r) & writes) for r in ("low", "medium", "high")}
    made = {
        "rows": F.count(F.lit(1)), "manual": F.count_if(action == "manual_review_required"), "hides": says("hide"), "merges": says("confirm_broad_duplicate"),
        "accepts": says("accept_no_change"), "cleanups": says("accept_cleanup"), **left, "confirmed": F.count_if((F.col("write_risk") == "low") & ~writes & (action != "accept_no_change")),
    }
    return df.agg(*[c.alias(n) for n, c in made.items()])


def proposal_summary(df: DataFrame) -> DataFrame:
    """(write_risk, updates, n): proposals by risk and whether they would change something."""
    return df.groupBy("write_risk", (F.col("proposed_updates") != "{}").alias("updates")).agg(F.count(F.lit(1)).alias("n"))
