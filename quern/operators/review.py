"""What people should look at: citation back-checks, audit risks, and facet options."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import tables
from quern.operators import rules
from quern.operators.joins import membership
from quern.operators.rules import flags


def back_check(edges: DataFrame, master: DataFrame, papers: DataFrame, key: str = "pmid") -> DataFrame:
    """``edges`` (key, title, publication_types) with flags and ``priority``: high for a paper on the topic that neither table knows, medium if it is like a review."""
    known = membership(edges, key, {"in_master": master, "in_papers": papers})
    on_topic, review = F.col("title").rlike("(?i)" + tables.ON_TOPIC), F.col("title").rlike("(?i)" + tables.REVIEW_LIKE) | F.col("publication_types").rlike("(?i)Review|Meta-Analysis")
    missing = (F.col(key) != "") & ~F.col("in_master") & ~F.col("in_papers")
    priority = F.when(missing & on_topic & ~review, "high").when(missing & on_topic, "medium").otherwise("low")
    return known.withColumns({"title_hit": on_topic, "review_like": review, "missing": missing, "priority": priority})


def audit_risks() -> Column:
    """The reasons to audit a decision that was made by itself, joined."""
    is_ = lambda d: F.col("model_decision") == d
    sure, focus, shown = F.col("model_confidence") == "high", F.col("focused") == "yes", F.col("default_visible") == "yes"
    found = flags(
        auto_accept_not_high=is_("auto_accept") & ~sure, auto_accept_has_issue_flags=is_("auto_accept") & (F.col("issue_flags") != ""), auto_accept_focused=is_("auto_accept") & focus,
        auto_hide_default_visible=is_("auto_hide") & shown, auto_hide_focused=is_("auto_hide") & focus, auto_hide_not_high=is_("auto_hide") & ~sure,
        auto_merge_focused=is_("auto_merge_duplicate") & focus, auto_merge_not_high=is_("auto_merge_duplicate") & ~sure,
    )
    return F.array_join(found, "; ")


def options(df: DataFrame, column: str, preferred: list[str]) -> DataFrame:
    """(value, place): the values that there are, preferred ones first in their order, then the rest by name."""
    place = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, preferred)), F.col("value")), F.lit(0)), F.lit(999)) if preferred else F.lit(999)
    return df.select(F.col(column).alias("value")).filter("value <> ''").distinct().withColumn("place", place.cast("int")).orderBy("place", "value")


#: Fields of an answer, with what stands for them where there is none.
ANSWERED = {"model_decision": "pending", "model_confidence": "", "manual_reason": "not yet adjudicated", "model_rationale": "", "duplicate_assessment": ""}


def adjudication_table(df: DataFrame, answers: DataFrame, key: str) -> DataFrame:
    """``df`` with the answer to each record, if any, who should decide, and how its state looks: visibility, topic, priority and flags.

    A record without an answer is pending, and for people to decide.
    """
    held = answers.select(key, *ANSWERED).withColumn("__answered", F.lit(True))
    joined = df.join(held, key, "left").withColumns({c: F.coalesce(c, F.lit(v)) for c, v in ANSWERED.items()})
    yes = lambda c: F.when(c, "yes").otherwise("no")
    made = {
        "manual_recommended": F.when(F.col("__answered"), rules.manual_recommended()).otherwise("yes"),
        "review_priority": rules.review_priority(),
        "default_visible": yes(rules.visible()),
        "topic_focused": yes(rules.on_topic(tables.T_CELL, False)),
        "issue_flags": F.array_join(rules.issue_flags(), "; "),
    }
    return joined.withColumns(made).drop("__answered")


def adjudication_order() -> list:
    """Records for people first, then by confidence of the model, priority and topic."""
    return [F.desc("manual_recommended"), F.asc("model_confidence"), F.desc("review_priority"), F.desc("topic_focused")]


def known_issues(df: DataFrame, notes: DataFrame, key: str) -> DataFrame:
    """The records that ``notes`` (key, known_issue_note) names, each with its note in front."""
    return notes.select(key, "known_issue_note").join(df, key).select("known_issue_note", *df.columns)
