"""Quality rules as a bitmask ledger: measure once, decide by policy, compare policies by bit arithmetic."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.base import SPACE_CHARS, SPACES, stage, window_hashes

WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``fails`` is evaluated over the measurements; ``bit`` is the rule's place in the ledger for good."""

    bit: int
    name: str
    fails: Column = field(compare=False)


def rules() -> list[Rule]:
    """The rules of the ledger. Bits are never given to another rule."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return [
        Rule(0, "few_words", F.col("n_words") < 20),
        Rule(1, "repeated_windows", 100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
        Rule(2, "symbols", 10 * F.col("n_symbols") > F.col("n_words")),
        Rule(3, "short_words", F.col("word_chars") < 2 * words),
        Rule(4, "long_words", F.col("word_chars") > 15 * words),
        Rule(5, "repeated_lines", (F.col("n_dup_lines") >= 3) & (10 * F.col("n_dup_lines") > 3 * F.col("n_lines"))),
        Rule(6, "few_letters", F.col("n_letters") * 5 < F.col("word_chars") * 3),
        Rule(7, "one_line_of_many_words", (F.col("n_lines") <= 1) & (F.col("n_words") > 10_000)),
    ]


#: Policies by version: the rules that each enforces.
POLICIES = {
    "v1": ("few_words", "repeated_windows"),
    "v2": ("few_words", "repeated_windows", "symbols", "short_words", "long_words", "repeated_lines", "few_letters"),
}
CURRENT = "v2"
#: Rules of the published base verdict.
BASE = ("few_words", "repeated_windows")


def mask(names) -> int:
    """The bits of the rules named."""
    bits = {r.name: r.bit for r in rules()}
    return sum(1 << bits[n] for n in names)


def measure(docs: DataFrame, carry: Sequence[Column] = ()) -> DataFrame:
    """``doc_id`` with the measurements that the rules read, by SQL functions alone. Columns in ``carry`` come along."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(F.col("text"), SPACES), lambda w: w != "")
    lines = F.filter(F.split(F.col("text"), "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *carry)
    more = base.columns[2:]
    split = base.withColumns({"words": words, "lines": lines})
    counted = split.select(
        "doc_id",
        *more,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("text", r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("words") > WINDOW, window_hashes(F.col("words"), WINDOW)).otherwise(F.array().cast("array<long>")).alias("windows"),
    )
    flagged = counted.withColumn("repeats", F.size("windows") > F.size(F.array_distinct("windows")))
    placed = flagged.withColumn("placed", F.when(F.col("repeats"), F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))))
    same = lambda x, k, step: F.coalesce(F.get(F.col("placed"), k + step)["h"] == x["h"], F.lit(False))
    found = placed.withColumn("starts", F.when(F.col("repeats"), F.sort_array(F.transform(F.filter("placed", lambda x, k: same(x, k, -1) | same(x, k, 1)), lambda x: x["at"]))))
    steps = F.zip_with(F.slice("starts", 2, F.size("starts")), F.slice("starts", 1, F.size("starts") - 1), lambda b, a: F.least(b - a, F.lit(WINDOW)))
    covered = F.when(F.col("repeats"), F.aggregate(steps, F.lit(WINDOW), lambda total, x: total + x)).otherwise(0).cast("long")
    return found.withColumn("n_repeat_words", covered).drop("windows", "repeats", "placed", "starts")


def ledger(docs: DataFrame, carry: Sequence[Column] = ()) -> DataFrame:
    """One row for each row of ``docs``: doc_id, the measurements, and ``failed``, a bit for each rule that fails.

    A null or empty text has no words and fails ``few_words``. Repeated rows each get their row.
    """
    bits = sum((F.when(r.fails, F.lit(1 << r.bit)).otherwise(0) for r in rules()), F.lit(0))
    made = measure(docs, carry).withColumn("failed", bits.cast("long"))
    # One generated row each: a filter on the ledger then stays above it, where it would otherwise measure once more for each rule.
    return made.select(F.explode(F.array(F.struct(*made.columns))).alias("__m")).select("__m.*")


def stored(docs: DataFrame) -> DataFrame:
    """The ledger, written to the shared folder: every policy and every ablation reads it, and nothing is measured again."""
    return stage(ledger(docs), "ledger")


def keeps(policy: str = CURRENT) -> Column:
    """Whether a ledger row passes every rule that ``policy`` enforces."""
    return F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def ablations(ledger_: DataFrame, policy: str = CURRENT) -> DataFrame:
    """(rule, n_failed, n_only): how many rows each rule of ``policy`` rejects, and how many it alone rejects.

    Rows are first counted by bitmask, so at most a few hundred rows are aggregated further.
    """
    enforced = mask(POLICIES[policy])
    counts = ledger_.groupBy(F.col("failed").bitwiseAND(F.lit(enforced)).alias("bits")).count()
    mine = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in rules() if r.name in POLICIES[policy]]))
    each = counts.withColumn("r", mine)
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return each.groupBy(F.col("r.rule").alias("rule")).agg(F.sum(F.when(hit, F.col("count")).otherwise(0)).alias("n_failed"), F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("count")).otherwise(0)).alias("n_only"))


def filter_by(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The rows of ``docs`` that ``policy`` keeps, with all their columns; the row travels through the ledger, so no join is needed."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    return ledger(docs, [whole]).filter(keeps(policy)).select("__row.*")
