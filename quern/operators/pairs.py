"""Pairs of binder and target sequences: normalise, check, collapse, split, sample and measure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import tables, text
from quern.operators.duplicates import collapse_pairs
from quern.operators.graph import written
from quern.operators.rules import flags
from quern.operators.sampling import equal_allocation


def binder_label(c: Column) -> Column:
    low = F.lower(text.clean(c))
    return F.when(low.isin(*tables.BINDER_WORDS), "binder").when(low.isin(*tables.NON_BINDER_WORDS), "non-binder").otherwise("unclear")


def binder_type(design: Column, fallback: Column) -> Column:
    return text.first_found(F.lower(F.concat_ws(" ", text.clean(design), text.clean(fallback))), tables.BINDER_TYPES, F.lit("other"))


#: Flags that make a pair of low confidence.
BROKEN = ("missing_binder_sequence", "missing_target_sequence", "invalid_binder_sequence", "invalid_target_sequence")


def checked(df: DataFrame) -> DataFrame:
    """``df`` (binder_sequence, target_sequence, interaction_label, confidence) with sequences cleaned, ``qa_flags``, ``confidence``, ``needs_review`` and ``sequence_pair_key``."""
    clean = df.withColumns({c: text.sequence(F.col(c)) for c in ("binder_sequence", "target_sequence")})
    b, t = F.col("binder_sequence"), F.col("target_sequence")
    found = flags(
        missing_binder_sequence=b == "", missing_target_sequence=t == "", invalid_binder_sequence=(b != "") & ~text.valid_sequence(b),
        invalid_target_sequence=(t != "") & ~text.valid_sequence(t), unclear_interaction_label=F.col("interaction_label") == "unclear",
        binder_sequence_too_short=(b != "") & (F.length(b) < 5), target_sequence_too_short=(t != "") & (F.length(t) < 5),
    )
    flagged = clean.withColumn("__flags", found)
    broken = F.arrays_overlap("__flags", F.array(*map(F.lit, BROKEN)))
    unclear = F.col("interaction_label") == "unclear"
    return flagged.withColumns({
        "qa_flags": F.array_join("__flags", ";"), "confidence": F.when(broken, "low").when(unclear, "medium").otherwise(F.col("confidence")),
        "needs_review": broken | unclear, "sequence_pair_key": text.pair_key(b, t),
    }).drop("__flags")


#: Columns of a normalised pair, in order, behind ``row_id`` and ``source_rank``.
COLUMNS = (
    *("source_type", "binder_name", "binder_type", "binder_sequence", "target_name", "target_sequence", "interaction_label", "affinity_value", "affinity_unit"),
    *("evidence_text", "source_reference", "confidence", "needs_review", "source_id", "design_class", "qa_flags", "duplicate_group_id", "sequence_pair_key"),
)


def target_name(c: Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.trim(F.regexp_replace(F.lower(text.clean(c)), "[^a-z0-9]+", " "))


def _given(c: Column) -> Column:
    return F.when(c == "", "not reported").otherwise(c)


def _normalised(df: DataFrame, source: str, rank: int, flagged: dict[str, Column], **made: Column) -> DataFrame:
    rows = df.select("row_id", F.lit(rank).alias("source_rank"), F.lit(source).alias("source_type"), F.lit("").alias("duplicate_group_id"), *[c.alias(n) for n, c in made.items()], flags(**flagged).alias("__before"))
    out = checked(rows)
    return out.withColumn("qa_flags", F.array_join(F.concat("__before", F.filter(F.split("qa_flags", ";"), lambda x: x != "")), ";")).select("row_id", "source_rank", *COLUMNS)


def from_designs(raw: DataFrame, source: str = "designs") -> DataFrame:
    """Rows of a table of designed binders (design_id, binder_name, binder_sequence, target, target_sequence, label, binding_strength, value, design_class) as normalised pairs.

    Their affinities have no unit, which is flagged, as is one that had to be read out of a text.
    """
    c = lambda n: text.clean(F.col(n))
    raw, affinity = raw.withColumn("__affinity", text.number_text(F.col("value"))), F.col("__affinity")
    flagged = {"affinity_parse_from_text": (affinity != "") & c("value").try_cast("double").isNull(), "affinity_unit_unverified": affinity != ""}
    said = F.concat(F.lit("Strength: "), _given(c("binding_strength")), F.lit(" | label: "), _given(c("label")), F.lit(" | class: "), _given(c("design_class")))
    return _normalised(
        raw, source, 0, flagged,
        binder_name=F.when(c("binder_name") == "", c("design_id")).otherwise(c("binder_name")), binder_type=binder_type(F.col("design_class"), F.col("binder_name")), binder_sequence=F.col("binder_sequence"),
        target_name=target_name(F.col("target")), target_sequence=F.col("target_sequence"), interaction_label=binder_label(F.col("label")), affinity_value=affinity,
        affinity_unit=F.when(affinity != "", "source_KD").otherwise(""), evidence_text=said, source_reference=c("design_id"), confidence=F.lit("high"), source_id=c("design_id"), design_class=c("design_class"),
    )


def from_literature(raw: DataFrame, source: str = "literature") -> DataFrame:
    """Rows of a table of published binders (binder_id, binder_sequence, target, target_sequence, label, binding_affinity_nm, source_publication) as normalised pairs."""
    c = lambda n: text.clean(F.col(n))
    raw, affinity = raw.withColumn("__affinity", text.number_text(F.col("binding_affinity_nm"))), F.col("__affinity")
    said = F.concat(F.lit("Label by the authors: "), _given(c("label")), F.lit(" | published in: "), _given(c("source_publication")))
    return _normalised(
        raw, source, 1, {"none": F.lit(False)},
        binder_name=c("binder_id"), binder_type=binder_type(F.lit(""), F.concat_ws(" ", c("source_publication"), c("binder_id"))), binder_sequence=F.col("binder_sequence"),
        target_name=target_name(F.col("target")), target_sequence=F.col("target_sequence"), interaction_label=binder_label(F.col("label")), affinity_value=affinity,
        affinity_unit=F.when(affinity != "", "nM").otherwise(""), evidence_text=said, source_reference=c("source_publication"), confidence=F.lit("medium"), source_id=c("binder_id"), design_class=F.lit(""),
    )


def resolved(df: DataFrame) -> DataFrame:
    """One row for each pair of sequences: the best by source, label and names, with the references of all in that order.

    A label that the group decides otherwise than the best row lowers confidence and asks for review; both that and the
    collapse are flagged.
    """
    source = F.when(F.col("source_rank").isNull(), 9).otherwise(F.col("source_rank"))
    label = F.when(F.col("interaction_label") == "binder", 0).when(F.col("interaction_label") == "non-binder", 1).otherwise(2)
    names = [F.col(c) for c in ("target_name", "binder_name") if c in df.columns]
    one = collapse_pairs(df.withColumn("__own", F.col("interaction_label")), "sequence_pair_key", "interaction_label", [source, label, *names], "source_reference", "; ")
    other = F.col("interaction_label") != F.col("__own")
    more = F.concat(F.when(F.col("removed") > 0, F.array(F.lit("duplicate_sequence_pair_collapsed"))).otherwise(F.array().cast("array<string>")), F.when(other, F.array(F.lit("conflicting_duplicate_labels"))).otherwise(F.array().cast("array<string>")))
    out = one.withColumns({
        "qa_flags": F.array_join(F.concat(F.filter(F.split("qa_flags", ";"), lambda x: x != ""), more), ";"),
        "confidence": F.when(other, "medium").otherwise(F.col("confidence")), "needs_review": other | F.col("needs_review"), "conflict": other,
    })
    if "duplicate_group_id" in df.columns:
        out = out.withColumn("duplicate_group_id", F.when(F.col("removed") > 0, F.concat(F.lit("seqpair_"), "sequence_pair_key")).otherwise(F.col("duplicate_group_id")))
    return out.drop("__own")


def pilot_tracks(designs: DataFrame, literature: DataFrame, most: int, seed: int = 1) -> dict[str, DataFrame]:
    """The pilot table of each track: both sources normalised, in one table, split by type of binder, collapsed and sampled."""
    # A sample reads its pairs several times: the sources are normalised once, and each track is collapsed once.
    made = tracks(written(from_designs(designs).unionByName(from_literature(literature)), "pairs"))
    return {name: pilot(written(resolved(rows), "resolved"), most, seed) for name, rows in zip(("designed", "antibody"), made, strict=True)}


def tracks(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(designed binders, antibodies)."""
    return df.filter(track() == "designed"), df.filter(track() == "antibody")


def track() -> Column:
    """The track of a pair by its type of binder; null has none."""
    antibody = F.col("binder_type").isin(*tables.ANTIBODY_TYPES)
    return F.when(antibody, "antibody").when(~antibody, "designed")


def track_metrics(df: DataFrame, *by: Column) -> DataFrame:
    """One row (or one for each ``by``): how many pairs are whole, valid and under review, in numbers and percentages; and how many have an affinity, where there is one."""
    b, t = F.col("binder_sequence"), F.col("target_sequence")
    n = F.count(F.lit(1))
    valid, both, review = F.count_if(text.valid_sequence(b) & text.valid_sequence(t)), F.count_if((b != "") & (t != "")), F.count_if(F.col("needs_review"))
    share = lambda c: text.percent(c, n)
    parsed = [] if "affinity_value" not in df.columns else [F.count_if(F.trim("affinity_value") != "")]
    parsed = [x for p in parsed for x in (p.alias("affinity_rows"), share(p).alias("affinity_pct"))]
    return df.groupBy(*by).agg(n.alias("rows"), valid.alias("valid_rows"), share(valid).alias("valid_pct"), both.alias("both_rows"), share(both).alias("both_pct"), review.alias("review_rows"), share(review).alias("review_pct"), *parsed)


def track_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field, value, n): how often each value of each column occurs."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns]))
    return df.select(each.alias("x")).groupBy("x.field", "x.value").agg(F.count(F.lit(1)).alias("n"))


def pilot(df: DataFrame, most: int, seed: int = 1) -> DataFrame:
    """At most ``most`` pairs, equally many of each source, label and type where there are enough."""
    stratum = F.concat_ws("|", F.coalesce(F.col("source_rank").cast("string"), F.lit("")), "interaction_label", "binder_type")
    return equal_allocation(df.withColumn("__stratum", stratum), "__stratum", most, seed, "sequence_pair_key").drop("__stratum")
