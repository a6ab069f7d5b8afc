"""Auditable updates: patches, gated fills, multi-pass imputation, and previews of what a writer would change."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import tables, text
from quern.operators.aggregates import majority
from quern.operators.graph import written
from quern.operators.rules import species_in_names, species_in_text
from quern.operators.schema import ensure_columns
from quern.sources.manifest import Versions, current, write_version


def preview(old: DataFrame, new: DataFrame, fields: list[str], key: str = "row_id") -> DataFrame:
    """(key, field, before, after): every field that an update would change."""
    pairs = [F.struct(F.lit(f).alias("field"), F.col(f"o.{f}").cast("string").alias("before"), F.col(f"n.{f}").cast("string").alias("after")) for f in fields]
    both = old.alias("o").join(new.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"))
    long = both.select(F.col(f"o.{key}").alias(key), F.explode(F.array(*pairs)).alias("x")).select(key, "x.*")
    return long.filter(~F.col("before").eqNullSafe(F.col("after")))


def patch(df: DataFrame, patches: DataFrame, keys: list[str], fields: list[str], note_field: str = "validation_notes", order: str = "no") -> DataFrame:
    """``df`` under a table of patches: for each selector, later values win and all notes are appended in order.

    ``patches`` has ``keys``, ``order``, a column for each field (blank: leave) and ``note``.
    """
    merged = patches.groupBy(*keys).agg(
        *[F.max_by(F.when(F.col(f) != "", F.col(f)), F.when(F.col(f) != "", F.col(order))).alias(f"__{f}") for f in fields],
        F.transform(F.array_sort(F.collect_list(F.struct(order, "note"))), lambda x: x["note"]).alias("__notes"),
    )
    notes = F.aggregate(F.coalesce("__notes", F.array().cast("array<string>")), F.coalesce(note_field, F.lit("")), lambda held, n: text.append_note(held, n))
    joined = df.join(merged, keys, "left").withColumn(note_field, notes)
    return joined.withColumns({f: F.coalesce(f"__{f}", f) for f in fields}).drop("__notes", *[f"__{f}" for f in fields])


def unmatched_patches(df: DataFrame, patches: DataFrame, keys: list[str], unique: bool = False) -> DataFrame:
    """Patches whose selector fits no record, or with ``unique`` not exactly one; a caller stops if there are any."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("records"))
    found = patches.join(sizes, keys, "left").withColumn("records", F.coalesce("records", F.lit(0)))
    return found.filter("records <> 1" if unique else "records = 0")


def must_match(df: DataFrame, patches: DataFrame, keys: list[str], unique: bool = False) -> DataFrame:
    """The patches; the job that reads them fails if a selector fits no record, or with ``unique`` not exactly one."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__records"))
    n = F.coalesce("__records", F.lit(0))
    wrong = (n != 1) if unique else (n == 0)
    stop = F.raise_error(F.concat_ws(" ", F.lit("records of"), *[F.col(k).cast("string") for k in keys], F.lit(":"), n.cast("string")))
    return patches.join(sizes, keys, "left").filter(F.when(wrong, stop.cast("boolean")).otherwise(True)).select(patches.columns)


def close_out(df: DataFrame, decided: tuple[str, ...], default: str = "resolved_by_action") -> DataFrame:
    """Decided actions need no review unless their resolution says so; a blank resolution gets a default."""
    done = F.col("validation_action").isin(*decided) & ~F.contains("validation_resolution", F.lit("needs_review"))
    blank = text.clean(F.col("validation_resolution")) == ""
    return df.withColumns({"validation_needs_review": F.when(done, "False").otherwise(F.col("validation_needs_review")), "validation_resolution": F.when(done & blank, default).otherwise(F.col("validation_resolution"))})


def proposals(df: DataFrame) -> DataFrame:
    """``df`` with ``proposed_action``, ``write_risk``, ``proposed_updates`` (JSON) and ``proposal_notes`` for a model's decision on a record.

    Reads model_decision, model_confidence, model_rationale, manual_recommended, manual_reason, default_visible and the record's
    current state. Every part of a decision is an action of its own; risk is that of the riskiest. What people must look at changes nothing.
    """
    c = lambda name: text.clean(F.col(name))
    manual = c("manual_recommended") == "yes"
    is_ = lambda d: ~manual & (c("model_decision") == d)
    current = c("validation_action")
    hide, merge, accept = is_("auto_hide"), is_("auto_merge_duplicate"), is_("auto_accept")
    hidden_already, hide_again = hide & (current == "hide_model_adjudicated"), hide & current.isin("hide_incomplete_recipe", "remove")
    hide_writes = hide & ~hidden_already
    merged = text.is_true(F.col("is_broad_duplicate"))
    merge_note = F.concat(F.lit("Model confirmed merge ("), c("model_confidence"), F.lit("): "), c("model_rationale"))
    stale = accept & current.isin("hide_incomplete_recipe", "remove", "fix")
    review = accept & text.is_true(F.col("validation_needs_review"))
    single = accept & (c("single_tf_status") == "unclear") & (text.item_count(F.col("factors")) == 1)
    kept_duplicate = accept & merged
    nothing = accept & ~stale & ~review & ~single & ~kept_duplicate
    pending = manual | ~(hide | merge | accept)
    notes = tables.PROPOSAL_NOTES
    parts = [  # condition, action, note
        (hidden_already, "confirm_existing_hide", notes["hidden_already"]),
        (hide_again, "confirm_existing_hide", notes["hide_again"]),
        (hide_writes & ~hide_again, "hide_model_adjudicated", notes["hide"]),
        (merge & ~merged, "confirm_broad_duplicate", notes["merge_new"]),
        (merge & merged, "confirm_broad_duplicate", notes["merge_again"]),
        (stale, "accept_cleanup_clear_stale_validation_action", notes["stale"]),
        (review, "accept_cleanup_clear_validation_review", notes["review"]),
        (single, "accept_cleanup_mark_single_tf_valid", notes["single"]),
        (kept_duplicate, "accept_valid_but_duplicate_hidden", notes["kept_duplicate"]),
        (nothing, "accept_no_change", notes["nothing"]),
    ]
    listed = lambda k: F.array_compact(F.array(*[F.when(p[0], F.lit(p[k])) for p in parts]))
    resolution = F.when(hide_writes, "model_adjudicated_hide").when(stale | review, "model_adjudicated_accept").when(single, "model_adjudicated_single_tf_valid")
    updates = {
        "broad_duplicate_reason": F.when(merge & ~merged, F.concat(F.lit("model_adjudicated_merge: "), c("model_rationale"))),
        "broad_duplicate_reason_append": F.when(merge & merged & ~F.contains(c("broad_duplicate_reason"), merge_note), merge_note),
        "is_broad_duplicate": F.when(merge & ~merged, "True"),
        "single_tf_status": F.when(single, "standalone_valid"),
        "validation_action": F.when(hide_writes, "hide_model_adjudicated").when(stale, ""),
        "validation_needs_review": F.when(hide_writes | review, "False"),
        "validation_notes_append": F.when(hide_writes, F.concat(F.lit("Model adjudication ("), c("model_confidence"), F.lit("): "), c("model_rationale"))),
        "validation_resolution": resolution,
    }
    given = F.create_map(*[x for k, v in updates.items() for x in (F.lit(k), v)])
    shown = hide_writes & (c("default_visible") == "yes")
    risk = F.when(pending, "manual").when(stale, "high").when(shown | (merge & ~merged) | review | single, "medium").otherwise("low")
    asked = F.when(c("manual_reason") != "", c("manual_reason")).otherwise("Model requested manual review.")
    return df.withColumns({
        "proposed_action": F.when(pending, "manual_review_required").otherwise(F.array_join(listed(1), "; ")),
        "write_risk": risk,
        "proposed_updates": F.to_json(F.map_filter(given, lambda k, v: v.isNotNull())),
        "proposal_notes": F.when(manual, asked).when(pending, "Unknown or pending model decision.").otherwise(F.array_join(listed(2), " ")),
    })


#: Risks in order; what is left to people is beyond all of them.
RISKS = ("low", "medium", "high")


def record_hash(fields: list[str]) -> Column:
    """Of a record as it is read: what a later writer may not find changed."""
    return F.xxhash64("pmid", *[c for f in fields for c in (F.col(f).cast("string"), F.col(f).isNull())])


def stamped(proposed: DataFrame, fields: list[str]) -> DataFrame:
    """Proposals with ``record_hash``, the hash of the record's ``fields`` that they were made from; the record's columns are still there."""
    return proposed.withColumn("record_hash", record_hash(fields))


def proposal_changes(df: DataFrame, proposed: DataFrame, most_risk: str, allowed: list[str]) -> DataFrame:
    """(row_id, field, before, after, error): what proposals of at most ``most_risk`` would change in allowed fields.

    A field named with ``_append`` gets the text after what it holds, once. A proposal whose pmid isn't the record's, or that was
    ``stamped`` with another state of the allowed fields than the record has now, is an error and changes nothing; a value that is there already
    is no change.
    """
    taken = proposed.filter(F.col("write_risk").isin(*RISKS[: RISKS.index(most_risk) + 1]))
    stamp = F.col("record_hash") if "record_hash" in proposed.columns else F.lit(None).cast("long")
    each = taken.select("row_id", F.col("pmid").alias("__pmid"), stamp.alias("__stamp"), F.explode(F.from_json("proposed_updates", "map<string,string>")).alias("named", "value"))
    each = each.withColumn("field", F.regexp_replace("named", "_append$", "")).filter(F.col("field").isin(*allowed))
    now = F.create_map(*[x for f in allowed for x in (F.lit(f), F.col(f).cast("string"))])
    both = each.join(df.select("row_id", "pmid", record_hash(allowed).alias("__hash"), now.alias("__now")), "row_id").withColumn("before", F.element_at("__now", F.col("field")))
    after = F.when(F.col("named") != F.col("field"), text.append_note(F.col("before"), F.col("value"), by=" | ")).otherwise(F.col("value"))
    changed = F.col("__stamp").isNotNull() & (F.col("__stamp") != F.col("__hash"))
    error = F.when(F.col("pmid") != F.col("__pmid"), "pmid mismatch; skipped").when(changed, "record changed; skipped").otherwise("")
    made = both.select("row_id", "field", "before", after.alias("after"), error.alias("error"))
    return made.filter((F.col("error") != "") | ~F.col("before").eqNullSafe(F.col("after")))


def _written_over(df: DataFrame, values: DataFrame, fields: list[str]) -> DataFrame:
    """``df`` with the values (row_id, field, value) in its fields; a value may be null."""
    given = values.groupBy("row_id").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("__given"))  # a field once a row
    put = lambda f: F.when(F.coalesce(F.map_contains_key("__given", F.lit(f)), F.lit(False)), F.element_at("__given", F.lit(f))).otherwise(F.col(f).cast("string"))
    return df.join(given, "row_id", "left").withColumns({f: put(f) for f in fields}).drop("__given")


def apply_changes(df: DataFrame, changes: DataFrame, fields: list[str]) -> DataFrame:
    """``df`` with the changes that have no error. ``changes`` without those that have one is the audit table that ``undo_changes`` reads."""
    once = changes.filter("error = ''").groupBy("row_id", "field").agg(F.max("after").alias("value"))
    return _written_over(df, once, fields)


def undo_changes(df: DataFrame, audit: DataFrame, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """(``df`` with each audited change taken back, the changes that can't be): a field that holds something else by now stays as it is."""
    now = F.create_map(*[x for f in fields for x in (F.lit(f), F.col(f).cast("string"))])
    held = audit.filter("error = ''").join(df.select("row_id", now.alias("__now")), "row_id").withColumn("now", F.element_at("__now", F.col("field"))).drop("__now")
    same = F.col("now").eqNullSafe(F.col("after"))
    back = held.filter(same).groupBy("row_id", "field").agg(F.max("before").alias("value"))
    return _written_over(df, back, fields), held.filter(~same).select("row_id", "field", "before", "after", "now")


def apply_version(folder: str, proposed: DataFrame, most_risk: str, allowed: list[str], version: str) -> dict:
    """Apply proposals to the current version of a table, and publish the result and its audit table as ``version``.

    Nothing is locked: where another writer has published since the version that was read, nothing is published and ``Conflict`` is raised.
    """
    spark = proposed.sparkSession
    head = Versions(spark, folder).head()
    rows = current(spark, folder)
    changes = written(proposal_changes(rows, proposed, most_risk, allowed), "changes")
    write_version(changes, f"{folder}/_audit", version)
    return write_version(apply_changes(rows, changes, allowed), folder, version, head)


def gated_fill(df: DataFrame, fills: DataFrame, key: str, column: str, accept: tuple[str, ...] = ("high",), method: str = "model") -> DataFrame:
    """``df`` with blank values filled from responses sure enough, and how each was got in ``<column>_method``."""
    good = fills.filter(F.col("confidence").isin(*accept) & ~text.is_unspecified(F.col("value"))).groupBy(key).agg(F.min("value").alias("__fill"))
    joined = ensure_columns(df, {f"{column}_method": ""}).join(good, key, "left")
    take = text.is_unspecified(F.col(column)) & F.col("__fill").isNotNull()
    return joined.withColumns({f"{column}_method": F.when(take, method).otherwise(F.col(f"{column}_method")), column: F.when(take, F.col("__fill")).otherwise(F.col(column))}).drop("__fill")


GENERATED = ("cell_fields", "same_pmid_vote", "title_abstract_evidence", "fulltext")


def vote(df: DataFrame, key: str = "pmid", column: str = "species", method: str = "same_pmid_vote") -> DataFrame:
    """``df`` with blanks filled by the value most frequent under their key; ties leave them blank."""
    won = majority(df, key, text.species(F.col(column)))
    joined = df.join(won, key, "left")
    take = (text.clean(F.col(column)) == "") & F.col("majority").isNotNull()
    return joined.withColumns({f"{column}_method": F.when(take, method).otherwise(F.col(f"{column}_method")), column: F.when(take, F.col("majority")).otherwise(F.col(column))}).drop("majority")


def infer(df: DataFrame, found: Column, method: str, column: str = "species") -> DataFrame:
    take = (text.clean(F.col(column)) == "") & (found != "")
    return df.withColumns({f"{column}_method": F.when(take, method).otherwise(F.col(f"{column}_method")), column: F.when(take, found).otherwise(F.col(column))})


def impute_species(df: DataFrame, fulltexts: DataFrame | None = None) -> DataFrame:
    """``df`` with ``species`` filled in passes (names of cells, vote, text, vote; with ``fulltexts`` (pmid, text) those, vote) and ``species_method``.

    What earlier runs filled in is first taken back.
    """
    full = ensure_columns(df, {"species_method": ""})
    mine = F.col("species_method").isin(*GENERATED)
    method = F.when(mine, "").otherwise(F.col("species_method"))
    reset = full.withColumns({"species": F.when(mine, "").otherwise(text.species(F.col("species"))), "species_method": method})
    reset = reset.withColumn("species_method", F.when((F.col("species") != "") & (F.col("species_method") == ""), "existing").otherwise(F.col("species_method")))
    found = reset.withColumns({"__names": species_in_names(F.col("source_cell"), F.col("target_cell")), "__text": species_in_text(text.joined(F.col("title"), F.col("evidence_sentence")))})
    if fulltexts is not None:
        # Only what a text says of species is joined, not the text.
        said = fulltexts.select("pmid", species_in_text(F.col("text")).alias("__full")).filter("__full <> ''").groupBy("pmid").agg(F.min("__full").alias("__full"))
        found = found.join(said, "pmid", "left").withColumn("__full", F.coalesce("__full", F.lit("")))
    # Every vote reads the rows twice, so what the rules find is written before the first.
    made = written(found, "species")
    made = vote(infer(made, F.col("__names"), "cell_fields"))
    made = vote(infer(made, F.col("__text"), "title_abstract_evidence"))
    if fulltexts is not None:
        made = vote(infer(made, F.col("__full"), "fulltext"))
    return made.drop("__names", "__text", "__full")


def release(df: DataFrame, staged: Column, note: str = "released") -> DataFrame:
    """``df`` with ``release``: ``released`` or ``held`` for staged records under review, else blank.

    A record is released if it is research, names factors, has evidence, a species and a clear scope, and isn't a single factor
    that waits for its class. It then needs no review, and resolution and notes say why.
    """
    value = lambda c: text.clean(F.col(c))
    waiting = staged & text.is_true(F.col("validation_needs_review"), ("true",))
    fit = (F.col("paper_type") == "research") & ~text.is_unspecified(F.col("factors")) & (value("evidence_sentence") != "") & (value("species") != "")
    fit = fit & ~text.is_true(F.col("single_tf_flag"), ("true",)) & (value("conversion_scope") != "unclear")
    out = waiting & fit
    return df.withColumns({
        "release": F.when(out, "released").when(waiting, "held").otherwise(""),
        "validation_needs_review": F.when(out, "False").otherwise(F.col("validation_needs_review")),
        "validation_resolution": F.when(out, "curated_coverage_expansion").otherwise(F.col("validation_resolution")),
        "validation_notes": F.when(out, text.append_note(F.col("validation_notes"), F.lit(note), by=" | ")).otherwise(F.col("validation_notes")),
    })


def apply_sure(df: DataFrame, answers: DataFrame, key: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """(``df`` with factors from sure answers, and how they were got in the notes; the answers applied).

    ``answers`` has one row for each key: extracted_factors, extracted_factor_type (blank: the record's own stays), confidence and reasoning.
    """
    sure = answers.filter((F.col("confidence") == "high") & (text.clean(F.col("extracted_factors")) != "") & (F.lower("extracted_factors") != text.NOT_SPECIFIED))
    named = sure.select(key, F.struct("extracted_factors", "extracted_factor_type", "reasoning").alias("__a"))
    hit = F.col("__a").isNotNull()
    applied = df.join(named, key, "left").withColumns({
        "factors": F.when(hit, F.col("__a.extracted_factors")).otherwise(F.col("factors")),
        "factor_type": F.when(hit & (text.clean(F.col("__a.extracted_factor_type")) != ""), F.col("__a.extracted_factor_type")).otherwise(F.col("factor_type")),
        "validation_needs_review": F.when(hit, "").otherwise(F.col("validation_needs_review")),
        "validation_notes": F.when(hit, F.concat(F.lit("fulltext_auto:"), F.left(F.coalesce("__a.reasoning", F.lit("")), F.lit(80)))).otherwise(F.col("validation_notes")),
    })
    return applied.drop("__a"), sure


def better_evidence(sentence: Column, quality: Column, other: Column, other_quality: Column) -> tuple[Column, Column]:
    """(sentence, quality): the second answer where the first isn't good and the second is, or is weak where the first is none."""
    take = (quality != "good") & ((other_quality == "good") | ((other_quality == "weak") & (quality == "none")))
    return F.when(take, other).otherwise(sentence), F.when(take, other_quality).otherwise(quality)


def known_issues(df: DataFrame, patches: DataFrame, key: str = "pmid") -> DataFrame:
    """``df`` under a table of known issues, at most one for each key (key, action, tag, note).

    The note is kept and appended, the tag added; an action is written and asks for a review. ``keep`` is written only where there is no action yet,
    and then, as where review is blank, needs none.
    """
    one = patches.select(key, F.struct("action", "tag", "note").alias("__k"))
    hit, action = F.col("__k").isNotNull(), F.col("__k.action")
    keep = hit & (action == "keep")
    full = ensure_columns(df, dict.fromkeys(["validation_known_issue", "validation_notes", "validation_action", "validation_error_category", "validation_needs_review"], ""))
    review, now = F.col("validation_needs_review"), F.col("validation_action")
    return full.join(one, key, "left").withColumns({
        "validation_known_issue": F.when(hit, F.col("__k.note")).otherwise(F.col("validation_known_issue")),
        "validation_notes": F.when(hit, text.append_note(F.col("validation_notes"), F.col("__k.note"))).otherwise(F.col("validation_notes")),
        "validation_error_category": F.when(hit, text.append_tag(F.col("validation_error_category"), F.col("__k.tag"))).otherwise(F.col("validation_error_category")),
        "validation_action": F.when(hit & (action != "") & (~keep | (text.clean(now) == "")), action).otherwise(now),
        "validation_needs_review": F.when(keep, F.when(text.clean(review) == "", "False").otherwise(review)).when(hit & (action != ""), "True").otherwise(review),
    }).drop("__k")


def evidence_update(df: DataFrame) -> DataFrame:
    """``df`` (evidence_sentence, new_sentence, new_quality) under the policy for new evidence: good and changed replaces and clears review, weak and changed replaces, else a note."""
    changed = (text.clean(F.col("new_sentence")) != "") & (F.col("new_sentence") != F.col("evidence_sentence"))
    good, weak = changed & (F.col("new_quality") == "good"), changed & (F.col("new_quality") == "weak")
    return df.withColumns({
        "evidence_sentence": F.when(good | weak, F.col("new_sentence")).otherwise(F.col("evidence_sentence")),
        "validation_needs_review": F.when(good, "False").otherwise(F.col("validation_needs_review")),
        "validation_notes": F.when(good | weak, F.col("validation_notes")).otherwise(text.append_note(F.col("validation_notes"), F.lit("No better evidence found."))),
    })


#: An annotation's columns and the record's.
ANNOTATED = {
    "recipe_valid": "validation_recipe_valid", "source_cell_valid": "validation_source_cell_valid", "target_cell_valid": "validation_target_cell_valid",
    "factors_valid": "validation_factors_valid", "standalone_recipe": "validation_standalone_recipe", "duplicate_status": "validation_duplicate_status",
    "error_category": "validation_error_category", "action": "validation_action", "annotation_notes": "validation_notes",
}
REVIEW_ACTIONS = ("fix", "hide_single_tf", "mark_duplicate", "remove", "needs_fulltext")
NO_MEMBER = "no_member_of_larger_recipe"


def needs_review(action: Column, valid: Column, standalone: Column, error: Column) -> Column:
    """Whether an annotation leaves a record open."""
    low = lambda c: F.lower(text.clean(c))
    return low(action).isin(*REVIEW_ACTIONS) | low(valid).isin("partial", "no", "unclear") | (low(standalone) == NO_MEMBER) | (text.clean(error) != "")


def apply_annotations(df: DataFrame, notes: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` under people's annotations: their answers, the action that follows, corrected fields and review flags.

    Of annotations on one record the last (by ``no``) decides each answer. Removal, hiding of single factors and duplicate marks
    follow in that order, so a later one decides the action. Corrections are applied after the match.
    """
    fields = list(ANNOTATED) + ["preferred_pmid", "corrected_source_cell", "corrected_target_cell", "corrected_factors"]
    one = notes.groupBy(*[text.clean(F.col(k)).alias(f"__{k}") for k in keys]).agg(F.max_by(F.struct(*[text.clean(F.col(f)).alias(f) for f in fields]), F.col("no")).alias("__n"))
    full = ensure_columns(df, dict.fromkeys([*ANNOTATED.values(), "validation_needs_review", "duplicate_reason", "preferred_pmid", "single_tf_flag"], ""))
    both = full.join(one, [text.clean(F.col(k)) == F.col(f"__{k}") for k in keys], "left").drop(*[f"__{k}" for k in keys])
    n = lambda f: F.col(f"__n.{f}")
    low = lambda f: F.lower(n(f))
    hit = F.col("__n").isNotNull()
    remove, single = (low("action") == "remove") | (low("recipe_valid") == "no"), (low("action") == "hide_single_tf") | (low("standalone_recipe") == NO_MEMBER)
    twin = (low("action") == "mark_duplicate") | F.startswith(low("duplicate_status"), F.lit("duplicate"))
    action = F.when(twin, "mark_duplicate").when(single, "hide_single_tf").when(remove, "remove").otherwise(n("action"))
    open_ = needs_review(n("action"), n("recipe_valid"), n("standalone_recipe"), n("error_category")) | remove | single | twin
    reason = F.when(low("duplicate_status") != "", low("duplicate_status")).otherwise("manual_validation")
    answers = {data: F.when(hit, n(field)).otherwise(F.col(data)) for field, data in ANNOTATED.items()}
    fixed = {f: F.when(hit & (n(f"corrected_{f}") != ""), n(f"corrected_{f}")).otherwise(F.col(f)) for f in ("source_cell", "target_cell", "factors")}
    return both.withColumns(answers | fixed | {
        "validation_action": F.when(hit, action).otherwise(F.col("validation_action")),
        "validation_needs_review": F.when(hit, F.when(open_, "True").otherwise("False")).otherwise(F.col("validation_needs_review")),
        "single_tf_flag": F.when(hit & single, "True").otherwise(F.col("single_tf_flag")),
        "duplicate_reason": F.when(hit & twin, text.append_tag(F.col("duplicate_reason"), reason)).otherwise(F.col("duplicate_reason")),
        "preferred_pmid": F.when(hit & twin & (n("preferred_pmid") != ""), n("preferred_pmid")).otherwise(F.col("preferred_pmid")),
    }).drop("__n")


def paper_type_writes(df: DataFrame, answers: DataFrame, key: str = "pmid") -> DataFrame:
    """``df`` under answers on paper types: sure ones are written with a note, likely ones flagged for review, others left."""
    one = answers.groupBy(key).agg(F.min(F.struct("paper_type", "confidence")).alias("__a"))
    both = ensure_columns(df, {"validation_needs_review": "", "validation_notes": ""}).join(one, key, "left")
    differs = F.col("__a").isNotNull() & (F.col("__a.paper_type") != F.col("paper_type"))
    sure, likely = differs & (F.col("__a.confidence") == "high"), differs & (F.col("__a.confidence") == "medium")
    note = F.concat(F.lit("paper_type set to "), F.col("__a.paper_type"))
    return both.withColumns({
        "validation_notes": F.when(sure, text.append_note(F.col("validation_notes"), note)).otherwise(F.col("validation_notes")),
        "validation_needs_review": F.when(likely, "True").otherwise(F.col("validation_needs_review")),
        "paper_type": F.when(sure, F.col("__a.paper_type")).otherwise(F.col("paper_type")),
    }).drop("__a")


def evidence_responses(df: DataFrame) -> DataFrame:
    """``df`` (answer: evidence_sentence, quality) with the evidence written, and weak or missing evidence flagged; an answer that can't be read is none."""
    quality = F.lower(F.trim(F.coalesce("answer.quality", F.when(F.col("answer").isNull(), "none").otherwise("good"))))
    open_ = quality.isin("weak", "none")
    return df.withColumns({
        "evidence_sentence": F.coalesce("answer.evidence_sentence", F.lit("")), "evidence_quality": quality,
        "validation_needs_review": F.when(open_, "True").otherwise(""), "validation_resolution": F.when(open_, F.concat(F.lit("evidence_quality_"), quality)).otherwise(""),
    })


def hide_weak_medium(df: DataFrame) -> DataFrame:
    """``df`` with medium-confidence records hidden whose evidence cites prior work or only describes methods."""
    active = ~F.col("is_duplicate") & ~F.col("validation_action").isin("remove", "hide_incomplete_recipe", "hide_single_tf")
    bad = active & (F.col("confidence") == "medium") & F.col("validation_resolution").isin("evidence_cites_prior_work", "evidence_is_methods_sentence")
    note = F.lit(tables.WEAK_EVIDENCE_NOTE)
    return df.withColumns({
        "validation_action": F.when(bad, "hide_incomplete_recipe").otherwise(F.col("validation_action")), "validation_needs_review": F.when(bad, "False").otherwise(F.col("validation_needs_review")),
        "validation_notes": F.when(bad, text.append_note(F.col("validation_notes"), note)).otherwise(F.col("validation_notes")),
    })
