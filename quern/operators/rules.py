"""Row classifiers: ordered rules over a record's fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import tables, text


def _whole(names: tuple[str, ...]) -> str:
    """One pattern for any of the names as a whole, so that a text is scanned once."""
    return f"^({'|'.join(names)})$"


def factor_type(name: Column) -> Column:
    """The type of a factor by its name: families of names first, then known genes."""
    low = F.lower(text.strip(name))
    gene = F.regexp_replace(F.translate(text.strip(F.regexp_replace(name, r"\([^)]*\)", "")), "αβ", "AB"), r"^[hm](?=[A-Z])", "")
    gene = F.regexp_replace(F.regexp_replace(gene, "c-MYC|cMYC|C-MYC", "MYC"), "OCT3/4|POU5F1", "OCT4")
    gene = F.upper(F.regexp_replace(gene, r"[^A-Za-z0-9]", ""))
    return (
        F.when(low.rlike(tables.MIRNA), "miRNA").when(low.rlike(tables.KNOCKDOWN), "knockdown").when(low.rlike(_whole(tables.CYTOKINES)), "cytokine")
        .when(low.rlike(_whole(tables.SMALL_MOLECULES)), "small_molecule").when(gene.isin(*tables.KNOWN_TF), "TF").otherwise("other")
    )


def type_label(label: Column) -> Column:
    return F.when(label == "TF (knockdown)", "knockdown").when(label.isin(*tables.FACTOR_TYPES), label).otherwise("other")


def aligned_types(types: Column, factors: Column) -> Column:
    """A label for each factor: one label stands for all; blank and other ones are inferred; surplus ones go."""
    parts, labels = text.split_piped(factors), F.transform(text.split_piped(types), type_label)
    spread = F.when((F.size(labels) == 1) & (F.size(parts) > 1), F.array_repeat(labels[0], F.size(parts))).otherwise(labels)

    def one(part: Column, i: Column) -> Column:
        given, guess = F.coalesce(F.get(spread, i), F.lit("")), factor_type(part)
        return F.when(given.isin("", "other") & (guess != "other"), guess).when(given == "", guess).otherwise(given)

    return F.when(F.size(parts) == 0, F.array_join(labels, ", ")).otherwise(F.array_join(F.transform(parts, one), ", "))


def is_single_tf(factors: Column, types: Column) -> Column:
    """Exactly one factor, and only labels of TFs, one at least."""
    named = F.filter(text.split_nested(factors), lambda x: x != text.NOT_SPECIFIED)
    labels = text.split_flat(types)
    return (F.size(named) == 1) & (F.size(labels) > 0) & F.forall(labels, lambda x: F.contains(x, F.lit("TF")))


def species_in_text(c: Column) -> Column:
    """The species that a text is about; blank if it names none, or several that don't go together."""

    def said(x: Column) -> Column:
        body, low = x["body"], x["low"]
        hits = {name: text.found(body, low, "|".join(p), "(?i)") for name, p in tables.SPECIES_IN_TEXT.items()}
        hits["human"] = hits["human"] | text.found(body, low, tables.HUMAN_DERIVED, "(?i)")
        both = body.rlike("(?i)" + tables.HUMAN_AND_MOUSE)
        graft = body.rlike("(?i)" + tables.HUMAN_CELLS) & body.rlike("(?i)" + tables.GRAFTS)
        return text.let(_names_of(hits), lambda n: F.when(F.size(n) == 1, F.get(n, F.lit(0))).when((F.array_join(n, ",") == "human,mouse") & both, "human, mouse").when((F.array_join(n, ",") == "human,mouse") & graft, "human").otherwise(""))

    return text.let(text.clean(c), lambda body: text.let(_with_low(body), said))


def _names_of(hits: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(hit, F.lit(name)) for name, hit in hits.items()]))


def _with_low(body: Column) -> Column:
    return F.struct(body.alias("body"), text.folded(body).alias("low"))


def species_in_names(*cells: Column) -> Column:
    """The species that the names of cells give: a word for it near a word for cells, or a cell line's name."""
    context = tables.CELL_CONTEXT
    near = lambda w: rf"\b(?:{w})\b(?:\W+\w+){{0,6}}\W+(?:{context})\b|\b(?:{context})\b(?:\W+\w+){{0,6}}\W+\b(?:{w})\b"

    def given(x: Column) -> Column:
        body, low = x["body"], x["low"]
        hits = {}
        for name, word in tables.SPECIES_WORDS.items():
            lines = [text.found(body, low, p, "(?i)") for p in tables.SPECIES_LINES.get(name, ())]
            # Words are looked for before the patterns around them, which are tried at every word.
            beside = [text.found(body, low, word, "(?i)") & body.rlike("(?i)" + near(word))] if name != "zebrafish" else []
            hits[name] = reduce(lambda a, b: a | b, lines + beside)
        hits["human"] = hits["human"] | text.found(body, low, tables.HUMAN_DERIVED, "(?i)")
        return text.let(_names_of(hits), lambda n: F.when(F.size(n) == 1, F.get(n, F.lit(0))).when(F.array_join(n, ",") == "human,mouse", "human, mouse").otherwise(""))

    return text.let(text.joined(*[text.clean(c) for c in cells]), lambda body: text.let(_with_low(body), given))


def conversion_scope(source: Column, target: Column, title: Column, evidence: Column) -> Column:
    """The scope of a conversion: the first rule that fits, over names first and over all text then."""

    def scope(x: Column) -> Column:
        has = lambda c, p: text.found(x[c], x[f"{c}_low"], p)
        both = (text.strip(x["s"]) != "") & (text.strip(x["t"]) != "")
        unlike = both & (F.lower(text.strip(x["s"])) != F.lower(text.strip(x["t"])))
        return (
            F.when(has("t", "|".join(tables.PLURIPOTENT_TARGET)), "classical_reprogramming").when(has("s", tables.STEM_SOURCE), "directed_differentiation")
            .when(has("all", tables.LINEAGE_WORDS), "lineage_conversion").when(has("all", "|".join(tables.STATE_WORDS)), "cell_state_modulation")
            .when(has("s", tables.TUMOUR_SOURCE) & has("t", tables.TUMOUR_TARGET), "cell_state_modulation").when(has("t", tables.SKELETAL_TARGET) & has("s", tables.SKELETAL_SOURCE), "directed_differentiation")
            .when(has("t", tables.BONE_TARGET) & both, "lineage_conversion").when(has("all", tables.INNER_EAR) & unlike, "lineage_conversion")
            .when(has("all", tables.RETINA) & both, "lineage_conversion").when(has("all", tables.GERMLINE) & unlike, "lineage_conversion")
            .when(has("all", tables.IN_VIVO), "lineage_conversion").when(has("all", f"{tables.INNATE}|{tables.COMMON_CELLS}") & unlike, "lineage_conversion").otherwise("unclear")
        )

    s, t = F.coalesce(source, F.lit("")), F.coalesce(target, F.lit(""))
    everything = F.lower(F.concat_ws(" ", s, t, F.coalesce(title, F.lit("")), F.coalesce(evidence, F.lit(""))))
    looked_at = {"s": s, "t": t, "all": everything}
    return text.let(F.struct(*[c.alias(n) for n, c in looked_at.items()]), lambda x: text.let(F.struct(*[x[n].alias(n) for n in looked_at], *[text.folded(x[n]).alias(f"{n}_low") for n in looked_at]), scope))


def canonical_target(name: Column) -> Column:
    """A target under its usual name; named sub-types stay as they are."""
    trimmed = text.strip(name)
    chain = F
    for found, unless, usual in tables.CANONICAL_TARGETS:
        chain = chain.when(trimmed.rlike("(?iu)" + found) & ~trimmed.rlike("(?iu)" + unless), F.lit(usual))
    return chain.otherwise(trimmed)


def is_specific(factors: Column) -> Column:
    """Whether a factor text names something: it isn't missing or generic, and some item is like a name."""
    low = F.lower(text.clean(factors))
    generic = text.is_unspecified(factors, tables.MISSING_FACTORS) | text.any_found(low, tables.GENERIC_FACTORS, "")
    return ~generic & F.exists(text.split_nested(factors), lambda p: p.rlike(tables.NAMED_FACTOR))


def token_set(factors: Column) -> Column:
    """The distinct words of a factor text, in order, aliases folded; commas don't keep words apart from others."""
    plain = F.regexp_replace(F.regexp_replace(text.spelled(F.lower(text.clean(factors)), {"β": "beta", "α": "alpha"}), r"[-_/]+", " "), r"[^a-z0-9 ]+", "")
    words = F.filter(F.split(plain, r"\s+"), lambda w: w != "")
    return F.array_sort(F.array_distinct(F.transform(words, lambda w: F.coalesce(text.literal_map(tables.TOKEN_ALIASES)[w], w))))


_CELLS = ("source_cell", "target_cell", "source_cell_std", "target_cell_std", "source_cell_broad", "target_cell_broad")


def on_topic(pattern: str, with_text: bool) -> Column:
    """Whether a record's cells (``with_text``: or its title or evidence) are about a topic."""
    fields = _CELLS + (("title", "evidence_sentence") if with_text else ())
    return text.let(F.lower(F.concat_ws(" ", *[text.clean(F.col(f)) for f in fields])), lambda low: text.found(low, low, pattern, ""))


def visible(rejected_answers: bool = False, broad: bool = True, missing: tuple[str, ...] = tables.UNSPECIFIED) -> Column:
    """Whether a record is in the default view; the policies differ in which duplicates and answers they look at."""
    low = lambda c: F.lower(text.clean(F.col(c)))
    shown = low("confidence").isin("high", "medium") & (low("paper_type") == "research") & ~text.is_true(F.col("is_broad_duplicate" if broad else "is_duplicate"), ("true",))
    shown = shown & ~text.is_unspecified(F.col("factors"), missing) & ~text.clean(F.col("single_tf_status")).isin("cocktail_member", "unclear")
    shown = shown & ~text.is_true(F.col("validation_needs_review"), ("true",)) & ~low("validation_action").isin(*tables.VIEW_HIDDEN)
    return shown & (low("validation_recipe_valid") != "no") if rejected_answers else shown


def issue_flags() -> Column:
    """What is wrong with a record, as named flags in order."""
    value = lambda c: text.clean(F.col(c))
    single, action, paper = value("single_tf_status"), value("validation_action"), value("paper_type")
    return F.array_compact(F.array(
        F.when(text.is_unspecified(F.col("factors")), "missing_factors"), F.when(value("species") == "", "species_blank"), F.when(value("conversion_scope") == "unclear", "scope_unclear"),
        F.when(single.isin("cocktail_member", "unclear"), F.concat(F.lit("single_tf_"), single)), F.when(text.is_true(F.col("validation_needs_review"), ("true",)), "validation_needs_review"),
        F.when(F.lower(action).isin(*tables.VIEW_HIDDEN), F.concat(F.lit("validation_action_"), action)), F.when(text.is_true(F.col("is_broad_duplicate"), ("true",)), "broad_duplicate"),
        F.when(F.lower(value("confidence")) == "low", "low_confidence"), F.when(F.lower(paper) != "research", F.concat(F.lit("paper_type_"), F.when(paper == "", "blank").otherwise(paper))),
    ))


def review_priority() -> Column:
    """How urgent a look at a record is: a sum over its visibility, topic and flags."""
    found = issue_flags()
    points = [
        (visible(), 40), (on_topic(tables.T_CELL, False), 20), (F.array_contains(found, "validation_needs_review"), 25), (F.array_contains(found, "missing_factors"), 18),
        (F.array_contains(found, "species_blank"), 14), (F.exists(found, lambda f: F.startswith(f, F.lit("single_tf_"))), 12), (F.array_contains(found, "broad_duplicate"), 8),
        (F.lower(text.clean(F.col("confidence"))) == "high", 5),
    ]
    return reduce(lambda a, b: a + b, [F.when(c, n).otherwise(0) for c, n in points])


def manual_recommended() -> Column:
    """Whether people should decide: the model says so, isn't sure, isn't sure enough of the topic, or sees a doubtful merge."""
    doubtful = F.col("duplicate_assessment").isin("split_needed", "unclear") & text.is_true(F.col("is_broad_duplicate"), ("true",))
    focus = on_topic(tables.T_CELL, False) & (F.col("model_confidence") != "high")
    return F.when((F.col("model_decision") == "needs_manual") | (F.col("model_confidence") == "low") | focus | doubtful, "yes").otherwise("no")


def is_vague(factors: Column) -> Column:
    """One item alone, and that no name."""
    parts = F.split(factors, ",")
    return (F.size(parts) == 1) & text.any_found(text.strip(parts[0]), tables.VAGUE_FACTORS)


def evidence_flags(df: DataFrame) -> DataFrame:
    """``df`` with review flags for evidence that is no result, and vague records hidden; resolved, hidden and duplicate records stay as they are.

    A possible negative decides the resolution over prior work; notes of both are kept.
    """
    evidence = text.strip(F.col("evidence_sentence"))
    active = ~F.col("is_duplicate") & ~F.col("validation_action").isin(*tables.KEEPER_HIDDEN) & ~F.startswith("validation_resolution", F.lit("resolved_"))
    prior, negative = active & text.any_found(evidence, tables.PRIOR_WORK), active & text.any_found(evidence, tables.NEGATIVE)
    methods = active & ~prior & text.any_found(evidence, tables.METHODS_ONLY)
    vague = active & ~prior & ~methods & ~negative & (F.col("confidence") == "medium") & (F.col("source") == "abstract") & is_vague(F.col("factors"))
    marks = dict(zip(tables.EVIDENCE_NOTES, (prior, methods, negative, vague), strict=True))
    notes = F.col("validation_notes")
    for name, hit in marks.items():
        notes = F.when(hit, text.append_note(notes, F.lit(tables.EVIDENCE_NOTES[name]), by=" | ", repeat=True)).otherwise(notes)
    resolution = reduce(lambda other, kv: F.when(kv[1], F.lit(kv[0])).otherwise(other), marks.items(), F.col("validation_resolution"))
    return df.withColumns({
        "validation_needs_review": F.when(prior | methods | negative, "True").when(vague, "False").otherwise(F.col("validation_needs_review")),
        "validation_action": F.when(vague, "hide_incomplete_recipe").otherwise(F.col("validation_action")),
        "validation_resolution": resolution,
        "validation_notes": notes,
    })


def flags(**conditions: Column) -> Column:
    """The names of the conditions that hold, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in conditions.items()]))


def priority(weights: dict[str, int], found: Column) -> Column:
    """The sum of the weights of the flags found."""
    return reduce(lambda a, b: a + b, [F.when(F.array_contains(found, n), w).otherwise(0) for n, w in weights.items()], F.lit(0))
