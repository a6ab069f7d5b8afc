"""Exact and broad duplicate resolution, keeper choice, and the evidence that supports a cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import tables, text
from quern.operators.graph import numbered, totalled, written
from quern.operators.schema import ensure_columns


def _ranked(c: str, ranks: dict[str, int], other: int) -> Column:
    out = F.lit(other)
    for value, rank in ranks.items():
        out = F.when(F.col(c) == value, rank).otherwise(out)
    return out


def hidden(actions: tuple[str, ...] = tables.KEEPER_HIDDEN) -> Column:
    return F.lower("validation_action").isin(*actions) | (F.lower("validation_recipe_valid") == "no")


def keeper_order(review: bool = False) -> list[Column]:
    """Which record of a group stays: shown before hidden, research first, (reviewed first,) earliest, best source, surest, with evidence."""
    keys = [hidden().cast("int"), _ranked("paper_type", tables.PAPER_RANK, 3)]
    if review:
        keys.append(text.is_true(F.col("validation_needs_review")).cast("int"))
    keys += [text.number(F.col("year"), 9999), _ranked("source", tables.SOURCE_RANK, 2), _ranked("confidence", tables.CONFIDENCE_RANK, 3)]
    return [*keys, (text.clean(F.col("evidence_sentence")) == "").cast("int"), F.col("pmid"), F.col("row_id")]


def broad_class(name: Column, role: str) -> Column:
    """The broad class of a cell name, by what is found in it; a name without one stays."""
    low = text.key_text(name)
    rules = tables.BROAD_SHARED + (tables.BROAD_TARGET if role == "target" else [])
    other = text.first_found(low, rules, text.clean(name))
    pluripotent = low.rlike("(?iu)" + tables.BROAD_PLURIPOTENT) & ~low.rlike("(?iu)" + tables.BROAD_NOT_PLURIPOTENT)
    return F.when(low == "", "").when(pluripotent, "induced pluripotent stem cell").otherwise(other)


#: Columns that a pass reads, with what stands for a missing one.
_DEFAULTS = {
    "source_cell_std": "", "target_cell_std": "", "validation_recipe_valid": "", "validation_needs_review": "", "is_duplicate": "False",
    "duplicate_reason": "", "preferred_pmid": "", "duplicate_group_id": "", "broad_duplicate_reason": "",
}


def _groups(df: DataFrame, raw: list[str], key: dict[str, Column], order: list[Column]) -> DataFrame:
    """``df`` with the columns of ``key``, which are made of ``raw``, and for rows of groups of two or more: ``group_no`` by first appearance, ``keeper``, ``keep_pmid``, ``keep_hidden``.

    Rows are first aggregated as they are written, so a key is made once for each writing; null is written as blank. One more aggregate
    over the keys and one over the groups; no list of a group's rows is made, so groups may be large.
    """
    first, blank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]), lambda c: F.coalesce(F.col(c), F.lit(""))
    writings = df.groupBy(*[blank(c).alias(c) for c in raw]).agg(
        F.count(F.lit(1)).alias("members"), F.min("row_id").alias("first_row"),
        F.min_by(F.struct(first.alias("order"), F.col("row_id"), F.col("pmid"), hidden().alias("hid")), first).alias("keep"),
    )
    keyed = written(writings.select(*[F.col(c).alias(f"__{c}") for c in raw], *[k.alias(n) for n, k in key.items()], "members", "first_row", "keep"), "keys")
    members = keyed.groupBy(*key).agg(F.sum("members").alias("members"), F.min("first_row").alias("first_row"), F.min_by("keep", "keep.order").alias("keep")).filter("members > 1")
    numbers = numbered(members, "first_row", "group_no").select(*key, "group_no", F.col("keep.row_id").alias("keeper"), F.col("keep.pmid").alias("keep_pmid"), F.col("keep.hid").alias("keep_hidden"))
    placed = keyed.drop("members", "first_row", "keep").join(numbers, list(key), "left")
    return df.drop(*key).join(placed, [blank(c) == F.col(f"__{c}") for c in raw], "left").drop(*[f"__{c}" for c in raw])


def exact_duplicates(df: DataFrame) -> DataFrame:
    """``df`` with ``is_duplicate`` (boolean), ``duplicate_reason``, ``preferred_pmid`` and ``duplicate_group_id`` brought up to date.

    Records are equal if their source, target and multiset of factors are. All but the keeper of a group are duplicates; so are
    records that people marked, unless they are a keeper that nothing hides. Marked records without a group get metadata of
    their own; records that are no duplicates lose theirs unless people marked them.
    """
    full = ensure_columns(df, _DEFAULTS)
    key = {f"__key_{r}": text.cell_key(F.col(f"{r}_cell_std"), F.col(f"{r}_cell")) for r in ("source", "target")} | {"__key_factors": text.factor_key(F.col("factors"))}
    grouped = _groups(full, ["source_cell_std", "source_cell", "target_cell_std", "target_cell", "factors"], key, keeper_order())
    marked = F.lower("validation_action") == "mark_duplicate"
    manual = marked | F.col("duplicate_reason").rlike(tables.SUPERSEDED)
    in_group = F.col("keeper").isNotNull()
    loser = F.coalesce(in_group & (F.col("row_id") != F.col("keeper")), F.lit(False))
    clear_keeper = F.coalesce(in_group & (F.col("row_id") == F.col("keeper")) & ~F.col("keep_hidden"), F.lit(False))
    number = F.when(F.col("group_no") < 10000, F.lpad(F.col("group_no").cast("string"), 4, "0")).otherwise(F.col("group_no").cast("string"))
    group_id = F.concat(F.lit("recipe_"), number)
    blank = lambda c: text.clean(F.col(c)) == ""
    now = grouped.withColumns({
        "is_duplicate": loser | (manual & ~clear_keeper),
        "duplicate_reason": F.when(loser, text.append_tag(F.col("duplicate_reason"), F.lit("same_standardized_recipe"))).otherwise(F.col("duplicate_reason")),
        "duplicate_group_id": F.when(loser, text.append_tag(F.col("duplicate_group_id"), group_id)).otherwise(F.col("duplicate_group_id")),
        "preferred_pmid": F.when(loser & blank("preferred_pmid"), F.col("keep_pmid")).otherwise(F.col("preferred_pmid")),
    })
    fallback = {"duplicate_reason": F.lit("manual_adjudication"), "duplicate_group_id": F.lit("manual"), "preferred_pmid": text.clean(F.col("pmid"))}
    drop = ~F.col("is_duplicate") & ~marked
    settled = now.withColumns({c: F.when(drop, "").when(F.col("is_duplicate") & blank(c), v).otherwise(F.col(c)) for c, v in fallback.items()})
    return settled.drop(*key, "group_no", "keeper", "keep_pmid", "keep_hidden")


AUTO_TAG = "same_broad_cell_recipe"


def broad_duplicates(df: DataFrame) -> DataFrame:
    """``df`` with broad classes and ``is_broad_duplicate`` (boolean), ``broad_duplicate_reason``, ``broad_preferred_pmid``, ``broad_duplicate_group_id``.

    Records are equal if their broad classes and factors are. The tag that this pass owns is built anew; what people wrote stays. A
    keeper is never a duplicate.
    """
    full = ensure_columns(df, _DEFAULTS)
    key = {f"{r}_cell_broad": broad_class(F.col(f"{r}_cell_std"), r) for r in ("source", "target")} | {"__key_factors": text.factor_key(F.col("factors"))}
    grouped = _groups(full, ["source_cell_std", "target_cell_std", "factors"], key, keeper_order(review=True))
    manual = (F.lower("validation_action") == "mark_duplicate") | F.col("duplicate_reason").rlike(tables.SUPERSEDED)
    in_group = F.col("keeper").isNotNull()
    loser = F.coalesce(in_group & (F.col("row_id") != F.col("keeper")), F.lit(False))
    keeper = F.coalesce(in_group & (F.col("row_id") == F.col("keeper")), F.lit(False))
    note = text.manual_note(F.col("broad_duplicate_reason"), AUTO_TAG)
    number = F.when(F.col("group_no") < 10000, F.lpad(F.col("group_no").cast("string"), 4, "0")).otherwise(F.col("group_no").cast("string"))
    orphan = manual & ~keeper & ~loser
    or_else = lambda c, other: F.when(text.clean(F.col(c)) == "", other).otherwise(text.clean(F.col(c)))
    preferred = or_else("preferred_pmid", text.clean(F.col("pmid")))
    return grouped.withColumns({
        "is_broad_duplicate": loser | orphan,
        "broad_duplicate_reason": F.when(loser, text.with_auto_tag(note, AUTO_TAG)).when(orphan & (note == ""), or_else("duplicate_reason", F.lit("manual_adjudication"))).otherwise(note),
        "broad_preferred_pmid": F.when(loser, F.col("keep_pmid")).when(orphan, preferred).otherwise(""),
        "broad_duplicate_group_id": F.when(loser, F.concat(F.lit("broad_recipe_"), number)).when(orphan, or_else("duplicate_group_id", F.concat(F.lit("broad_manual_"), preferred))).otherwise(""),
    }).drop("__key_factors", "group_no", "keeper", "keep_pmid", "keep_hidden")


#: Lists of one task of ``_beside_lists``: half of a Parquet dictionary, and at most one list of less than that beyond it; and its rows of one list.
_TASK_BYTES, _TASK_ROWS = 1 << 19, 1 << 16


def _beside_lists(rows: DataFrame, lists: DataFrame, key: str) -> DataFrame:
    """``rows`` joined with ``lists`` (``key``, ``members``: its rows, and texts), laid out so that texts as long as their groups can be written once.

    Every row gets all texts of its group, so values grow with the square of a group. A file holds a value once as long as its
    dictionary (1 MB a column) can, and in full for every row beyond. Groups are therefore dealt to tasks by the bytes of their
    texts, largest first; the rows of a very large group go to several tasks.
    """
    texts = [c for c in lists.columns if c not in (key, "members")]
    size = F.greatest(*[F.octet_length(F.col(c).cast("string")) for c in texts]).cast("long") + 4
    parts = F.ceil(F.col("members") / _TASK_ROWS).alias("parts")
    weight = F.when(F.col("parts") > 1, F.col("parts") * _TASK_BYTES).otherwise(F.greatest(F.least("size", F.lit(_TASK_BYTES)), F.floor(F.col("members") * (_TASK_BYTES / _TASK_ROWS))))
    sized = lists.select(key, "members", size.alias("size"), parts).withColumn("weight", weight.cast("long"))
    # Every weight is above 0, so a group's place is its own.
    places = written(totalled(sized, [F.desc("size"), F.col(key)], "weight", "place").select(key, "place", F.floor(F.col("place") / _TASK_BYTES).cast("int").alias("task"), F.col("parts").cast("int").alias("parts")), "places")
    tasks = places.agg(F.max(F.col("task") + F.col("parts"))).first()[0] or 1
    mine = F.col("task") + F.pmod(F.xxhash64(*[c for c in rows.columns if c != key]), F.col("parts")).cast("int")
    dealt = rows.join(places, key).withColumn("task", mine).drop(key, "parts").repartitionById(tasks, "task")
    each = lists.join(places, key).withColumn("task", F.explode(F.sequence("task", F.col("task") + F.col("parts") - 1))).select("task", "place", *texts).repartitionById(tasks, "task")
    return dealt.join(each.hint("merge"), ["task", "place"]).drop("task", "place")


def support(df: DataFrame, source: str, target: str, shown_ids: int = 12, shown_papers: int = 6) -> DataFrame:
    """(row_id, supporting_paper_count, supporting_pmids, pmids_preview, papers_preview): the papers of each record's cluster, by year and id.

    Papers are first made distinct within a cluster; only those lists are joined back to the records. A list holds every id, as it
    is asked for, but titles of the papers shown alone. Records of a cluster stand together, see ``_beside_lists``.
    """
    cluster = F.struct(text.key_text(F.col(source)).alias("s"), text.key_text(F.col(target)).alias("t"), text.factor_key(F.col("factors")).alias("f"))
    keyed = written(df.select("row_id", "pmid", "year", "title", cluster.alias("cluster")), "clusters")
    year = text.number(F.col("year"), 9999)
    papers = keyed.groupBy("cluster", "pmid").agg(F.min(F.struct(year.alias("y"), F.col("row_id").alias("r"), "year", "title")).alias("p"), F.count(F.lit(1)).alias("rows"))
    name = F.concat(F.col("pmid"), F.when(~F.col("p.year").isin("", "0"), F.concat(F.lit(" ("), F.col("p.year"), F.lit(")"))).otherwise(""), F.when(F.col("p.title") != "", F.concat(F.lit(": "), F.left("p.title", F.lit(140)))).otherwise(""))
    placed = papers.withColumn("n", F.row_number().over(Window.partitionBy("cluster").orderBy("p.y", "pmid")))
    listed = placed.groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("n", "pmid", F.when(F.col("n") <= shown_papers, name).alias("name")))).alias("papers"), F.sum("rows").alias("members"))
    ids, names = F.transform("papers", lambda x: x["pmid"]), F.transform("papers", lambda x: x["name"])
    lists = listed.select("cluster", "members", F.size("papers").cast("long").alias("supporting_paper_count"), F.array_join(ids, ", ").alias("supporting_pmids"), text.preview(ids, shown_ids).alias("pmids_preview"), text.preview(names, shown_papers).alias("papers_preview"))
    return _beside_lists(keyed.select("row_id", "cluster"), written(lists, "lists"), "cluster")


def first_rows(df: DataFrame, keys: list[str], order: str = "row_id", last: bool = False) -> DataFrame:
    """One row for each key: the first by ``order``, or the last. An aggregate, so a hot key is combined before it is shuffled."""
    pick = F.max_by if last else F.min_by
    row = F.struct(*[c for c in df.columns if c not in keys])
    return df.groupBy(*keys).agg(pick(row, F.col(order)).alias("__row")).select(*keys, "__row.*")


def resolve_labels(labels: Column) -> Column:
    """The label of a group from the set of its labels: the only one; unclear if binder and non-binder meet; else the stronger."""
    has = lambda x: F.array_contains(labels, x)
    return F.when(F.size(labels) == 1, labels[0]).when(has("binder") & has("non-binder"), "unclear").when(has("binder"), "binder").when(has("non-binder"), "non-binder").otherwise("unclear")


def collapse_pairs(df: DataFrame, key: str, label: str, rank: list[Column], reference: str, between: str = "; ") -> DataFrame:
    """One row for each pair: the best by ``rank``, its label resolved over the group, references joined in that order; ``removed`` counts the others."""
    order = F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)], F.col("row_id"))
    placed = df.withColumn("__order", order)
    # Whole rows: each task keeps its first of a pair before they are shuffled. References and labels go by themselves, without the rows.
    best = placed.withColumn("__place", F.row_number().over(Window.partitionBy(key).orderBy("__order"))).filter("__place = 1").drop("__place", "__order", label, reference).withColumnRenamed(key, "__key")
    # First by reference, so that a pair's list has each once, where it first stands.
    by_reference = placed.groupBy(key, reference).agg(F.min("__order").alias("__order"), F.collect_set(label).alias("__labels"), F.count(F.lit(1)).alias("__n"))
    listed = by_reference.groupBy(key).agg(
        F.array_distinct(F.flatten(F.collect_set("__labels"))).alias("__labels"),
        F.sort_array(F.collect_list(F.struct("__order", F.col(reference).alias("ref")))).alias("__refs"),
        (F.sum("__n") - 1).alias("removed"),
    )
    made = listed.join(best, F.col(key).eqNullSafe(F.col("__key")))
    refs = F.array_join(F.filter(F.transform("__refs", lambda x: x["ref"]), lambda x: x != ""), between)
    return made.select(key, *[c for c in df.columns if c not in (key, label, reference)], resolve_labels(F.col("__labels")).alias(label), refs.alias(reference), (F.size("__labels") > 1).alias("conflict"), "removed")


def protected_duplicates(df: DataFrame, keys: list[str], protected: DataFrame) -> DataFrame:
    """``df`` with duplicates of raw keys: of a group the latest record of a protected paper stays, else the earliest research record, else the earliest."""
    safe = protected.select(F.col("pmid").alias("__p")).distinct()
    joined = df.join(safe, F.col("pmid") == F.col("__p"), "left").withColumn("__safe", F.col("__p").isNotNull()).drop("__p")
    year = text.number(F.col("year"), 9999)
    rank = F.struct(F.when(F.col("__safe"), 0).when(F.col("paper_type") == "research", 1).otherwise(2).alias("k"), F.when(F.col("__safe"), -year).otherwise(year).alias("y"), F.col("row_id").alias("r"))
    groups = joined.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min("row_id").alias("__first"), F.min_by(F.struct("row_id", "pmid"), rank).alias("__keep")).filter("__n > 1")
    placed = joined.drop("__safe").join(numbered(groups, "__first", "__no").drop("__n", "__first"), keys, "left")
    loser = F.coalesce(F.col("row_id") != F.col("__keep.row_id"), F.lit(False))
    group_id = F.concat(F.lit("recipe_"), F.lpad(F.col("__no").cast("string"), 4, "0"))
    add = lambda old, new: F.when(~loser, F.col(old)).when(F.col(old) == "", new).otherwise(F.concat(F.col(old), F.lit(";"), new))
    full = ensure_columns(placed, {"duplicate_reason": "", "duplicate_group_id": "", "preferred_pmid": ""})
    return full.withColumns({
        "is_duplicate": loser, "duplicate_reason": add("duplicate_reason", F.lit("same_recipe")), "duplicate_group_id": add("duplicate_group_id", group_id),
        "preferred_pmid": F.when(loser, F.col("__keep.pmid")).otherwise(F.col("preferred_pmid")),
    }).drop("__no", "__keep")
