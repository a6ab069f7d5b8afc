"""Registered queries of operators that are parts of others, each by itself, on values that Spark derives from the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import tables, text
from quern.operators import curation, rules
from quern.operators.graph import shared_folder
from quern.plans.catalog import ORACLE_SQL, QUERIES, query
from quern.plans.records import over_records, records, table
from quern.plans.upkeep import _any
from quern.sources import tables as sources


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT c_custkey, c_name, 'present' AS kind FROM customer UNION ALL SELECT c_custkey, NULL, 'asked' FROM customer WHERE c_custkey % 3 = 0")
def s2_optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is there, one that isn't, and rows that ask for what it would have had."""
    there = sources.scan_optional(spark, f"{sf_dir}/customer.parquet", "c_custkey long, c_name string").withColumn("kind", F.lit("present"))
    none = sources.scan_optional(spark, _fresh(spark, "absent"), "c_custkey long, c_name string")
    asked = table(spark, sf_dir, "customer").filter("c_custkey % 3 = 0").select("c_custkey")
    found = asked.join(none, "c_custkey", "left").withColumn("kind", F.lit("asked"))
    return there.unionByName(none.withColumn("kind", F.lit("absent"))).unionByName(found)


@query("SELECT c_custkey, c_mktsegment, count(*) AS times FROM (SELECT * FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT * FROM customer WHERE c_custkey % 3 = 0) GROUP BY ALL")
def s8_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of known columns appended twice; an append of other columns is refused and leaves nothing."""
    at, rows, columns = _fresh(spark, "appended"), table(spark, sf_dir, "customer"), ["c_custkey", "c_mktsegment"]
    sources.append_rows(rows.filter("c_custkey % 2 = 0"), at, columns)
    sources.append_rows(rows.filter("c_custkey % 3 = 0").select(*columns), at, columns, exact=True)
    for wrong in (rows.select("c_custkey"), rows):
        try:
            sources.append_rows(wrong, at, columns, exact=True)
        except ValueError:
            continue
        raise AssertionError("an append of other columns was not refused")
    return spark.read.parquet(at).groupBy(*columns).agg(F.count(F.lit(1)).alias("times"))


@query(r"SELECT doc_id, md5(regexp_replace(coalesce(text, ''), '^[\s\x0B\x{85}\p{Z}]+|[\s\x0B\x{85}\p{Z}]+$', '', 'g')) AS digest FROM documents")
def p3_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts between white space of several scripts."""
    given = F.when(F.col("text").isNotNull(), F.concat(F.lit("  \t"), F.col("text"), F.lit("　\n ")))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.clean(given)).alias("digest"))


@query("""SELECT p_partkey, CASE p_partkey % 4
        WHEN 0 THEN split_part(p_name, ' ', 1) || ' (' || p_brand || ', ' || p_size || '; ' || p_type || ')|' || p_type || '|' || split_part(p_name, ' ', 2)
        WHEN 1 THEN p_brand || ' (a (' || p_type || ', b), ' || p_size || ')|' || p_name
        WHEN 2 THEN p_type || ')|' || p_name || '|)' || p_size
        ELSE p_name || '|' || p_type || ' (' || p_brand || ', ' || p_size || '; rest' END AS items FROM part""")
def x1_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of names: with parentheses that hold separators, nested ones, closed without being opened, and never closed."""
    name = lambda i: F.split("p_name", " ")[i]
    size, key = F.col("p_size").cast("string"), F.col("p_partkey") % 4
    cell = (
        F.when(key == 0, F.concat(name(0), F.lit(" ("), "p_brand", F.lit(", "), size, F.lit("; "), "p_type", F.lit("),; "), "p_type", F.lit(" ;"), name(1), F.lit(" ,")))
        .when(key == 1, F.concat("p_brand", F.lit(" (a ("), "p_type", F.lit(", b), "), size, F.lit("); "), "p_name"))
        .when(key == 2, F.concat("p_type", F.lit("), "), "p_name", F.lit(",)"), size))
        .otherwise(F.concat("p_name", F.lit(","), "p_type", F.lit(" ("), "p_brand", F.lit(", "), size, F.lit("; rest")))
    )
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(text.split_nested(cell), "|").alias("items"))


@query("""SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'OCT4' WHEN 1 THEN 'A' || upper(p_name) || ' G2' WHEN 2 THEN 'not specified' WHEN 3 THEN 'ASCL1' WHEN 4 THEN 'C-MYC' WHEN 5 THEN upper(p_type) || ' (' || upper(p_name) || ')'
    WHEN 6 THEN 'NGN2' ELSE upper(p_brand) END AS name FROM part""")
def x3_factor_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with aliases in several spellings and in parentheses, Greek letters, and names that have no alias."""
    key = F.col("p_partkey") % 8
    pick = lambda *forms: F.element_at(F.array(*map(F.lit, forms)), (F.col("p_size") % len(forms) + 1).cast("int"))
    given = (
        F.when(key == 0, pick("Oct-3/4", "POU5F1", "oct 4", "Oct3/4 (Pou5f1)", "OCT4  (OSKM)", " oct3 "))
        .when(key == 1, F.concat(F.lit("α"), "p_name", F.lit("  γ2 ")))
        .when(key == 2, pick("Unknown", " not specified", "NOT SPECIFIED IN TEXT")).when(key == 3, pick("Mash1", "ascl-1", "ASCL1")).when(key == 4, pick("c-Myc", "MYC", "C MYC"))
        .when(key == 5, F.concat("p_type", F.lit(" ("), "p_name", F.lit(")"))).when(key == 6, pick("Neurogenin 2", "NEUROG2", "Ngn-2")).otherwise(F.concat(F.lit(" "), "p_brand"))
    )
    return table(spark, sf_dir, "part").select("p_partkey", text.factor_name(given).alias("name"))


_MISSING = "CASE row_id % 6 WHEN 0 THEN ' Unknown' WHEN 1 THEN 'none' WHEN 2 THEN 'N/A ' WHEN 3 THEN '  ' WHEN 4 THEN 'not specified in text' ELSE factors END"


@query(over_records(f"""SELECT row_id, g = '' OR g IN ('not specified', 'unknown', 'not specified in text') AS unspecified, g = '' OR g IN ('not specified', 'unknown', 'none', 'n/a', 'not specified in text') AS missing,
    g = '' OR g IN ('none', 'small') AS other FROM (SELECT row_id, trim(lower({_MISSING})) AS g FROM rec)"""))
def f6_missing_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What counts as missing, by each set of words, and by one of a caller."""
    given = F.expr(_MISSING)
    sets = {"unspecified": tables.UNSPECIFIED, "missing": tables.MISSING_FACTORS, "other": ("none", "small")}
    return records(spark, sf_dir).select("row_id", *[text.is_unspecified(given, words).alias(n) for n, words in sets.items()])


_NAMED = """CASE l_linenumber % 6 WHEN 0 THEN 'Defined factor' || CASE WHEN l_quantity > 25 THEN 's' ELSE '' END WHEN 1 THEN ' Yamanaka factors ' WHEN 2 THEN 'small molecules, ' || l_returnflag
    WHEN 3 THEN l_returnflag || ' factors' WHEN 4 THEN 'unknown' || CASE WHEN l_quantity > 40 THEN ' protein' ELSE '' END ELSE 'transcription factor' || CASE WHEN l_quantity > 10 THEN 's' ELSE ' ' || l_linestatus END END"""


@query(f"SELECT l_orderkey, l_linenumber, g, len(string_split(g, ',')) = 1 AND {_any('trim(g)', tables.VAGUE_FACTORS)} AS vague FROM (SELECT l_orderkey, l_linenumber, {_NAMED} AS g FROM lineitem)")
def f14_vague(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single items that name nothing, beside lists and names."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.expr(_NAMED).alias("g"))
    return rows.withColumn("vague", rules.is_vague(F.col("g")))


_NOTE = tables.WEAK_EVIDENCE_NOTE.replace("'", "''")


@query(f"""SELECT row_id, CASE WHEN bad THEN 'hide_incomplete_recipe' ELSE validation_action END AS validation_action, CASE WHEN bad THEN 'False' ELSE validation_needs_review END AS validation_needs_review,
    CASE WHEN NOT bad THEN validation_notes WHEN validation_notes = '' THEN '{_NOTE}' ELSE validation_notes || ' || {_NOTE}' END AS validation_notes
    FROM (SELECT c.*, c.validation_action NOT IN ('remove', 'hide_incomplete_recipe', 'hide_single_tf') AND row_id % 3 = 0 AND validation_resolution IN ('evidence_cites_prior_work', 'evidence_is_methods_sentence') AS bad FROM ({ORACLE_SQL["c4_evidence_flags"]}) c)""")
def c5_weak_medium(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with flags for their evidence, of which those of middling confidence are hidden."""
    flagged = QUERIES["c4_evidence_flags"](spark, sf_dir)
    rows = flagged.withColumns({"is_duplicate": F.lit(False), "confidence": F.when(F.col("row_id") % 3 == 0, "medium").otherwise("high")})
    return curation.hide_weak_medium(rows).select("row_id", "validation_action", "validation_needs_review", "validation_notes")
