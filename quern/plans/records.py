"""The record view over the driver's tables: one curated record for each order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, lineitem, part, documents = (table(spark, sf_dir, n) for n in ("orders", "customer", "lineitem", "part", "documents"))
    lines = lineitem.select("l_orderkey", "l_partkey", "l_linestatus").join(part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"), "left")
    factors = lines.groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("p_type")), ", ").alias("types"), F.max("l_linestatus").alias("status"))
    count = documents.agg(F.count(F.lit(1))).scalar()  # part of the plan: nothing runs before the query does
    texts = documents.select("doc_id", F.left("text", F.lit(80)).alias("title"), F.left("text", F.lit(400)).alias("evidence_sentence"))
    joined = (
        orders.join(customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(factors, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(texts, F.col("o_orderkey") % count == F.col("doc_id"), "left")
    )
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    return joined.select(
        key.alias("row_id"),
        F.col("o_custkey").cast("string").alias("pmid"),
        F.col("c_mktsegment").alias("source_cell"),
        F.col("o_orderpriority").alias("target_cell"),
        F.coalesce("types", F.lit("not specified")).alias("factors"),
        F.when(F.col("o_orderstatus") == "O", "research").when(F.col("o_orderstatus") == "F", "review").otherwise("other").alias("paper_type"),
        F.when(price >= 300000, "high").when(price >= 100000, "medium").otherwise("low").alias("confidence"),
        F.year("o_orderdate").cast("string").alias("year"),
        F.when(F.col("status") == "F", "fulltext").otherwise("abstract").alias("source"),
        F.when(key % 4 == 0, "").when(key % 3 == 0, "mouse").otherwise("human").alias("species"),
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("evidence_sentence", F.lit("")).alias("evidence_sentence"),
        F.when(key % 50 == 0, "remove").when(key % 77 == 0, "mark_duplicate").otherwise("").alias("validation_action"),
    )


RECORDS_SQL = """
    f AS (SELECT l_orderkey, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS types, max(l_linestatus) AS status
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
    rec AS (SELECT o_orderkey AS row_id, CAST(o_custkey AS VARCHAR) AS pmid, c_mktsegment AS source_cell, o_orderpriority AS target_cell,
        coalesce(types, 'not specified') AS factors,
        CASE o_orderstatus WHEN 'O' THEN 'research' WHEN 'F' THEN 'review' ELSE 'other' END AS paper_type,
        CASE WHEN o_totalprice >= 300000 THEN 'high' WHEN o_totalprice >= 100000 THEN 'medium' ELSE 'low' END AS confidence,
        CAST(year(o_orderdate) AS VARCHAR) AS year, CASE WHEN status = 'F' THEN 'fulltext' ELSE 'abstract' END AS source,
        CASE WHEN o_orderkey % 4 = 0 THEN '' WHEN o_orderkey % 3 = 0 THEN 'mouse' ELSE 'human' END AS species,
        coalesce(left(d.text, 80), '') AS title, coalesce(left(d.text, 400), '') AS evidence_sentence,
        CASE WHEN o_orderkey % 50 = 0 THEN 'remove' WHEN o_orderkey % 77 = 0 THEN 'mark_duplicate' ELSE '' END AS validation_action
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN f ON o_orderkey = l_orderkey
        LEFT JOIN documents d ON d.doc_id = o_orderkey % (SELECT count(*) FROM documents))"""


def over_records(select: str, *views: str) -> str:
    """Oracle SQL over the record view ``rec`` and further views."""
    return "WITH " + ",".join([RECORDS_SQL, *views]) + "\n" + select
