"""Connected components of an edge table."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share; only a local session may do without."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if folder is None and master.startswith("local") and "cluster" not in master:
        folder = "file://" + tempfile.mkdtemp(prefix="quern-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its plan."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _neighbours(edges: DataFrame, both: bool) -> DataFrame:
    """(src, dst) with the smallest of each node's neighbourhood as ``low``."""
    seen = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))) if both else edges
    low = seen.groupBy("src").agg(F.least(F.min("dst"), F.first("src")).alias("low"))
    return seen.join(low, "src")


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of (src, dst): component is the smallest node reachable.

    Alternating large and small stars, a written table each round.
    """
    down = lambda e: e.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).filter("src <> dst").distinct()
    now = written(down(edges), "edges")
    for _ in range(most_rounds):
        parents = now.groupBy("src").count().filter("count > 1").select("src")
        if parents.unionByName(now.select(F.col("dst").alias("src")).join(now.select("src"), "src", "left_semi")).isEmpty():
            roots = now.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
            return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(roots)
        large = down(_neighbours(now, True).filter("dst > src").select(F.col("dst").alias("src"), F.col("low").alias("dst")))
        near = _neighbours(large, False)
        now = written(down(near.select(F.col("dst").alias("src"), F.col("low").alias("dst")).unionByName(near.select("src", F.col("low").alias("dst")))), "edges")
    raise RuntimeError("components did not converge")


def numbered(df: DataFrame, by: str, name: str) -> DataFrame:
    """``df`` with a number for each row in the order of ``by``, from 1: numbers are given inside ranges, so no task sees all rows."""
    ranges = written(df.repartitionByRange(F.col(by)).withColumn("__range", F.spark_partition_id()), "ranges")
    sizes = ranges.groupBy("__range").count()
    before = sizes.withColumn("__before", F.sum("count").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)))  # a row for each range
    within = F.row_number().over(Window.partitionBy("__range").orderBy(by))
    return ranges.withColumn(name, within).join(F.broadcast(before.drop("count")), "__range").withColumn(name, F.col(name) + F.coalesce("__before", F.lit(0))).drop("__range", "__before")


def totalled(df: DataFrame, by: list[Column], weight: str, name: str) -> DataFrame:
    """``df`` with the sum of ``weight`` over the rows that stand before a row in the order of ``by``: sums are made inside ranges, so no task sees all rows."""
    ranges = written(df.repartitionByRange(*by).withColumn("__range", F.spark_partition_id()), "ranges")
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sums = ranges.groupBy("__range").agg(F.sum(weight).alias("__sum"))
    before = sums.select("__range", F.sum("__sum").over(earlier(Window.orderBy("__range"))).alias("__before"))  # a row for each range
    within = F.sum(weight).over(earlier(Window.partitionBy("__range").orderBy(*by)))
    return ranges.withColumn(name, within).join(F.broadcast(before), "__range").withColumn(name, F.coalesce(name, F.lit(0)) + F.coalesce("__before", F.lit(0))).drop("__range", "__before")
