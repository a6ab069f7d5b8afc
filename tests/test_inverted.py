import pytest

from quern.functions import text
from quern.operators import filters, inverted

ROWS = ["Motor neurons", "motor neuron-like", "neuron motor", "iPS cell", "induced pluripotent stem cells", "T-cells (CD4+)", "cardio myocyte", "cardiac fibroblast", "B lymphocyte", "", None, "motor motor neuron", "stem cell", "stemcell"]


@pytest.fixture(scope="module")
def rows(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, t, "x y") for i, t in enumerate(ROWS)], "id long, name string, other string")
    return df.withColumn("blob", text.search_blob(F.col("name"), F.col("other"))), inverted.build(df, "id", "name", "other")


@pytest.mark.parametrize("query", ["motor neurons", "neuron", "iPS", "T cell", "cardiomyocytes fibroblast", "stem cell", "stem", "mot neu", "y", "zzz", "12", "motorneuronxy", "b lymphocyte"])
def test_search_by_index_finds_what_search_by_text_finds(rows, query):
    from pyspark.sql import functions as F

    df, index = rows
    want = {r.id for r in df.filter(filters.search(query, F.col("blob"), "id")).collect()}
    assert {r.key for r in inverted.search(index, query).collect()} == want


def test_plan_reads_ranges_of_tokens_alone(rows):
    _, index = rows
    plan = inverted.search(index, "motor neurons")._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(token,neuron" in plan and "EqualTo(token,motor)" in plan and "blob" not in plan
