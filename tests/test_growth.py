"""Work that grew faster than it must: what a row costs, and the same results as before."""

import pytest
from pyspark.sql import functions as F

from quern.functions import tables, text
from quern.operators import duplicates
from quern.plans import rulebook


@pytest.fixture(scope="module")
def odd_lines(spark, tmp_path_factory):
    """A folder with a few order lines of odd keys."""
    folder = str(tmp_path_factory.mktemp("lines"))
    lines = [(o, n, p, s) for o, n, p, s in [(0, 1, 0, 0), (3, 2, 1, 1), (15, 1, 2, 2), (29, 2, 79, 3), (30, 1, 80, 4), (31, 1, -7, 5), (-4, 2, -80, 3), (7, 1, None, 4), (8, 1, 6, None), (2**40, 3, 2**41 + 5, 9)]]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long").write.parquet(f"{folder}/lineitem.parquet")
    parts = [(p, f"name {p}", f"Type {p}") for p in {x[2] for x in lines if x[2] is not None}]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_type string").write.parquet(f"{folder}/part.parquet")
    return folder


@pytest.mark.parametrize("of", [rulebook.CELLS, rulebook.FACTORS])
def test_names_are_picked_without_branches(spark, odd_lines, of):
    """names of lines are those of the oracle's CASE, but no branch of a name each is compiled or asked."""
    got = rulebook._names(spark, odd_lines, of, ", ")
    both = spark.read.parquet(f"{odd_lines}/lineitem.parquet").join(spark.read.parquet(f"{odd_lines}/part.parquet"), F.col("l_partkey") == F.col("p_partkey"))
    want = both.selectExpr("l_orderkey", "l_linenumber", f"{rulebook._names_sql(of, ', ')} AS given")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("WHEN") < 10


_ODD = ["", "İPSC line", "ıps", "ipſ and hESC", "mesc\nT-Cell", "CAR-T", "a tcell", "IN VIVO glia reprogramming", "in vivo\nreprogramming", "naïve and NAÏVE stem cell", "Β and ϐ, β", "Müller GLIA", "MÜLLER glia", "patient derived", "from human donors",
    "ratsx rats", "CD4+ T lymphocyte", "tumour then transdifferentiation", "xdcx dc", "a dc", "Ks and nK cell", "nk cells", "human\tcord blood", "mouse model", "pre-B cell", "Sox2 before ATOH1", "esc", "escape"]


def test_words_before_patterns_find_the_same(spark):
    """a pattern is tried only where its word stands; on odd letters too that changes nothing."""
    t = tables
    any_case = ["|".join(t.PLURIPOTENT_TARGET), t.STEM_SOURCE, t.LINEAGE_WORDS, "|".join(t.STATE_WORDS), t.TUMOUR_SOURCE, t.SKELETAL_SOURCE, t.INNER_EAR, t.RETINA, t.GERMLINE, t.IN_VIVO, f"{t.INNATE}|{t.COMMON_CELLS}"]
    ascii_case = [t.HUMAN_DERIVED, *map("|".join, t.SPECIES_IN_TEXT.values()), *map("|".join, t.SPECIES_LINES.values())]
    asked = [(p, "(?iu)") for p in any_case] + [(p, "(?i)") for p in ascii_case] + [(p, "") for p in (t.T_CELL, t.IMMUNE)]
    df = spark.createDataFrame([(x,) for x in _ODD], "c string")
    c = F.col("c")
    wrong = df.select("c", *[(text.found(c, c if f == "" else text.folded(c), p, f) != c.rlike(f + p)).alias(f"p{i}") for i, (p, f) in enumerate(asked)])
    assert [(r.c, asked[i][0]) for r in wrong.collect() for i in range(len(asked)) if r[f"p{i}"]] == []
    assert all(text.needed(a) for p, _ in asked for a in text.alternatives(p))  # every alternative has a word that is looked for first


def test_needed_words():
    assert text.alternatives(r"a(b|c)|[x|y]z|\|q") == ["a(b|c)", "[x|y]z", r"\|q"]
    got = [text.needed(p) for p in (r"\btumou?rs?\b", r"ab+c", r"ab{2}cd\d+x", r"(patient|donor) derived", r"(a|b)?", r"x(a(b)c)y", r"cd4\+", "na[ïi]ve.*stem")]
    assert got == ["tumo", "ab", "cd", " derived", "", "", "cd4", "stem"]


def test_search_blob_of_odd_names(spark):
    """F16, F20: one pattern a name instead of four, the same words."""
    df = spark.createDataFrame([("  β-Cell__x / Y ",), (" T cells-- (CD4+)",), ("",), (None,), ("Müller",)], "c string")
    assert [r[0] for r in df.select(text.search_blob(F.col("c"))).collect()] == ["beta cell x y betacellxy", "t cells cd4 tcellscd4", " ", " ", "m ller mller"]
    assert str(df.select(text.search_blob(F.col("c")))._jdf.queryExecution().optimizedPlan()).lower().count("regexp_replace") <= 4


def test_duplicate_keys_are_made_once_a_writing(spark):
    """rows are aggregated as they are written before keys are made; writings of one key, null and blank stay one group."""
    values = [("A-cell", "t", "SOX2, OCT4"), ("a cell", "t", "OCT4,SOX2"), ("A_cell", "t", "oct3, sox2"), (None, "t", "x"), ("", "t", "X"), ("b", None, None), ("c", "t", "y")]
    cols = "row_id long, pmid string, source_cell string, target_cell string, factors string, paper_type string, year string, source string, confidence string, evidence_sentence string, validation_action string"
    df = spark.createDataFrame([(i, f"p{i}", *v, "research", str(2020 - i), "abstract", "high", "e", "") for i, v in enumerate(values)], cols)
    exact = {r.row_id: (r.is_duplicate, r.preferred_pmid, r.duplicate_group_id) for r in duplicates.exact_duplicates(df).collect()}
    assert exact == {0: (True, "p2", "recipe_0001"), 1: (True, "p2", "recipe_0001"), 2: (False, "", ""), 3: (True, "p4", "recipe_0002"), 4: (False, "", ""), 5: (False, "", ""), 6: (False, "", "")}
    named = df.withColumns({"source_cell_std": F.col("source_cell"), "target_cell_std": F.col("target_cell")})
    broad = {r.row_id: (r.source_cell_broad, r.is_broad_duplicate, r.broad_preferred_pmid) for r in duplicates.broad_duplicates(named).collect()}
    assert broad[3] == ("", True, "p4") and broad[6] == ("c", False, "") and [broad[i][1] for i in range(3)] == [False, False, False] and broad[5][1] is False
    # No key is made of a row: the plan of the result reads keys that are written.
    assert "regexp_replace" not in str(duplicates.exact_duplicates(df).select("duplicate_group_id")._jdf.queryExecution().optimizedPlan())


def _supported(spark, clusters, papers, width):
    """Records of as many clusters and papers each; ids are as wide and don't compress."""
    wide = F.concat(F.col("id").cast("string"), *[F.sha2(F.concat_ws("-", "id", F.lit(i)), 256) for i in range(width // 64)])
    kind = (F.col("id") % clusters).cast("string")
    return spark.range(clusters * papers).select(
        F.col("id").alias("row_id"), wide.alias("pmid"), F.lit("2001").alias("year"), F.lit("t").alias("title"), F.concat(F.lit("cell "), kind).alias("s"), F.lit("x").alias("t"), F.lit("SOX2").alias("factors"))


def test_lists_of_a_cluster_are_written_once(spark, tmp_path):
    """F8: a written result grows with the lists, not with their records times their length; lists and records stay whole."""
    df = _supported(spark, clusters=40, papers=60, width=2048)
    duplicates.support(df, "s", "t").write.parquet(f"{tmp_path}/out")
    ids = df.agg(F.sum(F.length("pmid") + 2)).first()[0]
    assert sum(f.stat().st_size for f in (tmp_path / "out").glob("*.parquet")) < 2 * ids
    read = spark.read.parquet(f"{tmp_path}/out")
    once = read.groupBy("supporting_pmids").count().agg(F.sum(F.length("supporting_pmids") + 2), F.sum("count"), F.count("*")).first()
    assert once == (ids, 2400, 40) and read.select("row_id").distinct().count() == 2400


def test_large_clusters_go_to_several_tasks(spark, monkeypatch):
    """F8: no task has all records of a large cluster, and each finds its lists there."""
    df = _supported(spark, clusters=3, papers=50, width=64).unionByName(_supported(spark, clusters=1, papers=1, width=64).selectExpr("row_id + 1000 as row_id", "pmid", "year", "title", "'alone' as s", "cast(null as string) as t", "factors"))
    key = ["row_id", "supporting_paper_count", "supporting_pmids", "pmids_preview", "papers_preview"]
    whole = sorted(duplicates.support(df, "s", "t").select(*key).collect())
    monkeypatch.setattr(duplicates, "_TASK_ROWS", 8)
    dealt = duplicates.support(df, "s", "t").withColumn("at", F.spark_partition_id()).collect()
    assert sorted(r[:5] for r in dealt) == [tuple(r) for r in whole] and len(whole) == 151
    assert len({r["at"] for r in dealt}) > 12 and max(sum(r["at"] == a for r in dealt) for a in {r["at"] for r in dealt}) < 25
    assert duplicates.support(df.limit(0), "s", "t").count() == 0
