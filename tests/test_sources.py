import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quern.operators import curation, duplicates, pairs, responses, review, rules, sampling
from quern.sources import markup
from quern.sources import tables as sources


def test_text_scan_keeps_every_cell_as_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text('pmid,title,year\n007,"two\nlines, ""quoted""",\n8,,1999\n')
    rows = sources.scan_text(spark, str(tmp_path / "a.csv"), ["pmid", "title", "year"]).collect()
    assert [tuple(r) for r in rows] == [("007", 'two\nlines, "quoted"', ""), ("8", "", "1999")]


def test_optional_scan_and_guards(spark, tmp_path):
    assert sources.scan_optional(spark, f"{tmp_path}/none", "pmid string").count() == 0
    rows = spark.createDataFrame([("1", "x", 2)], "pmid string, a string, b int")
    with pytest.raises(ValueError, match="missing columns"):
        sources.append_rows(rows, f"{tmp_path}/t", ["pmid", "c"])
    with pytest.raises(ValueError, match="extra columns"):
        sources.append_rows(rows, f"{tmp_path}/t", ["pmid", "a"], exact=True)
    sources.append_rows(rows, f"{tmp_path}/t", ["pmid", "a"])
    sources.append_rows(rows, f"{tmp_path}/t", ["pmid", "a"])
    assert sources.scan_optional(spark, f"{tmp_path}/t", "pmid string, a string").count() == 2
    sources.write_version(rows, f"{tmp_path}/v", "1")
    with pytest.raises(Exception, match="(?i)exist"):
        sources.write_version(rows, f"{tmp_path}/v", "1")


def test_requested_keys_keep_their_order(spark):
    assert [tuple(r) for r in sources.requested(spark, [" b", "a", "", "b"]).orderBy("pos").collect()] == [("b", 0), ("a", 1)]


def test_sections(spark):
    html = "<h1>Intro</h1><p>no</p><h2>Materials &amp; <i>Methods</i></h2><p>first <b>x</b></p><div><p>second</p></div><h2>Results</h2><p>" + "r" * 50 + "</p>"
    pages = spark.createDataFrame([(1, html), (2, None), (3, "<p>loose</p>"), (4, "<h2>Methods</h2><p></p>")], "page_id int, html string")
    got = {r.page_id: (r.methods, r.results) for r in sources.sections(pages, limit=20, methods="method", results="result").collect()}
    assert got == {1: ("first x second", "r" * 20)}


def test_nested_sections():
    of = lambda html: [(t, b.strip()) for t, b in markup.blocks_of(html, "p")]
    assert of("<sec><title>A</title><p>1</p><sec id='x'><title>B <i>b</i></title><p>2</p></sec><p>3</p></sec><p>4</p>") == [(["A"], "1"), (["B  b ", "A"], "2"), (["A"], "3")]
    assert of("<sec><p>1</p><title>late</title><title>second</title><p>2</p></sec>") == [([""], "1"), (["late"], "2")]
    assert of("<h1>One</h1><p>1</p><h3>Two</h3><p>2</p><h2>Three</h2><p>3</p><h1>Four</h1><p>4</p>") == [(["One"], "1"), (["Two", "One"], "2"), (["Three", "One"], "3"), (["Four"], "4")]
    assert of("<h1>A</h1><p>x<!-- </p><h1>no</h1> --> y<script>'</p>'</script></p><P CLASS='q'>up</P>") == [(["A"], "x y"), (["A"], "up")]
    assert of("</sec></p><sec><title>A</title><p>open<sec><title>B</title><p>in</p></sec></p><p/><p>end") == [(["B", "A"], "in")]
    assert of("<sec><title>A</title><sec><p>1</p></sec></sec></sec><sec/><sec><title>C</title><p>a<p>b</p></sec>") == [(["", "A"], "1"), (["C"], "a b")]
    assert of("") == [] and of("< p > a < b <p") == []


def test_articles_of_a_file(spark, tmp_path):
    body = "".join(f"<article id='{i}'>\n<sec><title>Methods</title><p>{'x' * i}</p></sec>\n</article>\n" for i in range(1, 200))
    (tmp_path / "a.xml").write_text(f"<?xml version='1.0'?><set><articles>{body}</articles></set>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    rows = sources.sections(sources.scan_articles(spark, f"{tmp_path}/a.xml"), methods="method").collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(len(r.methods) for r in rows) == list(range(1, 200))


def test_responses(spark):
    raw = ['```json\n{"has_recipe": true, "paper_type": "research", "entries": [{"factors": "A", "recipe_status": "positive", "confidence": "high"}, {"factors": "B", "recipe_status": "failed"}]}\n```',
           '{"has_recipe": false, "entries": []}', "nothing", '{"has_recipe": true, "entries": [{"factors": "C"}, {"factors": "D", "species": "mouse", "recipe_status": " Unclear", "confidence": "high", "notes": "n"}]} thanks', None]
    rows = spark.createDataFrame(list(enumerate(raw)), "row_id int, raw string")
    parsed = responses.parse(rows, "raw")
    assert [r.parsed for r in parsed.orderBy("row_id").collect()] == [True, True, False, True, False]
    got = sorted(tuple(r[c] for c in ("row_id", "factors", "confidence", "recipe_status", "needs_review", "species", "notes")) for r in responses.entries(parsed, "row_id").collect())
    assert got == [(0, "A", "high", "positive", False, "", ""), (3, "C", "", "successful", False, "", ""), (3, "D", "low", "unclear", True, "mouse", "n")]
    yes, no = responses.split_answers(parsed)
    assert (yes.count(), no.count()) == (2, 3)


def test_excerpt_takes_best_sentences_in_order(spark):
    body = "Nothing here. We used OCT4 and SOX2. Plain. OCT4 again! The end."
    got = spark.range(1).select(responses.excerpt(F.lit(body), ["oct4", "sox2"], 2, 100).alias("a"), responses.excerpt(F.lit(body), ["sox2"], 2, 10).alias("b"), responses.excerpt(F.lit(None).cast("string"), ["x"], 2, 9).alias("c")).first()
    assert tuple(got) == ("We used OCT4 and SOX2. OCT4 again!", "We used OC", "")


def test_evidence_rules(spark):
    said = ["We previously reported this.", "It failed to convert cells.", "Cells were isolated from mice.", "We made neurons.", "We previously reported that it failed to convert cells."]
    rows = spark.createDataFrame([(i, s, "medium", "abstract", "defined factors" if i == 3 else "OCT4", "", "", "", "", False) for i, s in enumerate(said)],
        "row_id int, evidence_sentence string, confidence string, source string, factors string, validation_action string, validation_resolution string, validation_needs_review string, validation_notes string, is_duplicate boolean")
    got = {r.row_id: r for r in rules.evidence_flags(rows).collect()}
    assert [got[i].validation_resolution for i in range(5)] == ["evidence_cites_prior_work", "possible_negative_needs_review", "evidence_is_methods_sentence", "medium_abstract_vague_factors", "possible_negative_needs_review"]
    assert got[4].validation_notes.count(" | ") == 1 and got[3].validation_action == "hide_incomplete_recipe"
    hidden = {r.row_id: r.validation_action for r in curation.hide_weak_medium(rules.evidence_flags(rows)).collect()}
    assert [hidden[i] for i in range(3)] == ["hide_incomplete_recipe", "", "hide_incomplete_recipe"]


def test_samples_have_exact_sizes_and_repeat(spark):
    rows = spark.range(200).select(F.col("id").alias("row_id"), (F.col("id") % 3).cast("string").alias("s"))
    one, two = (sampling.stratified(rows, "s", {"0": 5, "1": 2}, seed=4).collect() for _ in range(2))
    assert sorted(map(tuple, one)) == sorted(map(tuple, two)) and len(one) == 7 and sorted(r.no for r in one) == list(range(1, 8))
    assert sampling.equal_allocation(rows, "s", 20).count() == 20 and sampling.equal_allocation(rows.limit(0), "s", 20).count() == 0


def test_labels_of_groups(spark):
    rows = spark.createDataFrame([("k", 1, "binder", 1, "r1"), ("k", 2, "non-binder", 0, "r2"), ("q", 3, "unclear", 0, "r3"), ("q", 4, "binder", 1, "r3")], "pair string, row_id int, label string, rank int, ref string")
    got = {r.pair: (r.label, r.row_id, r.ref, r.removed) for r in duplicates.collapse_pairs(rows, "pair", "label", [F.col("rank")], "ref").collect()}
    assert got == {"k": ("unclear", 2, "r2; r1", 1), "q": ("binder", 3, "r3", 1)}


def test_options_put_preferred_first(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("z",), ("",), ("z",)], "v string")
    assert [r.value for r in review.options(rows, "v", ["z", "none"]).collect()] == ["z", "a", "b"]


def test_a_batch_of_pages_is_cut_into_pieces_of_bounded_size():
    pages = pa.array(["a" * 10, None, "b" * 30, "", "c" * 5, "d" * 5, "e" * 10])
    cut = list(markup.pieces(pages, 20))
    assert [x for p in cut for x in p.to_pylist()] == pages.to_pylist() and [len(p) for p in cut] == [3, 4]
    assert list(markup.pieces(pages.slice(0, 0))) == []


def test_agreement_is_one_row_a_record_in_the_shuffle(spark):
    rows = spark.createDataFrame([(1, "", True, "a", "x"), (1, "", True, None, "x"), (1, "late", False, "b", None), (2, "", True, "a", "x"), (2, None, None, "b", "x"), (3, "", True, "a", ""), (3, "", True, "b", "y"), (4, "e", None, None, None)], "k int, error string, is_recipe boolean, s string, f string")
    got = responses.field_agreement(rows, "k", {"s": F.col("s")}, {"f": F.col("f")})
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect())) == [(1, "yes", "yes", "yes"), (2, "no", "yes", "yes"), (3, "yes", "no", "no"), (4, "no", "n/a", "n/a")]


def test_a_sample_of_pairs_reads_them_collapsed(spark):
    """Neither the rules of the sources nor the collapse stand in the plan of a sample, which reads its pairs several times."""
    designs = spark.createDataFrame([(1, "d1", "", "ACD", "T", "CDE", "strong", "x", "<5 nM", "VHH"), (2, "d2", "n", "ACD", "T", "CDE", "no", "", "7.50", "VHH")], "row_id long, design_id string, binder_name string, binder_sequence string, target string, target_sequence string, label string, binding_strength string, value string, design_class string")
    papers = spark.createDataFrame([(3, "b1", "ACD", "T", "CDE", "no", "12", "mAb")], "row_id long, binder_id string, binder_sequence string, target string, target_sequence string, label string, binding_affinity_nm string, source_publication string")
    found = pairs.pilot_tracks(designs, papers, 5)["antibody"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan.lower() and "collect_list" not in plan
    assert [r.source_reference for r in found.collect()] == ["d1; d2; mAb"]
