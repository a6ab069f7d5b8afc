from difflib import SequenceMatcher

import duckdb
import pytest
from pyspark.sql import functions as F

from quern.functions import text
from quern.operators import curation, fuzzy, sampling
from quern.sources import tables as sources

SF = "/root/testdata/sf0.001"


def test_selectors_that_fit_no_record_end_the_job(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "pmid string, row_id int")
    both, none = (spark.createDataFrame([(p,) for p in ps], "pmid string") for ps in (["a", "b"], ["a", "c"]))
    assert curation.must_match(rows, both, ["pmid"]).count() == 2
    with pytest.raises(Exception, match="records of"):
        curation.must_match(rows, none, ["pmid"]).collect()
    with pytest.raises(Exception, match="records of"):
        curation.must_match(rows, both, ["pmid"], unique=True).collect()


def test_answers_that_are_not_allowed_end_the_job(spark):
    rows = spark.createDataFrame([(1, " Yes", "x"), (2, "", "x"), (3, "perhaps", None)], "row_id int, valid string, stratum string")
    with pytest.raises(ValueError, match="absent"):
        sampling.checked_answers(rows, "valid", ("yes", "no"), ["absent"])
    with pytest.raises(Exception, match="unexpected answer"):
        sampling.checked_answers(rows, "valid", ("yes", "no"), ["stratum"]).collect()
    good = sampling.checked_answers(rows, "valid", ("yes", "perhaps"), ["stratum"]).orderBy("row_id").collect()
    assert [(r.row_id, r.valid, r.stratum) for r in good] == [(1, "yes", "x"), (3, "perhaps", "")]


def test_versions(spark, tmp_path):
    """The last version published is current, whatever its name."""
    at = f"{tmp_path}/v"
    one, two = (spark.createDataFrame([(n,)], "n int") for n in (1, 2))
    sources.write_first(one, at, "1")
    sources.write_first(two, at, "1")
    assert sources.current(spark, at).first().n == 1
    sources.write_version(two, at, "10")
    sources.write_version(one, at, "9")
    assert sources.current(spark, at).collect() == [(1,)]


def test_number_text(spark):
    cases = {"<5 nM": "5", "1e-7 M": "1e-07", "123456789": "1.2345679e+08", "0.00012345": "0.00012345", "12345678": "12345678", "-3.50": "-3.5", "0.0": "0", "none": "", "100": "100"}
    rows = spark.createDataFrame([(k,) for k in cases], "s string").select("s", text.number_text(F.col("s")).alias("n"))
    assert {r.s: r.n for r in rows.collect()} == cases


def _components(pairs):
    low = {n: n for p in pairs for n in p}
    while True:
        new = dict(low)
        for a, b in pairs:
            new[a] = new[b] = min(new[a], new[b])
        if new == low:
            return low
        low = new


def _made_titles(spark):
    """First lines of documents, and the same with changed words and letters, moved and cut parts, and copies."""
    base = [r.t for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").select(F.substring_index("text", "\n", 1).alias("t")).collect() if r.t][:110]
    more = [t + "s" for t in base[:40:2]] + [t.replace("e", "", 2) for t in base[1:40:3]] + [t[:30] + t[33:] for t in base[:40]] + [t[:10] + "xy" + t[10:50] + t[52:] for t in base[:60]]
    return base + more + [t[: len(t) - len(t) // 9] for t in base[:60]] + base[:50:5] + [t[: len(t) // 2] + "q" + t[len(t) // 2 + 1 :] for t in base[:30]] + ["The " + base[3], "", "?!", None, "a", "b", "a", "to be", "to bee"]


def test_title_groups_against_all_pairs(spark):
    """Every pair of titles of one first character by its ratio, in the order of their ids, and the components of those."""
    df = spark.createDataFrame(list(enumerate(_made_titles(spark))), "id int, title string").repartition(3)
    keys = {r.id: r.t for r in df.select("id", text.title_key(F.col("title")).alias("t")).collect() if r.t}
    first, last = {}, {}
    for i in sorted(keys):
        first.setdefault(keys[i], i)
        last[keys[i]] = i
    alike = lambda x, y: SequenceMatcher(None, x, y).ratio() >= fuzzy.SIMILARITY
    want = {(i, j) for x, i in first.items() for y, j in first.items() if i < j and x[0] == y[0] and (alike(x, y) or (j < last[x] and alike(y, x)))}
    got = {(r.a, r.b) for r in fuzzy.similar_titles(df, "id", "title").collect()}
    assert len(want) > 100 and got == want
    copies = {(first[t], i) for i, t in keys.items() if first[t] != i}
    assert {r.node: r.component for r in fuzzy.title_groups(df, "id", "title").collect()} == _components(want | copies)


def test_title_candidates_are_all_within_the_edit_bound(spark):
    df = spark.createDataFrame(list(enumerate(_made_titles(spark))), "id int, title string")
    for similarity in (0.92, 0.8):
        bound = F.floor((1 - similarity) * (F.length("x") + F.length("y")) + 1e-9)
        one = fuzzy.distinct_titles(df, "id", "title")
        every = one.select(F.col("a").alias("i"), F.col("t").alias("x")).join(one.select(F.col("a").alias("j"), F.col("t").alias("y")), (F.col("i") < F.col("j")) & (F.left("x", F.lit(1)) == F.left("y", F.lit(1))) & (F.levenshtein("x", "y") <= bound))
        want = {(r.i, r.j) for r in every.collect()}
        assert {(r.a, r.b) for r in fuzzy.candidates(df, "id", "title", similarity).collect()} == want and len(want) > 100


def test_pieces_share_no_hot_first_letter(spark):
    """Titles of one first letter and length meet by their pieces alone."""
    rows = [(i, "t " + " ".join(str((i * 7919 + k * 104729) % 99991) for k in range(9))) for i in range(400)]
    titles = fuzzy.distinct_titles(spark.createDataFrame(rows, "id int, title string"), "id", "title").select(F.col("a").alias("id"), F.col("t").cast("binary").alias("t"))
    met = fuzzy.piece_index(titles, 0.08).join(fuzzy.piece_probes(titles, 0.08), "k").filter("id <> of").select("id", "of").distinct().count()
    assert met < 400 * 399 / 20


def test_pieces_are_never_sent_whole(spark):
    """Written titles are small, their pieces are not: no side of a join that grows with the letters goes through the driver."""
    df = spark.createDataFrame(list(enumerate(_made_titles(spark))), "id int, title string")
    plan = fuzzy.candidates(df, "id", "title")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_decisions_and_export_over_written_pairs(spark):
    """Groups, keepers and the sheet by SQL of another engine over the pairs that Spark found."""
    titles = _made_titles(spark)
    rows = [(i, t, None if i % 11 == 0 else str(2000 + i % 9) if i % 7 else "n/a", ("bioRxiv", "Cell", "medRxiv preprint", None)[i % 4]) for i, t in enumerate(titles)]
    papers = spark.createDataFrame(rows, "pmid int, title string, year string, journal string")
    groups = fuzzy.title_groups(papers, "pmid", "title")
    con = duckdb.connect()
    con.register("pairs", fuzzy.similar_titles(papers, "pmid", "title").toPandas())
    con.register("papers", papers.select("*", text.title_key(F.col("title")).alias("t")).toPandas())
    con.execute("""CREATE TABLE m AS WITH RECURSIVE copy AS (SELECT min(pmid) OVER (PARTITION BY t) AS a, pmid AS b FROM papers WHERE t <> ''),
        e AS (SELECT a, b FROM pairs UNION SELECT a, b FROM copy WHERE a <> b), pair AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
        reach(node, other) AS (SELECT a, a FROM pair UNION SELECT r.node, p.b FROM reach r JOIN pair p ON p.a = r.other),
        g AS (SELECT node, min(other) AS component FROM reach GROUP BY node)
        SELECT component::INT AS component, pmid, title, year, journal, coalesce(regexp_matches(lower(journal), 'biorxiv|medrxiv|research square|preprint'), false) AS preprint, coalesce(try_cast(year AS INT), 0) AS y FROM g JOIN papers ON pmid = node""")
    key = lambda r: tuple(None if v is None or v != v else v for v in r)
    want = con.sql("SELECT m.pmid, k.pmid FROM m JOIN (SELECT component, pmid, row_number() OVER (PARTITION BY component ORDER BY y DESC, pmid DESC) AS n FROM m WHERE NOT preprint) k USING (component) WHERE n = 1 AND preprint").fetchall()
    assert sorted(map(tuple, fuzzy.preprint_decisions(groups, papers, "pmid").collect())) == sorted(want) and len(want) > 20
    want = con.sql("""WITH k AS (SELECT component, pmid, bool_or(preprint) OVER (PARTITION BY component) AS mixed, row_number() OVER (PARTITION BY component ORDER BY preprint, y DESC, pmid DESC) AS n FROM m)
        SELECT component, m.pmid, title, year, journal, preprint, CASE WHEN mixed THEN k.pmid END FROM m JOIN k USING (component) WHERE n = 1""").fetchall()
    got = fuzzy.review_export(groups, papers, "pmid")
    assert got.columns == ["component", "pmid", "title", "year", "journal", "preprint", "keep"]
    assert sorted(map(key, got.collect()), key=repr) == sorted(map(key, want), key=repr)
    assert fuzzy.review_export(fuzzy.title_groups(papers.limit(0), "pmid", "title"), papers, "pmid").count() == 0


def test_better_evidence(spark):
    rows = spark.createDataFrame([("good", "good"), ("weak", "good"), ("weak", "weak"), ("none", "weak"), ("none", "none")], "a string, b string")
    made = curation.better_evidence(F.lit("first"), F.col("a"), F.lit("second"), F.col("b"))
    assert [tuple(r) for r in rows.select(*made).collect()] == [("first", "good"), ("second", "good"), ("first", "weak"), ("second", "weak"), ("first", "none")]


def test_pieces_that_meet_by_chance_go_no_further(spark):
    """F1 to F5: titles of the same few syllables share pieces everywhere; only those that stay alike behind a piece are read whole, and no alike pair is lost."""
    pick = lambda i, n: ("the", "tion", "er", "an", "in", "onre", "sh", "ou")[i * 7919 % 10007 * (n + 3) % 8191 % 8]
    base = ["t " + " ".join(pick(i, n) + pick(i + 5, n * n) for n in range(40)) for i in range(150)]
    # As many letters changed as can be, in even steps, so that few pieces stand and none with others
    near = ["".join(c if n % 7 or not n else "q" for n, c in enumerate(t)) for t in base[:40]] + [t[:1] + "x" * 13 + t[1:] for t in base[:20]]
    df = spark.createDataFrame(list(enumerate(base + near)), "id int, title string")
    keys = {r.t: r.a for r in fuzzy.distinct_titles(df, "id", "title").collect()}
    want = {(min(i, j), max(i, j)) for x, i in keys.items() for y, j in keys.items() if i < j and fuzzy.edit_distance(x, y, int(0.08 * (len(x) + len(y)) + 1e-9)) >= 0}
    assert {(r.a, r.b) for r in fuzzy.candidates(df, "id", "title").collect()} == want and len(want) >= 50
    assert fuzzy.candidates(df, "id", "title", near=False).count() < len(want) + 500  # of some 22,000


def test_long_lines_of_repeated_words(spark):
    """F1 to F5: a line of thousands of letters repeats its words; like pieces are one row, and pairs are those of all pairs."""
    lines = [w * (3000 // len(w)) for w in ("the ", "that ", "of thha ", "er in ")]
    mixed = [a[:1400] + "q" + b[: 1600 + 90 * k] for k in range(3) for a in lines for b in lines]
    rows = list(enumerate([*lines, *mixed, lines[0][:2100], "x" + lines[0][:2040], lines[1][:2000]]))
    df = spark.createDataFrame(rows, "id int, title string")
    rate = fuzzy.piece_probes(df.select("id", text.title_key("title").cast("binary").alias("t")), 0.08).count() / sum(len(t) for _, t in rows)
    assert rate < 0.4  # more than one a letter otherwise
    con = duckdb.connect()
    for first in (True, False):
        named = fuzzy.distinct_titles(df, "id", "title").toPandas()
        con.register("n", named)
        start = "left(x.t, 1) = left(y.t, 1) AND" if first else ""
        want = con.sql(f"SELECT least(x.a, y.a), greatest(x.a, y.a) FROM n x JOIN n y ON x.a < y.a AND {start} levenshtein(x.t, y.t) <= floor(0.08 * (length(x.t) + length(y.t)) + 0.000000001)").fetchall()
        assert sorted((r.a, r.b) for r in fuzzy.candidates(df, "id", "title", first=first).collect()) == sorted(want) and len(want) > 10


def test_edit_distance():
    con = duckdb.connect()
    words = ["a", "b", "ab", "abcabc", "kitten", "sitting", "the cat sat", "that cat", "x" * 300, "x" * 150 + "y" + "x" * 140, ("ab" * 200)[3:], "ba" * 180]
    for x in words:
        for y in words:
            apart = con.execute("SELECT levenshtein(?, ?)", [x, y]).fetchone()[0]
            assert [fuzzy.edit_distance(x, y, n) for n in (apart, apart - 1, apart + 9)] == [apart, -1, apart]


def test_title_groups_whatever_they_begin_with(spark):
    """F8: a title that differs in its first letter, or has a word less in front, is found as well."""
    titles = _made_titles(spark)
    more = ["z" + t[1:] for t in titles[:30] if len(t) > 12] + [t.split(" ", 1)[1] for t in titles[:60] if len(t) > 90 and " " in t]
    df = spark.createDataFrame(list(enumerate([*titles, *more])), "id int, title string").repartition(3)
    keys = {r.id: r.t for r in df.select("id", text.title_key(F.col("title")).alias("t")).collect() if r.t}
    first, last = {}, {}
    for i in sorted(keys):
        first.setdefault(keys[i], i)
        last[keys[i]] = i
    alike = lambda x, y: (lambda m: m.real_quick_ratio() >= fuzzy.SIMILARITY and m.quick_ratio() >= fuzzy.SIMILARITY and m.ratio() >= fuzzy.SIMILARITY)(SequenceMatcher(None, x, y))
    want = {(i, j) for x, i in first.items() for y, j in first.items() if i < j and (alike(x, y) or (j < last[x] and alike(y, x)))}
    assert {(r.a, r.b) for r in fuzzy.similar_titles(df, "id", "title", first=False).collect()} == want
    assert len({(i, j) for i, j in want if keys[i][0] != keys[j][0]}) > 20
    copies = {(first[t], i) for i, t in keys.items() if first[t] != i}
    assert {r.node: r.component for r in fuzzy.title_groups(df, "id", "title", first=False).collect()} == _components(want | copies)


def test_title_review_of_other_first_letters(spark, tmp_path):
    """F8: the query's sheet has them; the queries whose SQL joins by first letter don't."""
    from quern.plans import catalog

    line = "%s cell lines of the mouse are made anew by factors that were known before"
    spark.createDataFrame([(i, t) for i, t in enumerate([line % "Stem", line % "stem", line % "Item", "Another thing entirely"])], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted((r.pmid, r.component) for r in catalog.QUERIES["d5_title_review"](spark, str(tmp_path)).collect()) == [(0, 0), (1, 0), (2, 0)]
    assert sorted(r.pmid for r in catalog.QUERIES["d5_edit_review"](spark, str(tmp_path)).collect()) == [0, 1]


def test_blank_evidence_that_was_not_lost_stays_blank(spark, tmp_path):
    """records whose document is missing or blank have no evidence; only those that lost theirs get another's."""
    from quern.plans import catalog

    for name in ("orders", "customer", "lineitem", "part"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    documents = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id % 5 <> 1")
    odd = F.when(F.col("doc_id") % 7 == 0, F.lit(None)).when(F.col("doc_id") % 7 == 1, " \n ").otherwise(F.col("text"))
    documents.withColumn("text", odd).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    for name in ("orders", "customer", "lineitem", "part", "documents"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    want = con.sql(catalog.ORACLE_SQL["j12_restore"]).fetchall()
    assert sorted(map(tuple, catalog.QUERIES["j12_restore"](spark, str(tmp_path)).collect())) == sorted(want)
    assert sum(i % 2 == 1 and not e.strip() for i, e in want) > 50


def test_near_copies_are_linked_by_few_pairs(spark, monkeypatch):
    """F1 to F4: of a group of near copies a pair each is tried, not all pairs; the groups are those of all pairs."""
    text_ = "factors that turn one cell into another kind of cell without a stem cell between them"
    rows = [(i, text_[: 8 + i] + "q" + text_[8 + i :]) for i in range(40)] + [(90, "a wholly different line of words"), (91, "wholly different lines of words")]
    df = spark.createDataFrame(rows, "id int, title string")
    asked, alike = [], fuzzy._alike
    monkeypatch.setattr(fuzzy, "_alike", lambda found, *how: asked.append(found.count()) or alike(found, *how))
    for blocks in (True, False):
        asked.clear()
        every = {(r.a, r.b) for r in fuzzy.similar_titles(df, "id", "title", blocks=blocks).collect()}
        tried = asked.pop()
        got = {r.node: r.component for r in fuzzy.title_groups(df, "id", "title", blocks=blocks).collect()}
        assert got == _components(every) and sum(asked) < tried / 5 and tried > 700
