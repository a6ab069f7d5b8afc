import pytest
from helpers import assert_same, docs_of

from pyspark.sql import functions as F
from quern.llm import linededup, queries, rules
from quern.llm.base import window_hashes

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op1_line_dedup", "op3_license_scans", "op8_quality_rules", "quality_ablations"])
def test_oracle(spark, name):
    assert_same(queries.QUERIES[name](spark, SF), queries.ORACLE_SQL[name])


def test_ledger_on_edge_rows(spark):
    eight = " ".join(f"w{i}" for i in range(8))
    docs = docs_of(spark, [None, "", " \n\t ", "one", f"{eight} x {eight}", f"{eight} {eight}", "a\na\n \n \nb\na", "#$ é|", "long " * 30_000])
    got = {r.doc_id: r for r in rules.ledger(docs).collect()}
    assert [got[i].n_words for i in range(9)] == [0, 0, 0, 1, 17, 16, 4, 2, 30_000]
    assert [got[i].n_repeat_words for i in (3, 4, 5, 8)] == [0, 16, 16, 30_000]
    assert got[6].n_dup_lines == 2 and got[7].n_symbols == 3 and got[7].word_chars == 4
    assert got[0].failed & 1 and got[8].failed & 2


def test_window_hashes_tell_windows_apart(spark):
    words = [str(i % 7 + i // 20) for i in range(60)]
    for size in (1, 2, 3, 5, 8, 13):
        got = spark.createDataFrame([(words,)], "w array<string>").select(window_hashes(F.col("w"), size).alias("h")).first().h
        windows = [tuple(words[i : i + size]) for i in range(60 - size + 1)]
        assert len(got) == len(windows) and len(set(zip(got, windows, strict=True))) == len(set(got)) == len(set(windows))


def test_filter_keeps_columns_and_rows(spark):
    good = " ".join(f"plain{i} text" for i in range(30))
    docs = docs_of(spark, [good, "bad", good, None], [(0, good, None, None, None, None, None)])
    kept = rules.filter_by(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 0, 2]


def test_ablations(spark):
    good = " ".join(f"plain{i} text" for i in range(30))
    docs = docs_of(spark, [good, "bad", "| | |", good.replace(" ", " | ")])
    got = {r.rule: (r.n_failed, r.n_only) for r in rules.ablations(rules.ledger(docs)).collect()}
    assert got["few_words"] == (2, 1) and got["symbols"] == (2, 1) and got["repeated_lines"] == (0, 0)
    assert rules.ablations(rules.ledger(docs.limit(0))).count() == 0


def test_boilerplate_edges(spark):
    texts = [f"same line\nown {i}\n\n same line \t" for i in range(10)] + [None, "", "same line", "other\nother\nother"]
    out = linededup.drop_boilerplate(docs_of(spark, texts, [(99, "same line", "en", None, 9, "x", "y")]))
    got = {r.doc_id: r.text for r in out.collect()}
    assert out.columns == docs_of(spark, []).columns
    assert got[0] == "own 0\n" and got[10] is None and got[11] == "" and got[12] == "" and got[13] == "other\nother\nother" and got[99] == "same line"
    assert linededup.drop_boilerplate(docs_of(spark, [])).count() == 0
