import corpus_pipeline
import numpy as np
from quern.llm import rules, simhash
from quern.llm.base import table

SF = "/root/testdata/sf0.001"


def shingle_set(text):
    return set(simhash.shingle_hashes(text.encode(), 5).tolist())


def test_stages_in_order(spark):
    docs = table(spark, SF, "documents")
    columns, kept = docs.columns, {r.doc_id: r for r in docs.collect()}
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, SF)
        assert out.columns == columns
        rows = {r.doc_id: r for r in out.collect()}
        assert set(rows) <= set(kept) and len(rows) == out.count()
        if name == "near_dedup":
            sets = {i: shingle_set(r.text) for i, r in kept.items()}
            alike = lambda a, b: a == b or (a and len(a & b) >= 0.8 * len(a | b))
            ids = sorted(kept)
            for i in set(kept) - set(rows):  # each document that goes has a copy before it
                assert any(alike(sets[i], sets[j]) for j in ids if j != i)
            pairs = [(i, j) for n, i in enumerate(ids) for j in ids[n + 1 :] if alike(sets[i], sets[j])]
            missed = [p for p in pairs if p[0] in rows and p[1] in rows]
            assert not missed and pairs
        docs, kept = spark.createDataFrame(list(rows.values()), docs.schema), rows
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in last} == set(kept)


def test_quality_keeps_labelled_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    found = rules.ledger(docs).withColumn("kept", rules.keeps()).join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in found}
    assert n.get((0, True), 0) <= 0.05 * (n.get((0, True), 0) + n[0, False])
    assert n.get((1, False), 0) <= 0.06 * (n.get((1, False), 0) + n[1, True])


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    fills = np.bincount(np.unique([r.sequence_id for r in rows], return_inverse=True)[1], [r.length for r in rows])
    assert fills.max() <= 2048


def test_copies_of_a_page_leave_one(spark):
    """A group of copies passes line dedup whole, and near dedup keeps one; a line of many unlike pages still goes."""
    page = "\n".join(" ".join(f"w{k}x{n}" for n in range(12)) for k in range(5))
    rows = [(i, page, "hot") for i in range(40)]
    rows += [(100 + i, "\n".join(["home about contact", *(" ".join(f"p{i}l{k}n{n}" for n in range(9)) for k in range(4))]), "hot") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    cleaned = corpus_pipeline.line_dedup(spark, docs, SF)
    kept = {r.doc_id: r.text for r in corpus_pipeline.near_dedup(spark, cleaned, SF).collect()}
    assert kept[0] == page and set(kept) == {0, *range(100, 130)}
    assert not any("home" in t for t in kept.values())


def test_odd_documents_through_all_stages(spark, tmp_path):
    """Nulls in every column, repeated rows, clashing columns, an empty table, and one text of five megabytes."""
    rng = np.random.default_rng(8)
    prose = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), rng.integers(3, 9))) for _ in range(n))
    plain = [prose(60) for _ in range(6)]
    vocabulary = prose(500).split()
    long = "\n".join(" ".join(f"{x}" for x in rng.choice(vocabulary, 12)) for _ in range(70_000))
    rows = [(i, t, "en", "s", len(t), "x", 1) for i, t in enumerate(plain)] + [(0, plain[0], "en", "s", len(plain[0]), "x", 1)]
    rows += [(20, None, None, None, None, None, None), (21, "", "en", "s", 0, None, None), (None, plain[1], None, None, None, None, None), (22, prose(80), None, None, None, None, None), (23, long, "en", "s", len(long), "y", 2)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, node string, failed long"
    benchmark = table(spark, SF, "benchmark")
    for name, docs in (("odd", rows), ("none", [])):
        spark.createDataFrame(docs, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        benchmark.write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()
    assert {r.doc_id for r in got} == {*range(6), None, 22, 23}
    assert len([r for r in got if r.doc_id == 0]) == 1 and len(long) > 4_000_000
    fills = np.bincount(np.unique([r.sequence_id for r in got], return_inverse=True)[1], [r.length for r in got])
    assert fills.max() <= 2048
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []
