from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from quern.operators import curation
from quern.sources import manifest
from quern.sources import tables as sources
from quern.streaming import ingest


def test_of_two_writers_one_wins(spark, tmp_path):
    at = f"{tmp_path}/v"
    one, two = (spark.createDataFrame([(n,)], "n int") for n in (1, 2))
    first = sources.write_version(one, at, "1")
    sources.write_version(two, at, "2", first)
    with pytest.raises(manifest.Conflict):
        sources.write_version(one, at, "3", first)
    assert sources.current(spark, at).first().n == 2 and manifest.Versions(spark, at).head()["number"] == 1
    with pytest.raises(ValueError, match="exists"):
        sources.write_version(one, at, "2")
    assert sources.current(spark, at, "1").first().n == 1
    with pytest.raises(ValueError, match="no version"):
        sources.current(spark, f"{tmp_path}/none")


def test_a_name_is_claimed_once_by_many_at_a_time(spark, tmp_path):
    (tmp_path / "c").mkdir()
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda i: manifest.claim(spark, f"{tmp_path}/c/0", f"writer {i}"), range(24)))
    assert sum(got) == 1 and manifest.read_file(spark, f"{tmp_path}/c/0") == f"writer {got.index(True)}"
    assert [p.name for p in (tmp_path / "c").iterdir() if not p.name.endswith(".crc")] == ["0"]


def test_versions_through_another_file_system(spark, tmp_path):
    """Beyond local disks a rename that doesn't overwrite decides."""
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.quern.link./in", f"file://{tmp_path}")
    at = "viewfs://quern/in/v"
    rows = spark.createDataFrame([(1,)], "n int")
    first = sources.write_version(rows, at, "1")
    sources.write_version(rows.limit(0), at, "2", first)
    with pytest.raises(manifest.Conflict):
        sources.write_version(rows, at, "3", first)
    assert sources.current(spark, at).count() == 0 and sources.current(spark, at, "1").count() == 1


def test_a_reader_sees_one_folder(spark, tmp_path):
    for n in range(3):
        head = sources.write_version(spark.range(n, n + 1), f"{tmp_path}/v", str(n))
    files = sources.current(spark, f"{tmp_path}/v").inputFiles()
    assert files and all(head["path"] in f for f in files)


def _put(spark, tmp_path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")


def test_three_runs_with_failures_and_a_kill(spark, tmp_path, monkeypatch):
    schema = "id long, v string"

    def process(rows):
        reason = F.when(F.col("v") == "bad", "no answer").when(F.col("v") == "busy", ingest.AGAIN)
        return rows.filter("v <> 'nothing'").withColumn(ingest.FAILED, reason)

    run = lambda: ingest.ingest(spark, f"{tmp_path}/in", schema, f"{tmp_path}/out", "id", f"{tmp_path}/cp", process)
    _put(spark, tmp_path, [(1, "a"), (1, "a"), (2, "bad"), (3, "busy"), (4, "nothing"), (None, "n")], schema)
    table = run()
    assert sorted(map(tuple, table.rows().collect()), key=repr) == sorted([(1, "a"), (None, "n")], key=repr)
    assert [tuple(r) for r in table.failures().collect()] == [(2, "no answer")]

    _put(spark, tmp_path, [(2, "good now"), (3, "good now"), (4, "good now"), (5, "e"), (None, "n")], schema)
    publish = manifest.Versions.publish

    def killed(*_, **__):
        raise RuntimeError("killed before the commit")

    monkeypatch.setattr(manifest.Versions, "publish", killed)
    with pytest.raises(Exception, match="killed"):
        run()
    monkeypatch.setattr(manifest.Versions, "publish", publish)
    assert table.rows().count() == 2
    table = run()
    assert sorted(map(tuple, table.rows().collect()), key=repr) == sorted([(1, "a"), (3, "good now"), (5, "e"), (None, "n")], key=repr)
    assert run().rows().count() == 4 and manifest.Versions(spark, f"{tmp_path}/out").head()["number"] == 1


def test_a_batch_that_is_run_again_adds_nothing(spark, tmp_path):
    table = ingest.KeyedTable(spark, f"{tmp_path}/t", "id", "id long")
    assert table.add(spark.range(3), 0, "s") and not table.add(spark.range(9), 0, "s")
    assert table.add(spark.range(5), 0, "another stream")
    assert sorted(r.id for r in table.rows().collect()) == [0, 1, 2, 3, 4]


def test_only_the_buckets_of_a_batch_are_read(spark, tmp_path):
    table = ingest.KeyedTable(spark, f"{tmp_path}/t", "id", "id long", buckets=16)
    table.add(spark.range(2000), 0)
    head = table.versions.head()
    bucket = spark.range(7, 8).select(table._bucket().alias("b")).first().b
    files = table.known(head, [bucket])
    assert 2000 / 40 < files.count() < 2000 / 6
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan
    assert table.unseen(spark.createDataFrame([(7,), (5000,)], "id long"), head).collect() == [(5000,)]


def test_index_is_compacted(spark, tmp_path):
    table = ingest.KeyedTable(spark, f"{tmp_path}/t", ["a", "b"], "a string, b long", buckets=4, compact=3)
    edge = lambda *e: spark.createDataFrame(list(e), "a string, b long")
    for n in range(9):
        table.add(edge(("x", n), ("x", n - 1), ("y", None), (None, None), (None, n % 2)), n)
        assert len(table.versions.head()["index"]) <= 3
    got = sorted(map(tuple, table.rows().collect()), key=repr)
    assert got == sorted([("x", n) for n in range(-1, 9)] + [("y", None), (None, None), (None, 0), (None, 1)], key=repr)
    assert table.add(edge(), 9) and table.rows().count() == len(got)


def test_edges_with_nulls_over_runs(spark, tmp_path):
    schema = "a string, b string"
    _put(spark, tmp_path, [("r", "1"), ("r", "1"), ("s", None), (None, "2"), (None, None)], schema)
    run = lambda: ingest.running_edges(spark, f"{tmp_path}/in", schema, f"{tmp_path}/out", f"{tmp_path}/cp")
    run()
    _put(spark, tmp_path, [("s", None), (None, "2"), (None, None), ("t", "3")], schema)
    assert sorted(map(tuple, run().rows().collect()), key=repr) == sorted([("r", "1"), ("s", None), (None, "2"), (None, None), ("t", "3")], key=repr)


def test_proposals_are_published_once_and_undone(spark, tmp_path):
    """A stale proposal is refused, a second writer conflicts, and the audit table restores what it changed, nulls too."""
    at, fields = f"{tmp_path}/t", ["note", "flag"]
    rows = spark.createDataFrame([(1, "p1", None, "a"), (2, "p2", "old", "b"), (3, "p3", "old", "c")], "row_id int, pmid string, note string, flag string")
    sources.write_version(rows, at, "1")
    updates = [(1, "p1", "low", '{"note": "new", "flag": ""}'), (2, "p2", "low", '{"note_append": "more", "flag": "b"}'), (3, "p3", "low", '{"note": "new"}'), (3, "p3", "high", '{"flag": "z"}')]
    made = spark.createDataFrame(updates, "row_id int, __p string, write_risk string, proposed_updates string")
    proposed = curation.stamped(rows.join(made, "row_id"), fields)
    stale = rows.withColumn("note", F.when(F.col("row_id") == 3, "changed").otherwise(F.col("note")))
    sources.write_version(stale, at, "2")
    head = curation.apply_version(at, proposed, "low", fields, "3")
    assert head["number"] == 2
    got = {r.row_id: (r.note, r.flag) for r in sources.current(spark, at).collect()}
    assert got == {1: ("new", ""), 2: ("old | more", "b"), 3: ("changed", "c")}
    audit = sources.current(spark, f"{at}/_audit")
    assert sorted((r.row_id, r.field, r.error) for r in audit.collect()) == [(1, "flag", ""), (1, "note", ""), (2, "note", ""), (3, "note", "record changed; skipped")]
    back, stayed = curation.undo_changes(sources.current(spark, at), audit, fields)
    assert {r.row_id: (r.note, r.flag) for r in back.collect()} == {1: (None, "a"), 2: ("old", "b"), 3: ("changed", "c")} and stayed.count() == 0
    edited = sources.current(spark, at).withColumn("note", F.lit("edited"))
    back, stayed = curation.undo_changes(edited, audit, fields)
    assert {r.row_id: r.note for r in back.collect()} == {1: "edited", 2: "edited", 3: "edited"} and stayed.count() == 2
