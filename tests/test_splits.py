import csv
import io
import json
import random

import pytest

from quern.sources import tables as sources


@pytest.fixture
def small_splits(spark):
    """Files are read in splits of a few thousand bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "2500", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_quoted_line_ends_over_many_splits(spark, tmp_path, small_splits):
    rng = random.Random(1)
    cell = lambda: "".join(rng.choice(['a', 'é', ',', '"', '""', '\n', "\n\n", " ", "x" * 40, '",\n"']) for _ in range(rng.randint(0, 9)))
    want = []
    for f in range(3):
        rows = [(f"{f}-{i}", cell(), cell()) for i in range(80)] + [(f"{f}-long", "line\n" * 1200, "z")]
        rng.shuffle(rows)
        out = io.StringIO()
        writer = csv.writer(out, lineterminator="\r\n" if f == 1 else "\n", quoting=csv.QUOTE_ALL if f == 2 else csv.QUOTE_MINIMAL)
        writer.writerows([("id", "a b", "c"), *rows])
        (tmp_path / f"{f}.csv").write_text(("﻿" if f == 0 else "") + out.getvalue(), newline="", encoding="utf-8")
        want += rows
    df = sources.scan_text(spark, str(tmp_path), ["id", "a b", "c"])
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
    assert sorted(map(tuple, df.collect())) == sorted(want)


def test_header_must_fit(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,x\n1,2\n")
    with pytest.raises(Exception, match="no header"):
        sources.scan_text(spark, str(tmp_path / "a.csv"), ["id", "y"]).collect()
    (tmp_path / "b.csv").write_text("id,x\n\n1,\n,\n")
    assert [tuple(r) for r in sources.scan_text(spark, str(tmp_path / "b.csv"), ["id", "x"]).collect()] == [("1", ""), ("", "")]
    (tmp_path / "c.csv").write_text("id,x\n")
    assert sources.scan_text(spark, str(tmp_path / "c.csv"), ["id", "x"]).collect() == []


def _made(rng):
    odd = ['{', '}', '[', ']', '"', '\\', ':', ',', 'é', '\n', "text ", '"}', '{"a": ', "\\\"", " "]
    word = lambda: "".join(rng.choice(odd) for _ in range(rng.randint(0, 12)))
    return [{"id": i, "t": word(), "n": {"deep": {"er": word()}, "l": [{"v": word()}, {"v": word()}]}, "z": word() * 9} for i in range(60)]


@pytest.mark.parametrize(("indent", "ascii_only"), [(None, True), (2, False)])
def test_json_arrays_and_objects_over_many_splits(spark, tmp_path, small_splits, indent, ascii_only):
    rows = _made(random.Random(4))
    schema = "id long, t string, n struct<deep: struct<er: string>, l: array<struct<v: string>>>, z string"
    want = sorted((r["id"], r["t"], r["n"]["deep"]["er"], tuple(x["v"] for x in r["n"]["l"]), r["z"]) for r in rows)
    flat = lambda r: (r.id, r.t, r.n.deep.er, tuple(x.v for x in r.n.l), r.z)
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=ascii_only), encoding="utf-8")
    assert sorted(map(flat, sources.scan_json(spark, str(tmp_path / "a.json"), schema, "array").collect())) == want
    names = {r["id"]: f'k{r["id"]} "{r["t"]}' for r in rows}
    (tmp_path / "o.json").write_text(json.dumps({names[r["id"]]: r for r in rows}, indent=indent, ensure_ascii=ascii_only), encoding="utf-8")
    got = sources.scan_json(spark, str(tmp_path / "o.json"), schema, "object", "name")
    assert got.columns[0] == "name" and {r.id: r.name for r in got.collect()} == names and sorted(map(flat, got.collect())) == want


def test_small_json_forms(spark, tmp_path):
    cases = {"[]": [], "{}": [], " [ {\"id\": 1} , 5, null, {\"id\": 2}]\n": [1, 2], '[{"id": 3}]': [3]}
    for i, (body, ids) in enumerate(cases.items()):
        (tmp_path / f"{i}.json").write_text(body)
        assert sorted(r.id for r in sources.scan_json(spark, f"{tmp_path}/{i}.json", "id long", "array").collect() if r.id is not None) == ids
    (tmp_path / "l.json").write_text('{"id": 1}\n{"id": 2}\n')
    assert sources.scan_json(spark, f"{tmp_path}/l.json", "id long").count() == 2
    (tmp_path / "o.json").write_text('{"a": {"id": 1}, "b{": {"id": 2}, "\\u00e9}": {"id": 3}}')
    assert sorted((r.key, r.id) for r in sources.scan_json(spark, f"{tmp_path}/o.json", "id long", "object").collect()) == [("a", 1), ("b{", 2), ("é}", 3)]
