import random
from collections import defaultdict
from math import exp, log

import pytest
from helpers import docs_of

from quern.llm import mixing, queries

SF = "/root/testdata/sf0.001"


def wanted(totals):
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in totals if s is not None), key=lambda s: s.encode()) + ([None] if None in totals else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(totals.values()))
    while free:
        unit = left / sum(weight[s] for s in free)
        above = {s for s in free if unit * weight[s] > 3 * totals[s]}
        if not above:
            return target | {s: unit * weight[s] for s in free}
        for s in above:
            target[s] = 3.0 * totals[s]
            left -= target[s]
        free -= above
    return target


def check(rows, texts_):
    """Sizes, targets, bounds and nearness; texts_: (doc_id, text, source) of every row."""
    size = lambda t: len((t or "").encode().split())
    assert sorted(map(repr, ((r.doc_id, r.source, r.size) for r in rows))) == sorted(map(repr, ((i, s, size(t)) for i, t, s in texts_)))
    totals, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, t, s in texts_:
        totals[s] += size(t)
        largest[s] = max(largest[s], size(t))
    target = wanted(totals)
    for r in rows:
        assert r.source_size == totals[r.source] and r.target == pytest.approx(target[r.source], rel=1e-9)
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
    for s, t in target.items():
        assert abs(taken[s] - t) <= largest[s] + 1
    return {s: abs(taken[s] - t) / max(1, t) for s, t in target.items()}


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = queries.op12_mixing(spark, SF).collect()
    off = check(rows, [(r.doc_id, r.text, r.source) for r in docs])
    assert max(off.values()) < 0.02
    assert all(r.taken == r.size * r.copies for r in rows)


def test_hot_source_and_reruns(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SPREAD", 50)
    rng = random.Random(2)
    rows = [(i, " ".join("w" for _ in range(40 if i % 4 else rng.randint(1, 400))), "a" if i % 3 else f"s{i % 7}") for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one = mixing.mix(frame).collect()
    assert max(check(one, rows).values()) < 0.01
    again = mixing.mix(frame.repartition(7)).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, again))


def test_rates_solve_the_dual(spark):
    """Kept rates are min(3, exp(tilt * size / mean)) with the expected words on target."""
    classes = [("a", 1, 50), ("a", 10, 40), ("a", 300, 3), ("b", 5, 10), ("b", 50, 10), ("c", 7, 4), ("d", 0, 3), ("d", 9, 2)]
    sums = defaultdict(int)
    for s, z, n in classes:
        sums[s] += z * n
    target = {"a": 400.0, "b": 1500.0, "c": 84.0, "d": 30.0}
    sources = spark.createDataFrame([(s, sums[s], t) for s, t in target.items()], "source string, source_size long, target double")
    for r in mixing.balanced(spark.createDataFrame(classes, "source string, size long, n long"), sources).collect():
        if r.tilt is None:
            assert target[r.source] >= 3 * sums[r.source]
            continue
        rate = lambda z: 3.0 if r.tilt * z / r.mean > log(3) else exp(r.tilt * z / r.mean)  # noqa: B023, E731
        assert sum(n * z * rate(z) for s, z, n in classes if s == r.source) == pytest.approx(target[r.source], rel=1e-5)


def test_odd_rows(spark):
    texts = [None, "", " \n ", "one two", "one\x0btwo\x0cthree", "é ü", "w " * 60_000, "nbsp x y"]
    more = [(3, "one two", None, None, None, None, None)] * 3 + [(None, "a b c", "en", None, 1, "x", "y")] * 50 + [(None, "a b", "en", "src0", 1, "x", "y")] * 5
    rows = [(i, t, f"src{i % 2}") for i, t in enumerate(texts)] + [(m[0], m[1], m[3]) for m in more]
    check(mixing.mix(docs_of(spark, texts, more)).collect(), rows)
    assert mixing.mix(docs_of(spark, [])).collect() == []
    nothing = mixing.mix(docs_of(spark, [None, ""])).collect()
    assert [(r.size, r.target) for r in nothing] == [(0, 0.0), (0, 0.0)]


def test_one_source_and_code_points(spark):
    rows = [(0, "a b c", "z"), (1, "d e", "é"), (2, "f", "Z"), (3, "g h i j", "\U0001f600"), (4, "k", None), (5, "l m n o p", "￿")]
    check(mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect(), rows)
    one = [(i, "w " * (i + 1), "only") for i in range(30)]
    assert max(check(mixing.mix(spark.createDataFrame(one, "doc_id long, text string, source string")).collect(), one).values()) == 0
