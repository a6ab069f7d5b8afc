import re
from collections import Counter

import numpy as np
import pytest
from helpers import docs_of
from pyspark.sql import functions as F

from quern.llm import decontaminate
from quern.llm.base import table

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower()) if x]
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else [])


def alike(a, b):
    common = sum((Counter(a) & Counter(b)).values())
    return common / (len(a) + len(b) - common)


def brute(docs, items):
    """Every window of an item's size in every document, by weighted similarity."""
    out = {}
    index = {k: (s, set(s)) for k, t in items if (s := shingles(t))}
    for i, text in docs:
        whole = shingles(text)
        if not whole:
            continue
        for k, (item, kinds) in index.items():
            if kinds.isdisjoint(whole):
                continue
            best = max(alike(whole[p : p + len(item)], item) for p in range(max(1, len(whole) - len(item) + 1)))
            if best >= 0.8:
                out[i, k] = best
    return out


def test_against_every_window(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(docs, items).collect()}
    assert got.keys() == want.keys() and want
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_index_misses_no_print_within_radius(spark):
    rng = np.random.default_rng(5)
    pairs = []
    for k in range(60):
        fp = int(rng.integers(-(2**63), 2**63))
        other = fp
        for b in rng.choice(64, rng.integers(0, 15), replace=False):
            other ^= (1 << int(b)) if b < 63 else -(2**63)
        pairs.append((k, fp, other))
    a = decontaminate.block_keys(spark.createDataFrame([(k, f) for k, f, _ in pairs], "k long, fp long"))
    b = decontaminate.block_neighbours(spark.createDataFrame([(k, o) for k, _, o in pairs], "k long, fp long"))
    met = a.alias("a").join(b.alias("b"), (F.col("a.k") == F.col("b.k")) & (F.col("a.block") == F.col("b.block")) & (F.col("a.value") == F.col("b.value")))
    assert met.select("a.k").distinct().count() == 60


def test_edges(spark):
    item = " ".join(f"item{i}" for i in range(40))
    near = item.replace("item20", "changed")
    half = " ".join(item.split()[:20])
    texts = [None, "", "... !", f"before {item.upper()} after", f"{near}", half, "tiny item", "w " * 20_000, "clean words " + "of no item " * 20, f"{item} {item}"]
    docs = docs_of(spark, texts, [(3, "other row", None, None, None, None, None), (None, item, None, None, None, None, None)])
    bench = spark.createDataFrame([(1, item), (2, "tiny item"), (3, None), (4, ""), (1, item)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, bench).collect()}
    assert set(got) == {(3, 1), (6, 2), (9, 1), (None, 1)} | ({(4, 1)} if alike(shingles(near), shingles(item)) >= 0.8 else set())
    assert got[3, 1].first_shingle == 1 and got[9, 1].n_windows >= 2
    left = decontaminate.decontaminate(docs, bench)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == sorted(set(range(9)) - {3, 6} - {k for k, _ in got if k is not None})
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0


def test_parts_in_another_order_are_one_window(spark):
    """No shingle of such a copy lies as in the item, but the window over both parts shares nine in ten; brute force sees every window."""
    item = " ".join(f"item{i}" for i in range(80))
    swapped = " ".join([f"before{i}" for i in range(50)] + item.split()[40:] + item.split()[:40] + [f"after{i}" for i in range(50)])
    thirds = " ".join([f"x{i}" for i in range(99)] + item.split()[50:] + ["gap"] + item.split()[25:50] + item.split()[:25])
    texts = [swapped, thirds, f"{item} {swapped}", item[: len(item) // 2]]
    want = brute(list(enumerate(texts)), [(1, item)])
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs_of(spark, texts), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert got.keys() == want.keys() == {(0, 1), (2, 1)}  # three parts share too little
    assert all(got[k].similarity == pytest.approx(want[k]) for k in want)
    assert got[0, 1].first_shingle == 50 and got[2, 1].first_shingle == 0
