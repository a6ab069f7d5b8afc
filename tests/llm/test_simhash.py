import numpy as np
import pytest
import xxhash

from quern.llm import simhash

SF = "/root/testdata/sf0.001"


def brute(rows, k, radius):
    prints = {}
    for i, t in rows:
        words = (t or "").encode().lower().split()
        s = [b" ".join(words[j : j + k]) for j in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (f"{prints[i]:016x}", find(i)) for i in ids}


@pytest.mark.parametrize("radius", [4, 8])
def test_matches_brute_force(spark, radius):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs, 4, radius).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 4, radius)


@pytest.mark.parametrize("radius", [1, 3, 4, 8])
def test_ring_misses_no_pair(radius):
    """Some mask agrees, and from its start the chain holds."""
    rng = np.random.default_rng(1)
    masks, chains = simhash.ring_masks(radius, *simhash.ring_layout(radius)), simhash.Chains(radius)
    for _ in range(2000):
        diff = 0
        for b in rng.choice(64, rng.integers(0, radius + 1), replace=False):
            diff |= 1 << int(b)
        assert any(diff & m == 0 and chains.near(np.array([diff], np.uint64), start)[0] for m, start in masks)
    far = np.array([2**64 - 1, sum(1 << (7 * i) for i in range(9 if radius == 8 else radius + 1))], np.uint64)
    assert not any(chains.near(far, start).any() for _, start in masks)


def test_edge_rows(spark):
    rows = [(1, None, "x"), (2, "", "y"), (3, " \n\t", None), (None, "alpha beta", "z"), (5, "alpha beta", "z"), (5, "alpha beta", "z"), (7, "w " * 30_000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect())
    by = {(a, b): (c, d) for a, b, c, d in got}
    assert len(got) == 7
    assert {by[False, i] for i in (1, 2, 3)} == {("0" * 16, 1)}
    assert by[True, 0] == by[False, 5] and by[False, 5][1] == 5
    assert by[False, 7][1] == 7


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).collect() == []


def test_large_buckets_are_tiled(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 40)
    rows = [(i, "common words of one long passage " * 20 + f" tail{i} end{i % 7}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == brute(rows, 4, 4)


def test_verified_groups_and_keep_first(spark):
    base = [f"word{i}" for i in range(100)]
    near = base[:50] + ["changed"] + base[51:]
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(reversed(base))), (4, " ".join(base)), (4, " ".join(base))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    how = {"words_per_shingle": 2, "radius": 8, "similarity": 0.8}
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, **how).collect()} == {1: 1, 2: 1, 3: 3, 4: 1}
    assert sorted(r.doc_id for r in simhash.keep_first(docs, **how).collect()) == [1, 3]
