import random

import corpus_pipeline
import pytest
from quern.llm import jaccard, simhash


def words(rng, n):
    return [rng.choice("abcdefgh") + str(rng.randrange(100_000)) for _ in range(n)]


def edited(rng, base, kind):
    """``base`` with an edit that leaves a similarity of little more than 0.8 of five-word shingles."""
    n = len(base)
    if kind == "appended":
        return base + words(rng, int(0.22 * n))
    if kind == "put before":
        return words(rng, int(0.22 * n)) + base
    if kind == "cut":
        return base[: n - int(0.18 * n)]
    out = list(base)
    for k in rng.sample(range(n), max(1, n // 50)):
        out[k] = words(rng, 1)[0]
    return out


def shingles(text):
    return set(simhash.shingle_hashes(text.encode(), 5).tolist())


def components(texts):
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in range(len(texts))}


def test_recall_by_kind_of_edit(spark):
    rng, texts, kind_of = random.Random(5), [], {}
    for kind in ("appended", "put before", "cut", "scattered"):
        for _ in range(60):
            base = words(rng, rng.choice([25, 60, 200, 800]))
            kind_of[len(texts) + 1] = kind
            texts += [" ".join(base), " ".join(edited(rng, base, kind))]
    alike = [i for i in kind_of if 5 * len(shingles(texts[i]) & shingles(texts[i - 1])) >= 4 * len(shingles(texts[i]) | shingles(texts[i - 1]))]
    assert all(sum(kind_of[i] == kind for i in alike) >= 30 for kind in set(kind_of.values()))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    recall = {kind: sum(i not in kept for i in alike if kind_of[i] == kind) / sum(kind_of[i] == kind for i in alike) for kind in set(kind_of.values())}
    assert recall == dict.fromkeys(recall, 1.0)
    assert kept == set(range(len(texts))) - set(alike)


HOW = {"words_per_shingle": 2, "radius": 5, "similarity": 0.8}


@pytest.mark.parametrize(("tile", "links"), [(20_000, 1_000), (50, 10)])
def test_texts_of_a_template(spark, monkeypatch, tile, links):
    """No bucket loses a pair, dealt in tiles or not: true pairs among many texts that share half of their shingles."""
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "LINKS", links)
    monkeypatch.setattr(jaccard, "SAMPLED", 4)
    rng = random.Random(6)
    form = words(rng, 60)
    texts = [" ".join(form + words(rng, 40)) for _ in range(150)]
    texts += [t.rsplit(" ", 3)[0] for t in rng.sample(texts, 40)]
    texts += [" ".join(form[: 60 - k]) for k in range(15)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, **HOW).collect()} == components(texts)


def test_bucket_of_hundreds_of_prints(spark):
    """Hundreds of near copies of one text, some only alike by others, beside texts that are not alike enough."""
    rng = random.Random(8)
    base, texts = words(rng, 120), []
    for k in range(300):
        out = list(base)
        for at in rng.sample(range(120), 1 + k % 5):
            out[at] = words(rng, 1)[0]
        texts.append(" ".join(out))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, **HOW).collect()} == components(texts)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "alpha beta"), (5, "alpha  Beta"), (5, "alpha beta"), (7, "w " * 30_000), (None, "gamma")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id) for r in simhash.near_duplicates(docs, **HOW).filter("component_id IS NOT NULL").collect())
    assert got == [(0, 5), (1, 1), (2, 1), (3, 1), (5, 5), (5, 5), (7, 7)] and simhash.near_duplicates(docs, **HOW).count() == 8
    assert sorted(r.doc_id or 0 for r in simhash.keep_first(docs, **HOW).collect()) == [0, 0, 1, 5, 7]
    assert simhash.near_duplicates(docs.limit(0), **HOW).collect() == []
