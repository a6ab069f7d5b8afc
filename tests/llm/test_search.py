import math
from collections import Counter

from helpers import assert_same, docs_of

from quern.llm import queries, search

SF = "/root/testdata/sf0.001"


def brute(docs, items, top=20):
    """Every document scored for every item."""
    tf = [(i, Counter(w.decode() for w in search.terms((t or "").encode()))) for i, t in docs]
    tf = [(i, c) for i, c in tf if c]
    total = sum(sum(c.values()) for _, c in tf)
    df = Counter(w for _, c in tf for w in c)
    out = []
    for item, text in items:
        asked = Counter(w.decode() for w in search.terms((text or "").encode()))
        rows = []
        for i, c in tf:
            m = 75 + 25 * sum(c.values()) * len(tf) // total
            score = sum(n * math.floor(1000 * math.log((2 * len(tf) + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 12 * m)) for w, n in asked.items() if w in c)
            if score > 0:
                rows.append((-score, i is None, i or 0))
        out += [(item, rank, None if none else i, -score) for rank, (score, none, i) in enumerate(sorted(rows)[:top], 1)]
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_query(spark):
    assert_same(queries.op13_ranked_search(spark, SF), queries.ORACLE_SQL["op13_ranked_search"])


def test_odd_rows(spark):
    texts = [None, "", "...", "Alpha beta", "ALPHA beta!", "alpha, beta", "beta alpha", "alpha", "é É alpha", "alpha " * 50_000, "gamma 1-2", "beta", "other words only"] + ["alpha beta"] * 40
    more = [(3, "alpha beta", None, None, None, None, None), (None, "alpha beta", None, None, None, None, None), (None, "gamma gamma", None, None, None, None, None)]
    docs = docs_of(spark, texts, more)
    items = [(1, "Alpha alpha beta"), (2, "gamma"), (2, "delta É"), (3, None), (4, "!!"), (None, "beta 2 1"), (5, "zeta")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    want = brute([*enumerate(texts), *[(r[0], r[1]) for r in more]], items)
    for block_terms in (1, 4, 1000):
        got = search.ranked_documents(docs, asked, block_terms=block_terms)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert order(got.collect()) == order(want)
    assert order(search.ranked_documents(docs, asked, top=2).collect()) == order(brute([*enumerate(texts), *[(r[0], r[1]) for r in more]], items, 2))


def test_classes_are_scored_once(spark):
    docs = docs_of(spark, [f"alpha beta filler{i}" for i in range(50)] + ["alpha alpha beta x"])
    block = search.Block([(0, [b"alpha", b"beta"])])
    bags = search.texts(docs, binary=True).mapInArrow(search._bags(block.vocabulary), "doc_id long, n long, bag binary")
    rows = sorted((len(r.members), r.members[0]) for r in search.classes_of(bags, 51, 154, 20).collect())
    assert rows == [(1, 50), (20, 0)]


def test_empty_tables(spark):
    docs, items = docs_of(spark, ["alpha"]), spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs_of(spark, [None, "."]), items)):
        got = search.ranked_documents(d, i)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0


def test_scores_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(search, "CELLS", 40)
    assert_same(queries.op13_ranked_search(spark, SF), queries.ORACLE_SQL["op13_ranked_search"])
