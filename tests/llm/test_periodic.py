import hashlib
import random
import zlib

import numpy as np
from helpers import docs_of

from quern.llm import periodic, queries

SF = "/root/testdata/sf0.001"


def brute(words):
    """Every run, by comparing the words with themselves at every distance."""
    t, out = np.array(words), {}
    for q in range(1, len(t) // 2 + 1):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], (t[:-q] == t[q:]).astype(np.int8), [0]])))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if b - a >= q:
                out.setdefault((a, b + q), q)
    return sorted((s, q, e - s) for (s, e), q in out.items())


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def made(rng):
    kind, n = rng.randint(0, 8), rng.randint(0, 300)
    if kind < 3:
        return [rng.randint(0, (1, 3, 50)[kind]) for _ in range(n)]
    if kind == 3:
        return fibonacci(n)
    if kind == 4:  # one period between noise
        period = [rng.randint(0, 2) for _ in range(rng.randint(1, 90))]
        return [rng.randint(0, 2) for _ in range(rng.randint(0, 20))] + (period * 300)[:n] + [rng.randint(0, 2) for _ in range(rng.randint(0, 20))]
    if kind == 5:  # regions of one small period, out of step
        period = [rng.randint(0, 1) for _ in range(rng.randint(1, 4))]
        return sum(((period * 60)[rng.randint(0, 3) : rng.randint(5, 100)] for _ in range(rng.randint(1, 5))), [])
    if kind == 6:
        u, v = [0] * rng.randint(1, 40) + [1], [0] * rng.randint(1, 40) + [1]
        return u * 3 + v * 2 + u * 2 + v * 3
    if kind == 7:
        return ([0, 1] * rng.randint(1, 30) + [0]) * rng.randint(1, 6)
    return (([0] * 20 + [1] + [0] * rng.randint(1, 20)) * rng.randint(1, 5) + [rng.randint(0, 1)]) * 3


def test_every_run_is_found():
    rng = random.Random(3)
    for _ in range(120):
        texts = [made(rng) for _ in range(10)]
        for text, (start, length, period) in zip(texts, periodic.find_runs([np.array(t, np.int64) for t in texts]), strict=True):
            assert sorted(zip(start.tolist(), period.tolist(), length.tolist(), strict=True)) == brute(text)


def test_long_periods():
    rng = np.random.default_rng(5)
    for size, lead in ((700, 40), (1500, 3), (2048, 0)):
        block = rng.integers(0, 4000, size)
        text = np.concatenate([rng.integers(0, 4000, lead), np.tile(block, 3)[: 2 * size + 311]])
        (found,) = periodic.find_runs([text])
        assert (lead, 2 * size + 311, size) in list(zip(*(x.tolist() for x in found), strict=True))


def expected(doc_id, text):
    """The contract, word for word."""
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    runs = [r for r in brute([number[w] for w in words]) if r[2] >= 12] if n else []
    gone = {i for s, q, size in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[2], r[0], r[1]), default=(None, None, None))
    digest = lambda b: hashlib.sha256(b).hexdigest()
    return (
        *(doc_id, len(runs), best[0], best[2], best[1], 1000 * best[2] // best[1] if runs else None),
        *(digest("".join(f"{s},{size},{q}\n" for s, q, size in runs).encode()), digest(b" ".join(w for i, w in enumerate(words) if i not in gone)), n),
    )


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = sorted(tuple(r) for r in queries.op11_periodic_runs(spark, SF).collect())
    assert got == sorted(expected(r.doc_id, r.text) for r in docs)
    assert sum(r[1] > 0 for r in got) >= 10


def test_odd_texts(spark):
    texts = [None, "", " \n\t ", "one", "a " * 11, "a " * 12, "a b " * 6, "x\x0by\x0c" * 9, "é ü " * 8, "nbsp x " * 12, "w " * 100_000, " ".join(map(str, range(60_000))) + " 0" * 30, "a " * 20 + "b " + "a " * 20]
    docs = docs_of(spark, texts, [(3, "a " * 12, None, None, None, None, None)] * 2 + [(None, "a " * 12, None, None, None, None, None)])
    rows = periodic.periodic_runs(docs).collect()
    got = {r.doc_id: r for r in rows if r.doc_id not in (3, None)}
    runs = lambda i: [tuple(x) for x in got[i].runs]
    assert [got[i].n_words for i in (0, 1, 2, 4)] == [0, 0, 0, 11] and all(not runs(i) and not got[i].collapsed for i in (0, 1, 2))
    assert runs(4) == [] and runs(5) == [(0, 12, 1)] and runs(6) == [(0, 12, 2)] and got[6].collapsed == "a b"
    assert runs(7) == [(0, 18, 2)] and runs(8) == [(0, 16, 2)] and runs(9) == [(0, 24, 2)] or runs(9) == [(0, 12, 1)]
    assert runs(10) == [(0, 100_000, 1)] and got[10].collapsed == "w" and runs(11) == [(60_000, 30, 1)]
    assert runs(12) == [tuple(r) for r in sorted((s, size, q) for s, q, size in brute([0] * 20 + [1] + [0] * 20) if size >= 12)]
    assert sorted((r.doc_id is None, len(r.runs)) for r in rows if r.doc_id in (3, None)) == [(False, 0), (False, 1), (False, 1), (True, 1)]
    assert periodic.periodic_runs(docs.limit(0)).count() == 0
