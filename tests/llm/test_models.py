import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import docs_of
from pyspark.sql import functions as F

from quern.llm import classlm, langid
from quern.llm.base import table

SF = "/root/testdata/sf0.001"


def held_out(seven):
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(seven)) == 2, F.lit(False))


def brute_base(texts, learned):
    tokens = {i: [*(t or "").encode().lower().split(), b" "] for i, t in texts.items()}
    c = Counter(w for i in learned for w in tokens[i])
    n, v = sum(c.values()), len(c)
    return {i: (len(x), sum(w in c for w in x), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in x)) for i, x in tokens.items()}


@pytest.mark.parametrize("held", [200_000, 300])
def test_scores_by_brute_force(spark, held):
    """Base scores, and the model's score from its published parts: classes, class bigrams of the texts learned from, formulas."""
    docs = table(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    learned = [i for i in texts if zlib.crc32(str(i).encode()) % 7 != 2]
    want = brute_base(texts, learned)
    got = {r.doc_id: r for r in classlm.score_texts(docs, ~held_out(7), seeds=200, held=held, classes=12).collect()}
    assert len(got) == len(texts)
    train = docs.filter(~held_out(7))
    counts = classlm.word_counts(train)
    classes = {bytes(r.word): r["class"] for r in classlm.word_classes(train, counts, 200, 12).collect()}
    c = Counter(w for i in learned for w in [*(texts[i] or "").encode().lower().split(), b" "])
    assert set(classes) == set(c) - {b" "}  # every word has a class by exchange
    of = lambda w: 12 if w == b" " else classes.get(w, 13)
    seen, row = Counter(), Counter()
    for i in learned:
        line = [12, *(of(w) for w in (texts[i] or "").encode().lower().split()), 12]
        seen.update(zip(line, line[1:], strict=False))
    for (a, _), n in seen.items():
        row[a] += n
    margin = Counter()
    for (_, b), n in seen.items():
        margin[b] += n
    kinds, mass = Counter(classes.values()), Counter()
    for w, k in classes.items():
        mass[k] += c[w]
    alone = lambda b: (margin[b] + 1) / (sum(margin.values()) + 13)
    after = lambda a, b: 0.9 * seen[a, b] / row[a] + 0.1 * alone(b) if row[a] else alone(b)

    def p(a, w):
        if w == b" ":
            return after(a, 12)
        if w not in classes:
            return sum(after(a, k) / (mass[k] + kinds[k] + 1) for k in range(12))
        return after(a, classes[w]) * (c[w] + 1) / (mass[classes[w]] + kinds[classes[w]] + 1)

    for a in (0, 5, 12, 13):  # a distribution over all words, END and any other word
        assert sum(p(a, w) for w in c) + p(a, b"\n") == pytest.approx(1, rel=1e-9)
    for i, r in got.items():
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[i][:3]
        assert r.base_score == pytest.approx(want[i][3], rel=1e-9)
        tokens = [*(texts[i] or "").encode().lower().split(), b" "]
        score = sum(math.log10(p(of(a), w)) for a, w in zip([b" ", *tokens], tokens, strict=False))
        assert r.score == pytest.approx(score, rel=1e-9) and r.perplexity == pytest.approx(10 ** (-score / len(tokens)), rel=1e-6)
    mean = lambda f: sum(f(r) for i, r in got.items() if i not in learned) / sum(r.n_tokens for i, r in got.items() if i not in learned)
    assert mean(lambda r: r.score) > mean(lambda r: r.base_score)


def test_exchange_finds_classes(spark):
    """Three kinds of words that follow each other: seeds by exchange among themselves, the others by the classes beside them."""
    rng = np.random.default_rng(3)
    kind = {f"{k}{i}": k for k in "abc" for i in range(40)}
    rank = lambda k: f"{k}{min(int(rng.pareto(0.7) * 3), 39)}"
    lines = [" ".join(rank("abc"[(start + n) % 3]) for n in range(rng.integers(5, 40))) for start in rng.integers(0, 3, 600)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = classlm.word_classes(docs, classlm.word_counts(docs), seeds=30, classes=3).collect()
    by = {}
    for r in found:
        by.setdefault(r["class"], Counter())[kind[bytes(r.word).decode()]] += 1
    assert len(by) == 3 and sum(max(x.values()) for x in by.values()) / len(found) > 0.95


def test_best_class_is_the_best_single_move():
    rng = np.random.default_rng(0)
    pairs, where = rng.poisson(2.0, (20, 20)).astype(float), np.append(np.arange(18) % 4, [4, 5])

    def grid_of(w):
        m = np.zeros((20, 6))
        m[np.arange(20), w] = 1
        return m.T @ pairs @ m

    for s in range(18):
        others = np.arange(20) != s
        right = np.bincount(where[others], pairs[s, others], 6)
        left = np.bincount(where[others], pairs[others, s], 6)
        best = classlm.best_class(right, left, pairs[s, s], where[s], grid_of(where), 4)
        scores = [classlm.likelihood(grid_of(np.where(np.arange(20) == s, k, where))) for k in range(4)]
        assert scores[best] == pytest.approx(max(scores))


def test_lm_edges(spark):
    docs = docs_of(spark, [None, "", "A a\tb", "c"], [(2, "a", None, None, None, None, None), (None, "a zz", None, None, None, None, None)])
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known) for r in classlm.score_texts(docs, F.col("doc_id") < 3).collect())
    assert got == [(False, 0, 1, 1), (False, 1, 1, 1), (False, 2, 2, 2), (False, 2, 4, 4), (False, 3, 2, 1), (True, 0, 3, 2)]
    none = classlm.score_texts(docs, F.lit(False)).collect()
    assert {(r.train_tokens, r.n_known, r.base_score) for r in none} == {(0, 0, 0.0)} and all(r.score <= 0 for r in none)
    assert classlm.score_texts(docs_of(spark, []), F.lit(True)).count() == 0


def test_languages_of_held_out_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = langid.identify(docs, ~held_out(4)).join(docs, "doc_id").filter(held_out(4))
    right, total = got.agg(F.count_if(F.expr("lang = lang_pred")), F.count("*")).first()
    assert right / total > 0.97


def test_scores_are_those_of_kernel_ridge_regression():
    """The folded matrix against kernels of every pair: Nystroem features, ridge regression in their dual form."""
    rng = np.random.default_rng(2)
    alphabets = {"aa": "abcdefg ", "bb": "defghij ", "cc": "жзиклмн ", "dd": "語学漢字 "}
    texts = [("".join(rng.choice(list(letters), 60)), lang) for lang, letters in alphabets.items() for _ in range(15)]
    sample = [(langid.grams(t), lang) for t, lang in texts]
    names, features, weights = langid.fit(sample, landmarks=6, ridge=0.05)
    sets = [set(g.tolist()) for g, _ in sample]
    kernel = lambda a, b: len(a & b) / math.sqrt(len(a) * len(b))
    marks = [i for lang in alphabets for i in [k for k, (_, x) in enumerate(texts) if x == lang][:6]]
    inner = np.array([[kernel(sets[i], sets[j]) for j in marks] for i in marks])
    whole = np.array([[kernel(s, sets[j]) for j in marks] for s in sets])
    approximate = whole @ np.linalg.inv(inner) @ whole.T
    target = np.array([[1.0 if lang == n else -1.0 for n in names] for _, lang in texts])
    dual = np.linalg.solve(approximate + 0.05 * np.eye(len(sets)), target)
    fresh = [set(langid.grams("".join(rng.choice(list(a), 40))).tolist()) for a in alphabets.values()]
    want = np.array([[kernel(s, sets[j]) for j in marks] for s in fresh]) @ np.linalg.inv(inner) @ whole.T @ dual
    got = np.array([np.isin(features, list(s)) @ weights / math.sqrt(len(s)) for s in fresh])
    assert np.allclose(got, want, atol=2e-3) and [names[k] for k in got.argmax(1)] == list(alphabets)


def test_many_languages(spark):
    """No language is left out, however many there are."""
    rng = np.random.default_rng(4)
    rows = []
    for k in range(45):
        letters = [chr(0x4E00 + 12 * k + j) for j in range(12)]
        rows += [(100 * k + i, " ".join("".join(rng.choice(letters, 5)) for _ in range(20)), f"l{k:02}") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.identify(docs, F.col("doc_id") % 100 < 6).join(docs, "doc_id").filter("doc_id % 100 >= 6")
    assert got.filter("lang = lang_pred").count() == got.count() == 90


def test_fit_of_many_languages_is_bounded():
    """Two hundred languages of their own letters and words, forty texts each: under a gigabyte, and none is left out."""
    rng = np.random.default_rng(6)
    sample = []
    for k in range(200):
        letters = [chr(0x4E00 + 40 * k + j) for j in range(60)]  # neighbours share a third of theirs
        sample += [(langid.grams(" ".join("".join(rng.choice(letters, 6)) for _ in range(120))), f"l{k:03}") for _ in range(40)]
    tracemalloc.start()
    names, features, weights = langid.fit(sample)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1e9 and len(names) == 200 and len(features) <= langid.FEATURES and weights.nbytes < 60e6
    hit = sum(names[int((np.isin(features, g) @ weights).argmax())] == lang for g, lang in sample[::13])
    assert hit == len(sample[::13])


def test_language_edges(spark):
    docs = docs_of(spark, [None, "", "123 . !", "the cat and the dog " * 20, "ß", "x" * 100_000, "漢字"])
    docs = docs.withColumn("lang", F.when(F.col("doc_id") == 3, "en").when(F.col("doc_id") == 5, "xx"))
    got = {r.doc_id: r for r in langid.identify(docs, F.lit(True)).collect()}
    assert [got[i].lang_pred for i in range(4)] == ["und", "und", "und", "en"] and got[5].lang_pred == "xx"
    assert {got[4].lang_pred, got[6].lang_pred} <= {"en", "xx"} and all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in langid.identify(docs, F.lit(False)).collect()} == {"und"}
    assert langid.identify(docs_of(spark, []), F.lit(True)).count() == 0
