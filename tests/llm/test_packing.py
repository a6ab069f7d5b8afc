import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from helpers import docs_of
from tokenizers import Tokenizer

from quern.llm import packing, queries

SF = "/root/testdata/sf0.001"


def check(rows, texts):
    """Every piece once, ids as the public tokenizer gives them, sequences without gaps or overlaps; returns (used, least) sequences."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    want = []
    for i, t in texts:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)] if len(ids) > 2048 else [0, len(ids)]
        want += [(i, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    return len(bins), -(-sum(r.length for r in rows) // 2048)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    used, least = check(queries.op2_best_fit_packing(spark, SF).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert used <= least * 1.02 + 1


def test_odd_texts(spark):
    texts = [None, "", " ", "  two  spaces ", "a\n b \nc", "tab\tx", "nbsp y z", "don't we're", "1234 5678 ...!? éà", "<|endoftext|> x", "x" * 5000, "word " * 6000, "汉字 テスト 😀", "\n\n\n", "end "]
    rows = packing.pack(docs_of(spark, texts, [(3, "twice", None, None, None, None, None)] * 2)).collect()
    check(rows, [*enumerate(texts), (3, "twice"), (3, "twice")])


def test_empty_table(spark):
    assert packing.pack(docs_of(spark, [])).collect() == []


def test_many_shards_and_levels(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 60)
    texts = [" ".join(f"w{j}" for j in range(random.Random(i).randint(1, 900))) for i in range(400)]
    used, least = check(packing.pack(docs_of(spark, texts)).collect(), list(enumerate(texts)))
    assert used <= least * 1.03 + 1


def test_crossover_keeps_every_item_and_evolution_helps():
    rng = random.Random(4)
    lengths = np.array([rng.randint(300, 1400) for _ in range(300)])
    a = packing.best_fit(lengths.tolist(), range(300), 2048)
    b = packing.best_fit(lengths.tolist(), np.argsort(-lengths), 2048)
    for _ in range(20):
        child = packing.crossover(a, b, lengths, 2048, rng)
        assert child.min() >= 0 and np.bincount(child, lengths).max() <= 2048
        assert len(np.unique(child)) == child.max() + 1
    best = packing.evolve(lengths, [a], 2048, 1, 30)[0]
    assert best.max() <= b.max()


def test_search_saves_bins_where_best_fit_does_not_suffice():
    """Triples that fill a bin exactly, for which best fit by falling length needs bins more."""
    rng, saved = random.Random(1), 0
    for seed in range(3):
        pairs = [(rng.randint(500, 800), rng.randint(500, 700)) for _ in range(100)]
        lengths = np.array([x for a, b in pairs for x in (a, b, 2048 - a - b)])
        saved += packing.best_fit(lengths.tolist(), np.argsort(-lengths), 2048).max() - packing.evolve(lengths, [], 2048, seed, 60)[0].max()
    assert saved >= 3
