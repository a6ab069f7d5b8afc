"""Ranked lexical search for a set of queries, with documents grouped into bags that score alike."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.base import slices, stage, texts

#: Documents that are returned for each item.
TOP = 20
#: Items are searched in blocks of so many term places at most, which bounds what is sent to tasks; each block is a pass over the documents.
BLOCK_TERMS = 200_000
#: Rows of a score matrix times its columns, at most, that a task holds.
CELLS = 2_000_000

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """Letters and digits and everything beyond ASCII make terms; only A-Z is lower-cased."""
    return text.translate(_TABLE).split()


class Block:
    """Some items: the numbers of their terms, and for each item how often it has each."""

    def __init__(self, items: list[tuple[int, list[bytes]]]):
        self.items = [row for row, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        for _, words in items:
            for w in words:
                self.vocabulary.setdefault(w, len(self.vocabulary))
        held = [np.unique([self.vocabulary[w] for w in words], return_counts=True) for _, words in items]
        item = np.repeat(np.arange(len(items)), [len(t) for t, _ in held])
        term = np.concatenate([t for t, _ in held]).astype(np.int64)
        times = np.concatenate([n for _, n in held]).astype(np.int64)
        order = np.argsort(term, kind="stable")
        self.item, self.times = item[order], times[order]
        #: Postings of term t are the places first[t] to first[t + 1].
        self.first = np.searchsorted(term[order], np.arange(len(self.vocabulary) + 1))


def blocks(items: DataFrame, most: int) -> Iterator[Block]:
    """Items with a term (__item, text) in blocks of ``most`` term places at most; one item is never split."""
    held, size = [], 0
    for r in items.toLocalIterator():
        words = terms((r.text or "").encode())
        if held and size + len(words) > most:
            yield Block(held)
            held, size = [], 0
        if words:
            held.append((r["__item"], words))
            size += len(words)
    if held:
        yield Block(held)


def _bags(vocabulary: dict[bytes, int]):
    """Of each text: how many terms it has, and its bag: the numbers of its terms in ``vocabulary``, each followed by how often it comes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, body in slices(batch):
                sizes, made = [], []
                for text in body:
                    words = terms(text)
                    got = np.fromiter(map(vocabulary.get, words, repeat(-1)), np.int32, len(words))
                    number, times = np.unique(got[got >= 0], return_counts=True)
                    sizes.append(len(words))
                    made.append(np.stack([number, times], axis=1).astype("<i4").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(made, pa.binary())], ["doc_id", "n", "bag"])

    return run


def _holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, df) of a task's bags."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        for bag in batch.column(0):
            term = np.frombuffer(bag.as_buffer(), "<i4")[::2]
            if len(term):
                if term[-1] >= len(total):
                    total = np.concatenate([total, np.zeros(term[-1] + 1 + len(total), np.int64)])
                total[term] += 1
    term = np.flatnonzero(total)
    if len(term):
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(total[term])], ["term", "df"])


class Best:
    """The highest-scoring documents of each item so far: by score, then doc_id, null last."""

    def __init__(self, top: int):
        self.top = top
        self.rows: dict[int, list[tuple[int, bool, int]]] = defaultdict(list)

    def least(self, item: int) -> int:
        held = self.rows.get(item)
        return -held[-1][0] if held and len(held) == self.top else 1

    def add(self, item: int, score: int, members: list[int | None]) -> None:
        held = self.rows[item]
        held += [(-score, i is None, i or 0) for i in members]
        held.sort()
        del held[self.top :]


def _ranked(block: Block, weight: np.ndarray, top: int):
    """Over classes (bag, m, members): the best documents of each item in the task's classes. A class is scored once."""

    def scores(bags: list[np.ndarray], m: np.ndarray) -> np.ndarray:
        size = np.array([len(b) // 2 for b in bags])
        both = np.concatenate(bags).reshape(-1, 2).astype(np.int64)
        row, term, tf = np.repeat(np.arange(len(bags)), size), both[:, 0], both[:, 1]
        worth = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * np.repeat(m, size)))
        many = block.first[term + 1] - block.first[term]
        out = np.zeros(len(bags) * len(block.items), np.int64)
        for a, b in _stretches(many, CELLS):
            n = many[a:b]
            place = np.repeat(block.first[term[a:b]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            np.add.at(out, np.repeat(row[a:b], n) * len(block.items) + block.item[place], np.repeat(worth[a:b], n) * block.times[place])
        return out.reshape(len(bags), -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(top)
        rows = max(1, CELLS // max(1, len(block.items)))
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                bags = [np.frombuffer(b.as_buffer(), "<i4") for b in batch.column(0)]
                members = batch.column(2)
                got = scores(bags, batch.column(1).to_numpy())
                for item in range(len(block.items)):
                    column = got[:, item]
                    able = np.flatnonzero(column >= best.least(item))
                    for i in able[np.argsort(-column[able], kind="stable")]:
                        if column[i] < best.least(item):
                            break
                        best.add(item, int(column[i]), members[int(i)].as_py())
        flat = [(block.items[item], None if none else i, -score) for item, held in best.rows.items() for score, none, i in held]
        if flat:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*flat, strict=True)], ["__item", "doc_id", "score"])

    return run


def _stretches(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(from, to) of consecutive sizes that sum to about ``most``."""
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(most, sizes.sum() + most, most)) + 1
    ends = np.unique(np.minimum(cuts, len(sizes)))
    yield from zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)


def classes_of(bags: DataFrame, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(bag, m, members): documents of the same bag and m are one class; members are its ``top`` smallest doc_ids, null last.

    Rows meet by a hash of the bag and are told apart by the bag itself. No item can list more of a class than ``top`` documents,
    and each task keeps no more of it before the shuffle.
    """
    m = F.expr(f"75L + cast((cast(25 as decimal(38,0)) * n * {n_docs}) div {n_terms} as long)")
    some = bags.filter(F.length("bag") > 0).select("doc_id", m.alias("m"), F.xxhash64("bag").alias("h"), "bag")
    ranked = some.withColumn("__at", F.row_number().over(Window.partitionBy("h", "m", "bag").orderBy(F.col("doc_id").asc_nulls_last()))).filter(F.col("__at") <= top)
    held = ranked.groupBy("h", "m", "bag").agg(F.sort_array(F.collect_list(F.struct("__at", "doc_id"))).alias("members"))
    return held.select("bag", "m", F.transform("members", lambda x: x["doc_id"]).alias("members"))


def ranked_documents(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): for every row of ``items`` (item_id, text) the ``top`` documents (doc_id, text) of highest score above 0, equal scores by doc_id.

    A term's weight is ``floor(1000 * ln((2 N + 2) / (2 df + 1)))``; a document's score sums ``weight * (10**9 tf div (1000 tf + 12 m))``
    over the item's terms, repeats included, with ``m = 75 + 25 n N div L``: N documents with a term, L all their terms, n the
    document's, df the documents holding the term, tf its occurrences.

    Documents are restricted to the terms of a block of items; those of the same bag and m are a class, which is scored once and
    stands for its members in order of doc_id. Null and empty texts have no terms: such documents are not counted, such items get no
    rows. Rows that share an item_id, or a null one, are items of their own; rows that share a doc_id are documents of their own; a null doc_id comes
    last among equal scores. A long list of items is searched block by block.
    """
    asked = stage(items.select(F.col("item_id").cast("long").alias("item_id"), "text").withColumn("__item", F.monotonically_increasing_id()), "items")
    out, totals = None, None
    for block in blocks(asked.select("__item", "text"), block_terms):
        bags = stage(texts(docs, binary=True).mapInArrow(_bags(block.vocabulary), "doc_id long, n long, bag binary"), "bags")
        totals = totals or bags.filter("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
        n_docs, n_terms = totals
        if not n_docs:
            break
        weight = np.zeros(len(block.vocabulary), np.int64)
        for r in bags.select("bag").mapInArrow(_holders, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():  # of this block's terms alone
            weight[r.term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r.df + 1)))
        found = classes_of(bags, n_docs, n_terms, top).mapInArrow(_ranked(block, weight, top), "__item long, doc_id long, score long")
        found = stage(found, "found")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return asked.limit(0).select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    order = Window.partitionBy("__item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    last = out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return last.join(asked.select("__item", "item_id"), "__item").select("item_id", "rank", "doc_id", "score")
