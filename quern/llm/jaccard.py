"""Links of near duplicates by the similarity of their word-shingle sets: verification of candidates, and an exact join for the rest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.base import connected_components, digest, join_dealt, shingle_hashes, slices, stage, texts

#: Shingles of one text in SAMPLED are counted; the HOT most frequent of them, of LEAST_HOT texts at least, come last in the order. This decides cost alone.
SAMPLED, LEAST_HOT, HOT = 32, 4, 100_000
#: Rows of one shingle that one task compares; more are dealt out in tiles, two of which meet in each task.
TILE = 20_000
#: Links of one text that meet it in one task; more are dealt out.
LINKS = 1_000
#: Pairs that a task collects before it passes them on.
PASSED = 1_000_000


def prefix_size(n: int, similarity: float) -> int:
    """Sets of which one has ``n`` members share one of its first so many, in any order of all members, if they are as similar."""
    return n - int(np.ceil(similarity * n - 1e-9)) + 1 if n else 0


def _sets(words_per_shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, body in slices(batch, 1_000_000):
                yield pa.RecordBatch.from_arrays([pa.array([np.unique(shingle_hashes(t, words_per_shingle)).view(np.int64) for t in body], pa.list_(pa.int64()))], ["shingles"])

    return run


def _prefixes(hot: np.ndarray, counts: np.ndarray, words_per_shingle: int, similarity: float):
    """(token, n, pos, node, part): the prefix of each text's set of ``n`` shingles; ``hot`` is sorted, ``counts`` are its frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, at_row = batch.column(2).to_pylist(), 0
            for ids, body in slices(batch, 1_000_000):
                tokens, sizes, taken = [], [], []
                for text in body:
                    held = np.unique(shingle_hashes(text, words_per_shingle))
                    if len(hot) and len(held):
                        at = np.minimum(np.searchsorted(hot, held), len(hot) - 1)
                        held = held[np.argsort(np.where(hot[at] == held, counts[at], 0), kind="stable")]
                    tokens.append(held[: prefix_size(len(held), similarity)])
                    sizes.append(len(held))
                    taken.append(len(tokens[-1]))
                nodes = list(map(digest, body))
                own = [n if p is None else p for n, p in zip(nodes, parts[at_row : at_row + len(ids)], strict=True)]
                at_row += len(ids)
                pos = np.concatenate([np.arange(k) for k in taken]).astype(np.int32)
                columns = [np.concatenate(tokens).view(np.int64), np.repeat(np.array(sizes, np.int32), taken), pos]
                columns += [np.repeat(np.array(c, np.int64), taken) for c in (nodes, own)]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["token", "n", "pos", "node", "part"])

    return run


def _whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of rows sorted by their first two columns, cut so that no bucket of equal values in both is divided."""
    held: list[np.ndarray] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        ends = [(c[0][k], c[1][k]) for c, k in ((cols, 0), (cols, -1), *([(held, -1)] if held else []))]
        if held and len(set(ends)) == 1:
            parts.append(cols)  # the open bucket goes on: joined once it ends
            continue
        if held:
            cols = [np.concatenate(x) for x in zip(*parts, cols, strict=True)]
        last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
        cut = last[-1] + 1 if len(last) else 0
        if cut:
            yield [c[:cut] for c in cols]
        held = [c[cut:] for c in cols]
        parts = [held]
    if held:
        yield [np.concatenate(x) for x in zip(*parts, strict=True)]


def _reachable(n: np.ndarray, pos: np.ndarray, a, b, similarity: float) -> np.ndarray:
    """Whether sets can still be as similar if what they share begins at these places, and by their sizes."""
    n = n.astype(np.int64)
    fits = np.minimum(n[a], n[b]) >= similarity * np.maximum(n[a], n[b]) - 1e-9
    return fits & (np.minimum(n[a] - pos[a], n[b] - pos[b]) >= similarity / (1 + similarity) * (n[a] + n[b]) - 1e-9)


def _passed(found: list[np.ndarray]) -> pa.RecordBatch:
    both = np.unique(np.concatenate(found, axis=1), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["src", "dst"])


def _next_pairs(similarity: float):
    """Pairs of rows that are next to each other in a bucket, or next but one, and of two components: all pairs of small buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, tile, n, pos, node, part in _whole_buckets(batches):
            found = []
            for d in (1, 2):
                a = np.flatnonzero((token[d:] == token[:-d]) & (tile[d:] == tile[:-d]) & (part[d:] != part[:-d]))
                a = a[_reachable(n, pos, a, a + d, similarity)]
                found.append(np.stack([np.maximum(node[a], node[a + d]), np.minimum(node[a], node[a + d])]))
            yield _passed(found)

    return run


def _joining_pairs(similarity: float):
    """Every pair of a bucket that is of two components; rows are sorted by token, tile, then size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, tile, n, pos, node, part in _whole_buckets(batches):
            edge = np.concatenate([[0], np.flatnonzero((token[1:] != token[:-1]) | (tile[1:] != tile[:-1])) + 1, [len(token)]])
            found, count = [], 0
            for s, e in zip(edge[:-1], edge[1:], strict=True):
                ends = s + np.searchsorted(n[s:e], n[s:e] / similarity + 1e-9, side="right")
                for i in range(s, e):
                    b = np.arange(i + 1, ends[i - s])
                    b = b[part[b] != part[i]]
                    b = b[_reachable(n, pos, np.full(len(b), i), b, similarity)]
                    if len(b):
                        found.append(np.stack([np.maximum(node[b], node[i]), np.minimum(node[b], node[i])]))
                        count += len(b)
                    if count > PASSED:
                        yield _passed(found)
                        found, count = [], 0
            if found:
                yield _passed(found)

    return run


def sketch(hashes: np.ndarray) -> bytes:
    """Parities of how many of a set's ``hashes`` fall on each of about as many places; halves can be folded on each other."""
    width = 1 << min(16, max(8, int(len(hashes)).bit_length()))
    return np.packbits(np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width).astype(np.uint8) & 1).tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound for the number of members that are in one of two sets alone: each changes one parity at most."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) != len(y):
        x, y = (x[: len(x) // 2] ^ x[len(x) // 2 :], y) if len(x) > len(y) else (x, y[: len(y) // 2] ^ y[len(y) // 2 :])
    return int(np.bitwise_count(x ^ y).sum())


def _named(words_per_shingle: int):
    """(node, text, n, sketch) of texts, with the size and the sketch of their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, body in slices(batch, 1_000_000):
                sets = [np.unique(shingle_hashes(t, words_per_shingle)) for t in body]
                columns = [pa.array(list(map(digest, body)), pa.int64()), pa.array(body, pa.binary()), pa.array(list(map(len, sets)), pa.int64()), pa.array(list(map(sketch, sets)), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["node", "text", "n", "sketch"])

    return run


def _can_be_alike(similarity: float):
    """(src, dst) of rows (src, dst, a, b) whose sets (n, sketch) can be as similar by what their sketches say."""
    share = (1 - similarity) / (1 + similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (n, a), (m, b) = (batch.column(k).flatten() for k in (2, 3))
            most = ((n.to_numpy() + m.to_numpy()) * share + 1e-9).tolist()
            held = pa.array([least_difference(x, y) <= z for x, y, z in zip(a.to_pylist(), b.to_pylist(), most, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(held), batch.column(1).filter(held)], ["src", "dst"])

    return run


def _alike(words_per_shingle: int, similarity: float):
    """(src, dst) of rows (src, dst, a, b) whose texts ``a`` and ``b`` are as similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, of_last = None, np.empty(0, np.uint64)
        for batch in batches:
            src, dst = (batch.column(k).to_numpy() for k in (0, 1))
            held = np.zeros(len(src), bool)
            for i, other in enumerate(dst.tolist()):
                if other != last:  # rows come by dst
                    last, of_last = other, np.unique(shingle_hashes(batch.column(3)[i].as_py(), words_per_shingle))
                own = np.unique(shingle_hashes(batch.column(2)[i].as_py(), words_per_shingle))
                common = len(np.intersect1d(own, of_last, assume_unique=True))
                held[i] = common >= similarity * (len(own) + len(of_last) - common) - 1e-9
            yield pa.RecordBatch.from_arrays([pa.array(src[held]), pa.array(dst[held])], ["src", "dst"])

    return run


def _with_ends(pairs: DataFrame, named: DataFrame, value) -> DataFrame:
    """(src, dst, a, b): the pairs with ``value`` of ``named`` (node) for both ends. A node of many pairs is sent to several tasks."""
    a, b = (named.select(F.col("node").alias(end), value.alias(name)) for end, name in (("src", "a"), ("dst", "b")))
    return join_dealt(join_dealt(pairs, a, ["src"], "dst", LINKS), b, ["dst"], "src", LINKS).select("src", "dst", "a", "b")


class Copies:
    """The texts of ``docs`` by ``prints`` (doc_id, node), where a node stands for all texts of the same words."""

    def __init__(self, docs: DataFrame, prints: DataFrame, words_per_shingle: int, similarity: float):
        self.docs, self.prints, self.words, self.similarity = texts(docs, binary=True), prints, words_per_shingle, similarity
        self.classes = stage(prints.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "classes")
        self.first = self.classes.filter(F.col("doc_id").isNotNull())
        self.unique = prints.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").isEmpty()

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (src, dst) of nodes whose texts are as similar: those that sketches do not refuse meet their texts."""
        pairs = stage(pairs.distinct(), "pairs")
        ends = pairs.select(F.col("src").alias("node")).unionByName(pairs.select(F.col("dst").alias("node"))).distinct()
        ids = self.first.join(ends, "node", "left_semi").select("doc_id").distinct()
        needed = self.docs.join(ids.hint("merge"), "doc_id", "left_semi")  # as many ids as documents have candidates: not for a broadcast
        named = needed.mapInArrow(_named(self.words), "node long, text binary, n long, sketch binary")
        named = stage(named if self.unique else named.dropDuplicates(["node"]), "candidates")
        sketched = _with_ends(pairs, named, F.struct("n", "sketch"))
        left = stage(sketched.mapInArrow(_can_be_alike(self.similarity), "src long, dst long"), "left")
        return stage(_with_ends(left, named, F.col("text")).mapInArrow(_alike(self.words, self.similarity), "src long, dst long"), "links")

    def prefixes(self, parts: DataFrame) -> DataFrame:
        """(token, n, pos, node, part): the prefix of each text's set, with the text's component in ``parts``; copies come once."""
        least = self.prints.join(self.classes.withColumnRenamed("doc_id", "least"), "node").filter("doc_id > least").select("doc_id").distinct()
        marks = least.join(self.first.select("doc_id"), "doc_id", "left_anti").select("doc_id", F.lit(True).alias("copy"), F.lit(None).cast("long").alias("part"))
        if self.unique:  # else an id is of several texts, and each text is left in a component of its own
            marks = marks.unionByName(parts.join(self.first, "node").select("doc_id", F.lit(False).alias("copy"), F.col("component").alias("part")))
        marks = stage(marks, "marks")  # written, so that its size decides the join
        single = self.docs.filter("doc_id IS NOT NULL").join(marks, "doc_id", "left").filter("copy IS NULL OR NOT copy").select("doc_id", "text", "part")
        sample = single.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLED)) == 0).mapInArrow(_sets(self.words), "shingles array<long>")
        often = sample.select(F.explode("shingles").alias("token")).groupBy("token").count().filter(F.col("count") >= LEAST_HOT).orderBy(F.desc("count"), "token").limit(HOT).toPandas()
        hot = often["token"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(hot)
        made = single.mapInArrow(_prefixes(hot[order], often["count"].to_numpy(np.int64)[order], self.words, self.similarity), "token long, n int, pos int, node long, part long")
        return stage(made, "prefixes")


def _mixed(rows: DataFrame, least: int) -> DataFrame:
    """The rows of shingles that ``least`` texts of two components share, dealt in tiles and sorted for the pairs."""
    sums = rows.groupBy("token").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count(F.lit(1)).alias("size"))
    mixed = stage(sums.filter(f"low <> high AND size >= {least}").select("token", F.ceil(F.col("size") / TILE).cast("int").alias("tiles")), "mixed")
    dealt = rows.join(mixed, "token")
    own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    return dealt.withColumn("own", own).withColumn("other", other).select("token", (F.least("own", "other") * F.col("tiles") + F.greatest("own", "other")).alias("tile"), "n", "pos", "node", "part", (F.col("own") == F.col("other")).alias("home"))


def _pairs(rows: DataFrame, run) -> DataFrame:
    return rows.drop("home").repartition("token", "tile").sortWithinPartitions("token", "tile", "n", "node").mapInArrow(run, "src long, dst long")


def similar_components(docs: DataFrame, prints: DataFrame, candidates: DataFrame, similarity: float = 0.8, words_per_shingle: int = 5) -> DataFrame:
    """(node, component_id) for every node of ``prints`` (doc_id, node: the digest of the words): component_id is the smallest doc_id reachable.

    Links have the Jaccard similarity ``similarity`` at least. ``candidates`` (src, dst) that have it make the first components.
    Two sets as similar share a shingle among the first ``prefix_size`` of each, in any order of all shingles, so a join on those
    prefixes finds all others: first pairs next to each other by size, then every pair that is in two components still.
    """
    copies = Copies(docs, prints, words_per_shingle, similarity)
    parts = stage(connected_components(copies.verified(candidates)), "parts")
    rows = copies.prefixes(parts)
    near = stage(_mixed(rows, 2), "shared")
    links = copies.verified(_pairs(near, _next_pairs(similarity)))
    merge = lambda links: stage(connected_components(parts.select(F.col("node").alias("src"), F.col("component").alias("dst")).unionByName(links)), "parts")
    parts = merge(links)
    now = near.filter("home").join(parts.withColumnRenamed("node", "of"), F.col("part") == F.col("of"), "left").select("token", "n", "pos", "node", F.coalesce("component", "part").alias("part"))
    more = copies.verified(_pairs(_mixed(now, 4), _joining_pairs(similarity)))
    if not more.isEmpty():
        parts = merge(more)
    grouped = stage(copies.classes.join(parts, "node", "left").select("node", "doc_id", F.coalesce("component", "node").alias("part")), "parts")
    return grouped.join(grouped.groupBy("part").agg(F.min("doc_id").alias("component_id")), "part").select("node", "component_id")
