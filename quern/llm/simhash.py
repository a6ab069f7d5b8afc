"""SimHash near-duplicate detection, with candidates from a pigeonring filter."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import jaccard
from quern.llm.base import connected_components, digest, shingle_hashes, slices, stage, texts

BITS = 64
#: Rows of one bucket that one task compares; larger buckets are dealt out in tiles.
TILE = 20_000
#: Pairs that a task collects before it passes them on.
PASSED = 1_000_000


def fold(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The fingerprint of each run of ``sizes`` hashes: a bit is set if it is in over half of the run's hashes."""
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = (np.cumsum(sizes) - sizes)[full]
        counts = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * counts > sizes[full][:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def _fingerprints(words_per_shingle: int, with_digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, body in slices(batch, 1_000_000):
                hashes = [shingle_hashes(t, words_per_shingle) for t in body]
                prints = fold(np.concatenate(hashes), np.array([len(h) for h in hashes]))
                digests = list(map(digest, body)) if with_digest else [0] * len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(prints.view(np.int64)), pa.array(digests, pa.int64())], ["doc_id", "fp", "digest"])

    return run


def fingerprints(docs: DataFrame, words_per_shingle: int = 4, with_digest: bool = False) -> DataFrame:
    """(doc_id, fp, digest) for every row; digest is 0, or tells texts of unlike words apart."""
    return texts(docs, binary=True).mapInArrow(_fingerprints(words_per_shingle, with_digest), "doc_id long, fp long, digest long")


def ring_segments(count: int) -> list[tuple[int, int]]:
    """(first bit, width) of ``count`` segments of nearly equal width."""
    cuts = [i * BITS // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def ring_masks(radius: int, count: int, chain: int) -> list[tuple[int, int]]:
    """(mask, start) such that two prints within ``radius`` agree on all bits of some mask and keep the chain from its start.

    Pigeonring: on a ring of ``count`` segments, some chain of consecutive segments keeps its cumulative
    difference within ``length * radius / count`` at every length. A segment with a difference costs one at least,
    so the places of differing segments in such a chain are few; each largest set of places leaves a set of segments
    that must agree.
    """
    budget = [(i + 1) * radius // count for i in range(chain)]
    fits = [s for n in range(budget[-1], -1, -1) for s in combinations(range(chain), n) if all(sum(p <= i for p in s) <= budget[i] for i in range(chain))]
    largest = [s for s in fits if not any(set(s) < set(o) for o in fits)]
    parts = ring_segments(count)
    masks = []
    for start in range(count):
        for s in largest:
            mask = 0
            for k in set(range(chain)) - set(s):
                first, width = parts[(start + k) % count]
                mask |= ((1 << width) - 1) << first
            masks.append((mask, start))
    return masks


def ring_layout(radius: int) -> tuple[int, int]:
    """(segments, chain): the chain starts with two segments that must agree, and goes on while masks stay few."""
    count = 2 * radius + 1
    return count, min(count, 4 if radius <= 5 else 6)


class Chains:
    """The pigeonring test of XORed prints: cumulative differences along the chain from a start, against their budgets."""

    def __init__(self, radius: int):
        count, chain = ring_layout(radius)
        parts = ring_segments(count)
        self.segments = np.array([[((1 << w) - 1) << f for f, w in (parts[(start + k) % count] for k in range(chain))] for start in range(count)], np.uint64)
        self.budgets = np.array([(k + 1) * radius // count for k in range(chain)])
        self.radius = radius

    def near(self, differences: np.ndarray, start) -> np.ndarray:
        """Whether each pair is within the radius: pairs that break the chain from ``start`` are out before their full difference is counted."""
        along = np.bitwise_count(differences[:, None] & self.segments[start]).cumsum(axis=1)
        out = (along <= self.budgets).all(axis=1)
        held = np.flatnonzero(out)
        out[held] = np.bitwise_count(differences[held]) <= self.radius
        return out


def links(prints: np.ndarray, chains: Chains, start: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(from, to) positions of prints that the chain from ``start`` and the radius hold: pairs that keep the components of all such pairs."""
    rest, queue = np.arange(1, len(prints)), [0]
    while len(rest):
        if queue:
            at = queue.pop()
        else:
            at, rest = rest[0], rest[1:]
        near = chains.near(prints[rest] ^ prints[at], start)
        if near.any():
            got = rest[near]
            yield np.full(len(got), at), got
            queue += got.tolist()
            rest = rest[~near]


def _bucket_links(radius: int, starts_of: list[int]):
    """Over rows sorted by bucket: the links inside each bucket. Only the bucket that is open is held, of bounded size by TILE."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chains, start_of = Chains(radius), np.array(starts_of)
        held: list[np.ndarray] = []

        def passed(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
            both = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["src", "dst"])

        def closed(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            """rows: bucket columns (the mask's number first), fp, node; whole buckets only."""
            *keys, fp, node = rows
            if not len(fp):
                return
            edge = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            begins, ends = np.concatenate([[0], edge]), np.concatenate([edge, [len(fp)]])
            pairs: list[tuple[np.ndarray, np.ndarray]] = []
            count = 0
            two = begins[(ends - begins) == 2]
            if len(two):  # most buckets with a pair: checked all at once
                near = two[chains.near(fp[two] ^ fp[two + 1], start_of[keys[0][two]])]
                pairs.append((node[near], node[near + 1]))
            for s, e in zip(begins[(ends - begins) > 2], ends[(ends - begins) > 2], strict=True):
                order = s + np.argsort(node[s:e], kind="stable")
                for a, b in links(fp[order], chains, start_of[keys[0][s]]):
                    pairs.append((node[order[a]], node[order[b]]))
                    count += len(a)
                    if count >= PASSED:
                        yield passed(pairs)
                        pairs, count = [], 0
            if pairs:
                yield passed(pairs)

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            cols[-2] = cols[-2].view(np.uint64)
            if held:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols, strict=True)]
            last = np.flatnonzero(np.any([k != k[-1] for k in cols[:-2]], axis=0))
            cut = last[-1] + 1 if len(last) else 0
            yield from closed([c[:cut] for c in cols])
            held = [c[cut:] for c in cols]
        if held:
            yield from closed(held)

    return run


def candidate_links(nodes: DataFrame, radius: int) -> DataFrame:
    """Links (src > dst) between rows (node, fp) of ``nodes`` at ``radius`` or fewer differing bits, found in pigeonring buckets.

    The links keep the components of all such pairs.
    """
    masks = ring_masks(radius, *ring_layout(radius))
    signed = [m - 2**64 if m >= 2**63 else m for m, _ in masks]

    def keyed(rows: DataFrame) -> DataFrame:
        keys = F.array(*[F.struct(F.lit(i).cast("short").alias("no"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(signed)])
        return rows.select("node", "fp", F.explode(keys).alias("k")).select("k.no", "k.bits", "fp", "node")

    # Which buckets are large is estimated on one print in 16; this only decides how they are dealt out.
    sample = nodes.filter(F.pmod(F.xxhash64("fp"), F.lit(16)) == 0)
    hot = stage(keyed(sample).groupBy("no", "bits").count().filter(F.col("count") * 16 > TILE).select("no", "bits", F.ceil(F.col("count") * 16 / TILE).cast("int").alias("tiles")), "hot")
    rows = keyed(nodes)
    if hot.isEmpty():
        rows = rows.withColumn("tile", F.lit(0))
    else:
        tile = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
        rows = rows.join(hot, ["no", "bits"], "left").withColumn("tiles", F.coalesce("tiles", F.lit(1))).withColumn("own", tile)
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        rows = rows.withColumn("tile", F.least("own", "other") * F.col("tiles") + F.greatest("own", "other"))
    rows = rows.select("no", "bits", "tile", "fp", "node").repartition("no", "bits", "tile").sortWithinPartitions("no", "bits", "tile")
    return rows.mapInArrow(_bucket_links(radius, [start for _, start in masks]), "src long, dst long").distinct()


def near_duplicates(docs: DataFrame, words_per_shingle: int = 4, radius: int = 4, similarity: float | None = None, verify_words: int = 5) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id, text).

    Prints link at ``radius`` or fewer differing bits; ``component_id`` is the smallest doc_id reachable. Null and word-less
    texts have fingerprint zero and link like others. Repeated rows each get their row. A row with a null doc_id joins the
    component of its fingerprint, and has a null component if no doc_id shares it.

    With ``similarity`` texts link if the sets of their ``verify_words``-word shingles have that Jaccard similarity, and texts of
    the same words are one from the start. Links of prints are then candidates that are compared in full; they gather most
    copies. No radius holds all such pairs, so ``jaccard.similar_components`` adds every link between texts that are not yet in one
    component.
    """
    prints = stage(fingerprints(docs, words_per_shingle, similarity is not None), "prints")
    if similarity is not None:
        parts = jaccard.similar_components(docs, prints.select("doc_id", F.col("digest").alias("node")), candidate_links(_nodes(prints, "digest"), radius), similarity, verify_words)
        return prints.join(parts, F.col("digest") == F.col("node")).select("doc_id", _hex("fp"), "component_id")
    classes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("node")), "classes")
    parts = connected_components(candidate_links(classes.filter(F.col("node").isNotNull()).select("node", "fp"), radius))
    named = classes.join(parts, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(named, "fp").select("doc_id", _hex("fp"), "component_id")


def _nodes(prints: DataFrame, node: str) -> DataFrame:
    """(node, fp), once for each node that a doc_id has."""
    return prints.filter(F.col("doc_id").isNotNull()).groupBy(F.col(node).alias("node")).agg(F.min("fp").alias("fp"))


def _hex(fp: str):
    return F.lower(F.lpad(F.hex(fp), 16, "0")).alias("fingerprint")


def first_of_groups(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """``docs`` with the document of each group (doc_id, component_id) that has the smallest doc_id, once. Rows with a null doc_id stay."""
    parts = stage(groups.filter("doc_id = component_id").groupBy("doc_id").count(), "kept")
    kept = docs.join(parts.hint("merge"), "doc_id", "left_semi")  # nearly as many ids as documents: not for a broadcast
    if not parts.filter("count > 1").isEmpty():  # only then rows share a doc_id
        kept = kept.dropDuplicates(["doc_id"])
    return kept.unionByName(docs.filter(F.col("doc_id").isNull()))


def keep_first(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one with the smallest doc_id, once.

    Rows with a null doc_id stay.
    """
    return first_of_groups(docs, near_duplicates(docs, **how))
