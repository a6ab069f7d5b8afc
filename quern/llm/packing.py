"""Best-fit packing of documents into token sequences by a grouping genetic algorithm on islands."""

from __future__ import annotations

import base64
import random
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.base import slices, stage, texts

CAPACITY = 2048
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Items of one sub-problem: what one genetic search packs.
SHARD = 2_000
ISLANDS, EPOCHS, GENERATIONS, POPULATION = 3, 2, 6, 4
#: A level of packing keeps the bins filled at least so far; what is in the others goes on to the next level, with fewer shards.
FROZEN = (0.995, 0.97, 0.0)
#: Words whose ids one Python worker remembers.
REMEMBERED = 250_000


@lru_cache(1)
def _encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path if "/" in path else public_tokenizers.path(path), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class _Known(dict):
    """Little-endian ids of " " + word; filled on demand."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = np.array(self.encode(" " + word), "<u4").tobytes()
        return ids


#: White space beside a space, or of a rare kind: there a text can't be cut at its spaces.
_ODD = re.compile(r"[^\S \n]")


def token_bytes(text: str, known: _Known) -> bytes:
    """The ids of ``text`` as little-endian unsigned 32-bit numbers.

    No token of the pattern crosses a single space before a word, so such texts are put together from the ids of their words.
    """
    if "  " in text or " \n" in text or "\n " in text or text[-1:] == " " or _ODD.search(text):
        return np.array(known.encode(text), "<u4").tobytes()
    if len(known) > REMEMBERED:
        known.clear()
    first, *rest = text.split(" ")
    return np.array(known.encode(first), "<u4").tobytes() + b"".join(map(known.__getitem__, rest))


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(_encoding(path).encode_ordinary)
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for ids, body in slices(batch):
                out = []
                for i, text in zip(ids, body, strict=True):
                    data = token_bytes(text, known) + b"\0\0\0\0"
                    n = len(data) // 4
                    at = 0
                    for piece in range(-(-n // capacity)):
                        size = (n % capacity or capacity) if piece == 0 else capacity
                        out.append((row, i, piece, at, size, zlib.crc32(data[4 * at : 4 * (at + size)])))
                        row, at = row + 1, at + size
                yield pa.RecordBatch.from_pylist([dict(zip(_PIECE.names, x, strict=True)) for x in out], schema=_PIECE)

    return run


_PIECE = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """(row, doc_id, piece, start, length, ids_crc32): each document's ids and an id 0, cut into ``capacity`` ids, a short piece first.

    ``row`` tells pieces apart. A null text is empty and has its id 0 alone. ``vocabulary`` is a file of ranks, or its public name.
    """
    return texts(docs).mapInArrow(_pieces(vocabulary, capacity), "row long, doc_id long, piece int, start long, length long, ids_crc32 long")


class Bins:
    """Best fit: the bins by their free space, and a bit for each space that some bin has."""

    def __init__(self, capacity: int):
        self.capacity, self.by, self.bits, self.free = capacity, [[] for _ in range(capacity + 1)], 0, []

    def put(self, b: int, free: int) -> None:
        self.by[free].append(b)
        self.bits |= 1 << free

    def fit(self, size: int) -> int:
        """The bin that ``size`` leaves least space in, or a new one; it is taken."""
        above = self.bits >> size
        if above:
            free = size + (above & -above).bit_length() - 1
            b = self.by[free].pop()
            if not self.by[free]:
                self.bits ^= 1 << free
            self.free[b] = free - size
        else:
            b = len(self.free)
            self.free.append(self.capacity - size)
        self.put(b, self.free[b])
        return b


def best_fit(lengths: list[int], order, capacity: int, assigned: np.ndarray | None = None, fills: np.ndarray | None = None) -> np.ndarray:
    """The bin of each item, with the items of ``order`` put in that order beside what ``assigned`` and ``fills`` hold."""
    bins = Bins(capacity)
    out = np.full(len(lengths), -1, np.int32) if assigned is None else assigned
    for b, fill in enumerate([] if fills is None else fills.tolist()):
        bins.free.append(capacity - fill)
        bins.put(b, capacity - fill)
    for i in order:
        out[i] = bins.fit(lengths[i])
    return out


def fitness(assigned: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first; then bins as unlike in fill as can be, which leaves space that can be used."""
    fills = np.bincount(assigned, lengths) / capacity
    return -len(fills), float((fills**2).sum() / max(1, len(fills)))


def crossover(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, capacity: int, rng: random.Random) -> np.ndarray:
    """``a`` with whole well-filled bins of ``b``: bins of ``a`` that hold one of their items go, and what those held besides is best-fitted."""
    fills = np.bincount(b, lengths)
    ranked = np.argsort(-fills, kind="stable")
    share = max(1, int(len(ranked) * rng.uniform(0.2, 0.6)))
    chosen = np.zeros(len(fills), bool)
    chosen[ranked[:share]] = True
    injected = chosen[b]
    hit = np.zeros(a.max() + 1, bool)
    hit[a[injected]] = True
    mine = np.bincount(a, lengths)
    weak = np.argsort(mine, kind="stable")[: max(1, len(mine) // 50)]  # the weakest bins are broken up as well
    hit[weak] = True
    displaced = np.flatnonzero(hit[a] & ~injected)
    out = np.full(len(a), -1, np.int64)
    stay = ~hit[a] & ~injected
    out[stay] = a[stay]
    out[injected] = b[injected] + len(mine)
    placed = out >= 0
    names, numbers = np.unique(out[placed], return_inverse=True)
    out[placed] = numbers
    order = displaced[np.argsort(-lengths[displaced], kind="stable")]
    return best_fit(lengths.tolist(), order.tolist(), capacity, out.astype(np.int32), np.bincount(numbers, lengths[placed], len(names)).astype(np.int64))


def complete(assigned: np.ndarray, lengths: np.ndarray, capacity: int) -> bool:
    """Whether no packing can be better: all bins but one are full."""
    fills = np.bincount(assigned, lengths)
    return int((fills < capacity).sum()) <= 1


def evolve(lengths: np.ndarray, population: list[np.ndarray], capacity: int, seed: int, generations: int = GENERATIONS) -> list[np.ndarray]:
    """The population after ``generations``, best first.

    It starts from best fit by falling length and, with ``seed``, by lengths with more and more noise, down to chance. Packings of
    as few bins as can be are bred on: the emptier the last bins, the fewer sequences all shards take together.
    """
    rng = random.Random(seed)
    sizes = lengths.tolist()
    population = list(population)
    while len(population) < POPULATION:
        noise = np.array([rng.random() for _ in sizes]) * (0.0 if not population else 4.0 ** len(population) / 40)
        population.append(best_fit(sizes, np.argsort(-lengths * (1 + noise), kind="stable").tolist(), capacity))
    score = lambda x: fitness(x, lengths, capacity)
    population.sort(key=score, reverse=True)
    for _ in range(generations):
        if complete(population[0], lengths, capacity):
            break
        a, b = rng.sample(range(len(population)), 2)
        child = crossover(population[a], population[b], lengths, capacity, rng)
        if score(child) > score(population[-1]):
            population[-1] = child
            population.sort(key=score, reverse=True)
    return population


_ISLAND = "shard long, island int, rows array<long>, lengths array<int>, elites array<array<int>>"


def _epoch(capacity: int, epoch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                lengths = np.array(r["lengths"], np.int64)
                grown = evolve(lengths, [np.array(e, np.int32) for e in r["elites"] or []], capacity, r["shard"] * 1009 + r["island"] * 31 + epoch)
                r["elites"] = [e.tolist() for e in grown[:2]]
                yield pa.RecordBatch.from_pylist([r], schema=_ISLAND_ARROW)

    return run


_ISLAND_ARROW = pa.schema([("shard", pa.int64()), ("island", pa.int32()), ("rows", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("elites", pa.list_(pa.list_(pa.int32())))])


def _placed(capacity: int):
    """Of each shard's best packing: every item with its sequence, its place there and how full the sequence is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                rows, lengths, bins = np.array(r["rows"], np.int64), np.array(r["lengths"], np.int64), np.array(r["best"], np.int64)
                order = np.lexsort((rows, bins))
                b, n = bins[order], lengths[order]
                total = np.cumsum(n) - n
                first = np.concatenate([[0], np.flatnonzero(b[1:] != b[:-1]) + 1])
                sizes = np.diff(np.append(first, len(b)))
                fills = np.repeat(np.add.reduceat(n, first), sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[order]), pa.array(np.repeat(rows[order][first], sizes) * 2 + 1), pa.array(total - np.repeat(total[first], sizes)), pa.array(fills / capacity)],
                    ["row", "sequence_id", "offset", "fill"],
                )

    return run


def _pack_level(items: DataFrame, shards: int, capacity: int) -> DataFrame:
    """(row, sequence_id, offset, fill) for ``items`` (row, length), each shard packed on islands of its own."""
    shard = F.pmod(F.xxhash64("row"), F.lit(shards))
    dealt = items.groupBy(shard.alias("shard")).agg(F.array_sort(F.collect_list(F.struct((-F.col("length")).alias("n"), "row"))).alias("items"))
    state = dealt.select("shard", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), F.col("items.row").alias("rows"), F.transform("items", lambda x: (-x["n"]).cast("int")).alias("lengths"), F.array().cast("array<array<int>>").alias("elites"))
    for epoch in range(EPOCHS):
        state = stage(state.repartition("shard", "island").mapInArrow(_epoch(capacity, epoch), _ISLAND), "islands")
        if epoch < EPOCHS - 1:  # the best packing of each island moves on to the next one
            moved = state.select("shard", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.slice("elites", 1, 1).alias("came"))
            state = state.join(moved, ["shard", "island"]).select("shard", "island", "rows", "lengths", F.concat("elites", "came").alias("elites"))
    bins = F.array_max(F.col("elites")[0]) + 1
    best = state.groupBy("shard").agg(F.min_by(F.struct("rows", "lengths", F.col("elites")[0].alias("best")), F.struct(bins, F.col("island"))).alias("x")).select("x.*")
    return best.mapInArrow(_placed(capacity), "row long, sequence_id long, offset long, fill double")


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): all pieces of ``docs``, packed into few sequences.

    A piece of ``capacity`` ids is a sequence. The others are dealt to shards by hash; each shard is a bin-packing problem that
    several islands work on, with their best packings migrating between them. Well-filled bins of a shard are final; the rest
    is dealt to fewer shards, so that what is left over in the end is the rest of one shard. Repeated rows are packed as often
    as they come. An empty table gives an empty result.
    """
    cut = stage(pieces(docs, vocabulary, capacity), "pieces")
    whole = cut.filter(F.col("length") == capacity).select("row", (F.col("row") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    items = cut.filter(F.col("length") < capacity).select("row", "length")
    done = [whole]
    for level, least in enumerate(FROZEN):
        shards = max(1, -(-items.count() // SHARD))
        packed = stage(_pack_level(items, shards, capacity), f"packed{level}")
        final = shards == 1 or least == 0
        done.append((packed if final else packed.filter(F.col("fill") >= least)).select("row", "sequence_id", "offset"))
        if final:
            break
        items = packed.filter(F.col("fill") < least).select("row").join(cut.select("row", "length"), "row")
    places = done[0]
    for more in done[1:]:
        places = places.unionByName(more)
    return cut.join(places, "row").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
