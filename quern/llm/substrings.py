"""Substring dedup by content-defined chunks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.base import join_dealt, slices, stage

#: A boundary is where the gear hash's top bits are all zero: once in 2**CUT_BITS places.
CUT_BITS = 4
#: Chunks have at least so many bytes (but for a text's last one), and at most so many.
LEAST, MOST = 24, 1024
#: Bytes on either side without a boundary, after which the hash's smallest value makes one; a power of two.
CALM = 32
#: A passage has so many bytes at least: about forty words.
PASSAGE = 200
#: How often a chunk stands in a row for the stretches of it that are compared.
TIMES = np.unique(np.append(np.arange(1, 17), (16 * 1.25 ** np.arange(1, 80)).astype(np.int64)))
#: Chunks next to each other that stand earlier, each anywhere, are seeds if they have this share of a passage's bytes; its edges are no whole chunks.
RUN = 0.25
#: Chunks of one text in SAMPLED are counted to find the chunks of more than HOT places; this only decides how they are dealt out.
SAMPLED, HOT = 32, 5_000
#: Stands for no doc_id: such rows come last.
NO_ID = 2**63 - 1

_GEAR = np.random.Generator(np.random.PCG64(20240229)).integers(0, 2**32, 256, dtype=np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash after each byte: h = 2h + gear[byte], modulo 2**32, so that it depends on the last 32 bytes alone."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8, 16):
        later = h.copy()
        later[step:] += h[:-step] << np.uint32(step)
        h = later
    return h


def _around(values: np.ndarray, reach: int, of) -> np.ndarray:
    """``of`` (a ufunc such as minimum) over each value and ``reach`` (a power of two) more on either side."""
    wide = np.pad(values, reach, mode="edge")
    step = 1
    while step < 2 * reach:
        wide = of(wide[:-step], wide[step:])
        step *= 2
    return of(wide[:-1], wide[1:])


def cuts(data: np.ndarray) -> np.ndarray:
    """Places after which a chunk may end: where the gear hash's top bits are zero; where no such place is within CALM bytes, where it is smallest within CALM bytes.

    A word or phrase repeated on and on has few values of the hash, or none with a boundary; its smallest value comes back each time, so chunks begin
    at the same letter of it wherever the stretch begins and ends.
    """
    h = gear(data)
    usual = h >> np.uint32(32 - CUT_BITS) == 0
    low = (_around(h, CALM, np.minimum) == h) & ~_around(usual, CALM, np.logical_or)
    return np.flatnonzero(usual | low) + 1


def boundaries(data: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """For each text of ``data`` (they lie end to end, from ``offsets[i]`` to ``offsets[i + 1]``): the ends of its chunks, from its start."""
    places = cuts(data)
    firsts = np.searchsorted(places, offsets, side="right")
    out = []
    for i, (start, stop) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        ends, last = [], 0
        for p in (places[firsts[i] : firsts[i + 1]] - start).tolist() + [stop - start]:
            if p - last < LEAST and p != stop - start or p == last:
                continue
            while p - last > MOST:
                last += MOST
                ends.append(last)
            ends.append(p)
            last = p
        out.append(ends)
    return out


def repeated(digests: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, times, keys): of each stretch of one chunk again and again, which chunk is its first, and a key for it so many times in a row.

    A chunk that stands alone has its digest for a key. A stretch has keys for all small numbers of times that it holds, and for larger ones a
    quarter apart, so one meets the first place of a stretch that is as long; a single chunk of it may stand first in a short one. One key more, from
    its second chunk on, finds the stretch in itself.
    """
    new = np.append(True, (digests[1:] != digests[:-1]) | (owner[1:] != owner[:-1])) if len(digests) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, len(digests)))
    many = np.searchsorted(TIMES, length, side="right")
    first = np.repeat(begin, many)
    times = TIMES[np.arange(len(first)) - np.repeat(np.cumsum(many) - many, many)]
    long = np.flatnonzero(length >= 4)
    first = np.append(first, begin[long] + 1)
    times = np.append(times, TIMES[np.searchsorted(TIMES, length[long] - 1, side="right") - 1])
    with np.errstate(over="ignore"):
        keys = digests[first] ^ ((times - 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return first, times, keys


def _chunks(batches: Iterator[pa.RecordBatch], in_rows: bool = False) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints, done = batch.column(2), 0
        for ids, body in slices(batch, 2_000_000):
            # A text's first 31 bytes must not see the text before it.
            gap = b"\0" * 32
            data = np.frombuffer(gap + gap.join(body), np.uint8)
            sizes = np.array([len(t) for t in body], np.int64)
            begins = np.cumsum(sizes + 32) - sizes
            spans = np.stack([begins, begins + sizes], axis=1).ravel()
            ends = boundaries(data, np.append(spans, len(data)))[::2]
            starts = [[0, *e[:-1]] if e else [] for e in ends]
            owner = np.repeat(np.arange(len(ids)), [len(e) for e in ends])
            digests = [xxhash.xxh3_64_intdigest(t[s:e]) for t, a, b in zip(body, starts, ends, strict=True) for s, e in zip(a, b, strict=True)]
            flat = np.fromiter((s for a in starts for s in a), np.int64, len(digests))
            stops = np.fromiter((e for a in ends for e in a), np.int64, len(digests))
            keys, sizes = np.array(digests, np.uint64), stops - flat
            if in_rows:
                first, times, keys = repeated(keys, owner)
                owner, flat, sizes = owner[first], flat[first], sizes[first] * times
            columns = [pa.array(keys.view(np.int64)), pa.array(ids, pa.int64()).take(pa.array(owner)), prints.slice(done, len(ids)).take(pa.array(owner))]
            done += len(ids)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(flat), pa.array(sizes.astype(np.int32))], ["digest", "id", "print", "start", "size"])


def _keyed(docs: DataFrame) -> DataFrame:
    """(id, text, print): texts that aren't null, with a hash that tells rows of one doc_id apart."""
    text = F.col("text").cast("binary")
    return docs.filter(F.col("text").isNotNull()).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), text.alias("text"), F.xxhash64(text).alias("print"))


def chunks(docs: DataFrame, in_rows: bool = False) -> DataFrame:
    """(digest, id, print, start, size): the chunks of every text; places are in bytes of UTF-8. With ``in_rows`` chunks that stand again and again are put together (``repeated``)."""
    return _keyed(docs).mapInArrow(partial(_chunks, in_rows=in_rows), "digest long, id long, print long, start long, size int")


_PLACE = ["id", "print", "start"]
_FIRST = ["first_id", "first_print", "first_start"]


def _with_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (digest, tile), then place: each with the first place of its group; of tile -1 (no hot chunk) that one is left out."""
    last, of_last = None, None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        digest, tile, *place, size = (c.to_numpy() for c in batch.columns)
        new = np.append(last != (digest[0], tile[0]), (digest[1:] != digest[:-1]) | (tile[1:] != tile[:-1]))
        at = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        first = [np.where(at < 0, 0 if of_last is None else of_last[k], c[at]) for k, c in enumerate(place)]
        last, of_last = (digest[-1], tile[-1]), [c[-1] for c in first]
        same = np.all([a == b for a, b in zip(place, first, strict=True)], axis=0)
        kept = np.flatnonzero(~same | (tile >= 0))
        yield pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in (digest, tile, *place, size, *first)], ["digest", "tile", *_PLACE, "size", *_FIRST])


def _seeds(docs: DataFrame) -> DataFrame:
    """(id, print, start, size, first_id, first_print, first_start): every chunk that stands earlier, with the first place where it does."""
    sample = chunks(docs.filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLED)) == 0), True)
    hot = stage(sample.groupBy("digest").count().filter(F.col("count") * SAMPLED > HOT).select("digest", F.ceil(F.col("count") * SAMPLED / HOT).cast("int").alias("tiles")), "hot")
    rows, any_hot = chunks(docs, True), not hot.isEmpty()
    if any_hot:  # dealt to tiles, which have a first place each
        tile = F.pmod(F.xxhash64("id", "print"), F.col("tiles")).cast("int")
        rows = rows.join(hot, "digest", "left").withColumn("tile", F.coalesce(tile, F.lit(-1)))
    else:
        rows = rows.withColumn("tile", F.lit(-1))
    ordered = rows.select("digest", "tile", *_PLACE, "size").repartition("digest", "tile").sortWithinPartitions("digest", "tile", *_PLACE)
    found = stage(ordered.mapInArrow(_with_first, "digest long, tile int, id long, print long, start long, size int, first_id long, first_print long, first_start long"), "seeds")
    columns = [*_PLACE, "size", *_FIRST]
    cold = found.filter("tile < 0").select(columns)
    if not any_hot:
        return cold
    tiled = found.filter("tile >= 0")
    least = tiled.groupBy("digest").agg(F.min(F.struct(*_FIRST)).alias("least"))
    least = stage(least.select("digest", *[F.col(f"least.{c}").alias(c) for c in _FIRST]), "first")  # a row for each hot chunk, as its written size shows the planner
    own = [F.col(a) == F.col(b) for a, b in zip(_PLACE, _FIRST, strict=True)]
    return cold.unionByName(tiled.drop(*_FIRST).join(least, "digest").filter(~(own[0] & own[1] & own[2])).select(columns))


def _equal(a: bytes, i: int, b: bytes, j: int) -> int:
    """How many bytes are the same from ``a[i]`` and ``b[j]`` on."""
    most, done, step = min(len(a) - i, len(b) - j), 0, 64
    while done < most:
        n = min(step, most - done)
        x, y = a[i + done : i + done + n], b[j + done : j + done + n]
        if x != y:
            return done + int(np.argmax(np.frombuffer(x, np.uint8) != np.frombuffer(y, np.uint8)))
        done, step = done + n, step * 4
    return most


def passages_of(text: bytes, reversed_text: bytes, other: bytes, seeds: list[tuple[int, int, int]], least_bytes: int) -> list[tuple[int, int, int]]:
    """(start, end, start in ``other``) of the longest stretches around ``seeds`` (start, size, start in ``other``) that stand in ``other``, byte for byte."""
    out, behind = [], other[::-1]
    for start, size, there in sorted(seeds):
        if any(s <= start and start + size <= e for s, e, _ in out[-4:]) or text[start : start + size] != other[there : there + size]:
            continue
        before = _equal(reversed_text, len(text) - start, behind, len(other) - there)
        end = start + _equal(text, start, other, there)
        begin = start - before
        while begin < end and text[begin] & 0xC0 == 0x80:  # whole characters alone
            begin += 1
        while end > begin and end < len(text) and text[end] & 0xC0 == 0x80:
            end -= 1
        if end - begin >= least_bytes:
            out.append((begin, end, there - (start - begin)))
    return out


def _grown(least_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, last, text, behind = [], None, b"", b""
            ids, prints, first_ids, seeds = (batch.column(c) for c in ("id", "print", "first_id", "seeds"))
            for k in range(batch.num_rows):
                key = (ids[k].as_py(), prints[k].as_py())
                if key != last:
                    last, text = key, batch.column("a")[k].as_py()
                    behind = text[::-1]
                found = [(x["start"], x["size"], x["there"]) for x in seeds[k].as_py()]
                out += [(*key, s, e, first_ids[k].as_py(), there) for s, e, there in passages_of(text, behind, batch.column("b")[k].as_py(), found, least_bytes)]
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["id", "print", "start", "end", "first_id", "first_start"])

    return run


def repeated_passages(docs: DataFrame, least_bytes: int = PASSAGE) -> DataFrame:
    """(doc_id, start, end, first_doc_id, first_start, print): passages of at least ``least_bytes`` that stand earlier, in another document or in the same.

    Chunks that stand earlier are the seeds: from each the passage is grown to both sides as far as its bytes are those around
    the chunk's first place, so every passage stands in ``first_doc_id`` from ``first_start`` on as it is. A passage may be found
    in several documents, and parts of it too. Earlier is by doc_id, then by a hash of the text, then by place; a row without a
    doc_id is last, and its doc_id is null. Rows alike in doc_id and text are one document. ``start`` and ``end`` are bytes of the text's UTF-8 and don't cut
    characters. ``print`` is the text's hash, which tells apart rows of one doc_id. Null and empty texts have none. A chunk in
    a third of all texts is dealt to many tasks.
    """
    seeds = _seeds(docs)
    by = ["id", "print", "first_id", "first_print"]
    text = Window.partitionBy("id", "print").orderBy("start", "size", *_FIRST)
    shifted = seeds.withColumn("shift", F.col("start") - F.col("first_start"))
    behind = F.max(F.col("start") + F.col("size")).over(text.rowsBetween(Window.unboundedPreceding, -1))
    along = F.struct("first_id", "first_print", "shift") == F.lag(F.struct("first_id", "first_print", "shift")).over(text)
    marked = shifted.withColumns({"fresh": F.when(F.col("start") <= behind, 0).otherwise(1), "along": along}).withColumn("run", F.sum("fresh").over(text))
    marked = marked.withColumn("along", F.coalesce(F.col("along") & (F.col("fresh") == 0), F.lit(False)))
    run = Window.partitionBy("id", "print", "run")
    long = marked.withColumn("bytes", F.max(F.col("start") + F.col("size")).over(run) - F.min("start").over(run)).filter(F.col("bytes") >= least_bytes * RUN)
    heads = long.filter(~F.col("along")).groupBy(*by).agg(F.collect_list(F.struct("start", "size", F.col("first_start").alias("there"))).alias("seeds"))
    pairs = stage(heads, "pairs")  # as many seeds as a text has chunks, at most
    ends = pairs.select("id", "print").unionByName(pairs.select(F.col("first_id").alias("id"), F.col("first_print").alias("print"))).distinct()
    needed = _keyed(docs).join(ends.hint("merge"), ["id", "print"], "left_semi").dropDuplicates(["id", "print"])  # as many as documents have seeds: not for a broadcast
    texts = stage(needed, "seeded")
    there = texts.select(F.col("id").alias("first_id"), F.col("print").alias("first_print"), F.col("text").alias("b"))
    with_b = join_dealt(pairs, there, ["first_id", "first_print"], "print")
    with_a = with_b.join(texts.withColumnRenamed("text", "a").hint("merge"), ["id", "print"])
    grown = with_a.select(*by[:3], "seeds", "a", "b").mapInArrow(_grown(least_bytes), "id long, print long, start long, end long, first_id long, first_start long").distinct()
    named = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return grown.select(named("id").alias("doc_id"), "start", "end", named("first_id").alias("first_doc_id"), "first_start", "print")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            text, last, out = r["text"], 0, []
            for s, e in sorted((x["start"], x["end"]) for x in r["spans"]):
                out.append(text[last:s])
                last = max(last, e)
            kept = b"".join([*out, text[last:]]).decode("utf-8")
            yield pa.RecordBatch.from_arrays([pa.array([None if r["id"] == NO_ID else r["id"]], pa.int64()), pa.array([kept])], ["doc_id", "text"])


def drop_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """(doc_id, text) of ``docs`` without ``passages``, for documents that have some; rows that share a doc_id are told apart by their texts."""
    spans = passages.groupBy(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "print").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return _keyed(docs).join(spans, ["id", "print"]).select("id", "text", "spans").mapInArrow(_cut, "doc_id long, text string")
