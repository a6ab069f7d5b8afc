"""Records of large files whose separators may stand inside quotes: any number of tasks read a file, and find out where its records begin."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.operators.graph import written

_STATE = "file long, split long, flip long, out_d long, in_d long, pieces long"
_GLUED = "file long, split long, at long, part int, record string"
#: Parts of a split: the end of a record of the splits before, a whole record, one that goes on in the next split.
HEAD, WHOLE, TAIL = 0, 1, 2


def _pieces(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """(file, split, at, value): what stands between separators, in order of ``at`` within a split of a file."""
    text = spark.read.option("lineSep", sep).text(path)
    return text.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"), "value")


def _count(c: Column, what: str) -> Column:
    return (F.length(c) - F.length(F.replace(c, F.lit(what), F.lit("")))).cast("long")


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """(from, to) of equal neighbours."""
    edge = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    yield from zip([0, *edge.tolist()], [*edge.tolist(), len(keys)], strict=True)


def _walk(flip: np.ndarray, out_d: np.ndarray, in_d: np.ndarray, quoted: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(quoted, depth) before each piece and after the last."""
    q = np.concatenate([[quoted], (quoted + np.cumsum(flip)) % 2])
    return q, depth + np.concatenate([[0], np.cumsum(np.where(q[:-1] == 1, in_d, out_d))])


def _split_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each split, what it does to a state of being in quotes or not: whether quotes flip, and how depth changes if it begins outside or inside."""
    now, out = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        file, split, flip, out_d, in_d = (c.to_numpy() for c in batch.columns)
        for a, b in _runs(split ^ file):
            if now is None or (file[a], split[a]) != now[:2]:
                if now:
                    out.append(now)
                now = (file[a], split[a], 0, 0, 0, 0)
            ends = [_walk(flip[a:b], out_d[a:b], in_d[a:b], (h + now[2]) % 2, now[3 + h]) for h in (0, 1)]
            now = (*now[:2], int(ends[0][0][-1]), int(ends[0][1][-1]), int(ends[1][1][-1]), now[5] + b - a)
    if now:
        out.append(now)
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(np.array(c, np.int64)) for c in zip(*out, strict=True)], ["file", "split", "flip", "out_d", "in_d", "pieces"])


def _glue(sep: str, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, number, begun = None, [], 0, False
        quoted = depth = 0
        out: list[tuple] = []
        size = 0

        def close(part: int) -> None:
            nonlocal held, number, size
            if held:
                out.append((now[0], now[1], number, part, sep.join(held)))
                size += len(out[-1][4])
                number += 1
            held = []

        def passed() -> pa.RecordBatch:
            nonlocal out, size
            made = pa.RecordBatch.from_pydict(dict(zip(("file", "split", "at", "part", "record"), map(list, zip(*out, strict=True)), strict=True)), schema=pa.schema([("file", pa.int64()), ("split", pa.int64()), ("at", pa.int64()), ("part", pa.int32()), ("record", pa.string())]))
            out, size = [], 0
            return made

        for batch in batches:
            if not batch.num_rows:
                continue
            file, split, flip, out_d, in_d, start_q, start_d = (batch.column(i).to_numpy() for i in range(7))
            values = batch.column(7)
            for a, b in _runs(split ^ file):
                if now != (file[a], split[a]):
                    close(TAIL if begun else HEAD)  # what is open at a split's end may go on
                    now, number, begun = (file[a], split[a]), 0, False
                    quoted, depth = int(start_q[a]), int(start_d[a])
                q, d = _walk(flip[a:b], out_d[a:b], in_d[a:b], quoted, depth)
                begins = (q[:-1] == 0) & (d[:-1] <= level)
                texts = values[a : b].to_pylist()
                at = 0
                for k in np.flatnonzero(begins).tolist():
                    held += texts[at:k]
                    close(WHOLE if begun else HEAD)
                    begun, at = True, k
                    if size > 4_000_000:
                        yield passed()
                held += texts[at:]
                quoted, depth = int(q[-1]), int(d[-1])
        if now:
            close(TAIL if begun else HEAD)
        if out:
            yield passed()

    return run


def _records(pieces: DataFrame, sep: str, level: int) -> DataFrame:
    """(file, split, at, record): whole records; one that lies over several splits is put together from its parts, of which a split has two at most."""
    states = written(pieces.select("file", "split", "flip", "out_d", "in_d").mapInArrow(_split_states, _STATE), "states")  # a row for each split
    along = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    quoted = states.withColumn("start_q", F.coalesce(F.sum("flip").over(along), F.lit(0)) % 2)
    change = F.when(F.col("start_q") == 1, F.col("in_d")).otherwise(F.col("out_d"))
    begins = quoted.withColumn("start_d", F.coalesce(F.sum(change).over(along), F.lit(0))).select("file", "split", "start_q", "start_d")
    placed = pieces.join(written(begins, "begins"), ["file", "split"]).sortWithinPartitions("file", "split", "at")
    parts = written(placed.select("file", "split", "flip", "out_d", "in_d", "start_q", "start_d", "value").mapInArrow(_glue(sep, level), _GLUED), "parts")
    cut = parts.filter(F.col("part") != WHOLE)
    # A split's last record and the heads that follow it are one; those few rows are ordered within their file.
    order = Window.partitionBy("file").orderBy("split", "at")
    named = cut.withColumn("of", F.sum((F.col("part") == TAIL).cast("long")).over(order))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "at", "record"))), lambda x: x["record"]), sep)
    first = F.min(F.struct("split", "at"))
    glued = named.groupBy("file", "of").agg(first.alias("first"), joined.alias("record")).select("file", "first.split", "first.at", "record")
    return parts.filter(F.col("part") == WHOLE).select("file", "split", "at", "record").unionByName(glued)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, at, record): records of CSV files with quoted cells, in any number of tasks a file.

    A line begins a record if the quotes before it in its file are even; each split counts its own, a sum over splits
    tells how it begins, and a second pass puts the lines of a record together. A quote inside quotes is doubled.
    """
    lines = _pieces(spark, path, "\n").withColumns({"flip": _count(F.col("value"), '"') % 2, "out_d": F.lit(0).cast("long"), "in_d": F.lit(0).cast("long")})
    return _records(lines, "\n", 0).withColumn("record", F.regexp_replace("record", "\r$", ""))


def json_records(spark: SparkSession, path: str, level: int = 0) -> DataFrame:
    """(file, split, at, record): the objects inside ``level`` outer ones, in any number of tasks a file, with the text before each.

    A file is cut at closing braces. A piece begins an object if it stands outside strings, and no deeper than ``level``; strings and depth
    before each split come from sums over splits, as each split says what it does to either state.
    """
    bare = F.regexp_replace("value", r"\\.", "")
    parts = F.split(bare, '"', -1)
    opened = lambda h: _count(F.array_join(F.filter(parts, lambda _, i: i % 2 == h), ""), "{")
    flip = _count(bare, '"') % 2
    pieces = _pieces(spark, path, "}").withColumn("flip", flip)
    # The brace at the end of a piece closes something if it is outside strings.
    pieces = pieces.withColumns({"out_d": opened(0) - (1 - F.col("flip")), "in_d": opened(1) - F.col("flip")})
    return _records(pieces, "}", level).filter(F.contains("record", F.lit("{"))).withColumn("record", F.concat("record", F.lit("}")))
