"""LM scoring by a class-based bigram model; classes come from exchange clustering."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.base import slices, stage, texts

#: The most frequent words: so many exchange classes among themselves first, and the classes of so many are held by each task.
SEEDS, HELD = 4_096, 200_000
CLASSES = 48
#: Sweeps over the seeds, each in so many steps, and sweeps over all other words.
SWEEPS, STEPS, REST_SWEEPS = 4, 2, 2
#: Weight of the class bigram against the class's own frequency.
BIGRAM_WEIGHT = 0.9
#: Words counted by one task before it passes counts on.
COUNTED = 300_000
#: Bytes of text whose words a task holds, and counts together, at a time.
SLICE = 2_000_000

#: The token that ends a text. It can't be a word, as it holds a space.
END = b" "
#: Positions of a text, and classes, in one number.
CLASS_BITS = 8


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def passed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for _, body in slices(batch, SLICE):
            for text in body:
                counts.update(text.lower().split())
            counts[END] += len(body)
            if len(counts) > COUNTED:
                yield passed()
                counts.clear()
    yield passed()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over all of ``docs``: words of lower-cased ASCII letters, and ``END`` once a row."""
    return texts(docs, binary=True).mapInArrow(_counts, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def most_frequent(words: DataFrame, most: int) -> DataFrame:
    """The rows of (word, c) of so high a count that they are ``most`` at most; words of like count are in or out together.

    Found from a histogram of counts on a logarithmic scale, a few thousand rows whatever the corpus.
    """
    level = F.floor(F.log(F.col("c").cast("double")) * 100)
    least, taken = None, 0
    for r in sorted(words.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")).collect(), reverse=True):
        taken += r.n
        if taken > most:
            break
        least = r.c
    return words.filter(F.lit(False) if least is None else F.col("c") >= least)


def tokens_of(body: list[bytes]) -> list[bytes]:
    """The words of all texts, with END after each."""
    return list(chain.from_iterable((*text.lower().split(), END) for text in body))


def f(x: np.ndarray) -> np.ndarray:
    """x log x, which the likelihood of a class bigram model is made of."""
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def likelihood(grid: np.ndarray) -> float:
    """Of class bigram counts: sum G(a,b) log G(a,b) - sum L(a) log L(a) - sum R(b) log R(b), over cells and margins."""
    return float(f(grid).sum() - f(grid.sum(1)).sum() - f(grid.sum(0)).sum())


def best_class(right: np.ndarray, left: np.ndarray, own: float, a: int, grid: np.ndarray, classes: int) -> int:
    """The class that a word of class ``a`` should move to: the first of those that raise the likelihood most.

    ``right`` and ``left`` count the classes after and before the word, which ``grid`` counts too; ``own`` is how often it follows
    itself, and is in neither.
    """
    grid = grid.copy()
    grid[a] -= right
    grid[:, a] -= left
    grid[a, a] -= own
    rows, cols, k = grid[:classes], grid[:, :classes].T, np.arange(classes)
    gain = (f(rows + right) - f(rows)).sum(1) + (f(cols + left) - f(cols)).sum(1)
    cell, r, le = grid[k, k], right[:classes], left[:classes]
    gain += f(cell + r + le + own) - f(cell + r) - f(cell + le) + f(cell)
    n_row, n_col = grid.sum(1)[:classes] + le, grid.sum(0)[:classes] + r  # there wherever the word goes
    gain -= f(n_row + right.sum() + own) - f(n_row) + f(n_col + left.sum() + own) - f(n_col)
    return int(gain.argmax())


def _seed_pairs(numbers: dict[bytes, int]):
    """(pair, n): how often one seed follows another; END and all other words are a symbol each."""
    end, other, size = len(numbers), len(numbers) + 1, len(numbers) + 2
    known = numbers | {END: end}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int32)  # of one task
        for batch in batches:
            for _, body in slices(batch, SLICE):
                flat = tokens_of(body)
                now = np.fromiter(map(known.get, flat, repeat(other)), np.int64, len(flat))
                before = np.concatenate([[end], now[:-1]])  # each text follows an END
                pairs, n = np.unique(before * size + now, return_counts=True)
                total[pairs] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at].astype(np.int64))], ["pair", "n"])

    return run


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of rows (word, entries: list of (code, n)): the first of each row's entries, then row, code and n of every entry."""
    lists = batch.column(1)
    flat = lists.flatten()
    sizes = np.diff(lists.offsets.to_numpy())
    return np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes), flat.field(0).to_numpy(), flat.field(1).to_numpy().astype(np.float64)


def _vectors(batch: pa.RecordBatch, where: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of seeds: number, counts of the classes after and before each, and how often it follows itself. Codes are twice the neighbour's number, and one more for a word before."""
    seeds = batch.column(0).to_numpy()
    _, row, code, n = _entries(batch)
    near, before = code >> 1, (code & 1).astype(bool)
    same = near == seeds[row]
    own = np.bincount(row[same & ~before], n[same & ~before], len(seeds))
    sides = [np.bincount(row[side & ~same] * width + where[near[side & ~same]], n[side & ~same], len(seeds) * width).reshape(-1, width) for side in (~before, before)]
    return seeds, sides[0], sides[1], own


def _seed_grid(where: np.ndarray, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                seeds, right, _, own = _vectors(batch, where, width)
                np.add.at(total, where[seeds], right)
                np.add.at(total, (where[seeds], where[seeds]), own)
        yield _cells(total)

    return run


def _cells(grid: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(grid)
    return pa.RecordBatch.from_arrays([pa.array(at), pa.array(grid.ravel()[at].astype(np.int64))], ["cell", "n"])


def _summed(cells: DataFrame, width: int) -> np.ndarray:
    """The sum of the tasks' class bigram counts: a small table, whatever the corpus."""
    grid = np.zeros(width * width)
    rows = cells.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    grid[rows["cell"].to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
    return grid.reshape(width, width)


def _seed_moves(where: np.ndarray, grid: np.ndarray, classes: int, step: int, steps: int):
    moving = len(where) - 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                seeds, right, left, own = _vectors(batch, where, len(grid))
                mine = [i for i, s in enumerate(seeds.tolist()) if s < moving and s % steps == step]
                best = [best_class(right[i], left[i], own[i], int(where[seeds[i]]), grid, classes) for i in mine]
                yield pa.RecordBatch.from_arrays([pa.array(seeds[mine].astype(np.int64)), pa.array(best, pa.int64())], ["seed", "best"])

    return run


def exchange(contexts: DataFrame, seeds: int, classes: int, sweeps: int = SWEEPS, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(class of each symbol, class bigram counts) by exchange clustering of the seeds in ``contexts`` (seed, entries).

    In each step tasks decide for their part of the seeds which class raises the likelihood most, against the classes at the
    step's start; a step that lowers the likelihood is taken back. END and all other words are a class of their own each.
    """
    width = classes + 2
    where = np.append(np.arange(seeds) % classes, [classes, classes + 1])
    count = lambda w: _summed(contexts.mapInArrow(_seed_grid(w, width), "cell long, n long"), width)
    grid = count(where)
    for step in range(sweeps * steps):
        moves = contexts.mapInArrow(_seed_moves(where, grid, classes, step % steps, steps), "seed long, best long").toPandas()
        moved = where.copy()
        moved[moves["seed"].to_numpy(np.int64)] = moves["best"].to_numpy(np.int64)
        made = count(moved)
        if likelihood(made) > likelihood(grid):
            where, grid = moved, made
    return where, grid


def _rest_contexts(class_of: dict[bytes, int], classes: int):
    """(word, code, n) of all words but the seeds: code is the class before the word times the number of symbols, plus the class after it."""
    end, other, width = classes, classes + 1, classes + 2
    known = class_of | {END: end}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, body in slices(batch, SLICE):
                flat = tokens_of(body)
                now = np.fromiter(map(known.get, flat, repeat(other)), np.int64, len(flat))
                at = np.flatnonzero(now == other)
                code = np.concatenate([[end], now[:-1]])[at] * width + np.concatenate([now[1:], [end]])[at]
                words = pa.array([flat[i] for i in at.tolist()], pa.binary()).dictionary_encode()
                both, n = np.unique(words.indices.to_numpy().astype(np.int64) * width * width + code, return_counts=True)
                columns = [words.dictionary.take(pa.array(both // (width * width))), pa.array((both % (width * width)).astype(np.int32)), pa.array(n.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["word", "code", "n"])

    return run


def rest_moves(grid: np.ndarray, classes: int, now: np.ndarray, first: np.ndarray, row: np.ndarray, code: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For each word the class that raises the likelihood most; what a word of class ``now`` adds to the cells of that class is taken off first."""
    width = len(grid)
    mine = now[row][:, None] == np.arange(classes)
    n = n[:, None]
    gain = np.zeros((len(n), classes))
    for cells in (grid[:classes, code % width].T, grid[code // width, :classes]):
        there = np.maximum(cells - np.where(mine, n, 0), 0)
        gain += f(there + n) - f(there)
    gain, total = np.add.reduceat(gain, first), np.add.reduceat(n, first)
    own = np.where(now[:, None] == np.arange(classes), total, 0)
    for margin in (grid.sum(1)[:classes], grid.sum(0)[:classes]):
        there = np.maximum(margin - own, 0)
        gain -= f(there + total) - f(there)
    return gain.argmax(1).astype(np.int32)


def _rest_moves(grid: np.ndarray, classes: int):
    """(word, entries, class) with each word in its best class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2_000):
                batch = whole.slice(start, 2_000)
                best = rest_moves(grid, classes, batch.column(2).to_numpy(), *_entries(batch))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(best)], ["word", "entries", "class"])

    return run


def _rest_grid(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * width)
        for batch in batches:
            if batch.num_rows:
                _, row, code, n = _entries(batch)
                mine = batch.column(2).to_numpy()[row]
                total += np.bincount(np.concatenate([mine * width + code % width, code // width * width + mine]), np.concatenate([n, n]), width * width)
        yield _cells(total.reshape(width, width))

    return run


def word_classes(train: DataFrame, counts: DataFrame, seeds: int = SEEDS, classes: int = CLASSES) -> DataFrame:
    """(word, c, class) of every word in ``counts`` but END, by exchange clustering over the texts of ``train``.

    The ``seeds`` most frequent words are clustered first, on the counts of each beside each. Then every other word moves to
    the class that raises the likelihood most, by how often it stands beside each class of seeds, END, or another word; class
    bigrams are counted anew before each sweep.
    """
    body, width = texts(train, binary=True), classes + 2
    words = counts.filter(F.col("word") != F.lit(bytearray(END)))
    frequent = sorted(most_frequent(words, seeds).collect(), key=lambda r: (-r.c, bytes(r.word)))
    numbers = {bytes(r.word): i for i, r in enumerate(frequent)}
    size = len(numbers) + 2
    pairs = body.mapInArrow(_seed_pairs(numbers), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    sides = [(F.expr(f"pair div {size}"), F.col("pair") % size * 2), (F.col("pair") % size, F.expr(f"pair div {size}") * 2 + 1)]
    entry = F.explode(F.array(*[F.struct(a.cast("int").alias("seed"), b.cast("int").alias("code"), F.col("n")) for a, b in sides])).alias("e")
    listed = pairs.select(entry).select("e.*").groupBy("seed").agg(F.collect_list(F.struct("code", "n")).alias("entries"))  # as many entries as there are seeds, at most
    contexts = stage(listed.repartition(2 * train.sparkSession.sparkContext.defaultParallelism), "contexts")
    where, grid = exchange(contexts, len(numbers), classes)
    class_of = {w: int(where[i]) for w, i in numbers.items()}
    rest = body.mapInArrow(_rest_contexts(class_of, classes), "word binary, code int, n long").repartition("word")
    rest = rest.groupBy("word", "code").agg(F.sum("n").alias("n")).groupBy("word").agg(F.collect_list(F.struct("code", "n")).alias("entries"))  # a code for each two classes, at most
    rest = stage(rest, "rest")
    found, seed_grid = rest.withColumn("class", F.lit(-1)), grid
    for sweep in range(REST_SWEEPS):
        if sweep:
            grid = seed_grid + _summed(found.mapInArrow(_rest_grid(width), "cell long, n long"), width)
        found = stage(found.mapInArrow(_rest_moves(grid, classes), "word binary, entries array<struct<code:int,n:long>>, class int"), "found")
    seeded = train.sparkSession.createDataFrame([(bytearray(w), k) for w, k in class_of.items()], "word binary, class int")
    return words.join(found.select("word", "class").unionByName(seeded), "word").select("word", "c", "class")


@dataclass
class Model:
    """log10 probabilities of classes 0 to ``end`` (END): ``after`` (a row for each class before, and one for an unknown word), of a word in its class but for its count, and of an unknown word."""

    after: np.ndarray
    emission: np.ndarray
    unknown: np.ndarray

    @property
    def end(self) -> int:
        return len(self.emission) - 1


def model_of(grid: np.ndarray, mass: np.ndarray, kinds: np.ndarray, weight: float = BIGRAM_WEIGHT) -> Model:
    """The model of class bigram counts (END last) and of each class's tokens and words.

    P(word | class before) = P(class | class before) * (c + 1) / (tokens + words + 1 of the class). The first factor mixes bigram
    frequencies with add-one class frequencies. Each class gives one part in that sum to words never seen; their probabilities
    are added up over the classes. After such a word the class frequencies count alone. END is alone in its class.
    """
    margin = grid.sum(0) + 1
    alone = margin / margin.sum()
    before = grid.sum(1, keepdims=True)
    share = np.where(before > 0, weight, 0.0)
    after = np.vstack([share * grid / np.maximum(before, 1) + (1 - share) * alone, alone])
    room = mass + kinds + 1.0
    unknown = np.log10((after[:, :-1] / room).sum(1))
    return Model(np.log10(after), np.append(-np.log10(room), 0.0), unknown)


def _scanned(held: list[bytes], of_held: np.ndarray, counts: np.ndarray, end_count: int, end: int):
    """A row for each text (its classes, with ``unknown`` for words that aren't held) and one for each such word."""
    classes = np.append(of_held, [end, end + 1]).astype(np.uint8)
    logs = np.log10(np.append(counts, [end_count, 0]) + 1.0)
    known = np.array([True] * len(held) + [end_count > 0, False])
    rest = len(held) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = {w: i for i, w in enumerate(held)} | {END: len(held)}
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            learn, done = batch.column(2), 0
            for ids, body in slices(batch, SLICE):
                flat = tokens_of(body)
                number = np.fromiter(map(numbers.get, flat, repeat(rest)), np.int64, len(flat))
                stops = np.flatnonzero(number == len(held)) + 1
                starts = np.concatenate([[0], stops[:-1]])
                at = np.flatnonzero(number == rest)
                text = np.searchsorted(stops, at, side="right")
                made = classes[number].tobytes()
                rows = row + np.arange(len(ids))
                row += len(ids)
                none, blank = pa.nulls(len(at)), np.zeros(len(at))
                columns = [
                    np.concatenate([rows, rows[text]]),
                    pa.concat_arrays([pa.array(ids, pa.int64()), none.cast(pa.int64())]),
                    pa.concat_arrays([learn.slice(done, len(ids)), none.cast(pa.bool_())]),
                    # A text's own row has a key that no word has, and that no other text has.
                    pa.array([b" %d" % r for r in rows.tolist()] + [flat[i] for i in at.tolist()], pa.binary()),
                    np.concatenate([np.full(len(ids), -1), at - starts[text]]),
                    pa.concat_arrays([pa.array([made[a:b] for a, b in zip(starts, stops, strict=True)], pa.binary()), none.cast(pa.binary())]),
                    np.concatenate([np.add.reduceat(known[number].astype(np.int64), starts), blank.astype(np.int64)]),
                    np.concatenate([np.add.reduceat(logs[number], starts), blank]),
                ]
                done += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, (np.ndarray, list)) else c for c in columns], _SCANNED)

    return run


_SCANNED = ["row", "doc_id", "learn", "word", "pos", "classes", "known", "logs"]


def _filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Puts the classes of the words that weren't held into their texts' classes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lists, sequences = batch.column(2), batch.column(1)
        flat = np.frombuffer(b"".join(sequences.to_pylist()), np.uint8).copy()
        sizes = np.array([len(s.as_buffer()) for s in sequences])
        starts = np.cumsum(sizes) - sizes
        places = lists.flatten().to_numpy()
        flat[np.repeat(starts, np.diff(lists.offsets.to_numpy())) + (places >> CLASS_BITS)] = places & ((1 << CLASS_BITS) - 1)
        body = flat.tobytes()
        made = pa.array([body[a : a + n] for a, n in zip(starts, sizes, strict=True)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), made, *batch.columns[3:]], ["doc_id", "classes", *batch.schema.names[3:]])


def _sequences(batch: pa.RecordBatch, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(where each text starts, classes, classes before) of all texts of a batch."""
    body = batch.column(0).to_pylist()
    now = np.frombuffer(b"".join(body), np.uint8).astype(np.int64)
    sizes = np.array(list(map(len, body)))
    return np.cumsum(sizes) - sizes, now, np.concatenate([[end], now[:-1]])  # each text ends with END


def _class_grid(end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((end + 2) ** 2)
        for batch in batches:
            if batch.num_rows:
                _, now, before = _sequences(batch, end)
                total += np.bincount(before * (end + 2) + now, minlength=len(total))
        yield _cells(total.reshape(end + 2, end + 2))

    return run


def _scores(model: Model):
    end = model.end
    after = np.hstack([model.after + model.emission, model.unknown[:, None]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                starts, now, before = _sequences(batch, end)
                score = np.add.reduceat(after[before, now], starts)
                n = np.diff(np.append(starts, len(now)))
                columns = [*batch.columns[1:], pa.array(n), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "known", "logs", "n_tokens", "by_class"])

    return run


def score_texts(docs: DataFrame, learn: Column, seeds: int = SEEDS, held: int = HELD, classes: int = CLASSES) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity) for every row of ``docs``, learned from rows for which ``learn`` holds.

    Every word of the rows learned from is counted and gets a class by exchange (``word_classes``). The classes of the ``held``
    most frequent are sent to the tasks; all other words meet theirs in a join, and each text's classes are put together again.
    ``classes`` is below 254. A null text is empty and has its end token alone. Repeated rows each get their row. With nothing to
    learn from, all tokens are unknown. ``perplexity`` is 10 to the score's negative share of a token.
    """
    train = docs.filter(learn)
    counts = stage(word_counts(train), "counts").filter("c > 0")
    total, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    end_count = next((r.c for r in counts.filter(F.col("word") == F.lit(bytearray(END))).collect()), 0)
    classed = stage(word_classes(train, counts, seeds, classes), "classed")
    sums = classed.groupBy("class").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect()  # a row for each class
    mass, words = np.zeros(classes), np.zeros(classes)
    for r in sums:
        mass[r["class"]], words[r["class"]] = r.c, r.n
    top = most_frequent(classed, held).toPandas()
    known, least = list(map(bytes, top["word"])), None if top.empty else int(top["c"].min())
    others = classed if least is None else classed.filter(F.col("c") < least)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    scanned = rows.mapInArrow(_scanned(known, top["class"].to_numpy(np.uint8), top["c"].to_numpy(np.int64), end_count, classes), "row long, doc_id long, learn boolean, word binary, pos long, classes binary, known long, logs double")
    joined = scanned.join(others, "word", "left")
    packed = F.when(F.col("pos") >= 0, F.shiftleft("pos", CLASS_BITS) + F.coalesce("class", F.lit(classes + 1)))
    whole = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("classes").alias("classes"),
        F.collect_list(packed).alias("places"),  # the words of one text
        F.max("learn").alias("learn"),
        F.sum(F.col("known") + F.when(F.col("c") > 0, 1).otherwise(0)).alias("known"),
        F.sum(F.col("logs") + F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("logs"),
    )
    filled = stage(whole.drop("row").mapInArrow(_filled, "doc_id long, classes binary, learn boolean, known long, logs double"), "classes")
    grid = _summed(filled.filter("learn").select("classes").mapInArrow(_class_grid(classes), "cell long, n long"), classes + 2)[:-1, :-1]
    scored = filled.select("classes", "doc_id", "known", "logs").mapInArrow(_scores(model_of(grid, mass, words)), "doc_id long, known long, logs double, n_tokens long, by_class double")
    score = F.col("logs") - math.log10(end_count + 1) + F.col("by_class")
    return scored.select(
        "doc_id",
        "n_tokens",
        F.col("known").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * math.log10(total + kinds + 1)).alias("base_score"),
        score.alias("score"),
        F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"),
    )
