"""Periodic runs of words, found by string synchronising sets."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.base import slices, texts

#: Words of the shortest run that is reported.
LEAST = 12
#: Bytes of text that are searched together.
BATCH = 1_500_000

_ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_NONE = np.uint64(2**64 - 1)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of each pair."""
    x = (a ^ (a >> np.uint64(29))) * _ODD[0] + (b ^ (b >> np.uint64(31))) * _ODD[1]
    x ^= x >> np.uint64(32)
    x *= _ODD[2]
    return x ^ (x >> np.uint64(30))


class Contexts:
    """Hashes of all windows of 1, 2, 4, ... words over texts that are laid one after another, longest first, with a mark of its own around each.

    A window with a mark in it equals no other, so nothing is ever found across texts.
    """

    def __init__(self, texts_: list[np.ndarray]):
        sizes = np.array([len(t) for t in texts_])
        self.begins = np.cumsum(sizes + 1) - sizes
        words = np.full(sizes.sum() + len(sizes) + 1, -1, np.int64)
        marks = np.concatenate([[0], self.begins + sizes])
        words[marks] = -1 - np.arange(len(marks))
        for at, t in zip(self.begins, texts_, strict=True):
            words[at : at + len(t)] = t
        self.longest = int(sizes[0])
        self._ends = self.begins + sizes + 1
        self._sizes = -sizes
        with np.errstate(over="ignore"):
            self.levels = [_mixed(words.view(np.uint64), np.full(len(words), 7, np.uint64))]
            while 2 ** len(self.levels) <= self.longest:
                low, half = self.levels[-1], 2 ** (len(self.levels) - 1)
                n = self.reach(2 * half)
                self.levels.append(_mixed(low[:n], low[np.minimum(np.arange(half, n + half), n - 1)]))

    def reach(self, least: int) -> int:
        """The end of the texts that have ``least`` words or more."""
        many = np.searchsorted(self._sizes, -least, "right")
        return int(self._ends[many - 1]) if many else 0

    def extended(self, at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, period) of the longest stretches around ``at`` whose words equal those ``period`` further on; those of two periods at least, once each."""
        left, right = at.copy(), at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            ok = right + period < len(level)
            ok[ok] = level[right[ok]] == level[(right + period)[ok]]
            right += ok.astype(np.int64) << k
            back = left - (1 << k)
            ok = (back >= 0) & (back + period < len(level))
            ok[ok] = level[back[ok]] == level[(back + period)[ok]]
            left -= ok.astype(np.int64) << k
        whole = right - left >= period
        return smallest(left[whole], (right + period)[whole], period[whole])


def smallest(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each (start, end) once, with its smallest period: a stretch with a second, smaller period is the run of that one."""
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[first], end[first], period[first]


def synchronising(contexts: Contexts, scale: int, n: int, regions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which of the first ``n`` places are in the synchronising set of ``scale`` = 2**k words.

    A place is in it if, of the hashes of the windows of ``scale`` words that begin at it and up to ``scale`` places after it, the
    smallest is the first or the last one's; so the next ``2 * scale`` words alone decide. Windows with a period of a third of
    ``scale`` or less, which lie in ``regions`` (start, end), take no part; stretches of ``3 * scale`` words without any place are
    such regions.
    """
    own = contexts.levels[scale.bit_length() - 1][:n].copy()
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, np.minimum(regions[0], n), 1)
    np.add.at(edge, np.minimum(regions[1] - scale + 1, n), -1)
    own[np.cumsum(edge[:-1]) > 0] = _NONE
    low = own
    for k in range(scale.bit_length() - 1):
        low = np.minimum(low[: len(low) - (1 << k)], low[1 << k :])
    last = own[scale:]
    both = np.minimum(low[: len(last)], last)
    out = np.zeros(n, bool)
    out[: len(last)] = (both != _NONE) & ((both == own[: len(last)]) | (both == last))
    return out


def equal_pairs(contexts: Contexts, scale: int, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of chosen places of equal contexts of ``2 * scale`` words, 3 to 6 scales apart.

    Equal contexts in the set are over a third of a scale apart, so each place has 17 such partners at most.
    """
    level = contexts.levels[scale.bit_length()]
    if scale <= 2:
        n = min(len(level), len(chosen))
        found = [(np.flatnonzero((level[: n - d] == level[d:n]) & chosen[: n - d] & chosen[d:n]), d) for d in range(3 * scale, 6 * scale) if d < n]
        return np.concatenate([f for f, _ in found]), np.concatenate([np.full(len(f), d) for f, d in found])
    places = np.flatnonzero(chosen[: len(level)])
    order = np.argsort(level[places], kind="stable")
    places, context = places[order], level[places[order]]
    at, apart, step = [], [], 1
    left = np.arange(len(places) - 1)
    while len(left):
        left = left[left + step < len(places)]
        distance = places[left + step] - places[left]
        near = (context[left + step] == context[left]) & (distance < 6 * scale)
        left, distance = left[near], distance[near]
        at.append(places[left[distance >= 3 * scale]])
        apart.append(distance[distance >= 3 * scale])
        step += 1
    return (np.concatenate(at), np.concatenate(apart)) if at else (np.empty(0, np.int64), np.empty(0, np.int64))


def beside_regions(contexts: Contexts, runs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of the runs that lie over two highly periodic regions that touch.

    Where no synchronising place is, a run of period q is nine or more times a small period p, then the same again out of step.
    Both parts are runs of p that touch, and q is the distance that brings them in step, or p, 2p, ... more.
    """
    long = runs[1] - runs[0] >= 9 * runs[2]
    start, end, period = (x[long] for x in runs)
    order = np.lexsort((start, period))
    start, end, period = start[order], end[order], period[order]
    one = np.flatnonzero((period[1:] == period[:-1]) & (start[1:] <= end[:-1]))
    if not len(one):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    p, s1, s2 = period[one], start[one], start[one + 1]
    pair = np.repeat(np.arange(len(one)), p)
    turn = np.arange(len(pair)) - np.repeat(np.cumsum(p) - p, p)
    level = np.array([int(x - 1).bit_length() for x in p])
    step = np.full(len(one), -1)
    for k in np.unique(level):
        of = pair[level[pair] == k]
        by = turn[level[pair] == k]
        same = contexts.levels[k][s1[of] + by] == contexts.levels[k][s2[of]]
        step[of[same]] = by[same]
    most = np.minimum(end[one] - s1, end[one + 1] - s2)
    least = 9 * p + np.mod(s2 - s1 - step - 9 * p, p)
    many = np.where(step >= 0, np.maximum((most - least) // p + 1, 0), 0)
    pair = np.repeat(np.arange(len(one)), many)
    q = least[pair] + p[pair] * (np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many))
    return np.maximum(s1[pair], s2[pair] - q), q


def find_runs(texts_: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(start, length, period) of every run of each text (arrays of word numbers): its smallest period stands twice in it or more, and no word beside it goes on with it.

    Periods of one and two words are compared in place. Periods of 3 to 6 scales are proposed by pairs of synchronising places of
    equal context, and by the highly periodic regions where such places are left out; every proposal is extended in full.
    """
    order = sorted(range(len(texts_)), key=lambda i: -len(texts_[i]))
    empty = np.empty(0, np.int64)
    if not order or len(texts_[order[0]]) < 2:
        return [(empty, empty, empty)] * len(texts_)
    contexts = Contexts([texts_[i] for i in order])
    base = contexts.levels[0]
    places = [np.flatnonzero(base[:-d] == base[d:]) for d in (1, 2)]
    runs = contexts.extended(np.concatenate(places), np.repeat([1, 2], [len(x) for x in places]))
    at, q = beside_regions(contexts, runs)
    scale = 1
    while True:
        found = contexts.extended(at, q)
        runs = smallest(*(np.concatenate([a, b]) for a, b in zip(runs, found, strict=True)))
        if 6 * scale > contexts.longest:
            break
        periodic = (3 * runs[2] <= scale) & (runs[1] - runs[0] >= scale)
        chosen = synchronising(contexts, scale, contexts.reach(6 * scale), (runs[0][periodic], runs[1][periodic]))
        new = contexts.extended(*equal_pairs(contexts, scale, chosen))
        at, q = beside_regions(contexts, new)
        runs = smallest(*(np.concatenate([a, b]) for a, b in zip(runs, new, strict=True)))
        scale *= 2
    out = [(empty, empty, empty)] * len(texts_)
    cut = np.searchsorted(runs[0], contexts.begins)
    for k, (i, a, b) in enumerate(zip(order, cut, [*cut[1:], len(runs[0])], strict=True)):
        sorts = np.lexsort((runs[2][a:b], runs[0][a:b]))
        out[i] = runs[0][a:b][sorts] - contexts.begins[k], (runs[1] - runs[0])[a:b][sorts], runs[2][a:b][sorts]
    return out


def _searched(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, body in slices(batch, BATCH):
                number = defaultdict(count().__next__)
                words = [t.split() for t in body]
                found = find_runs([np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in words])
                kept, ends, parts = [], [0], []
                for w, (start, length, period) in zip(words, found, strict=True):
                    long = length >= least
                    start, length, period = start[long], length[long], period[long]
                    parts.append((start, length, period))
                    ends.append(ends[-1] + len(start))
                    if len(start):
                        edge = np.zeros(len(w) + 1, np.int32)
                        np.add.at(edge, start + period, 1)
                        np.add.at(edge, start + length, -1)
                        w = [w[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]  # noqa: PLW2901
                    kept.append(b" ".join(w))
                fields = [pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)]
                runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(w) for w in words], pa.int64()), runs, pa.array(kept, pa.binary())], ["doc_id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row of ``docs`` (doc_id, text).

    ``runs`` has (start, length, period), in words from 0, of every run of ``least`` words or more, by start, then period.
    ``collapsed`` is the text without what repeats: of each run the words after its first period go, and the words that stay are
    joined by one space. Words are what ASCII white space separates. Null, empty and word-less texts have no runs and an empty
    ``collapsed``. Repeated rows each get their row. Windows are compared by 64-bit hashes. A text is searched in one piece,
    whatever its length, in memory of some 300 bytes a word.
    """
    found = texts(docs, binary=True).mapInArrow(_searched(least), "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def longest(runs: Column) -> Column:
    """The run of greatest length; of equals the first, then the one of smallest period."""
    return F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("less"))))


def run_list(runs: Column) -> Column:
    """``start,length,period`` and a line end for each run."""
    lines = F.transform(runs, lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return F.array_join(lines, "")
