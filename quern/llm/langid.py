"""Language identification by string kernels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quern.llm.base import slices, stage

#: The model is fitted on at most so many labelled documents of each language, and on so many in all, dealt evenly to all languages.
SAMPLE, IN_ALL = 250, 8_000
#: So many of each language's sample are landmarks, and so many in all, dealt evenly; so many of their n-grams, those that most landmarks hold, are features.
#: They bound the matrix of features and languages, which tasks are sent, and the fit's memory.
LANDMARKS, MARKS, FEATURES = 40, 2_000, 1 << 16
RIDGE = 0.05
UNKNOWN = "und"

#: n-grams of 1 to 3 characters are hashed to so many places.
GRAMS = 1 << 18
#: Odd factors of the first, second and third character.
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def grams(text: str) -> np.ndarray:
    """The hashes of the distinct n-grams of lower-cased ``text``, in order."""
    s = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    present = np.zeros(GRAMS, bool)
    for n in (1, 2, 3):
        if len(s) >= n:
            made = np.full(len(s) - n + 1, n, np.uint32)
            for k in range(n):
                made = (made ^ s[k : len(s) - n + 1 + k]) * _FACTORS[k]
                made ^= made >> np.uint32(15)
            present[made >> np.uint32(14)] = True
    return np.flatnonzero(present).astype(np.int32)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield pa.RecordBatch.from_arrays([pa.array([grams(batch.column(1)[i].as_py().decode("utf-8", "replace"))], pa.list_(pa.int32())), batch.column(2).slice(i, 1), batch.column(0).slice(i, 1)], ["grams", "lang", "doc_id"])


def fit(sample: list[tuple[np.ndarray, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, features, weights): scores of a text are (presence of ``features`` @ ``weights``) / sqrt(its distinct n-grams).

    Kernel ridge regression, one language against the rest, in the span of landmarks (Nyström). The kernel of two texts is the
    number of n-grams present in both over the root of the product of their own numbers. A score is linear in the kernels with
    the landmarks, and those are linear in a text's presence vector, so both products are folded into one matrix.
    """
    names = sorted({lang for _, lang in sample})
    each = min(landmarks, max(1, MARKS // max(1, len(names))))
    chosen, taken = [], dict.fromkeys(names, 0)
    for i, (_, lang) in enumerate(sample):
        if taken[lang] < each:
            taken[lang] += 1
            chosen.append(i)
    found, n = np.unique(np.concatenate([sample[i][0] for i in chosen]), return_counts=True)
    features = np.sort(found[np.argsort(-n, kind="stable")[:FEATURES]])
    column = np.full(GRAMS, -1, np.int32)
    column[features] = np.arange(len(features))

    def held(i: int) -> np.ndarray:
        at = column[sample[i][0]]
        return at[at >= 0]

    # Presence rows are sparse: of each feature the landmarks that hold it, one after another.
    owned = [held(i) for i in chosen]
    norms = np.array([1 / np.sqrt(max(1, len(sample[i][0]))) for i in chosen])
    place = np.concatenate(owned)
    mark = np.repeat(np.arange(len(chosen)), [len(x) for x in owned])[np.argsort(place, kind="stable")]
    first = np.searchsorted(np.sort(place), np.arange(len(features) + 1))

    def kernels(rows) -> np.ndarray:
        """Of sample rows with all landmarks."""
        out = np.zeros((len(rows), len(chosen)))
        for k, i in enumerate(rows):
            at = held(i)
            many = first[at + 1] - first[at]
            where = np.repeat(first[at] - np.cumsum(many) + many, many) + np.arange(many.sum())
            out[k] = np.bincount(mark[where], minlength=len(chosen)) * norms / np.sqrt(max(1, len(sample[i][0])))
        return out

    values, vectors = np.linalg.eigh(kernels(chosen))
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    inner, target = np.zeros((len(chosen), len(chosen))), np.zeros((len(chosen), len(names)))
    number = {n: k for k, n in enumerate(names)}
    for start in range(0, len(sample), 128):
        rows = range(start, min(start + 128, len(sample)))
        mapped = kernels(rows) @ root
        wanted = np.full((len(rows), len(names)), -1.0)
        wanted[np.arange(len(rows)), [number[sample[i][1]] for i in rows]] = 1.0
        inner += mapped.T @ mapped
        target += mapped.T @ wanted
    solved = root @ np.linalg.solve(inner + ridge * np.eye(len(chosen)), target)
    weights = np.zeros((len(features), len(names)), np.float32)
    for k, at in enumerate(owned):
        weights[at] += (norms[k] * solved[k]).astype(np.float32)
    return names, features, weights


def _predictions(names: list[str], features: np.ndarray, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = 128
        x = np.zeros((rows, len(features)), np.float32)
        for batch in batches:
            for ids, whole in slices(batch):
                langs, scores = [], []
                for start in range(0, len(whole), rows):
                    body = whole[start : start + rows]
                    norms, known = np.ones(len(body), np.float32), np.zeros(len(body), bool)
                    for k, data in enumerate(body):
                        text = "" if data is None else data.decode("utf-8", "replace")
                        present, own = np.zeros(GRAMS, bool), grams(text)
                        present[own] = True
                        norms[k], known[k] = max(1, len(own)), any(map(str.isalpha, text))
                        x[k] = present[features]
                    got = (x[: len(body)] @ weights) / np.sqrt(norms)[:, None]
                    best = got.argmax(axis=1) if names else np.zeros(len(body), int)
                    langs += [names[b] if ok else UNKNOWN for b, ok in zip(best, known & bool(names), strict=True)]
                    top = got.max(axis=1) if names else np.zeros(len(body))
                    scores += np.where(known & bool(names), np.clip((top + 1) / 2, 0, 1), 0).astype(float).tolist()
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return run


def training_rows(docs: DataFrame, learn: Column, per_language: int = SAMPLE) -> list[tuple[np.ndarray, str]]:
    """The n-grams of up to ``per_language`` documents of every language, and about ``IN_ALL`` in all, chosen by a hash of doc_id."""
    labelled = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    each = min(per_language, max(1, IN_ALL // max(1, labelled.select("lang").distinct().count())))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = labelled.select("doc_id", "lang").withColumn("no", F.row_number().over(order)).filter(F.col("no") <= each)
    ids = stage(chosen.select("doc_id", F.col("lang").alias("as_lang")), "sample")  # few, as their written size shows the planner
    rows = labelled.select("doc_id", F.col("text").cast("binary").alias("text"), "lang").join(ids, "doc_id").filter("lang = as_lang").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    made = rows.mapInArrow(_sampled, "grams array<int>, lang string, doc_id long").toPandas().sort_values(["lang", "doc_id"])
    return [(np.asarray(g, np.int32), lang) for g, lang in zip(made["grams"], made["lang"], strict=True)]


def identify(docs: DataFrame, learn: Column, per_language: int = SAMPLE) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs``, from whole texts alone.

    The model is fitted on labelled rows for which ``learn`` holds; their number is bounded by ``per_language`` and ``IN_ALL``, and
    every language has its share. A text that is
    null or has no letter is ``und`` with score 0, as is every text if nothing can be learned. Rows with a null doc_id are not
    learned from. Repeated rows each get their row.
    """
    names, features, weights = fit(found) if (found := training_rows(docs, learn, per_language)) else ([], np.zeros(0, np.int32), np.zeros((0, 0), np.float32))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_predictions(names, features, weights), "doc_id long, lang_pred string, score double")
