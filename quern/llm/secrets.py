"""Secret scans that link the parts of a credential."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.base import slices, stage, texts

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
IDENTIFIER = re.compile(r"""(?i:\b(access_?key_?id|client_?id|account_?id|user_?name|login))["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]{4,})""", re.ASCII)
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z+/_-]*[0-9])(?=[A-Z0-9+/_-]*[a-z])(?=[a-z0-9+/_-]*[A-Z])[A-Za-z0-9+/_-]{24,}={0,2}(?![A-Za-z0-9+/=_-])")
ENDPOINT = re.compile(r"""\bhttps?://[^\x00-\x20"'<>]{4,}""")

#: Kinds in the order of a span list; the first three are reported wherever they stand.
KINDS = ("assign", "access", "hex", "identifier", "opaque", "endpoint")
#: For each weak kind, the kinds of which one must stand in its scope. An identifier and an opaque token complete each other; an
#: endpoint completes a secret that is reported without it, so opaque tokens are linked first.
PARTNERS = {"identifier": ("assign", "hex", "opaque"), "opaque": ("access", "identifier")}
ENDPOINT_PARTNERS = {"endpoint": ("assign", "hex", "opaque")}
#: The scope of a span: so many characters on either side.
REACH = 200

_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
_SCANNED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("base", pa.list_(_SPAN)), ("weak", pa.list_(_SPAN))])


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The (start, kind number, end) of all spans of the base kinds, and of the weak kinds where a part that may complete them is in the text."""
    marks = ":" in text or "=" in text
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8] if marks else []
    base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    weak = [(m.start(), 3, m.end()) for m in IDENTIFIER.finditer(text)] if marks else []
    if weak or any(k == 1 for _, k, _ in base):
        covered = sorted((s, e) for s, _, e in base + weak)
        starts, ends = [s for s, _ in covered], list(accumulate((e for _, e in covered), max))
        free = lambda a, b: not (k := bisect_left(starts, b)) or ends[k - 1] <= a
        weak += [(m.start(), 4, m.end()) for m in OPAQUE.finditer(text) if free(m.start(), m.end())]
    if "://" in text and (base or weak):
        weak += [(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)]
    return sorted(base), weak


def _scans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 36
    for batch in batches:
        for ids, body in slices(batch):
            out = []
            for i, text in zip(ids, body, strict=True):
                base, weak = ([dict(zip(("start", "kind", "end"), s, strict=True)) for s in spans] for spans in scan(text))
                out.append({"row": row, "doc_id": i, "base": base, "weak": weak})
                row += 1
            yield pa.RecordBatch.from_pylist(out, schema=_SCANNED)


def _in_scope(weak: DataFrame, parts: DataFrame, partners: dict, reach: int) -> DataFrame:
    """The spans (row, start, kind, end) of ``weak`` that have one of their ``partners`` in scope, by an interval join on stretches of ``reach`` characters."""
    over = lambda a, b: F.explode(F.sequence(F.floor(a / reach).cast("long"), F.floor(b / reach).cast("long")))
    laid = parts.select(F.col("row").alias("of"), F.col("start").alias("s"), F.col("kind").alias("k"), F.col("end").alias("e")).withColumn("stretch", over(F.col("s"), F.col("e")))
    spans = weak.filter(F.col("kind").isin([KINDS.index(k) for k in partners])).withColumn("place", over(F.greatest(F.col("start") - reach, F.lit(0)), F.col("end") + reach))
    completes = F.lit(False)
    for kind, others in partners.items():
        completes = completes | ((F.col("kind") == KINDS.index(kind)) & F.col("k").isin([KINDS.index(p) for p in others]))
    near = (F.col("s") < F.col("end") + reach) & (F.col("e") > F.col("start") - reach)
    return spans.join(laid, (F.col("row") == F.col("of")) & (F.col("place") == F.col("stretch")) & near & completes, "left_semi").select("row", "start", "kind", "end").distinct()


def _linked(scanned: DataFrame, reach: int) -> DataFrame:
    """(row, spans): the weak spans that a part in scope completes: identifiers and opaque tokens first, then endpoints beside what is reported."""
    found = scanned.filter(F.size("weak") > 0)
    each = lambda c: found.select("row", F.explode(c).alias("p")).select("row", "p.start", "p.kind", "p.end")
    base, weak = each("base"), each("weak")
    pairs = stage(_in_scope(weak, base.unionByName(weak), PARTNERS, reach), "linked")
    ends = _in_scope(weak, base.unionByName(pairs), ENDPOINT_PARTNERS, reach)
    return pairs.unionByName(ends).groupBy("row").agg(F.collect_set(F.struct("start", "kind", "end")).alias("spans"))


def find_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """(doc_id, base, spans) for every row of ``docs``: arrays of (start, kind, end) in code points, by start, then kind.

    ``base`` has assignments, access identifiers and hexadecimal keys; ``spans`` has them and the weak candidates (identifiers,
    opaque tokens, endpoints) that stand within ``reach`` characters of a part that completes a credential; a weak part that no
    part in its own scope completes completes no other. A null text is empty. Repeated rows each get their row.
    """
    scanned = stage(texts(docs).mapInArrow(_scans, "row long, doc_id long, base array<struct<start:long,kind:int,end:long>>, weak array<struct<start:long,kind:int,end:long>>"), "scanned")
    joined = scanned.join(_linked(scanned, reach), "row", "left")
    return joined.select("doc_id", "base", F.when(F.col("spans").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "spans"))).alias("spans"))


def span_list(column: str):
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
