"""Mixing sources to target weights by entropy balancing, with DataFrame and SQL functions alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.base import stage
from quern.operators.graph import numbered

#: Weights of the sources, in turn by code point.
WEIGHTS = (5, 2, 1)
#: A document is taken so often at most, and a source's target is so many times its size at most.
MOST = 3
#: The balance is found when no source is further than this from its target, as a share of it.
NEAR = 1e-6
ROUNDS = 80
#: Copies by which rounding is mended for each source, one a round.
MENDED = 4
#: Rates are whole numbers of this unit, so that sums are the same in any order and reruns agree.
UNIT = 1_000_000_000
#: Rows of one size in one source that are numbered together, at most, if all rows had it.
SPREAD = 10_000

WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): words of each text; a null text has none."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(totals: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) for a table of (source, source_size).

    Sources in order of code point, a null one last, weigh ``weights`` in turn and share all words by weight; a target stops at ``most``
    times its source's size, and what lies above is shared anew by weight until none is above. The level that is left, words for one unit
    of weight, is found by Newton steps on the piecewise linear total, each an aggregate.
    """
    known = totals.filter(F.col("source").isNotNull())
    n = known.count()
    named = numbered(known, "source", "__no").unionByName(totals.filter(F.col("source").isNull()).withColumn("__no", F.lit(n + 1)))
    weighed = stage(named.withColumn("__weight", F.get(F.array(*map(F.lit, weights)), F.pmod(F.col("__no") - 1, F.lit(len(weights)))).cast("long")), "weights")
    held = F.col("source_size") * most
    everything, level, below = weighed.agg(F.sum("source_size")).first()[0] or 0, 0.0, None
    while True:
        full = held <= level * F.col("__weight")
        filled, weight = weighed.agg(F.sum(F.when(full, held).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("__weight")))).first()
        if not weight or below == (filled, weight):
            break
        below, level = (filled, weight), (everything - filled) / weight
    return weighed.select("source", "source_size", F.when(held <= level * F.col("__weight"), held.cast("double")).otherwise(level * F.col("__weight")).alias("target"))


def _rate(tilt: Column, size: Column, mean: Column, most: int) -> Column:
    """Copies of a document of ``size`` on average, in whole units: exponentially tilted by its words, and ``most`` at most."""
    return F.round(F.least(F.exp(tilt * size / mean), F.lit(float(most))) * UNIT).cast("long")


def balanced(classes: DataFrame, sources: DataFrame, most: int = MOST) -> DataFrame:
    """(source, tilt, mean): ``classes`` (source, size, n) are documents of one source and size, ``sources`` has (source, source_size, target).

    Of all rates between 0 and ``most`` whose expected words are the target, those nearest to one copy each in relative entropy are
    ``min(most, exp(tilt * size / mean))``. The tilts solve the convex dual, which parts into one unknown a source: Newton steps for
    all sources at once, on the logarithm of the expected words, inside brackets that only narrow; a step that leaves its bracket
    halves it. Each round is one aggregate over the classes; its state is a written table with a row a source.
    """
    some = sources.join(classes.groupBy("source").agg(F.sum("n").alias("__n"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("__least")).withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    mean = F.greatest(F.col("source_size") / F.col("__n"), F.lit(1.0))
    full = F.col("target") >= most * F.col("source_size")
    start = some.select("source", "source_size", "target", mean.alias("mean"), full.alias("done"), F.when(full, F.lit(None).cast("double")).otherwise(F.log(F.col("target") / F.col("source_size"))).alias("tilt"))
    # At the upper end all documents are at ``most``; the lower end is open until a step has been below the target.
    state = start.withColumns({"low": F.lit(None).cast("double"), "high": F.lit(None).cast("double")})
    state = stage(state, "tilts")
    for _ in range(ROUNDS):
        if state.filter("not done").isEmpty():
            break
        of = state.filter("not done").select(F.col("source").alias("__s"), "tilt", "mean")
        met = classes.join(of, F.col("source").eqNullSafe(F.col("__s"))).withColumn("rate", _rate(F.col("tilt"), F.col("size"), F.col("mean"), most))
        words = F.col("n").cast("decimal(12,0)") * F.col("size").cast("decimal(9,0)") * F.col("rate").cast("decimal(11,0)")
        slope = F.when(F.col("rate") < most * UNIT, words.cast("double") * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = met.groupBy("source").agg(F.sum(words).alias("words"), F.sum(F.round(slope / UNIT).cast("decimal(38,0)")).alias("slope"))
        sums = sums.select(F.col("source").alias("__s"), (F.col("words").cast("double") / UNIT).alias("words"), F.col("slope").cast("double").alias("slope"))
        now = state.join(sums, F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s")
        over = F.col("words") > F.col("target")
        near = F.abs(F.col("words") - F.col("target")) <= NEAR * F.col("target")
        low, high = F.when(over, F.col("low")).otherwise(F.col("tilt")), F.when(over, F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") + F.log(F.try_divide("target", "words")) * F.try_divide("words", "slope")
        # An open end is left by doubling; slope or words of zero leave no step (null), as does one beyond the bracket.
        wide = F.when(over, F.least(F.col("tilt") * 2, F.lit(-1.0))).otherwise(F.greatest(F.col("tilt") * 2, F.lit(1.0)))
        halved = F.coalesce((low + high) / 2, wide)
        inside = (step > F.coalesce(low, F.lit(float("-inf")))) & (step < F.coalesce(high, F.lit(float("inf")))) & (F.abs(step) < F.greatest(F.abs(F.col("tilt")) * 8, F.lit(8.0)))
        moved = F.when(inside, step).otherwise(halved)
        stuck = (high - low) <= 1e-12 * F.greatest(F.abs(low), F.abs(high))
        done = F.col("done") | F.coalesce(near | stuck, F.lit(False))
        state = stage(now.select("source", "source_size", "target", "mean", done.alias("done"), F.when(done, F.col("tilt")).otherwise(moved).alias("tilt"), F.when(F.col("done"), F.col("low")).otherwise(low).alias("low"), F.when(F.col("done"), F.col("high")).otherwise(high).alias("high")), "tilts")
    return state.select("source", "tilt", "mean")


def _whole(rated: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """``rated`` (source, size, n, rate) with ``copies``, a whole number for each class.

    Rates are summed along the classes of a source by size and the sum is rounded at every class, so words and target differ by
    no more than the longest document. Then, a few times, the class whose size is nearest to what is missing, or over, gives
    or loses one copy.
    """
    along = Window.partitionBy("source").orderBy("size")
    own = (F.col("n").cast("decimal(19,0)") * F.col("rate").cast("decimal(11,0)")).cast("decimal(38,0)")
    summed = F.sum(own).over(along.rowsBetween(Window.unboundedPreceding, 0))
    until = F.expr(f"cast((__sum + {UNIT // 2}) div {UNIT} as long)")
    placed = rated.withColumn("__sum", summed).withColumn("__until", until)
    now = stage(placed.withColumn("copies", F.col("__until") - F.coalesce(F.lag("__until").over(along), F.lit(0))).select("source", "size", "n", "copies"), "copies")
    wanted = sources.select(F.col("source").alias("__s"), F.round("target").cast("long").alias("__target"))
    for _ in range(MENDED):
        missing = now.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("__words")).join(wanted, F.col("source").eqNullSafe(F.col("__s")))
        missing = missing.select(F.col("source").alias("__s"), (F.col("__target") - F.col("__words")).alias("__e")).filter("__e <> 0")
        able = ((F.col("__e") > 0) & (F.col("copies") < F.col("n") * most)) | ((F.col("__e") < 0) & (F.col("copies") > 0))
        of = now.join(missing, F.col("source").eqNullSafe(F.col("__s"))).filter(able & (F.col("size") < 2 * F.abs("__e")))
        nearest = F.min_by(F.struct("size", F.signum("__e").cast("long").alias("by")), F.struct(F.abs(F.abs("__e") - F.col("size")), "size"))
        best = of.groupBy(F.col("source").alias("__s")).agg(nearest.alias("__b")).select("__s", F.col("__b.size").alias("__z"), F.col("__b.by").alias("__by"))
        mended = now.join(best, F.col("source").eqNullSafe(F.col("__s")) & (F.col("size") == F.col("__z")), "left")
        now = stage(mended.select("source", "size", "n", (F.col("copies") + F.coalesce("__by", F.lit(0))).alias("copies")), "copies")
    return now


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) for every row of ``docs`` (doc_id, text, source): how often the mix takes each document.

    Sizes are words; targets are those of ``targets``, the rates those of ``balanced``, and copies, from 0 to ``most``, round them so that
    each source's words come within a few words of its target wherever its documents' sizes allow it, and else within its
    longest document. Documents of the same source and size have the same rate; which of them get the copies is decided by a hash of the
    doc_id, so reruns agree. A null source is a source; null and empty texts have no words and one copy, none in a source without words.
    Rows that share a doc_id, or a null one, are documents of their own; those of the same source and size are taken as one
    until the end, so a doc_id of very many rows is no large group.
    """
    rows = stage(sizes(docs), "sizes")
    spread = max(1, rows.count() // SPREAD)
    parts = rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(spread)))
    counts = stage(parts.groupBy("source", "size", "part").agg(F.count(F.lit(1)).alias("n")), "counts")
    classes = stage(counts.groupBy("source", "size").agg(F.sum("n").alias("n")), "classes")
    sources = stage(targets(classes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, most), "targets")
    tilts = balanced(classes, sources, most).withColumnRenamed("source", "__s")
    rated = classes.join(tilts, F.col("source").eqNullSafe(F.col("__s"))).select("source", "size", "n", F.coalesce(_rate(F.col("tilt"), F.col("size"), F.col("mean"), most), F.lit(most * UNIT)).alias("rate"))
    made = _whole(rated, sources, most)
    named = made.join(sources.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    # Copies are dealt evenly along the documents of a class: by part, and inside a part by doc_id; first each part gets its place.
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = counts.withColumn("__from", before).drop("n").withColumnsRenamed({"source": "__s", "size": "__z"})
    dealt = placed.join(named, F.col("__s").eqNullSafe(F.col("source")) & (F.col("__z") == F.col("size"))).drop("__s", "__z")
    grouped = parts.groupBy("source", "size", "part", "doc_id").agg(F.count(F.lit(1)).alias("__times"))
    within = Window.partitionBy("source", "size", "part").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    each = grouped.withColumn("__at", F.coalesce(F.sum("__times").over(within), F.lit(0))).withColumnsRenamed({"source": "__s", "size": "__z", "part": "__p"})
    met = each.join(dealt, F.col("__s").eqNullSafe(F.col("source")) & (F.col("__z") == F.col("size")) & (F.col("__p") == F.col("part")))
    every = met.select("doc_id", "source", "size", "source_size", "target", "n", "copies", (F.col("__at") + F.col("__from")).alias("__at"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("__times") - 1)).alias("__k"))
    share = lambda j: f"cast((cast({j} as decimal(19,0)) * cast(copies as decimal(19,0))) div n as long)"
    return every.select("doc_id", "source", "size", "source_size", "target", F.expr(f"{share('__at + __k + 1')} - {share('__at + __k')}").alias("copies"))
