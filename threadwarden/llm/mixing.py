"""Mixing sources to target weights along a time-varying curriculum.

Every source has a schedule: its weight as a piecewise-linear function of training time 0 to
1. The integral of the schedule is the source's cumulative demand for words; the demand up
to which the words of a document copy are used, inverted, is the time at which it is trained
on. Sorting the copies of all sources by that time gives the training order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadwarden.llm.common import first_of_repeats
from threadwarden.operators.distributed import running_total
from threadwarden.sources.staging import stage

WEIGHTS = (5.0, 2.0, 1.0)
# Of the three weights in turn: fading out, steady, coming in. Knots of (time, weight).
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 0.75), (1.0, 2.25)))
MAX_REPEATS = 3

Knots = Sequence[tuple[float, float]]


def n_words(text: Column) -> Column:
    """Number of runs of anything but blank and control white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(sizes: Mapping[str | None, int], weights: Mapping[str | None, float], max_repeats: int = MAX_REPEATS) -> dict:
    """Words each source should give: shares of all words by weight, at most ``max_repeats`` sizes.

    What a full source cannot take is shared by the others in proportion to their weights.
    """
    free = {s for s in sizes if weights[s] > 0}
    out = {s: 0.0 for s in sizes}
    left = sum(sizes.values())
    while free:
        total = sum(weights[s] for s in sorted(free, key=_by_code_point))
        full = [s for s in free if weights[s] * (left / total) > max_repeats * sizes[s]]
        if not full:
            for s in free:
                out[s] = weights[s] * (left / total)
            break
        for s in full:
            out[s] = float(max_repeats * sizes[s])
            left -= max_repeats * sizes[s]
        free -= set(full)
    return out


def _by_code_point(source: str | None) -> tuple[bool, str]:
    return source is None, source or ""


def area(knots: Knots) -> list[float]:
    """Integral of the schedule up to each knot."""
    sums = [0.0]
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        sums.append(sums[-1] + (t1 - t0) * (w0 + w1) / 2)
    return sums


def time_of(share: Column, times: Column, weights: Column, areas: Column) -> Column:
    """The training time up to which the schedule has used ``share`` (0 to 1) of its integral."""
    x = F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * F.element_at(areas, -1)
    last = F.size(areas) - 1
    i = F.greatest(F.least(F.size(F.filter(areas, lambda a: a <= x)), last), F.lit(1))
    w0, w1 = F.get(weights, i - 1), F.get(weights, i)
    t0, t1 = F.get(times, i - 1), F.get(times, i)
    rest = x - F.get(areas, i - 1)
    slope = (w1 - w0) / (t1 - t0)
    root = F.sqrt(F.greatest(w0 * w0 + 2 * slope * rest, F.lit(0.0)))
    return F.least(t0 + F.coalesce(F.try_divide(2 * rest, w0 + root), F.lit(0.0)), t1)


def plan_mix(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    schedules: Mapping[str | None, Knots] | None = None,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """What the mix takes of every row of ``docs``, and when.

    Returns doc_id, mark (a hash of the text), source, size, source_size, target, taken and
    ``copies``: an array of (copy, position, words), one for each time the document is used.
    Without ``weights``, the sources in order of code points, null last, weigh 5, 2, 1 in
    turn. A source passes over its documents in the order of md5(doc_id) until its target,
    rounded to words, is met: whole passes first, then the beginning of one more, of which
    the last document gives a part of its words. So sources meet their targets to the word
    and no document gives over ``max_repeats`` times its size.

    A null source is a source; null and empty texts have size 0 and are never taken. Repeated
    rows are rows of their own. An empty table, or one without words, gives nothing taken.
    Other columns are not read. One row per source comes to the driver, since a mix names its
    sources; documents do not.
    """
    spark = docs.sparkSession
    sized = stage(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.xxhash64(F.col("text").cast("string")).alias("mark"),
            n_words(F.col("text").cast("string")).alias("size"),
        ).withColumn("turn", F.md5(F.col("doc_id").cast("string"))),
        "sizes",
    )
    sizes = {r["source"]: r["size"] for r in sized.groupBy("source").agg(F.sum("size").alias("size")).collect()}
    names = sorted(sizes, key=_by_code_point)
    if weights is None:
        weights = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(names)}
    if schedules is None:
        schedules = {s: SCHEDULES[i % len(SCHEDULES)] for i, s in enumerate(names)}
    wanted = targets(sizes, {s: weights.get(s, 0.0) for s in names}, max_repeats)
    steady = ((0.0, 1.0), (1.0, 1.0))
    rows = []
    for s in names:
        knots = schedules.get(s, steady)
        rows.append((s, sizes[s], wanted[s], [t for t, _ in knots], [w for _, w in knots], area(knots)))
    schema = "source string, source_size bigint, target double, times array<double>, weights array<double>, areas array<double>"
    mix = spark.createDataFrame(rows, schema).withColumnRenamed("source", "_source")

    placed = running_total(sized, ["turn", "doc_id", "mark"], F.col("size"), "before", ["source"])
    placed = placed.join(mix, F.col("source").eqNullSafe(F.col("_source")))
    budget = F.floor(F.col("target") + 0.5)
    passes = F.when(F.col("source_size") > 0, F.expr("floor(target + 0.5) div source_size")).otherwise(F.lit(0))
    rest = budget - passes * F.col("source_size")
    words_of = lambda k: F.when(k < passes, F.col("size")).otherwise(F.least(F.greatest(rest - F.col("before"), F.lit(0)), F.col("size")))
    # the middle of the copy's words on the source's cumulative demand
    demand = lambda k: k * F.col("source_size") + F.col("before") + words_of(k) / 2
    copies = F.transform(
        F.sequence(F.lit(0).cast("bigint"), passes),
        lambda k: F.struct(
            k.cast("int").alias("copy"),
            time_of(F.try_divide(demand(k), budget), F.col("times"), F.col("weights"), F.col("areas")).alias("position"),
            words_of(k).cast("bigint").alias("words"),
        ),
    )
    return placed.select(
        "doc_id", "mark", "source", "size", "source_size", "target",
        F.filter(copies, lambda c: c["words"] > 0).alias("copies"),
    ).withColumn("taken", F.aggregate("copies", F.lit(0).cast("bigint"), lambda a, c: a + c["words"]))


def in_training_order(df: DataFrame, position: str, *ties: str) -> DataFrame:
    """Rows sorted by position over all partitions; ``df`` is read twice."""
    return df.repartitionByRange(position, *ties).sortWithinPartitions(position, *ties)


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix in training order, repeated as often as they are taken.

    A copy of which at least half the words are taken is used whole, others are left out, so
    that no text is cut; this touches one document per source.
    """
    plan = plan_mix(docs, **options)
    # rows repeated under one id and text share their copies
    plan = plan.groupBy("doc_id", "mark", "size").agg(F.flatten(F.collect_list("copies")).alias("_copies"))
    plan = plan.select(
        F.col("doc_id").alias("_id"), F.col("mark").alias("_of"),
        F.filter("_copies", lambda c: c["words"] * 2 >= F.col("size")).alias("_copies"),
    ).filter(F.size("_copies") > 0)
    marked = docs.withColumn("_mark", F.xxhash64(F.col("text").cast("string"))).withColumn("_doc", F.col("doc_id").cast("bigint"))
    marked = first_of_repeats(marked, ["_doc", "_mark"])
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_of"))
    used = marked.join(plan, same).withColumn("_copy", F.explode("_copies"))
    used = used.withColumn("_position", F.col("_copy.position"))
    return in_training_order(used.select(*docs.columns, "_position", "_doc"), "_position", "_doc").select(*docs.columns)
