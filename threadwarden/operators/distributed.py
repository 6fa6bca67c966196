"""Running totals, top-n and de-duplication that never put an unbounded group into one task.

Hot keys of joins need no helper here: adaptive execution splits their partitions, for inner,
left, semi and anti joins alike, and evaluates each side once. ``semi_join_stored`` is for rows too
wide to be shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadwarden.sources.staging import COMPACT, drop, new_stage_path, read_stages, stage, temporary_stages

# Stored rows are moved in so many slices, a slice of so many rows at least. What belongs to the rows of
# a slice is broadcast up to so many rows.
SLICES = 16
SLICE_ROWS = 5_000
BROADCAST_ROWS = 500_000


def running_total(
    df: DataFrame,
    order: Sequence[Column | str],
    value: Column | Sequence[Column],
    into: str | Sequence[str],
    within: Sequence[str] = (),
    totals: dict[str, tuple[Callable, str]] | None = None,
    null_groups: bool = True,
) -> DataFrame:
    """Sum of ``value`` over the rows before each row, as column ``into``; or of several values.

    A plain window would sort a whole group (or the whole table) in one task. Here the
    rows are range-partitioned, each slice is summed, the few slice sums are accumulated,
    and only rows of one slice meet in a window. The slice number is frozen in a stage
    table, so a task that is run again sees the same slices. ``order`` must be total.
    ``df`` is evaluated twice, to sample the ranges and to write the slices: pass narrow
    rows of a stored table.

    ``totals`` names group aggregates taken along with the slice sums, each as an
    aggregate that can be applied again to its own results (sum, min, max) and a column.
    ``null_groups=False`` drops rows whose group is null, which saves one shuffle.
    """
    totals = totals or {}
    values, names = ([value], [into]) if isinstance(into, str) else (list(value), list(into))
    group = [F.col(c) for c in within]
    ordering = [F.col(c) if isinstance(c, str) else c for c in order]
    sliced = stage(
        df.withColumns({f"_value{i}": v.cast("long") for i, v in enumerate(values)})
        .repartitionByRange(*group, *ordering)
        .withColumn("_slice", F.spark_partition_id()),
        "slices",
    )
    slices = sliced.groupBy(*group, "_slice").agg(
        *[F.sum(f"_value{i}").alias(f"_sum{i}") for i in range(len(values))], *[agg(source).alias(name) for name, (agg, source) in totals.items()]
    )
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = slices.select(
        *group,
        "_slice",
        *[F.coalesce(F.sum(f"_sum{i}").over(earlier), F.lit(0)).alias(f"_before{i}") for i in range(len(values))],
        *[agg(name).over(whole).alias(name) for name, (agg, _) in totals.items()],
    )
    if not within:
        # one row per partition of the table
        joined = sliced.join(F.broadcast(before), "_slice")
    elif null_groups:
        named = before.withColumnsRenamed({c: f"_of_{c}" for c in [*within, "_slice"]})
        same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in [*within, "_slice"]]
        joined = sliced.join(named, same)
    else:
        joined = sliced.join(before, [*within, "_slice"])
    inside = Window.partitionBy(*group, "_slice").orderBy(*ordering).rowsBetween(Window.unboundedPreceding, -1)
    sums = {
        name: F.col(f"_before{i}") + F.coalesce(F.sum(f"_value{i}").over(inside), F.lit(0)) for i, name in enumerate(names)
    }
    return joined.withColumns(sums).select(*df.columns, *names, *totals)


def row_position(df: DataFrame, order: Sequence[Column | str], into: str, within: Sequence[str] = ()) -> DataFrame:
    """Zero-based position of each row in a total order."""
    return running_total(df, order, F.lit(1), into, within)


def ranked_top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, into: str) -> DataFrame:
    """The first ``n`` rows of each group with their rank from 1.

    Up to the session's window group limit, Spark keeps only ``n`` rows per group and task
    before it shuffles. Above it, positions come from the distributed running total.
    """
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n <= threshold:
        ranked = df.withColumn(into, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    else:
        ranked = row_position(df, order, into, keys).withColumn(into, F.col(into) + 1)
    return ranked.filter(F.col(into) <= n)


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    return ranked_top_n(df, keys, order, n, "_rank").drop("_rank")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first by ``order``, ties broken by a hash of the row.

    An aggregate rather than a window, so that copies collapse before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    rank = F.struct(*order, F.xxhash64(*rest))
    return (
        df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_first")).select(*keys, "_first.*").select(*df.columns)
    )


def store_rows(df: DataFrame) -> DataFrame:
    """``df`` as a stage table of few bytes with a number ``_row`` for each row, for ``move_rows``."""
    path = new_stage_path(df.sparkSession, "rows")
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    numbered.write.option("compression", COMPACT).parquet(path)
    return read_stages(numbered, path)


def move_rows(rows: DataFrame, wanted: DataFrame, path: str, by: str | None = None) -> None:
    """Move those of ``store_rows`` that ``wanted`` names by ``_row`` to a table at ``path``, in folders ``by`` a column.

    ``wanted`` is stored and narrow, has a number once and may add columns. Rows are not shuffled, however wide,
    and no second copy of the table comes about: a slice of its files is moved at a time and
    then deleted, so ``rows`` is gone afterwards. The numbers of a file lie together, so a slice needs
    few of ``wanted``. They are broadcast; where they are too many, the slice alone is shuffled.
    """
    columns = [c for c in [*rows.columns, *wanted.columns] if c != "_row"]
    file = F.col("_metadata.file_path").alias("file")
    files = rows.groupBy(file).agg(F.min("_row").alias("low"), F.max("_row").alias("high"), F.count(F.lit(1)).alias("n")).orderBy("low").collect()
    if not files:
        rows.join(wanted, "_row").select(*columns).write.parquet(path)
        return
    size = -(-len(files) // max(1, min(SLICES, sum(f.n for f in files) // SLICE_ROWS)))
    for start in range(0, len(files), size):
        part = files[start : start + size]
        few = sum(f.n for f in part) <= BROADCAST_ROWS
        named = wanted.filter(F.col("_row").between(part[0].low, part[-1].high))
        named = F.broadcast(named) if few else named.hint("shuffle_hash")
        moved = read_stages(rows, *[f.file for f in part]).join(named, "_row").select(*columns)
        writer = moved.write.mode("append").option("compression", COMPACT)
        (writer.partitionBy(by) if by else writer).parquet(path)
        drop(rows.sparkSession, *[f.file for f in part])


def semi_join_stored(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """The rows of ``df`` whose ``on`` is among ``keys``, stored.

    As a left semi join that shuffles column ``on`` alone: ``df`` is stored once, and the rows are
    moved out of it.
    """
    path = new_stage_path(df.sparkSession, "joined")
    with temporary_stages(df.sparkSession):
        rows = store_rows(df)
        wanted = stage(rows.select("_row", on).join(keys.select(on), on, "left_semi").select("_row"), "wanted")
        move_rows(rows, wanted, path)
    return read_stages(df, path)
