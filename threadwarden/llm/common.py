"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadwarden.sources.staging import read_stages, stage, write_stage

# A group counts as hot above this share of all rows: fewer than 1/HOT_SHARE groups can be.
HOT_SHARE = 0.001


def worker_store(name: str, build: Callable[[], Any]) -> Any:
    """An object a Python worker builds once and keeps from task to task."""
    module = sys.modules.setdefault("_threadwarden_llm_store", types.ModuleType("_threadwarden_llm_store"))
    if not hasattr(module, name):
        setattr(module, name, build())
    return getattr(module, name)


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Texts as bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def binary_column(values: Sequence[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def fixed_rows(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    """A binary column whose cells are all ``width`` numbers, as one matrix."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, dtype).reshape(len(column), width)


def attach_by_key(rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str) -> DataFrame:
    """``rows`` with the columns of their group; ``groups`` has one row per key and its size.

    ``rows`` are read twice, so pass a stored table. A group of over one thousandth of all
    rows is hot: there can be at most a thousand, so their list is broadcast and their rows
    are never shuffled. The other groups are small against a shuffle partition and join as
    usual. Rows without a group keep nulls; null keys match nothing.
    """
    keys = list(keys)
    total = groups.agg(F.sum(size)).first()[0] or 0
    is_hot = F.col(size) > max(1000, int(total * HOT_SHARE))
    hot = F.broadcast(groups.filter(is_hot))
    rest = rows.join(hot.select(*keys), keys, "left_anti")
    return rows.join(hot, keys).unionByName(rest.join(groups.filter(~is_hot), keys, "left"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b): the component is its least node.

    Alternates two rounds until nothing changes: every node hands its larger neighbours to
    the least one around it, then its smaller ones. Edges never grow in number. Each round
    is a stage table, so that the plan stays short and a lost executor repeats one round.
    """
    a, b = F.col("a"), F.col("b")
    links, seen = _links(edges.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    while seen["n"]:
        both = links.unionByName(links.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        wide = both.join(least, "a").filter(b > a).select(b.alias("a"), F.col("m").alias("b")).filter(a != b)
        wide = stage(wide.distinct(), "wide")
        least = wide.groupBy("a").agg(F.min("b").alias("m"))
        near = wide.join(least, "a").select(b.alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        links, now = _links(near.filter(a != b).distinct())
        if now == seen:
            break
        seen = now
    own = links.select(b.alias("node")).distinct()
    return links.select(a.alias("node"), b.alias("component")).unionByName(own.select("node", F.col("node").alias("component")))


def _links(links: DataFrame) -> tuple[DataFrame, dict]:
    path, seen = write_stage(
        links,
        "links",
        n=F.count(F.lit(1)),
        mark=F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)")),
    )
    return read_stages(links, path), seen


def first_of_repeats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` without the repeats of a key; keys are near unique, so groups are small."""
    counts = df.select(*keys).groupBy(*keys).count().filter("count > 1")
    if counts.isEmpty():
        return df
    return df.dropDuplicates(list(keys))


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that hold only whole runs of equal ``key``, from batches sorted by it.

    Only the run that a batch ends with waits for the next batch.
    """
    waiting: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        values = batch.column(key).to_numpy(zero_copy_only=False)
        last = int(np.searchsorted(values, values[-1], "left"))
        if waiting and last:
            yield pa.concat_tables([*waiting, table.slice(0, last)])
            waiting = [table.slice(last)]
        elif waiting and waiting[-1].column(key)[-1].as_py() != values[0]:
            yield pa.concat_tables(waiting)
            waiting = [table]
        elif last:
            yield table.slice(0, last)
            waiting = [table.slice(last)]
        else:
            waiting.append(table)
    if waiting:
        yield pa.concat_tables(waiting)


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijective scrambling of 64-bit numbers."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices_by_bytes(texts: list[bytes], limit: int = 1 << 22) -> Iterator[slice]:
    """Slices of consecutive texts that hold about ``limit`` bytes, at least one text each."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > limit:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield slice(begin, len(texts))
