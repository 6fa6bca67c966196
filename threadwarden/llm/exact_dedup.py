"""Exact de-duplication against immutable snapshots, screened by static filters.

A snapshot is a stored table of the digests of its texts, with one binary-fuse filter per
bucket of digests. A digest that the filter rules out is new; the few others join the
snapshot's bucket exactly, and the texts behind equal digests are compared byte by byte.
Copies inside the new batch are grouped on their own by digest. All rows but the byte check
are narrow: ids and digests.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadwarden.llm.common import attach_by_key, binary_column, first_of_repeats, mix64, utf8
from threadwarden.sources.staging import stage

# Digests per bucket: what one task holds while it builds or probes a filter.
BUCKET_KEYS = 1 << 16

DIGEST_SCHEMA = "doc_id bigint, digest binary, prefix bigint"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, SHA-256 of the text with A-Z in lower case, and the digest's first 8 bytes."""

    def hashed(batches):
        for batch in batches:
            found = [hashlib.sha256(t.lower()).digest() for t in utf8(batch.column("text"))]
            prefix = np.frombuffer(b"".join(d[:8] for d in found), ">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), binary_column(found), pa.array(prefix)], ["doc_id", "digest", "prefix"]
            )

    # bytes.lower() changes A-Z only
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(hashed, DIGEST_SCHEMA)


# ---- the static filter ----


def _places(keys: np.ndarray, seed: int, length: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Three slots in neighbouring segments and a fingerprint for each key."""
    with np.errstate(over="ignore"):
        h = mix64(keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))
        first = (h >> np.uint64(32)) % np.uint64(segments * length)
        start = first // np.uint64(length)
        mask = np.uint64(length - 1)
        second = (start + np.uint64(1)) * np.uint64(length) + ((h >> np.uint64(16)) & mask)
        third = (start + np.uint64(2)) * np.uint64(length) + (h & mask)
        prints = (mix64(h) & np.uint64(0xFF)).astype(np.uint8)
    return np.stack([first, second, third]).astype(np.int64), prints


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segments, fingerprints) of a binary-fuse filter over distinct keys.

    Slots that one key alone uses are peeled off, round by round; the fingerprints are then
    set in reverse. A seed with a rest that cannot be peeled is replaced by the next.
    """
    keys = np.unique(np.asarray(keys).astype(np.int64).view(np.uint64))
    n = len(keys)
    length = 1 << max(2, int(np.log(max(n, 2)) / np.log(3.33) + 2.25))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 10))) + 0.05
    segments = max(1, -(-int(n * factor) // length) - 2)
    size = (segments + 2) * length
    for seed in range(1000):
        if seed and seed % 20 == 0:
            segments += max(1, segments // 10)
            size = (segments + 2) * length
        slots, prints = _places(keys, seed, length, segments)
        count = np.bincount(slots.ravel(), minlength=size)
        key_sum = np.bincount(slots.ravel(), weights=np.tile(np.arange(n), 3), minlength=size).astype(np.int64)
        order: list[tuple[np.ndarray, np.ndarray]] = []
        left = n
        while left:
            alone = np.flatnonzero(count == 1)
            if not len(alone):
                break
            peeled, at = np.unique(key_sum[alone], return_index=True)
            order.append((peeled, alone[at]))
            gone = slots[:, peeled]
            np.subtract.at(count, gone.ravel(), 1)
            np.subtract.at(key_sum, gone.ravel(), np.tile(peeled, 3))
            left -= len(peeled)
        if not left:
            table = np.zeros(size, np.uint8)
            for peeled, slot in reversed(order):
                s = slots[:, peeled]
                # the slot to be set still holds zero
                table[slot] = prints[peeled] ^ table[s[0]] ^ table[s[1]] ^ table[s[2]]
            return seed, length, segments, table.tobytes()
    raise RuntimeError("no seed gives a filter")


def probe_filter(keys: np.ndarray, seed: int, length: int, segments: int, table: bytes) -> np.ndarray:
    """True for every key of the filter, and for about one other key in 256."""
    slots, prints = _places(np.asarray(keys).astype(np.int64).view(np.uint64), seed, length, segments)
    cells = np.frombuffer(table, np.uint8)
    return (cells[slots[0]] ^ cells[slots[1]] ^ cells[slots[2]]) == prints


# ---- snapshots ----


@dataclass
class Snapshot:
    """``groups``: one row per distinct text; ``filters``: one row per bucket; 2**bits buckets."""

    groups: DataFrame
    filters: DataFrame
    bits: int


def bucket(bits: int) -> Column:
    return F.lit(0).cast("bigint") if bits == 0 else F.shiftrightunsigned("prefix", 64 - bits)


def group_copies(rows: DataFrame) -> DataFrame:
    """One row per digest: the largest doc_id, how many rows have it, and the number of copies.

    Counts are taken per task before each shuffle, so copies never meet in one task.
    """
    per_doc = rows.groupBy("digest", "prefix", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return per_doc.groupBy("digest", "prefix").agg(
        F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size"), F.max("n").alias("most_repeats")
    )


def build_snapshot(groups: DataFrame, at_least: int = 0) -> Snapshot:
    """Freeze ``groups`` of :func:`group_copies` and build the filter of each bucket."""
    groups = stage(groups, "snapshot")
    keys = max(groups.count(), at_least)
    bits = max(0, int(np.ceil(np.log2(max(1, keys / BUCKET_KEYS)))))

    def built(key, table):
        seed, length, segments, cells = build_filter(table.column("prefix").to_numpy())
        return pa.table({
            "bucket": pa.array([key[0].as_py()], pa.int64()),
            "seed": pa.array([seed], pa.int32()),
            "length": pa.array([length], pa.int32()),
            "segments": pa.array([segments], pa.int32()),
            "cells": pa.array([cells], pa.binary()),
        })

    schema = "bucket bigint, seed int, length int, segments int, cells binary"
    filters = groups.select(bucket(bits).alias("bucket"), "prefix").groupBy("bucket").applyInArrow(built, schema)
    return Snapshot(groups, stage(filters, "filters"), bits)


def screen(groups: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Digests of ``groups`` that the snapshot's filters do not rule out."""

    def probed(key, incoming, filters):
        if not incoming.num_rows or not filters.num_rows:
            return pa.table({"digest": pa.array([], pa.binary())})
        f = filters.to_pylist()[0]
        hit = probe_filter(incoming.column("prefix").to_numpy(), f["seed"], f["length"], f["segments"], f["cells"])
        return incoming.filter(pa.array(hit)).select(["digest"])

    incoming = groups.select(bucket(snapshot.bits).alias("bucket"), "prefix", "digest")
    return (
        incoming.groupBy("bucket").cogroup(snapshot.filters.groupBy("bucket")).applyInArrow(probed, "digest binary")
    )


def differing_bytes(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Digests of ``pairs`` (digest, doc_id) whose texts are not identical in every byte."""

    def lowered(batches):
        for batch in batches:
            texts = [t.lower() for t in utf8(batch.column("text"))]
            found = binary_column([hashlib.sha256(t).digest() for t in texts])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found, binary_column(texts)], ["doc_id", "digest", "text"])

    # positives grow with the snapshot: never broadcast them, whatever their size here; a task
    # hashes their ids, which are narrow, so that texts need not be sorted
    ids = pairs.select("doc_id").hint("shuffle_hash")
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).join(ids, "doc_id", "left_semi")
    # only the texts left are lowered and hashed, once each; as a key of that join the digest was taken of all texts
    texts = texts.mapInArrow(lowered, "doc_id bigint, digest binary, text binary")
    # a doc_id may stand before other texts too
    own = texts.join(pairs.hint("merge"), ["doc_id", "digest"])
    checked = own.groupBy("digest").agg(F.min("text").alias("least"), F.max("text").alias("most"))
    return checked.filter("least <> most").select("digest")


def exact_groups(docs: DataFrame, in_snapshot: Column | None = None) -> DataFrame:
    """doc_id, digest, keep_id, group_size, most_repeats and kept of every row of ``docs``.

    ``in_snapshot`` tells which rows form the snapshot; the rest comes in as a new batch
    (by default a hash of doc_id deals them in halves). Texts are equal when identical after
    lower-casing A-Z; a null text counts as empty, and empty texts equal each other. The row
    with the largest doc_id stays; null ids are the smallest. Rows repeated under one doc_id
    and text are counted in group_size, and kept for all of them if that id stays. An empty
    table gives an empty result. Columns other than doc_id and text are not read.
    """
    if in_snapshot is None:
        in_snapshot = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    rows = stage(digests(docs).withColumn("old", in_snapshot), "digests")
    fresh = stage(group_copies(rows.filter(~F.col("old"))), "batch")
    snapshot = build_snapshot(group_copies(rows.filter("old")), fresh.count())
    # positives join their exact bucket: equal digests, then equal bytes
    met = screen(fresh, snapshot).join(fresh, "digest").select("digest", "keep_id")
    met = met.join(snapshot.groups.select("digest", F.col("keep_id").alias("old_id")), "digest")
    pairs = stage(met.select("digest", F.explode(F.array("keep_id", "old_id")).alias("doc_id")), "positives")
    confirmed = pairs.select("digest").distinct().join(differing_bytes(docs, pairs), "digest", "left_anti")
    confirmed = stage(confirmed, "confirmed")
    sides = fresh.withColumn("old", F.lit(False)).unionByName(snapshot.groups.withColumn("old", F.lit(True)))
    joined = sides.join(confirmed, "digest", "left_semi").groupBy("digest", "prefix").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.max("most_repeats").alias("most_repeats")
    )
    joined = joined.withColumn("old", F.explode(F.array(F.lit(False), F.lit(True))))
    apart = sides.join(confirmed, "digest", "left_anti")
    groups = stage(apart.unionByName(joined).drop("prefix"), "groups")
    found = attach_by_key(rows.drop("prefix"), groups, ["digest", "old"], "group_size")
    return found.drop("old").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that :func:`exact_groups` drops; all columns stay.

    Of rows repeated under one doc_id and text one stays, whichever.
    """
    found = stage(exact_groups(docs), "exact")
    shape = found.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.col("doc_id").isNull(), 1)).alias("nameless"),
        F.max("most_repeats").alias("most"),
    ).first()
    if shape["rows"] == 0:
        return docs
    ids = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if shape["nameless"] == 0 and shape["most"] == 1 and ids.filter("n > 1").isEmpty():
        # ids name rows: the dropped ids are all it takes
        gone = found.filter("not kept").select(F.col("doc_id").alias("_gone"))
        return docs.join(gone.hint("merge"), F.col("doc_id").cast("bigint") == F.col("_gone"), "left_anti")
    kept = found.filter("kept").select(F.col("doc_id").alias("_keep"), F.col("digest").alias("_digest")).distinct()
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), _UPPER, _LOWER)
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_keep")) & (F.col("_own") == F.col("_digest"))
    both = docs.withColumn("_own", F.unhex(F.sha2(text, 256))).join(kept, same)
    return first_of_repeats(both, ["_keep", "_digest"]).select(*docs.columns)
