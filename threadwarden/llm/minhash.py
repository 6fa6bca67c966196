"""Near-duplicate groups by a multi-index Hamming join of b-bit MinHash signatures.

A document is the set of its word shingles; its signature holds, for each of 64 hash
functions, 16 bits of the least hash. The distance of two signatures is the number of slots
that differ. The slots are split into chunks; by the pigeonhole principle two signatures
within the distance threshold have a chunk with few errors, so each signature is filed under
every way to leave out that many slots of a chunk: all pairs within the threshold meet in a
bucket. Candidates are confirmed on the full shingle sets.

Buckets are never multiplied out. First every member is compared with one pivot of its
bucket, which links families of copies; then only buckets that still hold several components
are searched, inside tasks of bounded size that return links that join components.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadwarden.llm.common import (
    attach_by_key,
    binary_column,
    connected_components,
    first_of_repeats,
    fixed_rows,
    mix64,
    runs,
    utf8,
)
from threadwarden.sources.staging import stage

# Members of one bucket that a task compares with as many others at a time.
BLOCK_MEMBERS = 2_048
# Close pairs that wait to be compared in full, row by row.
PAIRS_AT_A_TIME = 1 << 18
# Text that is split into words at a time.
SLICE_BYTES = 1 << 22
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


@dataclass(frozen=True)
class Scheme:
    """What is linked, and how signatures are filed.

    ``distance`` 31 of 64 slots: a pair of similarity 0.8 differs in 12.8 slots on average
    and in more than 31 with a probability of 8.2e-08; more similar pairs hardly ever do.
    """

    words: int = 5
    percent: int = 80
    slots: int = 64
    distance: int = 31
    chunk_errors: int = 1
    chunks: list[np.ndarray] = field(init=False, repr=False, compare=False)
    keys: list[tuple[int, np.ndarray]] = field(init=False, repr=False, compare=False)

    def __post_init__(self):
        # with so many chunks, one of them holds at most chunk_errors of distance errors
        n = self.distance // (self.chunk_errors + 1) + 1
        chunks = np.array_split(np.arange(self.slots), n)
        object.__setattr__(self, "chunks", chunks)
        kept = [
            (c, np.setdiff1d(chunk, chunk[list(left_out)]))
            for c, chunk in enumerate(chunks)
            for left_out in itertools.combinations(range(len(chunk)), self.chunk_errors)
        ]
        object.__setattr__(self, "keys", kept)

    def coefficients(self) -> tuple[np.ndarray, np.ndarray]:
        seeds = mix64(np.arange(1, 2 * self.slots + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return (seeds[: self.slots] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (seeds[self.slots :] >> np.uint64(32)).astype(np.uint32)

    def least_hashes(self, sets: list[np.ndarray]) -> np.ndarray:
        """For every non-empty set, the least of its hashes under each function."""
        out = np.empty((len(sets), self.slots), np.uint32)
        factors, offsets = self.coefficients()
        at = 0
        while at < len(sets):
            # a few sets at a time, so that their hashes stay in the processor's cache
            to, size = at, 0
            while to < len(sets) and (to == at or size + len(sets[to]) <= 16_384):
                size += len(sets[to])
                to += 1
            part = sets[at:to]
            flat = (np.concatenate(part) >> np.uint64(32)).astype(np.uint32)
            starts = np.cumsum([0, *map(len, part[:-1])])
            for s in range(self.slots):
                out[at:to, s] = np.minimum.reduceat(flat * factors[s] + offsets[s], starts)
            at = to
        return out

    def signatures(self, sets: list[np.ndarray]) -> np.ndarray:
        """One row of 16-bit slots per non-empty set."""
        return (mix64(self.least_hashes(sets)) & np.uint64(0xFFFF)).astype(np.uint16)

    def bucket_keys(self, signatures: np.ndarray) -> np.ndarray:
        """The key of every bucket of every signature."""
        wide = signatures.astype(np.uint64)
        out = np.empty((len(wide), len(self.keys)), np.uint64)
        for k, (_, kept) in enumerate(self.keys):
            h = np.full(len(wide), k + 1, np.uint64)
            for s in kept:
                h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + wide[:, s])
            out[:, k] = h
        return out.view(np.int64)

    def first_key(self, equal: np.ndarray) -> np.ndarray:
        """The first key that pairs share, given which of their slots are equal."""
        out = np.full(len(equal), -1)
        for k in range(len(self.keys) - 1, -1, -1):
            out[equal[:, self.keys[k][1]].all(axis=1)] = k
        return out


def _word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of a text in lower case, a slice of the text at a time."""
    found, at = [], 0
    while at < len(text):
        to = at + SLICE_BYTES
        if to < len(text):
            space = _SPACE.search(text, to)
            to = space.start() if space else len(text)
        # bytes.split() and bytes.lower() know ASCII only
        words = text[at:to].lower().split()
        if words:
            found.append(pd.util.hash_array(np.array(words, dtype=object), categorize=False))
        at = to
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; a shorter text is one shingle."""
    hashes = _word_hashes(text)
    n = len(hashes)
    if not n:
        return hashes
    width = min(words, n)
    h = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + hashes[j : n - width + 1 + j])
    return np.unique(h)


def sketch(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """doc_id, n_shingles, a digest of the set and its signature; the last two null if empty."""

    def sketched(batches):
        for batch in batches:
            sets = [shingle_set(t, scheme.words) for t in utf8(batch.column("text"))]
            signatures = scheme.signatures([s for s in sets if len(s)])
            rows = iter(signatures)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    binary_column([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]),
                    binary_column([next(rows).tobytes() if len(s) else None for s in sets]),
                ],
                ["doc_id", "n_shingles", "digest", "signature"],
            )

    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return narrow.mapInArrow(sketched, "doc_id bigint, n_shingles bigint, digest binary, signature binary")


def full_sets(docs: DataFrame, nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """(node, shingles) of the documents named in ``nodes``."""

    def read(batches):
        for batch in batches:
            sets = [shingle_set(t, scheme.words) for t in utf8(batch.column("text"))]
            offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("node"), lists], ["node", "shingles"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("node"), F.col("text").cast("string"))
    # candidates grow with the documents: never broadcast them, whatever their number here
    texts = texts.join(nodes.hint("merge"), "node", "left_semi")
    return texts.mapInArrow(read, "node bigint, shingles array<bigint>")


def file_signatures(nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """(key, node) for every bucket of every signature."""

    def filed(batches):
        for batch in batches:
            if batch.num_rows:
                keys = scheme.bucket_keys(fixed_rows(batch.column("signature"), "<u2", scheme.slots))
                nodes = np.repeat(batch.column("node").to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(nodes)], ["key", "node"])

    return nodes.select("node", "signature").mapInArrow(filed, "key bigint, node bigint")


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of shared buckets with a pivot, from rows sorted by key and node.

    The first and the last bucket of a partition may go on in the next one; they are marked
    and always returned. Which member is the pivot depends on the key, so that a family met
    in many buckets is compared with several pivots.
    """

    def starred(table: pa.Table, first: bool, last: bool) -> pa.RecordBatch:
        keys, nodes = table.column("key").to_numpy(), table.column("node").to_numpy()
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        rank = mix64(nodes.view(np.uint64) + (keys.view(np.uint64) & np.uint64(15)) * np.uint64(0x9E3779B97F4A7C15))
        least = np.repeat(np.minimum.reduceat(rank, starts), sizes)
        at = np.flatnonzero(rank == least)
        # copies of a node in one bucket share the rank
        at = at[np.searchsorted(at, starts)]
        pivots = np.repeat(nodes[at], sizes)
        edge = np.zeros(len(starts), bool)
        edge[0] |= first
        edge[-1] |= last
        keep = np.repeat((sizes > 1) | edge, sizes)
        columns = [keys[keep], nodes[keep], pivots[keep], np.repeat(edge, sizes)[keep]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "node", "pivot", "edge"])

    waiting, first = None, True
    for table in runs(batches, "key"):
        if waiting is not None:
            yield starred(waiting, first, False)
            first = False
        waiting = table
    if waiting is not None:
        yield starred(waiting, first, True)


def close_pairs(pairs: DataFrame, nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs (a, b) whose signatures are within the distance threshold."""

    def near(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = (fixed_rows(batch.column(c), "<u2", scheme.slots) for c in ("sig_a", "sig_b"))
                close = (a != b).sum(axis=1) <= scheme.distance
                yield batch.select(["a", "b"]).filter(pa.array(close))

    signed = nodes.select("node", "signature")
    left = pairs.join(signed.select(F.col("node").alias("a"), F.col("signature").alias("sig_a")), "a")
    both = left.join(signed.select(F.col("node").alias("b"), F.col("signature").alias("sig_b")), "b")
    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(near, "a bigint, b bigint").distinct()


def confirmed(pairs: DataFrame, docs: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = stage(full_sets(docs, ends, scheme), "sets")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b")), "b"
    )
    shared = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - shared
    return both.filter(100 * shared >= scheme.percent * union).select("a", "b").distinct()


def _search(scheme: Scheme, table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows that share a cell, lie in different components and on the sides the cell
    compares, are within the distance, and meet in this bucket first."""
    cell, key, component, side, cross = (table.column(c).to_numpy() for c in ("cell", "key", "component", "side", "cross"))
    signatures = fixed_rows(table.column("signature").combine_chunks(), "<u2", scheme.slots)
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    ends = np.repeat(np.r_[starts[1:], len(cell)], np.diff(np.r_[starts, len(cell)]))
    rows = np.arange(len(cell))
    keys = None
    step = 1
    while True:
        rows = rows[rows + step < ends[rows]]
        if not len(rows):
            return
        for i in np.array_split(rows, max(1, len(rows) // 65_536)):
            j = i + step
            apart = (component[i] != component[j]) & (~cross[i] | (side[i] != side[j]))
            i, j = i[apart], j[apart]
            if not len(i):
                continue
            equal = signatures[i] == signatures[j]
            close = scheme.slots - equal.sum(axis=1) <= scheme.distance
            i, j, equal = i[close], j[close], equal[close]
            if len(i):
                keys = scheme.bucket_keys(signatures) if keys is None else keys
                here = keys[i, scheme.first_key(equal)] == key[i]
                if here.any():
                    yield i[here], j[here]
        step += 1


def _by_row(pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, np.ndarray]]:
    """Rows and those that each is paired with, from PAIRS_AT_A_TIME pairs or a few more at a time."""
    waiting, n = [], 0
    for found in itertools.chain(pairs, [None]):
        if found is not None:
            waiting.append(found)
            n += len(found[0])
        if waiting and (found is None or n >= PAIRS_AT_A_TIME):
            rows, others = map(np.concatenate, zip(*waiting))
            order = np.argsort(rows, kind="stable")
            rows, others = rows[order], others[order]
            starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
            yield from zip(rows[starts].tolist(), np.split(others, starts[1:]))
            waiting, n = [], 0


def _links_of(
    shingles: pa.ChunkedArray, components: np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]], percent: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``pairs`` that are similar enough and join components which no earlier ones join.

    The sets become codes once, and the set of a row is marked once for all it is paired with.
    """
    lists = shingles.combine_chunks()
    sizes = pc.list_value_length(lists).to_numpy()
    codes, different = pd.factorize(lists.flatten().to_numpy())
    sets = np.split(codes, np.cumsum(sizes)[:-1])
    held = np.zeros(len(different), bool)
    group = components.copy()
    for i, others in _by_row(pairs):
        others = others[group[others] != group[i]]
        # no more can be shared than the smaller set holds
        others = others[100 * np.minimum(sizes[others], sizes[i]) >= percent * np.maximum(sizes[others], sizes[i])]
        held[sets[i]] = True
        shared = np.array([np.count_nonzero(held[sets[j]]) for j in others.tolist()], np.int64)
        held[sets[i]] = False
        similar = others[100 * shared >= percent * (sizes[i] + sizes[others] - shared)]
        if len(similar):
            joined, first = np.unique(group[similar], return_index=True)
            yield np.full(len(first), i), similar[first]
            group[np.isin(group, joined)] = group[i]


def search_mixed(crowded: DataFrame, components: DataFrame, nodes: DataFrame, docs: DataFrame, scheme: Scheme) -> DataFrame | None:
    """Links between components that share a bucket; None if there are no candidates.

    Buckets above BLOCK_MEMBERS are dealt into cells that hold two blocks of members each,
    and every two blocks meet in one cell, so no member of a bucket is passed over. Cells are
    searched in memory; a first search finds the members that are within the distance of a
    member of another component, and only their full sets are read.
    """
    known = components.select("node", "component")
    members = crowded.select("key", "node").distinct().join(known, "node", "left")
    members = stage(members.withColumn("component", F.coalesce("component", "node")), "members")
    mixed = members.groupBy("key").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.count(F.lit(1)).alias("n")
    ).filter("least <> most").withColumn("blocks", F.ceil(F.col("n") / BLOCK_MEMBERS).cast("bigint"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = members.join(mixed.select("key", "blocks"), "key").withColumn("side", block)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    dealt = dealt.select(
        F.xxhash64("key", F.least("side", "other"), F.greatest("side", "other")).alias("cell"),
        "key", "node", "component", "side", (F.col("side") != F.col("other")).alias("cross"),
    )
    # in the cell of one block with itself, that block's members come once; in others, only unlike sides pair
    cells = dealt.join(nodes.select("node", "signature"), "node").select(
        "cell", "key", "node", "component", "side", "cross", "signature"
    )
    schema = "cell bigint, key bigint, node bigint, component bigint, side bigint, cross boolean, signature binary"

    def involved(batches):
        for table in runs(batches, "cell"):
            hits = [np.concatenate(p) for p in _search(scheme, table)]
            if hits:
                for batch in table.take(pa.array(np.unique(np.concatenate(hits)))).to_batches():
                    yield batch

    found = cells.repartition("cell").sortWithinPartitions("cell", "node").mapInArrow(involved, schema)
    found = stage(found, "involved")
    if found.isEmpty():
        return None
    sets = full_sets(docs, found.select("node").distinct(), scheme)

    def linked(batches):
        for table in runs(batches, "cell"):
            nodes, components = table.column("node").to_numpy(), table.column("component").to_numpy()
            links = list(_links_of(table.column("shingles"), components, _search(scheme, table), scheme.percent))
            if links:
                i, j = map(np.concatenate, zip(*links))
                yield pa.RecordBatch.from_arrays([pa.array(nodes[i]), pa.array(nodes[j])], ["a", "b"])

    full = found.join(sets, "node").select(*found.columns, "shingles")
    return full.repartition("cell").sortWithinPartitions("cell", "node").mapInArrow(linked, "a bigint, b bigint").distinct()


def near_groups(docs: DataFrame, scheme: Scheme = Scheme()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``.

    Documents are linked when 100 * intersection >= percent * union of their shingle sets
    (words: runs of anything but ASCII white space, A-Z lower-cased). A text of fewer words
    than a shingle is one shingle; null, empty and blank texts have an empty set, link with
    nothing, and are components of their own. component_id is the smallest doc_id reachable;
    kept is true where it is the row's own. Rows that share a doc_id are one document, with
    the links of all its texts; rows without doc_id follow their equals, or have no
    component and are kept. An empty table gives an empty result; other columns are not read.

    Confirmed links are exact. A pair at the similarity limit can be missed where its
    signatures differ in more than ``distance`` slots, see :class:`Scheme`.
    """
    rows = stage(sketch(docs, scheme), "sketches")
    classes = rows.filter("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.first("signature").alias("signature"), F.count(F.lit(1)).alias("size")
    )
    classes = stage(classes, "classes")
    nodes = classes.filter("node is not null")
    keys = file_signatures(nodes, scheme)
    # ranges of (key, node) split a bucket that very many share
    sorted_keys = keys.repartitionByRange("key", "node").sortWithinPartitions("key", "node")
    crowded = stage(sorted_keys.mapInArrow(_stars, "key bigint, node bigint, pivot bigint, edge boolean"), "crowded")
    cut = crowded.filter("edge").select("key", "pivot").distinct()
    cut = cut.join(cut.groupBy("key").agg(F.min("pivot").alias("first")), "key")
    spokes = crowded.select("node", "pivot").unionByName(cut.select(F.col("pivot").alias("node"), F.col("first").alias("pivot")))
    pairs = spokes.filter("node <> pivot").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    close = stage(close_pairs(pairs, nodes, scheme), "close")
    links = stage(confirmed(close, docs, scheme), "linked")
    components = connected_components(links)
    more = search_mixed(crowded, components, nodes, docs, scheme)
    if more is not None:
        components = connected_components(links.unionByName(stage(more, "more")))
    grouped = classes.join(components, "node", "left").select(
        "digest", "size", F.coalesce("component", "node").alias("component_id")
    )
    named = rows.filter("n_shingles > 0").select("doc_id", "n_shingles", "digest")
    found = attach_by_key(named, stage(grouped, "grouped"), ["digest"], "size").select("doc_id", "n_shingles", "component_id")
    alone = rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_copies(docs: DataFrame, scheme: Scheme = Scheme()) -> DataFrame:
    """``docs`` with one document of each group, that of the smallest doc_id; all columns stay.

    Rows without doc_id stay. Of rows repeated with the same id and text one stays.
    """
    gone = stage(near_groups(docs, scheme).filter("not kept").select(F.col("doc_id").alias("_gone")).distinct(), "near")
    id_ = F.col("doc_id").cast("bigint")
    left = docs.join(gone.hint("merge"), id_ == F.col("_gone"), "left_anti").withColumns({"_id": id_, "_mark": F.xxhash64(F.col("text").cast("string"))})
    repeats = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 and doc_id is not null")
    if repeats.isEmpty():
        return left.select(*docs.columns)
    named = first_of_repeats(left.filter("_id is not null"), ["_id", "_mark"])
    return named.unionByName(left.filter("_id is null")).select(*docs.columns)
