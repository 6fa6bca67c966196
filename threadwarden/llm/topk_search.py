"""Exact top-k inner products by the threshold algorithm.

The vectors are dealt into blocks. Each block holds one list per dimension, sorted by value;
a query walks all lists from their better end at once, looks up the full score of every
vector it meets, and stops when no unmet vector can reach its k-th result: an unmet vector
stands below the current place in every list, which bounds its score. The best of each block
are merged per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadwarden.operators.distributed import ranked_top_n
from threadwarden.sources.staging import stage

# Vectors and queries of one cell: what a task holds at once.
BLOCK_ROWS = 16_384
QUERY_ROWS = 4_096

RESULT = "query_id bigint, vec_id bigint, score bigint"


def quantised(embedding: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("bigint"))


def usable(embedding: Column) -> Column:
    """False for null vectors and for those with a null, NaN or infinite component."""
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf")))
    return embedding.isNotNull() & ~F.coalesce(F.exists(embedding, bad), F.lit(True))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists as rows of a matrix; short lists are filled with zeros."""
    lists = column.combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


class Block:
    """Vectors with one sorted list of rows per dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids = ids
        # sums of products are exact in doubles up to 2**53, and doubles multiply faster
        self.largest = float(np.abs(vectors.astype(np.float64)).max(initial=0))
        self.vectors = vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(vectors, self.order, 0)

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows but the query's own; ties go to the smaller id."""
        n = len(self.ids)
        exact = self.largest * float(np.abs(query.astype(np.float64)).sum()) < 2**53
        vectors = self._as_double() if exact else self.vectors
        weights = query.astype(np.float64) if exact else query
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        met = np.zeros(n, bool)
        own = self.ids == query_id
        best_ids, best = np.empty(0, np.int64), np.empty(0, np.int64)
        depth, step = 0, max(4 * k, 64)
        while depth < n:
            to = min(n, depth + step)
            fresh = np.zeros(n, bool)
            fresh[self.order[n - to : n - depth, up].ravel()] = True
            fresh[self.order[depth:to, down].ravel()] = True
            if to == n:
                fresh[:] = True
            rows = np.flatnonzero(fresh & ~met & ~own)
            met |= fresh
            scores = (vectors[rows] @ weights).astype(np.int64)
            if len(best) >= k:
                rows, scores = rows[scores >= best[k - 1]], scores[scores >= best[k - 1]]
            best_ids, best = np.concatenate([best_ids, self.ids[rows]]), np.concatenate([best, scores])
            if len(best) > k:
                reach = np.partition(best, len(best) - k)[len(best) - k]
                best_ids, best = best_ids[best >= reach], best[best >= reach]
            first = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[first], best[first]
            depth, step = to, step * 2
            if depth < n and len(best) >= k:
                bound = int(query[up] @ self.values[n - 1 - depth, up] + query[down] @ self.values[depth, down])
                if bound < best[k - 1]:
                    break
        return best_ids, best

    def _as_double(self) -> np.ndarray:
        if not hasattr(self, "_double"):
            self._double = self.vectors.astype(np.float64)
        return self._double


def exact_top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS
) -> DataFrame:
    """query_id, rank, vec_id, score: for each query the k largest inner products.

    Both tables hold vec_id and an integer array ``vector``. Rows with the query's own vec_id
    are left out; ties go to the smaller vec_id; with fewer than k others, all come. A row
    repeated in ``vectors`` is a candidate each time; rows repeated in ``queries`` ask once,
    and different vectors under one query id share their k results. Vectors of different
    length are filled up with zeros. Scores must fit a long. Empty tables give no rows.

    Every block of vectors meets every block of queries in a cell of its own, so the memory of
    a task is bounded and cells run in parallel; only k rows per query leave a cell.
    """
    vectors = stage(vectors.select("vec_id", "vector"), "vectors")
    queries = stage(queries.select("vec_id", "vector").distinct(), "queries")
    sizes = [df.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first() for df in (vectors, queries)]
    width = max(s[1] or 0 for s in sizes)
    n_blocks, n_asked = (max(1, -(-s[0] // rows)) for s, rows in zip(sizes, (block_rows, query_rows)))
    deal = lambda n: F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    blocks = vectors.withColumn("block", deal(n_blocks)).withColumn("asked", every(n_asked))
    asked = queries.withColumn("asked", deal(n_asked)).withColumn("block", every(n_blocks))

    def search(key, rows, ask):
        found = []
        if rows.num_rows and ask.num_rows:
            block = Block(rows.column("vec_id").to_numpy(), _matrix(rows.column("vector"), width))
            ids = ask.column("vec_id").to_numpy()
            for query_id, query in zip(ids, _matrix(ask.column("vector"), width)):
                best_ids, best = block.top(query_id, query, k)
                found.append((np.full(len(best), query_id, np.int64), best_ids, best))
        columns = [np.concatenate(c) if found else np.empty(0, np.int64) for c in (zip(*found) if found else [(), (), ()])]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, columns))))

    cells = blocks.groupBy("block", "asked").cogroup(asked.groupBy("block", "asked")).applyInArrow(search, RESULT)
    ranked = ranked_top_n(cells, ["query_id"], [F.col("score").desc(), F.col("vec_id")], k, "rank")
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
