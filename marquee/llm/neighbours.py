"""Nearest neighbours of a stated query set by a block matrix join.

Queries and candidates are dealt into blocks, and every query block meets every candidate block in
one task. Vectors are rounded to int8 with a scale each; the product of two int8 blocks gives all
inner products with an error that the norms of what rounding left bound. A pair whose upper bound
falls below the k-th lower bound of its query in the tile cannot be among the k nearest. The others
are computed again from the original vectors in double precision, and heaps keep the best k.
"""

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FOUND = "query_id long, vec_id long, score double"


def _quantised(x):
    """int8 values (as floats, whose sums of products are exact here), scales, and norms of the error."""
    scale = np.abs(x).max(axis=1) / 127
    codes = np.rint(x / scale[:, None])
    error = np.linalg.norm(x - codes * scale[:, None], axis=1)
    return codes.astype(np.float32), scale, error


def _exact(a, b):
    """Inner products of aligned rows, summed from the first component on."""
    return np.cumsum(a * b, axis=1)[:, -1]


def tile(query_ids, queries, ids, vectors, k):
    """The ``k`` nearest candidates of each query inside one pair of blocks."""
    qc, qs, qe = _quantised(queries)
    xc, xs, xe = _quantised(vectors)
    rough = (qc @ xc.T) * (qs[:, None] * xs)
    # q.x - q'.x' = (q - q').x + q'.(x - x')
    bound = qe[:, None] * np.linalg.norm(vectors, axis=1) + np.linalg.norm(qc * qs[:, None], axis=1)[:, None] * xe
    bound = bound * (1 + 1e-6) + np.abs(rough) * 1e-6 + 1e-300
    other = query_ids[:, None] != ids
    low = np.where(other, rough - bound, -np.inf)
    floor = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] > k else np.full(len(low), -np.inf)
    row, column = np.nonzero(other & (rough + bound >= floor[:, None]))
    scores = np.empty(len(row))
    for at in range(0, len(row), 1 << 16):
        part = slice(at, at + (1 << 16))
        scores[part] = _exact(queries[row[part]], vectors[column[part]])
    ends = np.searchsorted(row, np.arange(len(queries) + 1))
    out = []
    for i in range(len(queries)):
        own = range(ends[i], ends[i + 1])
        best = heapq.nsmallest(k, ((-scores[j], ids[column[j]]) for j in own))
        out += [(query_ids[i], vec, -minus) for minus, vec in best]
    return out


def _tiles(k, step=4096):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"})
        queries = np.array(left["vector"].tolist(), dtype=np.float64)
        query_ids, ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
        heaps = {}
        for at in range(0, len(right), step):
            vectors = np.array(right["vector"].iloc[at: at + step].tolist(), dtype=np.float64)
            for query, vec, score in tile(query_ids, queries, ids[at: at + step], vectors, k):
                heap = heaps.setdefault(query, [])
                (heapq.heappush if len(heap) < k else heapq.heappushpop)(heap, (score, -vec))
        rows = [(q, -v, s) for q, heap in heaps.items() for s, v in heap]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``vector`` (doubles) of the rows that can take part; repeated rows once."""
    vector = F.col("embedding").cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    rows = rows.filter("vec_id is not null and vector is not null").filter(~F.exists("vector", bad))
    return rows.filter(F.exists("vector", lambda x: x != 0)).distinct()


def nearest(queries: DataFrame, candidates: DataFrame, k=20, query_block=1024, block=16384) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): the ``k`` largest inner products per query.

    Both frames have ``vec_id`` and ``embedding``. A query's own ``vec_id`` is no candidate; ties go
    to the smaller ``vec_id``; fewer than ``k`` candidates are all returned. Rows without an id, and
    vectors that are null, zero, or hold a null or non-finite component, take no part. Vectors meet
    vectors of the same length only. The number of blocks follows the number of rows.
    """
    left, right = usable(queries), usable(candidates)
    parts = max(1, -(-left.count() // query_block))
    blocks = max(1, -(-right.count() // block))
    dealt = lambda rows, n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    length = F.size("vector").alias("length")
    left = left.select("*", length, dealt(left, parts).alias("part"), every(blocks).alias("block"))
    right = right.select("*", length, dealt(right, blocks).alias("block"), every(parts).alias("part"))
    keys = ["length", "part", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_tiles(k), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
