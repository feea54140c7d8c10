"""Exact nearest neighbours by a block matrix join.

Vectors are cut into blocks of queries and of candidates, and each pair of blocks is a tile of one task. A
tile multiplies int8 codes; the error of a product is bounded by the lengths of the rounding residues,
so a candidate whose upper bound is below the k-th best lower bound cannot be among the k best. The rest is
recomputed from the original numbers in double precision, and heaps merge the tiles' lists.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import lean
from glossa.session import write_scratch


@dataclass(frozen=True)
class NearestSettings:
    """Rows of a block. A tile multiplies ``step`` queries at a time, so it needs a few times
    ``step * candidates`` doubles beside its rows."""

    queries: int = 4096
    candidates: int = 8192
    step: int = 128
    seed: int = 3


def usable_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): one row per key and its vector; vectors that take no part are left out.

    Those are null, empty, zero, or hold a null, NaN or infinite number. Of rows that
    repeat a key the smallest vector counts.
    """
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.col(key).isNotNull() & F.col(vector).isNotNull() & ~bad & F.exists(v, lambda x: x != 0)
    return rows.filter(good).select(F.col(key).cast("long").alias("id"), v.alias("v")).groupBy("id").agg(F.min("v").alias("v"))


def exact_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed in the order of the components."""
    total = np.zeros(len(x))
    for d in range(x.shape[1]):
        total += x[:, d] * y[:, d]
    return total


def _codes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, their scale, the length of the coded vector and that of the residue."""
    scale = np.abs(rows).max(axis=1) / 127
    codes = np.rint(rows / scale[:, None]).astype(np.int8)
    coded = codes * scale[:, None]
    return codes, scale, np.linalg.norm(coded, axis=1), np.linalg.norm(rows - coded, axis=1)


def tile_best(query_ids, queries, ids, candidates, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of each query's k best candidates of a tile, itself left out."""
    qc, qs, ql, qr = _codes(queries)
    cc, cs, cl, cr = _codes(candidates)
    # Products of codes are whole numbers below 2^24 for up to 1040 dimensions: float32 holds them exactly.
    kind = np.float32 if queries.shape[1] <= 1040 else np.float64
    about = (qc.astype(kind) @ cc.astype(kind).T).astype(np.float64) * qs[:, None] * cs[None, :]
    error = (ql[:, None] * cr[None, :] + qr[:, None] * (cl + cr)[None, :]) * (1 + 1e-9) + 1e-12 * ql[:, None] * cl[None, :]
    own = query_ids[:, None] == ids[None, :]
    low = np.where(own, -np.inf, about - error)
    if len(ids) > k:
        least = -np.partition(-low, k - 1, axis=1)[:, k - 1]
        left = (about + error >= least[:, None]) & ~own
    else:
        left = ~own
    q, c = np.nonzero(left)
    score = np.empty(len(q))
    for at in range(0, len(q), 1 << 16):
        part = slice(at, at + (1 << 16))
        score[part] = exact_products(queries[q[part]], candidates[c[part]])
    order = np.lexsort((ids[c], -score, q))
    q, c, score = q[order], c[order], score[order]
    first = np.searchsorted(q, np.arange(len(query_ids)))
    keep = np.arange(len(q)) - first[q] < k
    return query_ids[q[keep]], ids[c[keep]], score[keep]


def nearest(
    rows: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding", settings: NearestSettings = NearestSettings()
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest inner product for each query row.

    ``is_query`` is a condition on column ``id``. Every usable row but the query's own is a candidate; all of
    them are returned if there are fewer than ``k``. Ties go to the smaller id.

    * see ``usable_vectors`` for nulls, zero vectors and repeated rows
    * vectors of different lengths are not comparable and never meet
    * empty table, no query or no candidate: no rows; other columns are not read

    A tile holds bounded blocks whatever the table's size. A block is copied to the tiles it takes part in, as
    the exact search of a query set against all rows needs.
    """
    vectors = write_scratch(
        usable_vectors(rows, key, vector).withColumn("dim", F.size("v")).withColumn("query", is_query), "vectors"
    )
    sizes = vectors.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.count_if("query").alias("q"))
    # One row per vector length, with the number of blocks of either kind.
    sizes = sizes.filter("q > 0").select(
        "dim",
        F.ceil(F.col("q") / F.lit(settings.queries)).cast("int").alias("q_blocks"),
        F.ceil(F.col("n") / F.lit(settings.candidates)).cast("int").alias("c_blocks"),
    )
    sized = vectors.join(F.broadcast(sizes), "dim")
    spread = F.xxhash64("id", F.lit(settings.seed))
    queries = (
        sized.filter("query").withColumn("qb", F.pmod(spread, F.col("q_blocks")).cast("int"))
        .withColumn("cb", F.explode(F.sequence(F.lit(0), F.col("c_blocks") - 1))).select("dim", "qb", "cb", "id", "v")
        .toDF("q_dim", "q_qb", "q_cb", "q_id", "q_v")
    )
    candidates = (
        sized.withColumn("cb", F.pmod(spread, F.col("c_blocks")).cast("int"))
        .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1))).select("dim", "qb", "cb", "id", "v")
    )

    def tile(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        right = right.sort_values("id")
        ids, vectors = right["id"].to_numpy(), np.array(right["v"].to_list(), dtype=np.float64)
        parts = []
        for at in range(0, len(left), settings.step):
            some = left.iloc[at : at + settings.step]
            q, c, s = tile_best(some["q_id"].to_numpy(), np.array(some["q_v"].to_list(), dtype=np.float64), ids, vectors, k)
            parts.append(pd.DataFrame({"query_id": q, "vec_id": c, "score": s}))
        return pd.concat(parts)

    parts = queries.groupBy("q_dim", "q_qb", "q_cb").cogroup(candidates.groupBy("dim", "qb", "cb")).applyInPandas(
        tile, "query_id long, vec_id long, score double"
    )

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by query; one heap of k rows at a time."""
        query, heap = None, []

        def done():
            best = sorted(heap, reverse=True)
            return [(query, i + 1, -negative, score) for i, (score, negative) in enumerate(best)]

        for batch in batches:
            out = []
            for q, v, s in zip(batch["query_id"].tolist(), batch["vec_id"].tolist(), batch["score"].tolist()):
                if q != query:
                    out += done()
                    query, heap = q, []
                if len(heap) < k:
                    heapq.heappush(heap, (s, -v))
                else:
                    heapq.heappushpop(heap, (s, -v))
            yield pd.DataFrame(out, columns=["query_id", "rank", "vec_id", "score"])
        yield pd.DataFrame(done(), columns=["query_id", "rank", "vec_id", "score"])

    return parts.repartition("query_id").sortWithinPartitions("query_id").mapInPandas(lean(merge), "query_id long, rank int, vec_id long, score double"
    )
