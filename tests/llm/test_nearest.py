from __future__ import annotations

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from glossa.llm.nearest import NearestSettings, nearest, tile_best


def as_dict(df):
    return {(r.query_id, r.rank): (r.vec_id, r.score) for r in df.collect()}


def test_table_equals_brute_force(small):
    vectors = {r.vec_id: r.embedding for r in small("embeddings").collect()}
    got = as_dict(nearest(small("embeddings"), F.col("id") % 20 == 0, 20, settings=NearestSettings(queries=7, candidates=61, step=3)))
    assert got == brute.nearest(vectors, lambda i: i % 20 == 0, 20)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [2.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [nan, 1.0]),
        (7, [inf, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]), (10, [-1e30, 1e-30]), (11, [1e-300, 0.0]), (20, [1.0, 2.0]), (20, [1.0, 2.0]), (None, [9.0, 9.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("clash")).repartition(4)
    good = {k: v for k, v in rows if k is not None}
    want = brute.nearest(good, lambda i: i % 20 == 0, 3)
    assert as_dict(nearest(df, F.col("id") % 20 == 0, 3)) == want
    assert {k[0] for k in want} == {0, 20}
    assert nearest(df.limit(0), F.col("id") % 20 == 0, 3).collect() == []
    assert nearest(df.filter("vec_id = 0"), F.col("id") % 20 == 0, 3).collect() == []


@pytest.mark.parametrize("scale", [1e-6, 1.0, 1e6])
def test_bounds_keep_every_near_vector(scale):
    """Close scores: what the int8 codes cannot tell apart is recomputed."""
    random = np.random.default_rng(0)
    base = random.standard_normal(48)
    rows = (base + 1e-3 * random.standard_normal((3000, 48))) * scale
    queries = rows[:40]
    q, c, s = tile_best(np.arange(40), queries, np.arange(3000), rows, 20)
    for i in range(40):
        scores = np.zeros(3000)
        for d in range(48):
            scores += queries[i, d] * rows[:, d]
        order = [j for j in np.lexsort((np.arange(3000), -scores)) if j != i][:20]
        assert c[q == i].tolist() == order
