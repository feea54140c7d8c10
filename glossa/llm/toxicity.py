"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are computed on the JVM: lower-cased words (runs of letters and digits) of the whole
text, hashed into ``buckets`` as unigrams, bigrams and one-skip bigrams (words i and i + 2), each counted once
per text with value 1 (``unit_length`` scales them by the text's number of features instead). Learning takes a bounded sample of labelled rows (``most_rows``, lowest
hash of doc_id first), spread over learners of ``rows_per_learner`` rows; each runs FTRL-proximal (per-coordinate
rates, L1 and L2) over its rows and the learners' weights are averaged by a Spark aggregation. L1 keeps the
weights sparse; at most ``buckets`` + 1 of them exist, which bounds what is broadcast to score every document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import lean
from glossa.session import write_scratch


@dataclass(frozen=True)
class ToxicitySettings:
    buckets: int = 1 << 20
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 10.0
    l2: float = 1.0
    epochs: int = 6
    # Bound on the labelled rows learned from, and rows per learner.
    most_rows: int = 200_000
    rows_per_learner: int = 50_000
    threshold: float = 0.3
    seed: int = 23
    # Value of a present feature: 1, or 1 / sqrt(distinct features of the text) when True.
    unit_length: bool = False


@dataclass(frozen=True)
class ToxicityModel:
    features: np.ndarray  # int64 bucket numbers with a non-zero weight
    weights: np.ndarray  # float64
    bias: float
    buckets: int
    rows: int  # labelled rows learned from

    def dense(self) -> np.ndarray:
        out = np.zeros(self.buckets, dtype=np.float64)
        out[self.features] = self.weights
        return out


def _pairs(words: Column, gap: int, tag: int, buckets: int) -> Column:
    later = F.slice(words, gap + 1, F.greatest(F.size(words) - gap, F.lit(0)))
    joined = F.zip_with(words, later, lambda a, b: F.when(b.isNotNull(), F.pmod(F.xxhash64(F.lit(tag), a, b), F.lit(buckets))))
    return F.filter(joined, lambda h: h.isNotNull())


def features(text: Column, buckets: int) -> Column:
    """Distinct hashed unigrams, bigrams and skip-grams of the whole text; empty for null or wordless text."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    unigrams = F.transform(words, lambda w: F.pmod(F.xxhash64(F.lit(1), w), F.lit(buckets)))
    return F.array_distinct(F.concat(unigrams, _pairs(words, 1, 2, buckets), _pairs(words, 2, 3, buckets)))


def _ftrl(rows: list[tuple[np.ndarray, float]], settings: ToxicitySettings) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal over ``rows`` (feature numbers, label) for ``epochs`` passes; returns (features, weights), bias last."""
    s = settings
    size = s.buckets + 1
    z = np.zeros(size)
    n = np.zeros(size)
    bias = np.array([s.buckets], dtype=np.int64)
    for _ in range(s.epochs):
        for feats, label in rows:
            idx = np.concatenate([feats, bias])
            value = np.full(len(idx), 1.0 / math.sqrt(max(len(feats), 1)) if s.unit_length else 1.0)
            value[-1] = 1.0
            zi, ni = z[idx], n[idx]
            w = np.where(np.abs(zi) <= s.l1, 0.0, -(zi - np.sign(zi) * s.l1) / ((s.beta + np.sqrt(ni)) / s.alpha + s.l2))
            margin = float(np.dot(w, value))
            p = 1.0 / (1.0 + math.exp(-max(min(margin, 35.0), -35.0)))
            g = (p - label) * value
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / s.alpha
            z[idx] = zi + g - sigma * w
            n[idx] = ni + g * g
    w = np.where(np.abs(z) <= s.l1, 0.0, -(z - np.sign(z) * s.l1) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))
    kept = np.flatnonzero(w)
    return kept, w[kept]


def learn_toxicity(docs: DataFrame, labels: DataFrame, settings: ToxicitySettings = ToxicitySettings()) -> ToxicityModel:
    """A model from ``labels`` (doc_id, toxic) joined to the texts of ``docs`` (doc_id, text).

    Rows with a null toxic value or doc_id are not used; a doc_id with several texts or labels gives one
    example per pair. Of the labels, the ``most_rows`` of lowest hash of (doc_id, label) are learned from,
    with every text of their doc_id.
    Without labelled rows the model has no weights and scores every text 0.5.
    """
    s = settings
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col("toxic").cast("double").alias("_y"), F.xxhash64("doc_id", "toxic", F.lit(s.seed)).alias("_r")
    )
    # The sample is chosen on the labels alone, so that no text is shuffled; its size is bounded by most_rows,
    # which bounds the broadcast that finds its texts.
    chosen = known.orderBy("_r", "doc_id", "_y").limit(s.most_rows)
    chosen = write_scratch(chosen, "toxic-sample")
    counted = chosen.count()
    if not counted:
        return ToxicityModel(np.empty(0, np.int64), np.empty(0), 0.0, s.buckets, 0)
    examples = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        "_r", "_y", features(F.col("text"), s.buckets).alias("_f")
    )
    learners = max(1, math.ceil(counted / s.rows_per_learner))
    examples = examples.repartition(learners, "_r").sortWithinPartitions("_r", "_y")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            feats = batch.column("_f")
            flat = feats.values.to_numpy(zero_copy_only=False).astype(np.int64)
            offsets = feats.offsets.to_numpy()
            base = offsets[0]
            for i, label in enumerate(batch.column("_y").to_numpy(zero_copy_only=False)):
                rows.append((flat[offsets[i] - base: offsets[i + 1] - base].copy(), float(label)))
        if rows:
            kept, weights = _ftrl(rows, s)
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64()), pa.array(weights, pa.float64())], ["feature", "weight"])

    summed = examples.mapInArrow(lean(learn), "feature long, weight double").groupBy("feature").agg(
        (F.sum("weight") / learners).alias("weight")
    )
    table = summed.toArrow()
    feats = table.column("feature").to_numpy()
    weights = table.column("weight").to_numpy()
    at_bias = feats == s.buckets
    bias = float(weights[at_bias].sum())
    return ToxicityModel(feats[~at_bias].astype(np.int64), weights[~at_bias].astype(np.float64), bias, s.buckets, counted)


def score_toxicity(docs: DataFrame, model: ToxicityModel, settings: ToxicitySettings = ToxicitySettings()) -> DataFrame:
    """Every row of ``docs`` with score (0 to 1, higher: toxic likelier) and predicted (score >= threshold).

    Null, empty and wordless texts get the bias's score; the whole text counts, however long. Columns named
    score, predicted or _f are replaced. Rows keep their other columns, repeated rows stay repeated.
    """
    spark = docs.sparkSession
    dense = spark.sparkContext.broadcast(model.dense().astype(np.float32))
    bias = model.bias
    base = docs.drop("score", "predicted", "_f")
    rows = base.withColumn("_f", features(F.col("text"), model.buckets))
    schema = base.schema.add("score", "double").add("predicted", "integer")
    threshold = settings.threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = dense.value
        for batch in batches:
            feats = batch.column("_f")
            flat = feats.values.to_numpy(zero_copy_only=False).astype(np.int64)
            offsets = feats.offsets.to_numpy().astype(np.int64)
            flat = flat[offsets[0]: offsets[-1]]
            offsets = offsets - offsets[0]
            sizes = np.diff(offsets)
            sums = np.zeros(len(sizes))
            if len(flat):
                cums = np.r_[0.0, np.cumsum(w[flat], dtype=np.float64)]
                sums = cums[offsets[1:]] - cums[offsets[:-1]]
            margin = bias + sums / np.sqrt(np.maximum(sizes, 1))
            score = 1.0 / (1.0 + np.exp(-np.clip(margin, -35, 35)))
            rest = batch.drop_columns(["_f"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32), pa.int32())],
                schema=pa.schema([*rest.schema, pa.field("score", pa.float64()), pa.field("predicted", pa.int32())]),
            )

    return rows.mapInArrow(lean(run), schema)
