"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors.

A text becomes a vector of hashed terms (words, shapes of words, line and repetition features) weighed by
their rarity in the whole corpus, then a latent vector through the leading singular directions of
the labelled ones. Every document's cosine to every labelled vector is computed exactly, in blocks; the most
similar ones vote with a weight that rises with similarity.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import keep_texts, lean, sample_per_group, with_text_columns


@dataclass(frozen=True)
class QualitySettings:
    """``rows_per_label``: bound of labelled rows learned from for each label, lowest hash first;
    with ``dims`` it bounds what is broadcast (2 * rows_per_label * dims numbers)."""

    rows_per_label: int = 1000
    terms: int = 8192
    dims: int = 48
    neighbours: int = 31
    sharpness: float = 16.0
    seed: int = 5


_LETTERS = re.compile(r"[^\W\d_]+")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
_LOWER = re.compile(r"[a-zß-öø-ÿ]+")
_DIGIT = re.compile(r"\d+")

_shapes: dict[str, tuple[int, ...]] = {}


def _term_ids(word: str, terms: int) -> tuple[int, ...]:
    """Ids of a word's runs of lower-case letters and of its shape; the first quarter of the ids is for shapes."""
    known = _shapes.get(word)
    if known is None:
        if len(_shapes) > 400_000:
            _shapes.clear()
        shape = _DIGIT.sub("0", _LOWER.sub("a", _UPPER.sub("A", word)))
        quarter = terms // 4
        ids = [crc32(shape.encode("utf-8", "replace")) % (quarter - 8)]
        for run in _LETTERS.findall(word.lower()):
            ids.append(quarter + crc32(run.encode("utf-8", "replace")) % (terms - quarter))
        known = _shapes[word] = tuple(ids)
    return known


# Characters of a word; a longer one (text without blanks) is several, one behind the other.
_PIECE = 64


def term_counts(text: str | None, terms: int) -> dict[int, int]:
    """Counts of a whole text's terms. Eight ids tell of repetition and of line and word lengths."""
    words = (text or "").split()
    counts: dict[int, int] = {}
    distinct = Counter(words)
    if max(map(len, distinct), default=0) > _PIECE:
        words = [w[i : i + _PIECE] for w in words for i in range(0, len(w), _PIECE)]
        distinct = Counter(words)
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    for word, n in distinct.items():
        for i in _term_ids(word, terms):
            counts[i] = counts.get(i, 0) + n
    total = len(words)
    lines = (text or "").count("\n") + 1
    base = terms // 4 - 8
    counts[base] = repeats
    counts[base + 1] = total - len(distinct)
    if not words:
        counts[base + 2] = 1
    counts[base + 3 + min(3, total // (lines * 10))] = max(1, total // 20)
    return {i: n for i, n in counts.items() if n}


def _sparse(texts: list, terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row offsets, ids, weights) of the texts; a weight is 1 + log(count) over the row's norm."""
    sizes, ids, weights = [0], [], []
    for text in texts:
        counts = term_counts(text, terms)
        ids.append(np.fromiter(counts.keys(), np.int32, len(counts)))
        weights.append(1 + np.log(np.fromiter(counts.values(), np.float64, len(counts))))
        sizes.append(sizes[-1] + len(counts))
    return np.array(sizes), np.concatenate(ids), np.concatenate(weights)


@dataclass(frozen=True)
class QualityModel:
    rarity: np.ndarray  # per term
    directions: np.ndarray  # terms x dims
    vectors: np.ndarray  # labelled rows x dims, of length 1
    labels: np.ndarray
    prior: float


def document_frequency(docs: DataFrame, terms: int) -> tuple[np.ndarray, int]:
    """In how many documents of the whole table each term occurs, and their number.

    A task adds its rows up, so it sends one row per term at most.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, rows = np.zeros(terms + 1, dtype=np.int64), 0
        for batch in batches:
            rows += len(batch)
            for text in batch["text"]:
                counts = term_counts(text, terms)
                seen[np.fromiter(counts.keys(), np.int64, len(counts))] += 1
        seen[terms] = rows
        yield pd.DataFrame({"term": np.flatnonzero(seen), "n": seen[seen > 0]})

    totals = docs.select("text").mapInPandas(lean(run), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    seen = np.zeros(terms + 1, dtype=np.int64)
    for row in totals.collect():  # terms + 1 rows at most
        seen[row["term"]] = row["n"]
    return seen[:terms], int(seen[terms])


def _latent(texts: list, rarity: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Weighed terms of the texts along ``directions``."""
    offsets, ids, weights = _sparse(texts, len(rarity))
    weights = weights * rarity[ids]
    out = np.empty((len(texts), directions.shape[1]))
    for i in range(len(texts)):
        part = slice(offsets[i], offsets[i + 1])
        out[i] = weights[part] @ directions[ids[part]]
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


def learn_quality(docs: DataFrame, labels: DataFrame, settings: QualitySettings = QualitySettings()) -> QualityModel:
    """``docs`` (doc_id, text) gives the rarities, all of it; ``labels`` (doc_id, quality) which vectors.

    At most ``rows_per_label`` documents of each label are learned from. Labels other than 0 and 1 and
    those of unknown documents teach nothing. With no labelled rows every score is 0.5.
    """
    terms = settings.terms
    seen, rows = document_frequency(docs, terms)
    rarity = np.log((rows + 1) / (seen + 1)) + 0.05
    sample = sample_per_group(labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter("quality in (0, 1)"), "quality", settings.rows_per_label, settings.seed)
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    chosen = chosen.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = [term_counts(t, terms) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "quality": batch["quality"],
                "ids": [list(c) for c in counts], "counts": [list(c.values()) for c in counts],
            })

    # 2 * rows_per_label rows at most; their terms, not their texts, come to the driver.
    found = chosen.mapInPandas(lean(run), "doc_id long, quality int, ids array<int>, counts array<int>").toPandas()
    found = found.sort_values(["quality", "doc_id"])
    dense = np.zeros((len(found), terms), dtype=np.float32)
    for i, (ids, counts) in enumerate(zip(found["ids"], found["counts"])):
        dense[i, ids] = (1 + np.log(np.asarray(counts))) * rarity[ids]
    return _fit(_unit(dense).astype(np.float32), found["quality"].to_numpy(dtype=float), rarity, settings)


def _fit(dense: np.ndarray, labels: np.ndarray, rarity: np.ndarray, settings: QualitySettings) -> QualityModel:
    """Leading right singular directions by subspace iteration, from a fixed start."""
    dims = min(settings.dims, len(dense)) or 1
    basis = np.random.default_rng(settings.seed).standard_normal((dense.shape[1], dims)).astype(np.float32)
    # Labels are balanced for the directions, so that the rarer kind shapes them too.
    weight = np.ones(len(labels), dtype=np.float32)
    for value in (0, 1):
        if (labels == value).any():
            weight[labels == value] = 1 / np.sqrt((labels == value).mean())
    weighed = dense * weight[:, None]
    for _ in range(6 if len(dense) else 0):
        basis, _r = np.linalg.qr(weighed.T @ (weighed @ basis))
    vectors = _unit(dense @ basis) if len(dense) else np.zeros((0, dims))
    prior = float(labels.mean()) if len(labels) else 0.5
    return QualityModel(rarity, basis, vectors.astype(np.float32), labels, prior)


def vote(latent: np.ndarray, model: QualityModel, settings: QualitySettings) -> np.ndarray:
    """Share of label 1 among the nearest labelled vectors, weighed by exp(sharpness * cosine).

    Votes of a label are divided by its number of vectors over the balanced number, so a bounded
    sample of unequal labels does not tilt the vote.
    """
    if not len(model.vectors):
        return np.full(len(latent), 0.5)
    k = min(settings.neighbours, len(model.vectors))
    share = {v: max((model.labels == v).mean(), 1e-9) for v in (0, 1)}
    balance = np.where(model.labels == 1, 0.5 / share[1], 0.5 / share[0])
    out = np.empty(len(latent))
    for at in range(0, len(latent), 512):
        cosine = _unit(latent[at : at + 512]).astype(np.float32) @ model.vectors.T
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        close = np.take_along_axis(cosine, near, axis=1).astype(np.float64)
        weight = np.exp(settings.sharpness * (close - close.max(axis=1, keepdims=True))) * balance[near]
        out[at : at + 512] = (weight * model.labels[near]).sum(axis=1) / weight.sum(axis=1)
    return out


def score_quality(docs: DataFrame, model: QualityModel, settings: QualitySettings = QualitySettings()) -> DataFrame:
    """All rows and columns of ``docs`` with score (0 to 1) and predicted (1 if score >= 0.5).

    Input columns of these names are replaced. Null text scores as the empty text; repeated rows score alike;
    an empty table gives no rows. Scores depend on the text alone.
    """
    # Plain arrays: what is broadcast is not pickled with the code.
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))

    def score(texts: list) -> list:
        model = QualityModel(**sent.value)
        return [vote(_latent(texts, model.rarity, model.directions), model, settings)]

    scored = with_text_columns(docs.drop("predicted"), "text", {"score": ("double", pa.float64())}, score)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_predicted(docs: DataFrame, model: QualityModel, settings: QualitySettings = QualitySettings()) -> DataFrame:
    """The rows of ``docs`` that ``score_quality`` predicts as 1, with all their columns and no others."""
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))

    def good(texts: list) -> list[bool]:
        model = QualityModel(**sent.value)
        return (vote(_latent(texts, model.rarity, model.directions), model, settings) >= 0.5).tolist()

    return keep_texts(docs, "text", good)
