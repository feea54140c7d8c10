"""Language identification as inference of a mixture of languages.

Each language has a distribution over hashed byte n-grams. Expectation-maximisation estimates in what
proportions languages make up a document; languages are added to its set while the likelihood, less
a penalty per language, rises. The language of the largest proportion is the prediction.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import blocks, lean, utf8, with_text_columns

UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageSettings:
    """``width``-byte n-grams in ``buckets`` (a power of two). ``most_languages`` bounds the model
    (``buckets`` numbers per language): with more languages in the labelled rows learning stops with an error.

    ``independent``: an n-gram counts as this share of an independent observation, since neighbours overlap.
    ``penalty``: in units of half the logarithm of the observations, as in the Bayes criterion.
    """

    width: int = 3
    buckets: int = 1 << 16
    most_languages: int = 256
    smoothing: float = 0.5
    rounds: int = 25
    independent: float = 0.25
    penalty: float = 2.0


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    likelihood: np.ndarray  # buckets x languages


# Bytes that are no letters become spaces and A-Z lower case; bytes beyond ASCII stay.
_FOLD = bytes(c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_LETTER = re.compile(r"[^\W\d_]")


def gram_ids(data: bytes, settings: LanguageSettings) -> np.ndarray:
    """Bucket of every n-gram of a text in UTF-8 that is not mostly blank, words bounded by spaces."""
    buf = np.frombuffer(b" " + data.translate(_FOLD) + b" ", dtype=np.uint8)
    n = len(buf) - settings.width + 1
    if n < 1:
        return np.empty(0, np.uint32)
    code = np.zeros(n, dtype=np.uint32)
    for i in range(settings.width):
        code = code * np.uint32(257) + buf[i : i + n]
    blank = buf == 32
    keep = ~(blank[:n] & blank[1 : n + 1]) & ~(blank[settings.width - 2 : settings.width - 2 + n] & blank[settings.width - 1 :])
    code = code[keep]
    code = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (code ^ (code >> np.uint32(12))) & np.uint32(settings.buckets - 1)


def learn_languages(labelled: DataFrame, settings: LanguageSettings = LanguageSettings()) -> LanguageModel:
    """N-gram distributions from all rows of ``labelled`` (text, lang) with a language.

    Tasks add their rows up, so each sends one row per language and bucket at most.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, rows in batch.groupby("lang", sort=False):
                total = seen.setdefault(lang, np.zeros(settings.buckets, dtype=np.int64))
                texts = [utf8(t) for t in rows["text"]]
                for a, b in blocks([len(t) for t in texts], 1 << 20):
                    total += np.bincount(gram_ids(b"  ".join(texts[a:b]), settings), minlength=settings.buckets)
        for lang, total in seen.items():
            used = np.flatnonzero(total)
            yield pd.DataFrame({"lang": lang, "bucket": used.astype(np.int32), "n": total[used]})

    rows = labelled.filter(F.col("lang").isNotNull()).select("text", "lang")
    sums = rows.mapInPandas(lean(run), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    languages = [r["lang"] for r in rows.select("lang").distinct().orderBy("lang").limit(settings.most_languages + 1).collect()]
    if len(languages) > settings.most_languages:
        raise ValueError(f"more than {settings.most_languages} languages in the labelled rows; raise most_languages")
    place = {lang: i for i, lang in enumerate(languages)}
    counts = np.full((settings.buckets, len(languages)), settings.smoothing)
    found = sums.toPandas()  # buckets * most_languages rows at most
    counts[found["bucket"].to_numpy(dtype=np.int64), found["lang"].map(place).to_numpy(dtype=np.int64)] += found["n"].to_numpy()
    return LanguageModel(languages, (counts / counts.sum(axis=0, keepdims=True)).astype(np.float32))


def _proportions(p: np.ndarray, weight: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Mixture proportions of the columns of ``p`` by expectation-maximisation; log-likelihood."""
    share = np.full(p.shape[1], 1 / p.shape[1])
    total = weight.sum()
    for _ in range(rounds if p.shape[1] > 1 else 0):
        mass = p @ share
        new = share * (p.T @ (weight / mass)) / total
        done = np.abs(new - share).max() < 1e-4
        share = new
        if done:
            break
    return share, float(weight @ np.log(p @ share))


def language_mixture(data: bytes, model: LanguageModel, settings: LanguageSettings) -> list[tuple[str, float]]:
    """The document's languages and proportions, largest first; empty without n-grams or languages."""
    ids = gram_ids(data, settings)
    if not len(ids) or not model.languages:
        return []
    if len(ids) * 4 > settings.buckets:
        counts = np.bincount(ids, minlength=settings.buckets)
        used = np.flatnonzero(counts)
        weight = counts[used] * settings.independent
    else:
        used, weight = np.unique(ids, return_counts=True)
        weight = weight * settings.independent
    p = model.likelihood[used].astype(np.float64)
    # All languages together first; then sets of the largest of them, while one more language pays.
    share, _ = _proportions(p, weight, settings.rounds)
    order = np.lexsort((np.arange(len(share)), -share))
    single = weight @ np.log(p[:, order])
    first = int(np.argmax(single))
    order = np.concatenate([order[first : first + 1], np.delete(order, first)])
    cost = settings.penalty * 0.5 * np.log(max(2.0, weight.sum()))
    best, (part, value) = order[:1], (np.ones(1), float(single[first]))
    for size in range(2, len(order) + 1):
        tried, reached = _proportions(p[:, order[:size]], weight, settings.rounds)
        if reached - cost <= value:
            break
        best, part, value = order[:size], tried, reached
    by_share = np.lexsort((best, -part))
    return [(model.languages[best[i]], float(part[i])) for i in by_share]


def predict_language(docs: DataFrame, model: LanguageModel, settings: LanguageSettings = LanguageSettings()) -> DataFrame:
    """All rows and columns of ``docs`` with lang_pred, score (its proportion) and lang_set.

    Input columns of these names are replaced. Text that is null or has no letter: ``und``, score 0. Without a
    learned language every row is ``und``. Repeated rows get equal results; an empty table no rows.
    """
    # Plain arrays: what is broadcast is not pickled with the code.
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))

    def predict(texts: list) -> list:
        model = LanguageModel(**sent.value)
        found = [language_mixture(utf8(t), model, settings) if t and _LETTER.search(t) else [] for t in texts]
        return [
            [f[0][0] if f else UNKNOWN for f in found],
            [min(1.0, f[0][1]) if f else 0.0 for f in found],
            [[name for name, _ in f] for f in found],
        ]

    fields = {
        "lang_pred": ("string", pa.string()), "score": ("double", pa.float64()), "lang_set": ("array<string>", pa.list_(pa.string())),
    }
    return with_text_columns(docs, "text", fields, predict)
