from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossa.llm.common import id_remainder
from glossa.llm.toxicity import ToxicitySettings, features, learn_toxicity, score_toxicity

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark, small):
    docs, labels = small("documents"), small("labels")
    held = id_remainder("doc_id", 4) == 2
    model = learn_toxicity(docs, labels.filter(~held))
    scored = score_toxicity(docs.select("doc_id", "text"), model).join(labels.filter(held), "doc_id").collect()
    right = sum(int(r.predicted == r.toxic) for r in scored)
    assert len(scored) > 20 and right >= 0.9 * len(scored)
    assert 0 < len(model.features) <= model.buckets and model.rows > 0


def test_features_are_distinct_hashes_of_the_whole_text(column):
    long_text = "ok " * 30000 + "idiot"
    got = column(["", None, "A b", "a b a b", "!!", long_text], lambda c: features(c, 1 << 20), "string")
    assert got[0] == [] and got[1] == [] and got[4] == []
    # "A b": a, b and the bigram (a b); no skip-gram with two words.
    assert len(got[2]) == 3 and set(got[2]) <= set(got[3])
    # "a b a b": a, b, (a b), (b a), and the skip-grams (a a), (b b).
    assert len(got[3]) == 6
    # The last word of a very long text counts: ok, idiot, (ok ok), (ok idiot), skips (ok ok), (ok idiot).
    assert len(got[5]) == 6


def test_every_text_scored_and_edge_cases(spark, documents):
    docs = documents([(1, "you idiot clown"), (2, "a calm day"), (3, None), (4, ""), (5, "calm " * 20000 + "idiot"), (None, "x"), (2, "a calm day")])
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (2, 1, 0), (3, 1, None), (None, 0, 1)], LABELS)
    model = learn_toxicity(docs, labels, ToxicitySettings(l1=0.1, epochs=20))
    out = score_toxicity(docs.withColumn("score", F.lit("clash")), model).collect()
    assert len(out) == 7 and all(0 <= r.score <= 1 for r in out)
    assert all(r.predicted == int(r.score >= 0.3) for r in out)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r.score)
    assert by[1][0] > by[2][0] and by[2][0] == by[2][1]
    assert by[3] == by[4]  # null and empty texts: the bias alone


def test_no_labels_scores_one_half(spark, documents):
    docs = documents([(1, "text")])
    model = learn_toxicity(docs, spark.createDataFrame([], LABELS))
    assert [r.score for r in score_toxicity(docs, model).collect()] == [0.5]
    assert [r.doc_id for r in score_toxicity(docs.limit(0), model).collect()] == []


def test_learners_average(spark, documents):
    rows = [(i, ("idiot " if i % 3 == 0 else "") + f"word{i % 7} calm") for i in range(90)]
    docs = documents(rows)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(90)], LABELS)
    one = learn_toxicity(docs, labels, ToxicitySettings(l1=0.5))
    many = learn_toxicity(docs, labels, ToxicitySettings(l1=0.5, rows_per_learner=20))
    for model in (one, many):
        got = score_toxicity(docs, model).collect()
        assert all(r.predicted == int(r.doc_id % 3 == 0) for r in got)
    assert many.rows == one.rows == 90 and np.all(np.isfinite(many.weights))
