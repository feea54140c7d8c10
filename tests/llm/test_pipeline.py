from __future__ import annotations

from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries
from glossa.llm.decontaminate import contaminated
from glossa.llm.queries import N_SHARDS, TARGETS
from glossa.session import write_scratch


def test_stages_in_order(spark, small, sf_dir):
    docs = small("documents")
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, write_scratch(stage(spark, docs, sf_dir), "stage")
        seen.append((name, before, docs))
    for _, _, out in seen[:-1]:
        assert out.columns == columns
    labels = {r.doc_id: r.quality for r in small("labels").collect()}
    ids = [[r.doc_id for r in out.select("doc_id").collect()] for _, _, out in seen]
    # quality: rejected documents go, good ones stay
    judged = [d for d in labels if labels[d] == 1]
    assert sum(d in set(ids[0]) for d in judged) >= 0.99 * len(judged)
    assert sum(d in set(ids[0]) for d in labels if labels[d] == 0) == 0
    # near-duplicates: the smallest doc_id of each component
    rows = [(r.doc_id, r.text) for r in seen[1][1].collect()]
    assert set(ids[1]) == {c for _, c in brute.near_dup(rows, 5, 80).values()}
    # benchmark: nothing left, nothing else gone
    hits = {r.doc_id for r in contaminated(seen[2][1], small("benchmark")).collect()}
    assert set(ids[2]) == set(ids[1]) - hits
    # mixing: every document stays, copies only
    assert set(ids[3]) == set(ids[2]) and max(Counter(ids[3]).values()) > 1
    tokens = Counter()
    for r in seen[3][2].collect():
        tokens[r.lang] += len((r.text or "").split())
    for name, share in TARGETS.items():
        assert tokens[name] / sum(tokens.values()) == pytest.approx(share, abs=0.06)
    # sharding: all rows
    last = seen[4][2].collect()
    assert Counter(r.doc_id for r in last) == Counter(ids[3])
    assert all(r.shard == brute.jump(r.doc_id, N_SHARDS) for r in last)


def test_odd_rows_pass_every_stage(spark, documents, sf_dir):
    rows = [(1, None), (2, ""), (3, "the house " * 20_000), (3, "the house " * 20_000), (3, "another text of that number"), (None, "no number"), (None, "no number"), (4, "a")]
    docs = documents(rows).withColumn("size", F.lit("clash"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.count() >= 0
    one = corpus_pipeline.keep_one_of_each_group(spark, docs, sf_dir).collect()
    assert Counter(r.doc_id for r in one)[3] == 1 and Counter(r.doc_id for r in one)[None] == 2
    assert corpus_pipeline.shard(spark, docs, sf_dir).count() == len(rows)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_registered(spark, sf_dir):
    names = set(queries())
    assert {"pipeline", *(f"op{n}_" for n in range(1, 11))} <= {n if n == "pipeline" else n.split("_")[0] + "_" for n in names}
    assert queries()["pipeline"](spark, sf_dir).count() > 0
