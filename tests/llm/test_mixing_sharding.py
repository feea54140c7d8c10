from __future__ import annotations

from collections import defaultdict
from zlib import crc32

import brute
import pytest
from pyspark.sql import functions as F

from glossa.llm.mixing import MixSettings, apply_mix, mix_to_targets, token_count
from glossa.llm.sharding import assign_shards, jump_shards

TARGETS = {"en": 0.4, "de": 0.3, "fr": 0.2, "es": 0.1}


def totals(rows, value="rate"):
    sums = [0.0] * 4
    for r in rows:
        for i in range(4):
            sums[i] += r[value] * r.tokens * r.membership[i]
    return [s / sum(sums) for s in sums]


@pytest.mark.parametrize("floor", [0.0, 1.0])
def test_expected_tokens_meet_the_targets(small, floor):
    docs = small("documents")
    mixed = mix_to_targets(docs, docs.select("doc_id", "lang"), TARGETS, settings=MixSettings(min_rate=floor)).collect()
    assert totals(mixed) == pytest.approx(list(TARGETS.values()), abs=1e-3)
    assert len(mixed) == docs.count() and min(r.rate for r in mixed) >= floor
    names = list(TARGETS)
    right = sum(names[max(range(4), key=lambda i: r.membership[i])] == r.lang for r in mixed)
    assert right >= 0.98 * len(mixed)
    assert all(sum(r.membership) == pytest.approx(1) and min(r.membership) >= 0 for r in mixed)


def test_copies_follow_the_rates(small):
    docs = small("documents")
    mixed = mix_to_targets(docs, docs.select("doc_id", "lang"), TARGETS, settings=MixSettings(min_rate=1.0))
    rows = mixed.collect()
    assert all(int(r.rate) <= r.copies <= int(r.rate) + 1 for r in rows)
    out = apply_mix(mixed, docs.columns)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in rows)


def test_tokens(spark):
    texts = {"": 0, "  \n\t": 0, "a": 1, " a\n b\x0bc ": 3, "é ü": 2}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.n for r in df.select("t", token_count(F.col("t")).alias("n")).collect()} == texts


def test_mixing_odd_rows(documents):
    rows = [(1, "the house of the hill", "en"), (1, "the house of the hill", "en"), (2, None, "de"), (3, "", None), (None, "das haus", "de"), (4, "x " * 50_000, "en")]
    docs = documents(rows).withColumn("rate", F.lit("clash"))
    mixed = mix_to_targets(docs, docs.select("doc_id", "lang"), TARGETS).collect()
    assert len(mixed) == 6
    same = [tuple(r) for r in mixed if r.doc_id == 1]
    assert len(same) == 2 and same[0] == same[1]
    assert all(r.membership == [0.25] * 4 for r in mixed if not r.text)
    assert mix_to_targets(docs.limit(0), docs.select("doc_id", "lang").limit(0), TARGETS).collect() == []
    with pytest.raises(ValueError):
        mix_to_targets(docs, docs, {})


def test_jumps_equal_the_published_algorithm(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), 12345678901, *range(100, 400)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    counts = (1, 2, 7, 40, 41)
    for r in df.select("k", jump_shards(F.col("k"), *counts).alias("s")).collect():
        assert r.s == [brute.jump(r.k, n) for n in counts]


def test_shards(documents):
    rows = [(i, "ü" * (i % 5)) for i in range(300)] + [(7, "again"), (7, "again"), (None, None), (None, "x")]
    docs = documents(rows, 5).withColumn("shard", F.lit("clash"))
    got = assign_shards(docs, 4).collect()
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        key = -1 if r.doc_id is None else r.doc_id
        body = (r.text or "").encode()
        assert (r.shard, r.grown_shard) == (brute.jump(key, 4), brute.jump(key, 5))
        assert r.grown_shard in (r.shard, 4) and r.law == "key"
        assert (r.size, r.text_crc32) == (len(body) + 16, crc32(body))
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert assign_shards(docs.limit(0), 4).collect() == []


def test_no_python_in_native_plans(small):
    docs = small("documents")
    for df in (mix_to_targets(docs, docs.select("doc_id", "lang"), TARGETS), assign_shards(docs, 40)):
        text = df._jdf.queryExecution().toString()
        assert "Python" not in text and "Pandas" not in text and "InArrow" not in text
