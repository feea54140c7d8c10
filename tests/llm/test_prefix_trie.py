from __future__ import annotations

import random

import brute
import pytest

from glossa.llm.prefix_trie import graft_prefixes, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def trie(spark, rows, graft=False, batch=1000, schema=SCHEMA):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        convs = spark.createDataFrame(rows, schema).repartition(3)
        turns = graft_prefixes(convs) if graft else convs
        return {tuple(r) for r in prefix_trie(turns, members=convs.select("conv_id")).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def random_rows(seed, convs=60, words=("a b", "c", "", "a  b", "d e f")):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.randrange(0, 6)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice([*words, None])))
    return rows


@pytest.mark.parametrize("batch", [1, 3, 1000])
def test_equal_to_brute_force_across_batch_boundaries(spark, batch):
    rows = random_rows(7)
    assert trie(spark, rows, batch=batch) == brute.prefix_trie(rows, graft=False)


def test_grafted_first_turns(spark):
    rows = random_rows(11, convs=90)
    assert trie(spark, rows, graft=True, batch=4) == brute.prefix_trie(rows, graft=True)


def test_small_table_against_brute_force(spark, small):
    rows = [tuple(r) for r in small("conversations").select("conv_id", "turn", "role", "text").collect()]
    got = {tuple(r) for r in prefix_trie(graft_prefixes(small("conversations")), members=small("conversations").select("conv_id")).collect()}
    assert got == brute.prefix_trie(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (1, None, "user", "x"), (1, 0, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"),
        (2, None, "user", "x"), (2, 0, "", ""), (2, 0, "user", "x"), (2, 0, "user", "x"), (2, 1, "user", "long " * 5000),
        (None, 0, "user", "lost"), (3, None, None, None),
    ]
    got = trie(spark, rows)
    assert got == brute.prefix_trie(rows, graft=False)
    root = [r for r in got if r[1] == 0]
    assert root == [(1, 0, None, 3, 2, 2, 3, root[0][7])]


def test_turnless_conversations_end_at_the_root(spark):
    got = trie(spark, [(5, None, None, None), (4, 0, "user", "hi")])
    # A row with null turn, role and text is one turn of empty role and text.
    assert {r[1] for r in got} == {0, 1} and len(got) == 3
    assert got == brute.prefix_trie([(5, None, None, None), (4, 0, "user", "hi")], graft=False)


def test_members_without_turns(spark):
    convs = spark.createDataFrame([(4, 0, "user", "hi")], SCHEMA)
    members = spark.createDataFrame([(4,), (9,), (None,)], "conv_id long")
    got = {tuple(r) for r in prefix_trie(convs, members=members).collect()}
    import hashlib

    assert (4, 0, None, 2, 1, 1, 0, hashlib.sha256(b"9").hexdigest()) in got
    assert (4, 1, 4, 1, 0, 1, 0, hashlib.sha256(b"4").hexdigest()) in got


def test_empty_table_gives_no_rows(spark):
    assert trie(spark, []) == set()


def test_clashing_column_names_are_ignored(spark):
    rows = [(1, 0, "user", "a", 1, "x"), (2, 0, "user", "a", 2, "y")]
    convs = spark.createDataFrame(rows, SCHEMA + ", depth long, ends string")
    got = {tuple(r) for r in prefix_trie(convs).collect()}
    assert got == brute.prefix_trie([r[:4] for r in rows], graft=False)


def test_one_shared_conversation_copied_many_times(spark):
    rows = [(c, t, "user", f"w{t}") for c in range(300) for t in range(3)]
    got = trie(spark, rows, batch=7)
    assert got == brute.prefix_trie(rows, graft=False)
    assert max(r[3] for r in got) == 300 and len(got) == 4
