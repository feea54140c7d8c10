from __future__ import annotations

import random

import brute
from pyspark.sql import functions as F

from glossa.llm.spelling import one_edit, spelling_variants


def plain_one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def test_sorted_scan_equals_plain_edit_distance():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randrange(1, 8))) for _ in range(400)})
    for query in words[::7] + ["", "zzzz"]:
        assert one_edit(query, words) == [w for w in words if plain_one_edit(query, w)]


def test_small_table_against_brute_force(small):
    docs = small("documents")
    got = {tuple(r) for r in spelling_variants(docs).collect()}
    assert got == brute.spelling([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_forms_roots_ties_nulls_and_clashes(spark, documents):
    rows = [(1, "Colour " * 5 + "colour " * 20), (2, "color " * 100 + "colours " * 5), (3, None), (None, "colour " * 5),
            (4, ""), (5, "x" * 100000 + " colouz " * 100), (5, "colour " * 5)]
    docs = documents(rows).withColumn("word", F.lit("clash")).withColumn("n", F.lit(1))
    got = {tuple(r) for r in spelling_variants(docs).collect()}
    assert got == brute.spelling([(r[0], r[1]) for r in rows])
    by = {r[0]: r for r in got}
    # colours (5) is near colour (35) only; colour (35) is near colours and colouz (100), below five times.
    assert by["colours"][1:] == ("colour", "colour", 5, 1, 35)
    assert by["colour"][1:] == (None, "colour", 35, 2, None) and by["colouz"][4] == 1


def test_empty_table(spark, documents):
    assert spelling_variants(documents([]).limit(0)).collect() == []


def test_words_that_share_only_three_code_points_are_not_scanned(monkeypatch):
    import pandas as pd

    from glossa.llm import spelling

    seen, scan = [0], spelling.one_edit

    def counted(query, words, start=0, skip=None):
        seen[0] += max(0, len(words) - start)
        return scan(query, words, start, skip)

    monkeypatch.setattr(spelling, "one_edit", counted)
    letters = "abcdefghijklmnopqrst"
    words = [f"abc{x}{y}klmno" for x in letters for y in letters] + ["abcaaklmnoo", "abcaaklmn", "abcaaklmnx"]
    pairs = spelling._block_pairs(pd.DataFrame({"word": words, "_side": 0}))
    assert {("abcaaklmn", "abcaaklmno"), ("abcaaklmno", "abcaaklmnoo"), ("abcaaklmno", "abcaaklmnx")} <= set(zip(pairs["a"], pairs["b"]))
    # All against all would be 81,003.
    assert seen[0] < 500
