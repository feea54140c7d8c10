from __future__ import annotations

import re

import numpy as np
from pyspark.sql import functions as F

from glossa.llm.decontaminate import DecontaminationSettings, contaminated, drop_contaminated

ITEMS = [
    (1, "A farmer named Alice has 12 apples and gives 5 apples to Bob, then Alice walks 3 km home to count what is left."),
    (2, "What is the capital of the country that lies north of the river and south of the long wall?"),
    (3, "Two words"),
    (4, None),
    (None, "no id here but words enough to make up a window of text"),
]
CLEAN = "The farmer went home with all the apples that were left and it was late when she came to the house by the river."


def found(spark, documents, rows, settings=DecontaminationSettings()):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("kind", F.lit("clash"))
    docs = documents(rows).withColumn("coverage", F.lit("clash"))
    got = {(r.doc_id, r.item_id): r.kind for r in contaminated(docs, items, settings).collect()}
    left = {r.doc_id for r in drop_contaminated(docs, items, settings).collect()}
    assert left == {r[0] for r in rows} - {d for d, _ in got}
    return got


def test_passages(spark, documents):
    rows = [
        (1, f"{CLEAN} {ITEMS[0][1]} {CLEAN}"),
        (2, f"{CLEAN} {ITEMS[1][1].upper()}\n{CLEAN}"),
        (3, "A farmer named Carol has 30 apples and gives 11 apples to Dave, then Carol walks 8 miles home to count what is left."),
        # another name in each place: the slots contradict one another
        (4, "A farmer named Carol has 30 apples and gives 11 apples to Erin, then Frank walks 8 miles home to count what is left."),
        (5, CLEAN), (6, None), (7, ""), (8, "Two words"), (9, (CLEAN + " ") * 800 + ITEMS[1][1]), (None, ITEMS[1][1]),
        (10, "what is the capital of the country that lies, north of the river and nothing more than that"),
    ]
    assert found(spark, documents, rows) == {
        (1, 1): "literal", (2, 2): "literal", (3, 1): "template", (8, 3): "literal", (9, 2): "literal", (None, 2): "literal", (10, 2): "literal",
    }


def test_repeated_rows_and_empty_tables(spark, documents):
    rows = [(1, ITEMS[0][1]), (1, ITEMS[0][1])]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert contaminated(documents(rows), items).count() == 2
    assert contaminated(documents(rows).limit(0), items).count() == 0
    assert contaminated(documents(rows), items.limit(0)).count() == 0
    assert drop_contaminated(documents(rows), items.limit(0)).count() == 2


def test_slices_equal_one_table(spark, documents, small):
    one = {tuple(r) for r in contaminated(small("documents"), small("benchmark")).collect()}
    many = {tuple(r) for r in contaminated(small("documents"), small("benchmark"), DecontaminationSettings(slice_windows=500)).collect()}
    assert one == many


def test_every_whole_item_is_found_and_nothing_else(small):
    plain = lambda t: " ".join(re.findall(r"\S+", t.lower()))
    items = {r.item_id: plain(r.text) for r in small("benchmark").collect()}
    exact = {(r.doc_id, i) for r in small("documents").collect() for i, t in items.items() if t in plain(r.text)}
    assert {(r.doc_id, r.item_id) for r in contaminated(small("documents"), small("benchmark")).collect()} == exact != set()


def kinds(spark, documents, items, texts):
    table = spark.createDataFrame(items, "item_id long, text string")
    got = contaminated(documents(list(enumerate(texts))), table).collect()
    return {(r.doc_id, r.item_id): r.kind for r in got}


def words(seed, n):
    return [f"w{(seed * 1000 + i) * 7919 % 100003}x" for i in range(n)]


def test_parts_and_single_edits(spark, documents):
    items = [(n, " ".join(words(n, n))) for n in (8, 9, 12, 15, 16, 20, 38, 600)]
    texts, want = [], set()

    def add(item, part, there=True):
        texts.append(f"{CLEAN} {' '.join(part)} {CLEAN}")
        if there:
            want.add((len(texts) - 1, item))

    add(38, words(38, 38)[10:29])
    add(600, words(600, 600)[150:350])
    add(600, words(600, 600)[150:160], there=False)
    for n in (8, 9, 12, 15, 16, 20):
        w = words(n, n)
        for at in range(n):
            add(n, [*w[:at], "other", *w[at + 1 :]])
        add(n, [*w[: n // 2], "other", *w[n // 2 :]])
        add(n, [*w[: n // 2], *w[n // 2 + 1 :]])
    add(15, words(15, 15)[:7], there=False)
    assert set(kinds(spark, documents, items, texts)) == want


def test_equal_numbers_may_become_different(spark, documents):
    items = [(1, "If 2 trains leave the station at noon and meet each other again after 2 hours how far did the trains go in that time")]
    texts = [items[0][1].replace("2 trains", "3 trains").replace("2 hours", "5 hours"), items[0][1].replace("2 ", "4 ")]
    assert kinds(spark, documents, items, texts) == {(0, 1): "template", (1, 1): "template"}


def test_items_that_share_an_id_or_have_none(spark, documents):
    short, long = " ".join(words(1, 15)), " ".join(words(2, 100))
    numbers = "A farmer named Alice has 12 apples and gives 5 apples to Bob"
    items = spark.createDataFrame(
        [(7, short), (7, long), (7, long), (8, numbers), (8, "Zero apples"), (None, " ".join(words(3, 20))), (None, " ".join(words(4, 20)))],
        "item_id long, text string",
    )
    docs = documents([
        (1, f"{CLEAN} {short} {CLEAN}"), (2, f"{CLEAN} {long}"), (3, numbers.replace("12", "30").replace("Alice", "Carol")), (4, " ".join(words(3, 20))),
        (5, " ".join(words(4, 20))), (6, CLEAN), (9, f"{short} {long}"),
    ])
    for settings in (DecontaminationSettings(), DecontaminationSettings(slice_windows=60)):
        got = sorted((r.doc_id, r.item_id or 0, r.kind, r.coverage) for r in contaminated(docs, items, settings).collect())
        assert got == [
            (1, 7, "literal", 1.0), (2, 7, "literal", 1.0), (3, 8, "template", 1.0), (4, 0, "literal", 1.0), (5, 0, "literal", 1.0),
            (9, 7, "literal", 1.0), (9, 7, "literal", 1.0),
        ]
        assert {r.doc_id for r in drop_contaminated(docs, items, settings).collect()} == {6}


def test_places_of_a_text_are_looked_up_together(monkeypatch):
    from glossa.llm import decontaminate as d

    settings = DecontaminationSettings()
    table = d.window_table([(1, ITEMS[0][1]), (2, ITEMS[1][1])], settings)
    table.maybe[:] = True
    calls, search = [0], np.searchsorted

    def counted(*args, **kwargs):
        calls[0] += 1
        return search(*args, **kwargs)

    monkeypatch.setattr(np, "searchsorted", counted)
    got = d.passages(f"{CLEAN} {ITEMS[0][1]} {CLEAN}", table, d.Vocabulary(), settings)
    assert [hit[0] for hit in got] == [0]
    assert calls[0] <= 2 * len(table.widths)
