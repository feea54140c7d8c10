from __future__ import annotations

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import readwriter

from glossa.llm import bitmap, hashing, suffix_dedup
from glossa.llm.components import connected_components
from glossa.llm.near_dup import NearDupSettings, min_hashes, most_differing_bits, near_duplicates, odd_sketch, _constants
from glossa.llm.suffix_dedup import SuffixSettings, remove_repeats

THREE = NearDupSettings(shingle=3, percent=85)


def components(df, settings=THREE):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df, settings).collect()}


def variants(seed, groups, size, words=60, changes=3):
    rng = random.Random(seed)
    rows, i = [], 0
    for _ in range(groups):
        base = [f"w{rng.randrange(500)}" for _ in range(words)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(changes + 1)):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(500)}"
            rows.append((i, " ".join(copy)))
            i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_table_equals_brute_force(small, size, percent):
    rows = [(r.doc_id, r.text) for r in small("documents").collect()]
    got = components(small("documents"), NearDupSettings(shingle=size, percent=percent))
    assert got == brute.near_dup(rows, size, percent)


def test_large_groups_around_the_threshold(documents):
    """Groups whose members are linked only through others, cut into tiles."""
    rows = variants(3, groups=3, size=60, changes=4)
    settings = NearDupSettings(shingle=3, percent=85, block=16)
    assert components(documents(rows), settings) == brute.near_dup(rows, 3, 85)


def test_near_dup_odd_rows(documents):
    rows = [
        (5, None), (6, ""), (7, " \n\t "), (8, "one"), (9, "ONE"), (10, "one two"), (11, "one\x0btwo"), (12, "Ä b c"), (13, "ä b c"),
        (14, "a b c d"), (15, "a b c d"), (15, "a b c d"), (None, "a b c d"), (16, "x " * 30_000), (17, "x " * 30_000), (18, "y" * 100_000),
    ]
    got = near_duplicates(documents(rows).withColumn("n", F.lit("clash")), THREE).collect()
    want = brute.near_dup([r for r in rows if r[0] is not None], 3, 85)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert (r.component_id, r.kept) == (None, True)
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    assert near_duplicates(documents(rows).limit(0), THREE).collect() == []


def test_rows_that_share_an_id(documents):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "z y x w v u")]
    got = near_duplicates(documents(rows), THREE).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (2, 1), (2, 1)]


def test_sketches_let_similar_sets_through():
    flips, factors = _constants(THREE)
    rng = np.random.default_rng(0)
    most = most_differing_bits(THREE)
    near = far = 0
    for _ in range(300):
        shared, other = rng.integers(0, 2**63, 850).astype(np.uint64), rng.integers(0, 2**63, 1150).astype(np.uint64)
        a, b = np.concatenate([shared, other[:75]]), np.concatenate([shared, other[75:150]])
        c = np.concatenate([shared[:200], other[150:950]])
        sketch = [odd_sketch(min_hashes(x, flips, factors), 8) for x in (a, b, c)]
        near += np.bitwise_count(sketch[0] ^ sketch[1]).sum() <= most
        far += np.bitwise_count(sketch[0] ^ sketch[2]).sum() <= most
    assert near == 300 and far < 30


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(1000 + i, 1001 + i) for i in range(70)] + [(5000, 5001 + i) for i in range(50)] + [(7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {x: find(x) for x in {v for e in edges if e[0] != e[1] for v in e}}
    assert connected_components(df.limit(0)).collect() == []


def test_word_hashes_do_not_depend_on_place_or_blocks(monkeypatch):
    words = [f"word{i % 97}" * (1 + i % 5) for i in range(3000)]
    data = " ".join(words).encode()
    whole, starts = hashing.word_hashes(data)
    assert len(whole) == len(words) and len(set(whole.tolist())) == len(set(words))
    monkeypatch.setattr(hashing, "_BLOCK", 64)
    hashing._powers.clear()
    again, at = hashing.word_hashes(data)
    hashing._powers.clear()
    assert (again == whole).all() and (at == starts).all()


def removed(df, settings=SuffixSettings()):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(df, settings).collect()}


def test_suffix_table_equals_brute_force(small):
    rows = [(r.doc_id, r.text) for r in small("documents").collect()]
    assert removed(small("documents")) == brute.suffix_dedup(rows, 50)


@pytest.mark.parametrize("settings", [
    SuffixSettings(), SuffixSettings(batch=400, shard=150, piece=300, filter_words=64), SuffixSettings(hot=2, most_windows=8),
])
def test_suffix_overlaps(documents, settings):
    rng = random.Random(4)
    base = ["".join(rng.choice("ab \n") for _ in range(rng.randrange(40, 200))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [b[rng.randrange(20):] for b in rng.sample(base, 3)]
        rows.append((i * 3, rng.choice(["", "é", "\0"]).join(parts)))
    rows += [(1000, "a" * 500), (1001, "a" * 49), (1002, "a" * 50), (1003, "ab" * 200), (1004, "b" + "ab" * 100)]
    rng.shuffle(rows)
    assert removed(documents(rows), settings) == brute.suffix_dedup(rows, 50)


@pytest.mark.parametrize("settings", [SuffixSettings(), SuffixSettings(batch=400, shard=150, piece=300)])
def test_suffix_repeated_unit_before_a_shared_passage(documents, settings):
    """The shared window stands at the second or later of several smallest k-mers of one document."""
    rng = random.Random(6)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    rows = []
    for i in range(60):
        unit, shared = letters(rng.randrange(16, 36)), letters(60)
        rows += [(4 * i, f"{letters(60)}{unit}{unit}{shared}"), (4 * i + 1, f"{letters(60)}{unit}{shared}")]
        rows += [(4 * i + 2, f"{letters(30)}{unit * 3}{letters(20)}"), (4 * i + 3, f"{letters(30)}{unit * 2}{letters(40)}")]
    assert removed(documents(rows), settings) == brute.suffix_dedup(rows, 50)


def test_suffix_odd_rows(documents):
    long = "".join(chr(97 + (i * i) % 26) for i in range(200_000))
    rows = [(1, None), (2, ""), (3, "short"), (4, long), (5, long), (5, long), (None, long), (6, "x" + long[:70] + "y")]
    got = remove_repeats(documents(rows).withColumn("spans", F.lit("clash")), with_kept=True).collect()
    assert len(got) == len(rows)
    cut = {r.doc_id: (r.n_removed, bytes(r.kept)) for r in got}
    assert cut[5] == (len(long), b"") and cut[6] == (70, b"xy") and cut[4][0] == brute.suffix_dedup([(4, long)], 50)[4][1] == 0
    assert cut[None] == (0, long.encode()) and cut[1] == cut[2] == (0, b"")
    assert remove_repeats(documents(rows).limit(0)).collect() == []
    with pytest.raises(ValueError):
        remove_repeats(documents(rows), SuffixSettings(length=20))


@pytest.fixture
def rows_written(monkeypatch, spark):
    """Rows of the tables written so far."""
    written, write = [], readwriter.DataFrameWriter.parquet

    def counted(self, path, *args, **kwargs):
        write(self, path, *args, **kwargs)
        written.append(spark.read.parquet(path).count())

    monkeypatch.setattr(readwriter.DataFrameWriter, "parquet", counted)
    return written


def random_texts(seed, n, size):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(size)) for _ in range(n)]


def test_suffix_tables_hold_what_repeats_alone(documents, rows_written):
    """However small the bitmap is beside the hashes that repeat: segments of one document alone are not written."""
    texts = random_texts(10, 200, 600)
    rows = [*enumerate(texts), (500, "x" + texts[3][100:300] + "y"), (501, "z" + texts[9][:80])]
    assert removed(documents(rows), SuffixSettings(filter_words=1)) == brute.suffix_dedup(rows, 50)
    assert sum(rows_written) < 200


def test_suffix_short_common_strings_are_not_compared(documents, rows_written):
    """A phrase of 20 bytes in every document makes no segment of one a segment of another."""
    rows = [(i, x[:100] + "a phrase that all use"[:20] + x[100:]) for i, x in enumerate(random_texts(11, 200, 200))]
    assert removed(documents(rows)) == brute.suffix_dedup(rows, 50)
    assert sum(rows_written) == 0


def test_suffix_shuffles_end_with_their_tables(documents, spark, monkeypatch):
    """Also where the driver's garbage collection does not find them."""
    def shuffled():
        held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
        return {x for x in held.split() if x.startswith("shuffle_")}

    monkeypatch.setattr(suffix_dedup, "release", lambda spark: None)
    texts = random_texts(17, 30, 300)
    docs = documents([*enumerate(texts), (50, texts[3]), (51, texts[5][:90] + texts[6])]).withColumn("version", F.lit(0).cast("long"))
    cleanup, before = spark.conf.get(suffix_dedup._CLEANUP), shuffled()
    spans = suffix_dedup.repeated_spans(docs)
    assert shuffled() <= before and spark.conf.get(suffix_dedup._CLEANUP) == cleanup
    assert sorted(r.doc for r in spans.collect()) == [50, 51]


@pytest.mark.parametrize("packed", [1, 40, 1 << 20])
def test_suffix_common_hash_in_stretches(documents, packed):
    """A part's rows taken in one stretch and in several; rows of one id, and a document that holds a passage twice."""
    line, other = random_texts(12, 2, 60)
    rows = [(i, x + line + y) for i, (x, y) in enumerate(zip(random_texts(13, 40, 70), random_texts(14, 40, 70)))]
    rows += [(100, line), (101, line), (-5, other + line[:55]), (102, other + "-" + other + line), (2**62, other)]
    assert removed(documents(rows), SuffixSettings(packed=packed)) == brute.suffix_dedup(rows, 50)
    again = [(7, line + "a"), (7, line + "b" + line), (7, line + "a"), (3, line[5:])]
    got = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in remove_repeats(documents(again), SuffixSettings(packed=packed)).collect())
    assert got == [(3, 55, 0), (7, 61, 55), (7, 61, 55), (7, 121, 110)]


def test_suffix_shortest_length(documents):
    rng = random.Random(15)
    base = ["".join(rng.choice("abc ") for _ in range(150)) for _ in range(5)]
    rows = [(i, b[rng.randrange(60):] + rng.choice(base)[: rng.randrange(80)]) for i, b in enumerate(base * 8)]
    assert removed(documents(rows), SuffixSettings(length=32)) == brute.suffix_dedup(rows, 32)


def test_suffix_rows_packed_and_unpacked():
    rng = np.random.default_rng(16)
    n, low, high = 300, -(1 << 63), (1 << 63) - 1
    columns = {"h": rng.integers(0, 1 << 64, n, dtype=np.uint64), "s": rng.integers(0, 1 << 64, n, dtype=np.uint64)}
    columns |= {"doc": rng.integers(low, high, n), "version": rng.integers(low, high, n)}
    columns["doc"][:4] = [low, high, low, 0]
    columns |= {name: rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32) for name in ("start", "n", "segs")}
    part = rng.integers(0, 7, n)
    packed = suffix_dedup._pack(part, columns)
    assert packed.column("part").to_pylist() == sorted(set(part.tolist()))
    order = np.argsort(part, kind="stable")
    got = suffix_dedup._unpack(packed.column("data").to_pylist())
    assert list(got) == list(columns) and all((got[name] == columns[name][order]).all() for name in columns)


def shards_of(strings, shard):
    """Shards of strings over the symbols 1 and up, and the rotations of all strings by row."""
    shards, rotations = [], []
    for at in range(0, len(strings), shard):
        part = [s + b"\0" for s in strings[at : at + shard]]
        sizes = np.array([len(s) for s in part])
        starts = np.cumsum(sizes) - sizes
        shards.append(suffix_dedup.build_shard(np.frombuffer(b"".join(part), dtype=np.uint8), starts, sizes))
        turned = [(s[i:] + s[:i]) * 60 for s in part for i in range(len(s))]
        rotations += [turned[place] for place in shards[-1].order]
    return shards, rotations


@pytest.mark.parametrize("symbols, most", [(2, 10), (4, 8), (100, 4), (200, 3)])
@pytest.mark.parametrize("depth", [1, 7, 50])
def test_suffix_merge_takes_several_symbols_a_round(monkeypatch, symbols, most, depth):
    rng = random.Random(symbols)
    base = [bytes(rng.randrange(1, symbols + 1) for _ in range(90)) for _ in range(12)]
    strings = [b[rng.randrange(30) : rng.randrange(50, 90)] for b in base for _ in range(10)]
    shards, rotations = shards_of(strings, 25)
    assert all(r[:50] <= s[:50] for a, b in zip([0, *np.cumsum([len(x.order) for x in shards])], np.cumsum([len(x.order) for x in shards]))
               for r, s in zip(rotations[a : b - 1], rotations[a + 1 : b]))
    taken, steps = [], suffix_dedup._steps
    monkeypatch.setattr(suffix_dedup, "_steps", lambda *args: taken.append(steps(*args)) or taken[-1])
    row, block = suffix_dedup.merge_shards(shards, depth)
    assert sorted(row.tolist()) == list(range(len(rotations)))
    merged = [rotations[r][:depth] for r in row]
    assert merged == sorted(merged)
    assert (np.diff(block) == [a != b for a, b in zip(merged, merged[1:])]).all()
    assert len(taken[0]) >= min(most, depth)


def test_suffix_segments_hold_each_window_once(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_STRETCH", 64)
    rng = random.Random(8)
    texts = [bytes(rng.choice(b"abc \n") for _ in range(rng.choice([0, 1, 49, 50, 51, 64, 150, 700]))) for _ in range(60)]
    texts += [b"", b"z" * 300, texts[7], texts[7], b"", b""]
    for settings in (SuffixSettings(), SuffixSettings(length=32, most_windows=5)):
        text, h, s, start, n = suffix_dedup.segments(texts, settings)
        windows = [(t, i) for t, a, c in zip(text.tolist(), start.tolist(), n.tolist()) for i in range(a, a + c)]
        assert sorted(windows) == [(t, i) for t, x in enumerate(texts) for i in range(len(x) - settings.length + 1)]
        assert n.max() <= settings.most_windows
        least, content = {}, {}
        for t, x, y, a, c in zip(text.tolist(), h.tolist(), s.tolist(), start.tolist(), n.tolist()):
            for i in range(a, a + c):
                assert least.setdefault(texts[t][i : i + settings.length], x) == x
            assert content.setdefault(texts[t][a : a + c + settings.length - 1], (x, y)) == (x, y)
        assert len({y for _, y in content.values()}) == len(content)


def test_suffix_runs_of_several_rows_at_once():
    rng = random.Random(9)
    rows = [[(a, a + rng.randrange(1, 9)) for a in (rng.randrange(60) for _ in range(rng.randrange(9)))] for _ in range(200)]
    rows = [[], None, *rows, None, [(0, 5), (5, 9)], []]
    kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    spans = pa.array([r if r is None else [{"a": a, "b": b} for a, b in r] for r in rows], kind)
    wanted = []
    for r in rows:
        held = sorted({i for a, b in r or () for i in range(a, b)})
        first = [i for i in held if i - 1 not in held]
        wanted.append([(i, next(j for j in range(i, 99) if j not in held)) for i in first])
    assert list(suffix_dedup._merged(spans)) == wanted
    assert list(suffix_dedup._merged(spans.slice(50, 70))) == wanted[50:120]
    assert list(suffix_dedup._merged(spans.slice(0, 2))) == [[], []] and list(suffix_dedup._merged(spans.slice(0, 0))) == []
    assert suffix_dedup._cut(b"0123456789", [(0, 2), (5, 10)]) == b"234"


def test_bitmap_lets_pass_what_was_put_in(spark):
    rng = np.random.default_rng(5)
    values = rng.integers(-(1 << 63), 1 << 63, 600)
    for words in (64, 100, 1024):
        made = bitmap.bitmap_of(spark.createDataFrame([(int(v),) for v in values[:300]], "v long"), words)
        bits = [{(int(w), int(b)) for w, b in zip(*bitmap._bits(values.view(np.uint64)[i : i + 1], words, f))}
                for f in range(bitmap.FUNCTIONS) for i in range(len(values))]
        hit = [all(int(made[w]) & b for one in bits[i :: len(values)] for w, b in one) for i in range(len(values))]
        assert all(hit[:300]) and bitmap.passes(values.view(np.uint64), made).tolist() == hit
