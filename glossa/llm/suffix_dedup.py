"""Removal of byte strings that an earlier document holds, by merged Burrows-Wheeler transforms.

1. Every window of ``length`` bytes has a smallest k-mer hash. Neighbouring windows of one smallest hash form
   a segment. Equal windows have equal hashes, so only segments of one hash need be compared.
2. Where each segment stands goes to tasks by hash. Hashes that occur in one document alone are set aside.
3. The distinct segments of the other hashes are cut from their documents' texts, where a hash has several, and go to
   tasks by hash. A task cuts them into shards, builds each
   shard's transform, and merges the transforms by refining their interleave (Holt and
   McMillan, 2014), here several symbols at a time. Suffixes are not sorted again. After ``length`` symbols the blocks of the interleave are the
   intervals of suffixes with a common prefix of that length: the repeated windows, and the first document of each.
4. Each document's windows are looked up, and what they cover is taken out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.llm.bitmap import bitmap_of, passes
from glossa.llm.common import blocks, lean, release, repeats_an_id, utf8
from glossa.llm.hashing import mix, range_hashes
from glossa.session import scratch_path, scratch_scope


@dataclass(frozen=True)
class SuffixSettings:
    """``length``: bytes of a repeated string (even, 32 to 56). ``most_windows``: windows of a segment.

    ``filter_words``: 64-bit words of the bitmap that tells tasks which documents are cut (bounded; when it
    fills up more texts are shuffled and the result is the same). ``batch`` and ``shard``: bytes of
    segments merged at once, and of one transform. ``packed``: places of segments that a task packs, or
    takes from a part, at once. ``hot``: distinct segments of one hash beyond which its windows
    are grouped by their bytes over all tasks instead.
    """

    length: int = 50
    most_windows: int = 64
    filter_words: int = 1 << 20
    batch: int = 1 << 20
    shard: int = 1 << 17
    hot: int = 5000
    piece: int = 1 << 20
    packed: int = 1 << 19


_SHORTEST, _KMER = 32, 24
# Steps a round of the merge takes at most, and the pairs of a symbol and a rank that are numbered by a table.
_MOST_STEPS = 10
_RANKED = 1 << 23
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_STRETCH = 1 << 15  # places hashed at once: their numbers stay in a core's cache


def _kmer_hashes(buf: np.ndarray) -> np.ndarray:
    """Hash of the ``_KMER`` bytes at each place. Each third is folded first, so no two bytes reach the top bits only."""
    out = np.empty(max(0, len(buf) - _KMER + 1), dtype=np.uint64)
    for at in range(0, len(out), _STRETCH):
        part = np.ascontiguousarray(buf[at : at + _STRETCH + _KMER - 1])
        eight = np.ndarray(len(part) - 7, dtype="<u8", buffer=part, strides=(1,)).astype(np.uint64)
        eight ^= eight >> np.uint64(32)
        x = eight[: len(part) - _KMER + 1] * np.uint64(0x9E3779B97F4A7C15)
        x += eight[8 : 8 + len(x)] * np.uint64(0x94D049BB133111EB)
        eight *= np.uint64(0xD6E8FEB86659FD93)
        x += eight[_KMER - 8 :]
        x ^= x >> np.uint64(32)
        np.multiply(x, np.uint64(0xBF58476D1CE4E5B9), out=out[at : at + len(x)])
    return out


def _window_minima(buf: np.ndarray, length: int) -> np.ndarray:
    """Smallest hash of the ``_KMER``-byte strings in each window of ``length`` bytes."""
    out = np.empty(max(0, len(buf) - length + 1), dtype=np.uint64)
    wanted = length - _KMER + 1
    for at in range(0, len(out), _STRETCH):
        least, width = _kmer_hashes(buf[at : at + _STRETCH + length - 1]), 1
        while width * 2 <= wanted:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = wanted - width
        out[at : at + _STRETCH] = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    return out


def segments(texts: list[bytes], settings: SuffixSettings) -> tuple[np.ndarray, ...]:
    """(text, smallest hash, content hash, start, windows) of the segments of some texts."""
    length = settings.length
    buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    n = len(buf) - length + 1
    if n < 1:
        none = np.empty(0, np.int64)
        return none, none.view(np.uint64), none.view(np.uint64), none, none
    least = _window_minima(buf, length)
    # A segment also ends where the windows of its text begin or stop.
    cut = np.empty(n, dtype=bool)
    cut[0] = True
    np.not_equal(least[1:], least[:-1], out=cut[1:])
    edges = np.concatenate([ends - sizes, ends - np.minimum(sizes, length - 1)])
    cut[edges[edges < n]] = True
    start = np.flatnonzero(cut)
    count = np.diff(start, append=n)
    inside = start + length <= ends[np.searchsorted(ends, start, side="right")]
    start, count = start[inside], count[inside]
    if len(count) and count.max() > settings.most_windows:
        parts = -(-count // settings.most_windows)
        place = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start, whole = np.repeat(start, parts) + place * settings.most_windows, np.repeat(count, parts)
        count = np.minimum(whole - place * settings.most_windows, settings.most_windows)
    content = range_hashes(buf, start, start + count + length - 1)
    text = np.searchsorted(ends, start, side="right")
    return text, least[start], content, start - (ends - sizes)[text], count


def _pieces(texts: list[bytes], settings: SuffixSettings) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in blocks of bounded size; a longer text in overlapping pieces, which share no window."""
    overlap = settings.length - 1
    for a, b in blocks([len(t) for t in texts], settings.piece):
        if b == a + 1 and len(texts[a]) > settings.piece:
            for at in range(0, len(texts[a]) - overlap, settings.piece):
                yield [a], [at], [texts[a][at : at + settings.piece + overlap]]
        else:
            yield list(range(a, b)), [0] * (b - a), texts[a:b]


def _groups(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts): an order that brings equal values together, and where in it each value begins."""
    order = np.argsort(values)
    ordered = values[order]
    return order, np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))


# Columns of packed rows. The first two are hashes, which do not compress; of the others the same byte of all rows stands
# together, and ``doc`` holds differences, so that most of their bytes are zeros.
_PACKED = {"h": "<u8", "s": "<u8", "doc": "<i8", "version": "<i8", "start": "<u4", "n": "<u4", "segs": "<u4"}
_HASHES = 16
_WIDTH = sum(np.dtype(kind).itemsize for kind in _PACKED.values())
_PARTS = 8  # parts for each partition of a shuffle; a task holds the packed rows of one part at a time


def _pack(part: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """(part, data): one row per part with the packed rows of that part."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    columns = {name: columns[name][order].astype(kind) for name, kind in _PACKED.items()}
    doc = columns["doc"].copy()
    doc[1:] -= columns["doc"][:-1]
    doc[at] = columns["doc"][at]
    rest = [x.view(np.uint8).reshape(len(part), -1) for x in ({**columns, "doc": doc}[name] for name in list(_PACKED)[2:])]
    planes = np.concatenate(rest, axis=1)
    data = [
        columns["h"][a:b].tobytes() + columns["s"][a:b].tobytes() + planes[a:b].T.tobytes()
        for a, b in zip(at.tolist(), [*at[1:].tolist(), len(part)])
    ]
    return pa.RecordBatch.from_arrays([pa.array(part[at].astype(np.int32)), pa.array(data, pa.binary())], names=["part", "data"])


def _unpack(packed: list[bytes]) -> dict[str, np.ndarray]:
    found: dict[str, list[np.ndarray]] = {name: [np.empty(0, kind)] for name, kind in _PACKED.items()}
    for data in packed:
        n = len(data) // _WIDTH
        found["h"].append(np.frombuffer(data, "<u8", n))
        found["s"].append(np.frombuffer(data, "<u8", n, n * 8))
        planes, at = np.frombuffer(data, np.uint8, offset=n * _HASHES).reshape(-1, n), 0
        for name, kind in list(_PACKED.items())[2:]:
            size = np.dtype(kind).itemsize
            values = np.ascontiguousarray(planes[at : at + size].T).view(kind).ravel()
            found[name].append(np.cumsum(values) if name == "doc" else values)
            at += size
    return {name: np.concatenate(arrays) for name, arrays in found.items()}


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each part, from batches in the order of ``part``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column("part").to_numpy()
        cuts = np.flatnonzero(part[1:] != part[:-1]) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(part)]):
            if held and held[-1].column("part")[0].as_py() != part[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, 1 << 16):
        yield batch.slice(at, 1 << 16)


def _parts(spark: SparkSession) -> int:
    return _PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))


def _located(rows: DataFrame, settings: SuffixSettings) -> DataFrame:
    """(part, data): where every segment stands, packed, in parts by smallest hash."""
    parts = _parts(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        size = 0

        def packed() -> pa.RecordBatch:
            columns = {name: np.concatenate([x[name] for x in held]) for name in held[0]}
            return _pack((mix(columns["h"]) % np.uint64(parts)).astype(np.int64), {**columns, "segs": np.zeros(size, np.uint32)})

        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            versions = batch.column("version").to_numpy(zero_copy_only=False)
            texts = [utf8(t) for t in batch.column("text").to_pylist()]
            for members, base, pieces in _pieces(texts, settings):
                text, h, s, start, n = segments(pieces, settings)
                if not len(h):
                    continue
                member = np.array(members)[text]
                at = (start + np.array(base)[text]).astype(np.uint32)
                held.append({"h": h, "s": s, "doc": ids[member], "version": versions[member], "start": at, "n": n.astype(np.uint32)})
                size += len(h)
                if size >= settings.packed:
                    yield packed()
                    held, size = [], 0
        if held:
            yield packed()

    return rows.mapInArrow(lean(run), "part int, data binary")


def _leads(found: dict[str, np.ndarray], last: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """One row of each hash and segment, that of its smallest document, and the largest document of each (``last``: so far)."""
    order = np.lexsort((found["doc"], found["s"], found["h"]))
    h, s = found["h"][order], found["s"][order]
    at = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (s[1:] != s[:-1])]))
    return {name: values[order[at]] for name, values in found.items()}, np.maximum.reduceat(last[order], at)


def _census(rows: DataFrame, settings: SuffixSettings) -> DataFrame:
    """(h, s, doc, version, start, n, segs, lead): segments of the hashes that occur in several documents.

    ``segs``: distinct segments of the hash. With ``lead``: a row for each of them, in its smallest document, if the
    hash has several. Without: every place in a document larger than the first that holds the hash, without h and s
    if the hash has one segment.
    """
    names = ["h", "s", "doc", "version", "start", "n", "segs", "lead"]

    def sent(found: dict[str, np.ndarray], segs: np.ndarray, lead: bool) -> Iterator[pa.RecordBatch]:
        alone = segs == 1
        arrays = [
            np.where(alone, 0, found["h"].view(np.int64)), np.where(alone, 0, found["s"].view(np.int64)), found["doc"], found["version"],
            found["start"].astype(np.int64), found["n"].astype(np.int32), segs.astype(np.int32), np.full(len(segs), lead),
        ]
        yield from _sliced(pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_part(batches):
            # A part is taken a stretch at a time, twice: a very common hash has any number of rows.
            packed = table.column("data")
            stretches = list(blocks([len(x.as_buffer()) for x in packed], settings.packed * _WIDTH))
            whole = None
            leads = last = None
            for a, b in stretches:
                found = _unpack(packed[a:b].to_pylist())
                if len(stretches) == 1:
                    order, at = _groups(found["h"])
                    doc = found["doc"][order]
                    several = np.minimum.reduceat(doc, at) != np.maximum.reduceat(doc, at)
                    order = order[np.repeat(several, np.diff(at, append=len(order)))]
                    found = whole = {name: values[order] for name, values in found.items()}
                    if not len(order):
                        break
                own, most = _leads(found, found["doc"])
                if leads is not None:
                    own = {name: np.concatenate([leads[name], own[name]]) for name in own}
                    own, most = _leads(own, np.concatenate([last, most]))
                leads, last = own, most
            if leads is None:
                continue
            new = np.concatenate([[True], leads["h"][1:] != leads["h"][:-1]])
            at = np.flatnonzero(new)
            h, least, segs = leads["h"][at], np.minimum.reduceat(leads["doc"], at), np.diff(at, append=len(new))
            several = least != np.maximum.reduceat(last, at)
            if not several.any():
                continue
            wanted = np.repeat(several & (segs > 1), segs)
            yield from sent({name: values[wanted] for name, values in leads.items()}, np.repeat(segs, segs)[wanted], True)
            h, least, segs = h[several], least[several], segs[several]
            for a, b in stretches:
                found = whole or _unpack(packed[a:b].to_pylist())
                place = np.minimum(np.searchsorted(h, found["h"]), len(h) - 1)
                late = np.flatnonzero((h[place] == found["h"]) & (found["doc"] > least[place]))
                yield from sent({name: values[late] for name, values in found.items()}, segs[place[late]], False)

    schema = "h long, s long, doc long, version long, start long, n int, segs int, lead boolean"
    return _located(rows, settings).repartition("part").sortWithinPartitions("part").mapInArrow(lean(run), schema)


def _fetched(rows: DataFrame, leads: DataFrame, settings: SuffixSettings) -> DataFrame:
    """(h, s, first, segs, seg): the bytes of segments, cut from their documents' texts."""
    part = F.pmod(F.xxhash64("doc", "version"), F.lit(_parts(rows.sparkSession))).cast("int").alias("part")
    length = settings.length

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def packed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            columns = {name: table.column(name).to_numpy() for name in _PACKED}
            order = np.argsort(columns["doc"], kind="stable")
            return _pack(table.column("part").to_numpy()[order], {name: values[order] for name, values in columns.items()})

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= settings.packed:
                yield packed()
                held, size = [], 0
        if size:
            yield packed()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_part(batches):
            wanted = _unpack([x for x in table.column("data").to_pylist() if x is not None])
            if not len(wanted["h"]):
                continue
            order = np.lexsort((wanted["version"], wanted["doc"]))
            wanted = {name: values[order] for name, values in wanted.items()}
            doc, version = wanted["doc"], wanted["version"]
            at = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (version[1:] != version[:-1])]))
            ranges = dict(zip(zip(doc[at].tolist(), version[at].tolist()), zip(at.tolist(), [*at[1:].tolist(), len(doc)])))
            start = wanted["start"].astype(np.int64)
            end = start + wanted["n"] + (length - 1)
            for batch in table.to_batches():
                texts = batch.filter(batch.column("text").is_valid())
                taken, seg = [], []
                for key, text in zip(zip(texts.column("doc").to_pylist(), texts.column("version").to_pylist()), texts.column("text")):
                    a, b = ranges.pop(key, (0, 0))
                    if a < b:
                        data = utf8(text.as_py())
                        taken.append(np.arange(a, b))
                        seg += [data[i:j] for i, j in zip(start[a:b].tolist(), end[a:b].tolist())]
                if taken:
                    rows_of = np.concatenate(taken)
                    h, s = (wanted[name][rows_of].view(np.int64) for name in ("h", "s"))
                    arrays = [h, s, doc[rows_of], wanted["segs"][rows_of].astype(np.int32)]
                    yield from _sliced(pa.RecordBatch.from_arrays([*map(pa.array, arrays), pa.array(seg, pa.binary())], names=["h", "s", "first", "segs", "seg"]))
            if ranges:
                raise ValueError(f"{len(ranges)} documents are not what they were when first read")

    asked = leads.select(part, *_PACKED).mapInArrow(lean(pack), "part int, data binary")
    texts = rows.withColumnRenamed("doc_id", "doc").select(part, F.lit(None).cast("binary").alias("data"), "doc", "version", "text")
    asked = asked.select("part", "data", F.lit(None).cast("long").alias("doc"), F.lit(None).cast("long").alias("version"), F.lit(None).cast("string").alias("text"))
    both = asked.union(texts).repartition("part").sortWithinPartitions("part")
    return both.mapInArrow(lean(cut), "h long, s long, first long, segs int, seg binary")


@dataclass
class Shard:
    """Rotations of some strings in order, to a depth of at least 56 symbols; 0 ends a string."""

    bwt: np.ndarray
    order: np.ndarray  # rotation -> place in the concatenated symbols


def build_shard(symbols: np.ndarray, string_start: np.ndarray, string_size: np.ndarray) -> Shard:
    """Transform of strings given as concatenated symbols (bytes), each string with its end symbol."""
    n = len(symbols)
    following = np.arange(1, n + 1)
    following[string_start + string_size - 1] = string_start
    # The first seven symbols in one number, then the ranks of three such runs (two, if three have no room).
    rank, ahead = symbols.astype(np.int64), following
    for _ in range(6):
        rank, ahead = (rank << 8) | symbols[ahead], following[ahead]
    known, runs = 7, 3 if n <= 1 << 21 else 2
    while known < 56:
        order, first = _groups(rank)
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.repeat(np.arange(len(first)), np.diff(first, append=n))
        own, step = rank, ahead
        for _ in range(runs - 1):
            rank, ahead = rank * n + own[ahead], step[ahead]
        known *= runs
    order = np.argsort(rank)
    before = np.empty_like(symbols)
    before[following] = symbols
    return Shard(before[order], order)


def _steps(bwt: np.ndarray, back: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(symbols, row) for one, two and more steps back, ``most`` at most: the rank of the symbols before each row, in
    order, and the row of the rotation that begins with them. As many steps as have ranks of 16 bits."""
    steps = [(bwt.astype(np.uint16), back)]
    size = int(bwt.max()) + 1
    known = size
    while len(steps) < most:
        ranks, row = steps[-1]
        if size * known > _RANKED:
            break
        pair = bwt.take(row).astype(np.uint32) * np.uint32(known) + ranks
        used = np.zeros(size * known, dtype=bool)
        used[pair] = True
        known = int(np.count_nonzero(used))
        if known > 1 << 16:
            break
        rank = np.cumsum(used, dtype=np.uint32) - np.uint32(1)
        steps.append((rank.take(pair).astype(np.uint16), back.take(row)))
    return steps


def merge_shards(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the shards by the first ``depth`` symbols: (row, block) per merged place.

    Rows count the shards' rotations one shard after another. Each round moves every place to the bucket of
    its preceding symbols, in order, and the row there to the rotation that begins with them; within a shard
    rows keep their order. Places of one block have a common prefix of all symbols of the rounds so far.
    Stops early when a round splits no block.
    """
    bwt = np.concatenate([s.bwt for s in shards])
    back = np.empty(len(bwt), dtype=np.int32)  # row -> row of the rotation that begins one symbol earlier
    at = 0
    for s in shards:
        back[at + np.argsort(s.bwt, kind="stable")] = np.arange(at, at + len(s.bwt), dtype=np.int32)
        at += len(s.bwt)
    steps = _steps(bwt, back, min(depth, _MOST_STEPS))
    rounds, rest = divmod(depth, len(steps))
    steps = {size: (steps[size - 1][0], steps[size - 1][1].astype(np.int64)) for size in {len(steps), rest} - {0}}
    most = max(steps)
    row = np.arange(len(bwt))
    block = np.zeros(len(bwt), dtype=np.int64)
    count = 1
    for size in [most] * rounds + [rest] * bool(rest):
        symbols, back = steps[size]
        symbol = symbols.take(row)
        move = np.argsort(symbol, kind="stable")
        block <<= 16
        block |= symbol
        key, row = block.take(move), back.take(row).take(move)
        block[0] = 0
        np.cumsum(key[1:] != key[:-1], out=block[1:])
        if block[-1] + 1 == count:
            break
        count = int(block[-1]) + 1
    return row, block


def first_documents(strings: list[bytes], first: np.ndarray, settings: SuffixSettings) -> tuple[np.ndarray, np.ndarray]:
    """(place, document): for each window of the concatenated strings (with one end symbol each) the smallest ``first``
    of the strings that hold it."""
    length = settings.length
    sizes = np.array([len(s) + 1 for s in strings])
    starts = np.cumsum(sizes) - sizes
    joined = np.frombuffer(b"\0".join(strings) + b"\0", dtype=np.uint8)
    # Bytes as small numbers from 1, in order. UTF-8 never uses all 256 bytes, so one is left for the end.
    used = np.bincount(joined, minlength=256) > 0
    symbols = np.cumsum(used).astype(np.uint8)[joined]
    symbols[starts + sizes - 1] = 0
    shards, places = [], []
    ranges = list(blocks(sizes.tolist(), max(settings.shard, int(sizes.sum()) // 200 + 1)))
    for a, b in ranges:
        low, high = starts[a], starts[b - 1] + sizes[b - 1]
        shard = build_shard(symbols[low:high], starts[a:b] - low, sizes[a:b])
        shards.append(shard)
        places.append(shard.order + low)
    row, block = merge_shards(shards, length)
    place = np.concatenate(places)[row]
    owner = np.repeat(np.arange(len(strings)), sizes)
    # Windows that reach an end symbol are no windows.
    whole = place + length < (starts + sizes)[owner[place]]
    place, block = place[whole], block[whole]
    new = np.concatenate([[True], block[1:] != block[:-1]])
    least = np.minimum.reduceat(first[owner[place]], np.flatnonzero(new))
    document, window = np.empty(len(joined), dtype=least.dtype), np.zeros(len(joined), dtype=bool)
    document[place], window[place] = least[np.cumsum(new) - 1], True
    return np.flatnonzero(window), document[window]


def _may_share(h: np.ndarray, strings: list[bytes], settings: SuffixSettings) -> np.ndarray:
    """Which strings may share a window with another of the same smallest hash.

    A window holds the k-mer of that hash, some bytes before it and the rest behind it. In each quarter of
    the possible places of the k-mer a window holds certain bytes around it for sure; a string for which
    these occur in no other, in any quarter, shares nothing.
    """
    around = settings.length - _KMER
    quarter = -(-(around + 1) // 4)
    sizes = np.array([len(x) + 1 for x in strings])
    starts = np.cumsum(sizes) - sizes
    ends = starts + sizes - 1
    buf = np.frombuffer(b"\0".join(strings) + b"\0", dtype=np.uint8)
    owner = np.repeat(np.arange(len(strings)), sizes)
    hashes = _kmer_hashes(buf)
    own = owner[: len(hashes)]
    at = np.flatnonzero((hashes == h.view(np.uint64)[own]) & (np.arange(len(hashes)) + _KMER <= ends[own]))
    # Every place counts: a window may hold any of several such k-mers of a string.
    found, h = own[at], h.view(np.uint64)[own[at]]
    keep = np.zeros(len(strings), dtype=bool)
    ranges = []
    for i in range(4):
        low, high = at - i * quarter, at + _KMER + max(0, around - (i + 1) * quarter + 1)
        fits = (low >= starts[found]) & (high <= ends[found])
        ranges.append((low[fits], high[fits], h[fits], found[fits]))
    hashed = range_hashes(buf, np.concatenate([r[0] for r in ranges]), np.concatenate([r[1] for r in ranges]))
    for _, _, least, holder in ranges:
        key, hashed = mix(hashed[: len(least)] + least), hashed[len(least) :]
        if not len(key):
            continue
        order, first = _groups(key)
        holder = holder[order]
        several = np.minimum.reduceat(holder, first) != np.maximum.reduceat(holder, first)
        keep[holder[np.repeat(several, np.diff(first, append=len(key)))]] = True
    return keep


def _compare(segs: DataFrame, settings: SuffixSettings) -> DataFrame:
    """(h, s, offset, windows, first) from (h, s, first, seg) sorted by hash within partitions."""
    length = settings.length

    def whole(h, s, first, strings) -> pa.RecordBatch:
        windows = np.array([len(x) - length + 1 for x in strings], dtype=np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(h), pa.array(s), pa.array(np.zeros(len(h), np.int32)), pa.array(windows), pa.array(first)],
            names=["h", "s", "offset", "windows", "first"],
        )

    def solve(h, s, first, strings) -> Iterator[pa.RecordBatch]:
        share = _may_share(h, strings, settings)
        if not share.all():
            yield whole(h[~share], s[~share], first[~share], [x for x, k in zip(strings, share) if not k])
        if not share.any():
            return
        h, s, first, strings = h[share], s[share], first[share], [x for x, k in zip(strings, share) if k]
        sizes = np.array([len(x) + 1 for x in strings])
        starts = np.cumsum(sizes) - sizes
        place, document = first_documents(strings, first, settings)
        owner = np.repeat(np.arange(len(strings)), sizes)[place]
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (document[1:] != document[:-1])])
        at = np.flatnonzero(new)
        windows = np.diff(np.concatenate([at, [len(place)]]))
        o = owner[at]
        yield pa.RecordBatch.from_arrays(
            [pa.array(h[o]), pa.array(s[o]), pa.array((place[at] - starts[o]).astype(np.int32)), pa.array(windows.astype(np.int32)), pa.array(document[at])],
            names=["h", "s", "offset", "windows", "first"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def cut(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            numbers = [rows.column(c).to_numpy() for c in ("h", "s", "first")]
            return solve(*numbers, rows.column("seg").to_pylist())

        for batch in batches:
            held.append(batch)
            size += batch.column("seg").nbytes
            if size >= settings.batch:
                rows = pa.Table.from_batches(held)
                h = rows.column("h").to_numpy()
                # All but the last hash, whose rows may go on.
                whole_hashes = int(np.searchsorted(h, h[-1]))
                if whole_hashes:
                    yield from cut(rows.slice(0, whole_hashes))
                    held = rows.slice(whole_hashes).combine_chunks().to_batches()
                    size = sum(b.column("seg").nbytes for b in held)
        if held:
            yield from cut(pa.Table.from_batches(held))

    common = segs.filter(F.col("segs") <= settings.hot)
    runs = common.select("h", "s", "first", "seg").repartition("h").sortWithinPartitions("h").mapInArrow(lean(run), "h long, s long, offset int, windows int, first long"
    )
    # A hash with very many different segments: its windows are grouped by their bytes instead.
    windows = segs.filter(F.col("segs") > settings.hot).withColumn(
        "offset", F.explode(F.sequence(F.lit(0), F.octet_length("seg") - length))
    ).select("h", "s", "first", F.col("offset").cast("int").alias("offset"), F.substring("seg", F.col("offset") + 1, F.lit(length)).alias("w"))
    least = windows.groupBy("w").agg(F.min("first").alias("least"))
    hot = windows.join(least, "w").select("h", "s", "offset", F.lit(1).alias("windows"), F.col("least").alias("first"))
    return runs.union(hot)


def repeated_spans(docs: DataFrame, settings: SuffixSettings = SuffixSettings()) -> DataFrame:
    """(doc, version, spans): per document, the start and end of what earlier documents hold, unmerged.

    ``docs``: doc_id, text, and ``version``, which tells rows of one doc_id apart.
    """
    rows = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "version", "text")
    spark = docs.sparkSession

    def write(df: DataFrame, path: str) -> DataFrame:
        # Its shuffles end with it: on a large table the driver may not have forgotten the plan when it collects garbage.
        before = spark.conf.get(_CLEANUP, "false")
        spark.conf.set(_CLEANUP, "true")
        try:
            df.write.mode("append").parquet(path)
        finally:
            spark.conf.set(_CLEANUP, before)
        release(spark)
        return spark.read.schema(df.schema).parquet(path)

    # Tables are given back with their scope, the texts' segments once they are compared.
    spans_path = scratch_path(spark, "spans")
    with scratch_scope(spark):
        found = write(_census(rows, settings), scratch_path(spark, "segments"))
        runs_path = scratch_path(spark, "runs")
        with scratch_scope(spark):
            segs = write(_fetched(rows, found.filter("lead"), settings), scratch_path(spark, "bytes"))
            runs = write(_compare(segs, settings), runs_path)
        common = found.filter("segs > 1 and not lead").select("h", "s", "doc", "version", "start")
        common = common.join(runs, ["h", "s"]).filter(F.col("first") < F.col("doc"))
        begin = F.col("start") + F.col("offset")
        common = common.select("doc", "version", begin.alias("a"), (begin + F.col("windows") + settings.length - 1).alias("b"))
        alone = found.filter("segs = 1").select(
            "doc", "version", F.col("start").alias("a"), (F.col("start") + F.col("n") + settings.length - 1).alias("b")
        )
        spans = common.union(alone).groupBy("doc", "version").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
        return write(spans, spans_path)


def _merged(spans: pa.Array) -> Iterator[list[tuple[int, int]]]:
    """Per row of ``spans`` (lists of start ``a`` and end ``b``, null: none) its maximal runs, in order."""
    sizes = pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False)
    a, b = (x.to_numpy() for x in spans.flatten().flatten())
    if not len(a):
        yield from ([] for _ in sizes)
        return
    # Rows one after another on one line, none of which reaches into the next.
    base = np.repeat(np.arange(len(sizes)), sizes) * (int(b.max()) + 1)
    order = np.argsort(a + base)
    a, reach, base = (a + base)[order], np.maximum.accumulate((b + base)[order]), base[order]
    first = np.flatnonzero(np.concatenate([[True], a[1:] > reach[:-1]]))
    last = np.append(first[1:], len(a)) - 1
    runs = list(zip((a - base)[first].tolist(), (reach - base)[last].tolist()))
    ends = np.searchsorted(first, np.cumsum(sizes)).tolist()
    for low, high in zip([0, *ends], ends):
        yield runs[low:high]


def _cut(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    """What is left of ``data`` without some runs of it, given in order."""
    kept, at = [], 0
    for a, b in runs:
        kept.append(data[at:a])
        at = b
    kept.append(data[at:])
    return b"".join(kept)


def remove_repeats(docs: DataFrame, settings: SuffixSettings = SuffixSettings(), with_kept: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs`` (doc_id, text), and with
    ``with_kept`` the remaining bytes.

    Removed is each byte covered by a string of ``length`` bytes that also starts in a document of
    smaller doc_id. Strings are judged on the input.

    * null text is empty; a null doc_id is smaller than none: nothing is removed there, nor because of it
    * repeated rows: rows of one doc_id do not remove from one another, and each is cut by its own text
    * empty table: no rows; other columns are not read
    """
    if settings.length < _SHORTEST or settings.length > 56 or settings.length % 2:
        raise ValueError(f"length must be even, at least {_SHORTEST} and at most 56")
    named = docs.filter(F.col("doc_id").isNotNull())
    # Rows of one doc_id are told apart by their text; usually there are none.
    version = F.xxhash64("text") if repeats_an_id(named.select("doc_id")) else F.lit(0).cast("long")
    rows = docs.select("doc_id", "text").withColumn("version", version)
    spans = repeated_spans(rows, settings)
    # Texts of documents without spans need not be shuffled.
    sent = docs.sparkSession.sparkContext.broadcast(bitmap_of(spans.select("doc"), settings.filter_words))

    def having(batch: pa.RecordBatch, cut: bool) -> pa.RecordBatch:
        ids = batch.column("doc_id").cast(pa.int64())
        hit = passes(ids.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64), sent.value)
        return batch.filter(pa.array((hit & ids.is_valid().to_numpy(zero_copy_only=False)) == cut))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield having(batch, True)

    near = rows.mapInArrow(lean(keep), rows.schema)
    near = near.join(spans, (near["doc_id"] == spans["doc"]) & (near["version"] == spans["version"]), "left")

    def digest(batches: Iterator[pa.RecordBatch], joined: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch if joined else having(batch, False)
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                runs_of = _merged(part.column("spans")) if joined else [[]] * part.num_rows
                out = []
                for text, runs in zip(part.column("text").to_pylist(), runs_of):
                    data = utf8(text)
                    kept = _cut(data, runs)
                    out.append((len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept if with_kept else None))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                arrays = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *arrays], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    result = near.select("doc_id", "text", "spans").mapInArrow(lean(lambda batches: digest(batches, True)), schema)
    result = result.union(rows.select("doc_id", "text").mapInArrow(lean(lambda batches: digest(batches, False)), schema))
    return result if with_kept else result.drop("kept")
