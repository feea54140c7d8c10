"""Prefix trie of conversations: a node per distinct sequence of first turns, with counts over its subtree.

Method. Conversations become arrays of 128-bit turn ids and are range-sorted by Spark, identical
sequences merged first. Each Arrow batch of the sorted rows is a padded turn-id matrix read one column
(depth) at a time: a row whose turn at some depth differs from the row above, or that has none there,
flags a change; OR-accumulating these column masks marks where a node starts at every depth, and
``reduceat`` aggregates the nodes of that depth. Nodes cut by a batch or range-shard boundary are partial;
they carry a 128-bit prefix key and recombine in a Spark aggregation. Subtree counts are prefix sums in
sort order: a node's subtree is the contiguous run of sorted sequences that start with it.

A single conversation is one array, so its turns meet in one task; everything else is spread.
Turn ids and prefix keys are 128-bit hashes: two different turns or prefixes collide with
probability about n^2 / 2^128.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossa.llm.common import lean
from glossa.llm.hashing import mix
from glossa.session import write_scratch

# Words of a turn's text: runs of characters other than ASCII white space.
WORDS = r"[^\x20\x09-\x0D]+"
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

# Odd multipliers of the two lanes of prefix keys.
_LANES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))

PARTIALS = (
    "depth long, k1 long, k2 long, p1 long, p2 long, cnt long, min_id long, fr long, lr long, ends string, words long"
)


def graft_prefixes(conversations: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Conversations in which conversation c starts with the first h turns of conversation c - c % ``group``.

    h is the unsigned crc32 of c's decimal text modulo ``most``; the first h turns of that conversation
    (all if fewer, none if it is absent) are followed by c's own turns after its first h. Turns are ordered as in
    ``numbered``. Returns conv_id, turn (0, 1, ... in the new order), role, text; a conversation left without
    turns has no rows (``prefix_trie`` takes its id from ``members``).
    """
    turns = numbered(conversations)
    ids = turns.select("conv_id").distinct().select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("_base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("_h"),
    )
    own = turns.join(ids, "conv_id").filter(F.col("_k") >= F.col("_h")).select("conv_id", F.lit(1).alias("_part"), "_k", "role", "text")
    lent = turns.filter(F.col("_k") < most).select(F.col("conv_id").alias("_base"), "_k", "role", "text")
    borrowed = ids.join(lent, "_base").filter(F.col("_k") < F.col("_h")).select("conv_id", F.lit(0).alias("_part"), "_k", "role", "text")
    place = Window.partitionBy("conv_id").orderBy("_part", "_k")
    return own.unionByName(borrowed).select(
        "conv_id", (F.row_number().over(place) - 1).cast("long").alias("turn"), "role", "text"
    )


def numbered(conversations: DataFrame) -> DataFrame:
    """Turns with their place ``_k`` (from 0): by turn (null first), then role, then text, which are made empty where null.

    Rows with a null conv_id are left out.
    """
    clean = conversations.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return clean.withColumn("_k", F.row_number().over(order) - 1)


def _word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")


def sequences(conversations: DataFrame, members: DataFrame) -> DataFrame:
    """One row per distinct turn sequence: seq (interleaved 128-bit turn ids), words per turn, cnt, min_id, ends.

    ``members`` holds the conv_ids that count, turnless ones included. ``ends`` is the lowercase SHA-256 hex of
    the comma-joined ascending decimal conv_ids with exactly this sequence; it is computed by streaming sorted
    ids, so a sequence shared by many conversations needs no memory.
    """
    items = numbered(conversations).select(
        "conv_id",
        F.struct(
            F.col("_k").alias("k"),
            F.xxhash64(F.lit(1), "role", "text").alias("a"),
            F.xxhash64(F.lit(2), "role", "text").alias("b"),
            _word_count(F.col("text")).alias("w"),
        ).alias("t"),
    )
    per = items.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    ids = members.filter(F.col("conv_id").isNotNull()).select("conv_id").distinct()
    convs = ids.join(per, "conv_id", "left").select(
        "conv_id",
        F.coalesce(F.flatten(F.transform("ts", lambda t: F.array(t["a"], t["b"]))), F.array().cast("array<long>")).alias("seq"),
        F.coalesce(F.transform("ts", lambda t: t["w"]), F.array().cast("array<long>")).alias("words"),
    )
    convs = write_scratch(
        convs.select("conv_id", "seq", "words", F.xxhash64(F.lit(1), "seq").alias("s1"), F.xxhash64(F.lit(2), "seq").alias("s2")),
        "conv-seqs",
    )
    ends = (
        convs.select("s1", "s2", "conv_id").repartition("s1", "s2").sortWithinPartitions("s1", "s2", "conv_id")
        .mapInArrow(lean(_stream_ends), "s1 long, s2 long, ends string")
    )
    merged = convs.groupBy("s1", "s2").agg(
        F.first("seq").alias("seq"), F.first("words").alias("words"), F.count(F.lit(1)).alias("cnt"), F.min("conv_id").alias("min_id")
    )
    return merged.join(ends, ["s1", "s2"]).select("seq", "words", "cnt", "min_id", "ends")


def _stream_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per run of equal (s1, s2) in sorted rows, the SHA-256 of its comma-joined ids; runs may span batches."""
    key, digest, first = None, None, True
    out_1, out_2, out_h = [], [], []

    def flush():
        nonlocal out_1, out_2, out_h
        batch = pa.RecordBatch.from_arrays(
            [pa.array(out_1, pa.int64()), pa.array(out_2, pa.int64()), pa.array(out_h, pa.string())], ["s1", "s2", "ends"]
        )
        out_1, out_2, out_h = [], [], []
        return batch

    for batch in batches:
        s1 = batch.column("s1").to_numpy()
        s2 = batch.column("s2").to_numpy()
        ids = batch.column("conv_id").to_numpy()
        if not len(ids):
            continue
        cut = np.flatnonzero((s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])) + 1
        starts = np.r_[0, cut]
        stops = np.r_[cut, len(ids)]
        for lo, hi in zip(starts.tolist(), stops.tolist()):
            here = (int(s1[lo]), int(s2[lo]))
            if here != key:
                if key is not None:
                    out_1.append(key[0]), out_2.append(key[1]), out_h.append(digest.hexdigest())
                key, digest, first = here, hashlib.sha256(), True
            text = ",".join(map(str, ids[lo:hi].tolist()))
            digest.update((text if first else "," + text).encode())
            first = False
        if len(out_1) >= 4096:
            yield flush()
    if key is not None:
        out_1.append(key[0]), out_2.append(key[1]), out_h.append(digest.hexdigest())
    if out_1:
        yield flush()


def _prefix_keys(ids: np.ndarray, place: np.ndarray, lane: int) -> np.ndarray:
    """Running key of every prefix: sum over turns t of mix(id_t + lane) * L^t modulo 2^64, cumulated along the flat array."""
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.r_[np.uint64(1), np.full(max(int(place.max(initial=0)), 0), _LANES[lane], np.uint64)])
        return np.cumsum(mix(ids.view(np.uint64) + np.uint64(lane + 1)) * powers[place], dtype=np.uint64)


def _nodes(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Partial nodes of one batch of sorted distinct sequences (see the module's method)."""
    seq = batch.column("seq")
    n = batch.num_rows
    flat = seq.values.to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, 2)
    starts = (seq.offsets.to_numpy() // 2).astype(np.int64)
    toff = starts[:-1] - starts[0]
    lens = np.diff(starts)
    flat = flat[starts[0]: starts[-1]]
    words = batch.column("words")
    wflat = words.values.to_numpy(zero_copy_only=False).astype(np.int64)
    woff = words.offsets.to_numpy()
    wflat = wflat[woff[0]: woff[-1]]
    cnt = batch.column("cnt").to_numpy().astype(np.int64)
    min_id = batch.column("min_id").to_numpy().astype(np.int64)
    row = batch.column("row").to_numpy().astype(np.int64)
    ends = np.array(batch.column("ends").to_pylist(), dtype=object)

    place = np.arange(len(flat), dtype=np.int64) - np.repeat(toff, lens)
    with np.errstate(over="ignore"):
        # Key of a row's prefix of depth d is S[toff + d - 1] - S[toff - 1]; shift by one so that S[toff] - S[toff] = 0.
        s_a = np.r_[np.uint64(0), _prefix_keys(flat[:, 0], place, 0)] if len(flat) else np.zeros(1, np.uint64)
        s_b = np.r_[np.uint64(0), _prefix_keys(flat[:, 1], place, 1)] if len(flat) else np.zeros(1, np.uint64)

    out = {k: [] for k in ("depth", "k1", "k2", "p1", "p2", "cnt", "min_id", "fr", "lr", "ends", "words")}

    def emit(depth, k1, k2, p1, p2, c, m, f, la, e, w):
        out["depth"].append(np.full(len(k1), depth, np.int64)), out["k1"].append(k1), out["k2"].append(k2)
        out["p1"].append(p1), out["p2"].append(p2), out["cnt"].append(c), out["min_id"].append(m)
        out["fr"].append(f), out["lr"].append(la), out["ends"].append(e), out["words"].append(w)

    zero = np.zeros(1, np.int64)
    emit(0, zero, zero, np.array([None], object), np.array([None], object), np.array([cnt.sum()]), np.array([min_id.min()]),
         row[:1], row[-1:], np.array([ends[0] if lens[0] == 0 else None], object), zero)
    changed = np.zeros(n, dtype=bool)
    active = np.flatnonzero(lens > 0)
    depth = 0
    while len(active):
        # Rows that have a turn at this depth; the column of their turns and of the rows above them.
        at = toff[active] + depth
        above = active - 1
        has_above = (above >= 0) & (lens[np.maximum(above, 0)] > depth)
        upper = np.where(has_above, toff[np.maximum(above, 0)] + depth, 0)
        differs = ~has_above | (flat[at, 0] != flat[upper, 0]) | (flat[at, 1] != flat[upper, 1])
        changed[active] |= differs
        first = np.flatnonzero(changed[active])
        lead = active[first]
        last = active[np.r_[first[1:], len(active)] - 1]
        base = toff[lead]
        with np.errstate(over="ignore"):
            k1 = (s_a[base + depth + 1] - s_a[base]).view(np.int64)
            k2 = (s_b[base + depth + 1] - s_b[base]).view(np.int64)
            if depth:
                p1 = (s_a[base + depth] - s_a[base]).view(np.int64).astype(object)
                p2 = (s_b[base + depth] - s_b[base]).view(np.int64).astype(object)
            else:
                p1 = np.zeros(len(lead), np.int64).astype(object)
                p2 = p1
        exact = lens[lead] == depth + 1
        emit(
            depth + 1, k1, k2, p1, p2, np.add.reduceat(cnt[active], first), np.minimum.reduceat(min_id[active], first),
            row[lead], row[last], np.where(exact, ends[lead], None), wflat[base + depth],
        )
        depth += 1
        active = active[lens[active] > depth]

    arrays = []
    for name in ("depth", "k1", "k2", "p1", "p2", "cnt", "min_id", "fr", "lr", "words"):
        parts = np.concatenate(out[name])
        arrays.append(pa.array(parts.tolist() if parts.dtype == object else parts, pa.int64()))
    arrays.insert(9, pa.array(np.concatenate(out["ends"]).tolist(), pa.string()))
    return pa.RecordBatch.from_arrays(arrays, PARTIALS_NAMES)


PARTIALS_NAMES = [p.split()[0] for p in PARTIALS.split(", ")]


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield _nodes(batch)


def prefix_trie(conversations: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """Every node of the trie of turn sequences (role, text) of ``conversations``, with counts over its subtree.

    Input: conv_id, turn, role, text; turns are ordered by turn (null first), then role, then text, so ties
    and repeated rows have a defined order and repeated rows are repeated turns. Null role or text is empty;
    rows with a null conv_id are left out. ``members`` (conv_id) names the conversations, turnless ones included;
    by default those of ``conversations``. Other columns are ignored, whatever their names. Empty and very long
    texts are ordinary turns.

    A depth-d node is a distinct sequence of first d turns; its members are the conversations that start with
    it (the root, depth 0, holds them all). Returns per node: conv_id (smallest member), depth, parent_conv_id
    (null at the root), n_convs, n_children, n_leaves (childless nodes of its subtree, itself included),
    saved_tokens (over its subtree, each node's (n_convs - 1) times the words of its last text) and ends_sha256
    (SHA-256 of the comma-joined ascending ids of members with exactly d turns; of the empty text if none).
    An empty table gives no rows.
    """
    distinct = sequences(conversations, conversations.select("conv_id") if members is None else members)
    ordered = distinct.repartitionByRange("seq").sortWithinPartitions("seq").withColumn("row", F.monotonically_increasing_id())
    partial = write_scratch(ordered.mapInArrow(lean(_partials), PARTIALS), "trie-partials")
    nodes = write_scratch(
        partial.groupBy("depth", "k1", "k2").agg(
            F.sum("cnt").alias("n_convs"), F.min("min_id").alias("conv_id"), F.min("fr").alias("fr"), F.max("lr").alias("lr"),
            F.max("ends").alias("ends"), F.first("words").alias("words"), F.first("p1", ignorenulls=True).alias("p1"),
            F.first("p2", ignorenulls=True).alias("p2"),
        ),
        "trie-nodes",
    )
    children = nodes.filter(F.col("depth") > 0).groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    linked = (
        nodes.join(children, ["depth", "k1", "k2"], "left").join(parents, ["depth", "p1", "p2"], "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
        .withColumn("_v", (F.col("n_convs") - 1) * F.col("words"))
        .withColumn("_l", (F.col("n_children") == 0).cast("long"))
    )
    linked = write_scratch(linked, "trie-linked")
    # Nodes a sorted sequence opens: those whose first sequence it is. Their sums over depths at or below a node.
    own = Window.partitionBy("fr").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    linked = linked.withColumn("_ov", F.sum("_v").over(own)).withColumn("_ol", F.sum("_l").over(own))
    # Prefix sums over sorted sequences, by range shard (the high bits of the row number), then within it.
    per_row = linked.groupBy("fr").agg(F.sum("_v").alias("rv"), F.sum("_l").alias("rl")).withColumn("_shard", F.shiftright("fr", 33))
    shards = per_row.groupBy("_shard").agg(F.sum("rv").alias("sv"), F.sum("rl").alias("sl"))
    before = Window.orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.select("_shard", F.coalesce(F.sum("sv").over(before), F.lit(0)).alias("ov"), F.coalesce(F.sum("sl").over(before), F.lit(0)).alias("ol"))
    inside = Window.partitionBy("_shard").orderBy("fr").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = write_scratch(
        per_row.join(F.broadcast(offsets), "_shard").select(
            "fr", (F.sum("rv").over(inside) + F.col("ov")).alias("cv"), (F.sum("rl").over(inside) + F.col("ol")).alias("cl")
        ),
        "trie-cumulative",
    )
    at_first = cum.select(F.col("fr"), F.col("cv").alias("cv_first"), F.col("cl").alias("cl_first"))
    at_last = cum.select(F.col("fr").alias("lr"), F.col("cv").alias("cv_last"), F.col("cl").alias("cl_last"))
    done = linked.join(at_first, "fr").join(at_last, "lr")
    return done.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("_ol") + F.col("cl_last") - F.col("cl_first")).cast("long").alias("n_leaves"),
        (F.col("_ov") + F.col("cv_last") - F.col("cv_first")).cast("long").alias("saved_tokens"),
        F.coalesce("ends", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
