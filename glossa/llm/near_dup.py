"""Near-duplicates by banded MinHash with odd sketches (Mitzenmacher, Pagh and Pham, 2014).

Exactly equal shingle sets are one class. Classes meet in bands of MinHash samples. The samples of a
class are also folded into a bitmap of parities, and so is its whole set. The number of bits in which two
bitmaps differ bounds the samples, and the shingles, in which they differ, so pairs below the
threshold fall before their sets are read. What is left is compared on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.llm.bitmap import bitmap_of, passes
from glossa.llm.common import lean, release, repeats_an_id, utf8, with_text_columns
from glossa.llm.components import connected_components
from glossa.llm.hashing import mix, shingle_set
from glossa.session import write_scratch


@dataclass(frozen=True)
class NearDupSettings:
    """``percent``: least similarity, inclusive. ``bands`` bands of ``rows`` samples each; large buckets of the
    first ``forest_bands`` are searched for likely links first, those of all bands afterwards.

    A pair at the threshold meets in no band with probability (1 - (percent/100)^rows)^bands:
    6e-11 for 85 % and 5e-8 for 80 % at the values below. ``sketch_words``, ``parity_words``: 64-bit
    words of the bitmaps of samples and of sets. ``lost``: probability at which the samples' bitmap may refuse a
    pair at the threshold; that of sets never does. ``block``: most members of a bucket compared in one
    task at once. ``filter_words``: size of the filter that says whose sets are wanted.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4
    forest_bands: int = 8
    sketch_words: int = 8
    parity_words: int = 16
    filter_words: int = 1 << 18
    lost: float = 1e-9
    block: int = 512
    seed: int = 11


def most_differing_bits(settings: NearDupSettings) -> int:
    """Bits in which two sketches at the threshold may differ, but for ``lost`` of such pairs.

    Each differing sample toggles two bits at most; how many samples differ is binomial.
    """
    n, p = settings.bands * settings.rows, 1 - settings.percent / 100
    tail, k = 1.0, 0
    while tail > settings.lost and k < n:
        tail -= comb(n, k) * p**k * (1 - p) ** (n - k)
        k += 1
    return 2 * k


def _constants(settings: NearDupSettings) -> tuple[np.ndarray, np.ndarray]:
    n = settings.bands * settings.rows
    raw = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(settings.seed))
    return (raw[:n] >> np.uint64(32)).astype(np.uint32), (raw[n:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def min_hashes(items: np.ndarray, flips: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """One smallest value per hash function, over any number of items in bounded memory."""
    low = (items >> np.uint64(32)).astype(np.uint32) ^ items.astype(np.uint32)
    best = np.full(len(flips), 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(low), 2048):
        part = (low[i : i + 2048][None, :] ^ flips[:, None]) * factors[:, None]
        np.minimum(best, (part ^ (part >> np.uint32(15))).min(axis=1), out=best)
    return best


def odd_sketch(samples: np.ndarray, words: int) -> np.ndarray:
    """Parity bitmap of the samples: sample i of value v toggles one bit chosen by (i, v)."""
    place = mix(samples.astype(np.uint64) + (np.arange(len(samples), dtype=np.uint64) << np.uint64(32)))
    bits = np.bincount((place % np.uint64(words * 64)).astype(np.int64), minlength=words * 64) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.uint64)


def set_parity(items: np.ndarray, words: int) -> np.ndarray:
    """Parity bitmap of a whole set: two of them differ in at most as many bits as their sets in items."""
    place = (items * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    bits = np.bincount((place % np.uint64(words * 64)).astype(np.int64), minlength=words * 64) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.uint64)


def signatures(docs: DataFrame, settings: NearDupSettings) -> DataFrame:
    """(doc_id, n, fp, bands, sketch, parity) per row. ``fp``: fingerprint of the whole set, null if empty."""
    flips, factors = _constants(settings)
    shape = (settings.bands, settings.rows)

    def of_text(text: str | None):
        items = shingle_set(utf8(text), settings.shingle)
        if not len(items):
            return 0, None, [], [], []
        samples = min_hashes(items, flips, factors)
        keys = np.arange(settings.bands, dtype=np.uint64) + np.uint64(1)
        for column in samples.astype(np.uint64).reshape(shape).T:
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + column)
        fp = f"{int(items.sum(dtype=np.uint64)):016x}{int(np.bitwise_xor.reduce(mix(items * np.uint64(5) + np.uint64(1)))):016x}"
        return len(items), fp, keys.view(np.int64), odd_sketch(samples, settings.sketch_words).view(np.int64), set_parity(items, settings.parity_words).view(np.int64)

    fields = {
        "n": ("long", pa.int64()), "fp": ("string", pa.string()),
        **{name: ("array<long>", pa.list_(pa.int64())) for name in ("bands", "sketch", "parity")},
    }
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_text_columns(rows, "text", fields, lambda texts: list(zip(*map(of_text, texts)))).drop("text")


def shingle_sets(docs: DataFrame, wanted: DataFrame, settings: NearDupSettings) -> DataFrame:
    """(id, items): the sorted full sets of the documents whose id is in ``wanted`` (and of few others).

    Made again from the text where the text is read, so no text is shuffled; written once.
    """
    sent = docs.sparkSession.sparkContext.broadcast(bitmap_of(wanted.select("id"), settings.filter_words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                hit = part.filter(pa.array(passes(part.column("id").to_numpy().view(np.uint64), sent.value)))
                sets = [shingle_set(utf8(t), settings.shingle).view(np.int64) for t in hit.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([hit.column("id"), pa.array(sets, pa.list_(pa.int64()))], names=["id", "items"])

    rows = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("id"), "text")
    return write_scratch(rows.mapInArrow(lean(run), "id long, items array<long>"), "sets")


def _differing_bits(a: str, b: str, words: int) -> Column:
    return reduce(lambda x, y: x + y, [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(words)])


def _may_link(settings: NearDupSettings) -> Column:
    """Whether sizes and bitmaps of classes a and b allow a link."""
    n, m = F.col("n_a"), F.col("n_b")
    sample_bits = _differing_bits("sketch_a", "sketch_b", settings.sketch_words)
    set_bits = _differing_bits("parity_a", "parity_b", settings.parity_words)
    return (
        (F.least(n, m) * 100 >= F.greatest(n, m) * settings.percent)
        & (sample_bits <= most_differing_bits(settings))
        & (set_bits * (100 + settings.percent) <= (n + m) * (100 - settings.percent))
    )


def _links(shared: Column, n: Column, m: Column, settings: NearDupSettings) -> Column:
    return shared * 100 >= (n + m - shared) * settings.percent


def _confirmed(docs: DataFrame, classes: DataFrame, pairs: DataFrame, settings: NearDupSettings) -> DataFrame:
    """The ``pairs`` (a, b) of classes that are links, by their full sets."""
    slim = classes.select("id", "n", "sketch", "parity")
    pairs = (
        pairs.join(slim.toDF("a", "n_a", "sketch_a", "parity_a"), "a").join(slim.toDF("b", "n_b", "sketch_b", "parity_b"), "b")
        .filter(_may_link(settings)).select("a", "b", "n_a", "n_b")
    )
    pairs = write_scratch(pairs, "pairs")
    sets = shingle_sets(docs, pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))), settings)
    shared = F.size(F.array_intersect("items_a", "items_b")).cast("long")
    links = (
        pairs.join(sets.toDF("a", "items_a"), "a").join(sets.toDF("b", "items_b"), "b")
        .filter(_links(shared, F.col("n_a"), F.col("n_b"), settings)).select("a", "b")
    )
    return write_scratch(links, "links")


def _tiles(rows: DataFrame, settings: NearDupSettings) -> DataFrame:
    """Rows of (bucket, size, id, …) copied to the tiles their block takes part in.

    A bucket of more than ``block`` members is cut into blocks by a hash of the id, and each pair of
    blocks is a tile, so no task holds a whole bucket.
    """
    blocks = F.ceil(F.col("size") / F.lit(settings.block)).cast("int")
    own = F.pmod(F.xxhash64("id", F.lit(settings.seed)), F.col("_blocks")).cast("int")
    return (
        rows.withColumn("_blocks", blocks).withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("low", F.least("_own", "_other")).withColumn("high", F.greatest("_own", "_other"))
        .drop("_blocks", "_own", "_other", "size")
    )


class _Tile:
    """Members of a tile, and which of them the bitmaps allow to be linked with one of them."""

    def __init__(self, tile: pd.DataFrame, settings: NearDupSettings):
        self.settings, self.bits = settings, most_differing_bits(settings)
        self.ids, self.n = tile["id"].to_numpy(), tile["n"].to_numpy()
        self.sketch, self.parity = (
            np.array(tile[c].to_list(), dtype=np.int64).view(np.uint64) for c in ("sketch", "parity")
        )

    def distance(self, i: int) -> np.ndarray:
        """Differing samples' bits from member ``i``, and a large number where a link is ruled out."""
        n, m, percent = self.n, self.n[i], self.settings.percent
        bits = np.bitwise_count(self.sketch ^ self.sketch[i]).sum(axis=1, dtype=np.int64)
        sets = np.bitwise_count(self.parity ^ self.parity[i]).sum(axis=1, dtype=np.int64)
        fits = (np.minimum(n, m) * 100 >= np.maximum(n, m) * percent) & (sets * (100 + percent) <= (n + m) * (100 - percent))
        return np.where(fits & (bits <= self.bits), bits, 1 << 30)


def _likely_links(rows: DataFrame, settings: NearDupSettings) -> DataFrame:
    """(a, b): per tile, a shortest forest by the bitmaps, so that few pairs are likely to join many members."""

    def forest(tile: pd.DataFrame) -> pd.DataFrame:
        tile = tile.sort_values("id")
        members = _Tile(tile, settings)
        ids, far = members.ids, 1 << 30
        nearest, by = np.full(len(ids), far), np.zeros(len(ids), dtype=np.int64)
        left = np.ones(len(ids), dtype=bool)
        out, i = [], 0
        for _ in range(len(ids)):
            left[i] = False
            closer = np.where(left, members.distance(i), far)
            better = closer < nearest
            nearest[better], by[better] = closer[better], i
            nearest[i] = far
            if not left.any():
                break
            i = int(np.argmin(np.where(left, nearest, far + 1)))
            if nearest[i] < far:
                a, b = sorted((int(ids[i]), int(ids[by[i]])))
                out.append((a, b))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return _tiles(rows, settings).groupBy("bucket", "low", "high").applyInPandas(forest, "a long, b long")


def _other_links(docs: DataFrame, rest: DataFrame, settings: NearDupSettings) -> DataFrame:
    """Links between members of a bucket that have different labels, all of them as far as labels go.

    First, bitmaps alone tell which members have a partner of another label in their tile. The full
    sets of those alone go to the tiles, where pairs are compared unless their labels have met
    already; a tile returns a spanning forest of its links.
    """

    def partners(tile: pd.DataFrame) -> pd.DataFrame:
        members, label = _Tile(tile, settings), tile["label"].to_numpy()
        active = [bool(((members.distance(i) < 1 << 30) & (label != label[i])).any()) for i in range(len(tile))]
        return tile.loc[active, ["bucket", "low", "high", "id", "label", "n", "sketch", "parity"]]

    def compare(tile: pd.DataFrame) -> pd.DataFrame:
        members, label = _Tile(tile, settings), tile["label"].to_numpy()
        ids, n, sets = members.ids, members.n, tile["items"].to_list()
        root = {x: x for x in label}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        out = []
        for i in range(len(tile)):
            for j in np.flatnonzero(members.distance(i) < 1 << 30):
                x, y = find(label[i]), find(label[j])
                if j <= i or x == y:
                    continue
                shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if shared * 100 >= (n[i] + n[j] - shared) * settings.percent:
                    root[x] = y
                    out.append((ids[i], ids[j]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    key = ["bucket", "low", "high"]
    active = write_scratch(
        _tiles(rest, settings).groupBy(*key).applyInPandas(
            partners, "bucket long, low int, high int, id long, label long, n long, sketch array<long>, parity array<long>"
        ),
        "active",
    )
    sets = shingle_sets(docs, active, settings)
    return active.join(sets, "id").groupBy(*key).applyInPandas(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, settings: NearDupSettings = NearDupSettings()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id reachable over links; kept marks the row of that id.

    * null, empty and wordless texts: no shingles, linked with nothing, kept
    * null doc_id: linked with nothing, component_id null, kept
    * repeated rows: rows of one doc_id are one document, for which the smallest of their texts is
      compared; all of them are returned
    * empty table: no rows; other columns are not read

    Work per step: three passes over the texts, which are never shuffled; bands shuffled as a few bytes
    each; sets made only for classes in pairs that the bitmaps let through. No step lists all pairs of a bucket.
    """
    signed = write_scratch(signatures(docs, settings), "signatures")
    named = signed.filter(F.col("doc_id").isNotNull())
    if repeats_an_id(named):
        docs = docs.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("text").alias("text"))
        named = write_scratch(signatures(docs, settings), "signatures")
    usable = named.filter(F.col("fp").isNotNull())
    copies = write_scratch(
        usable.groupBy("fp").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .filter(F.col("first") != F.col("last")).select("fp", "first"),
        "copies",
    )
    same = write_scratch(
        usable.select("doc_id", "fp").join(copies, "fp").filter(F.col("doc_id") != F.col("first"))
        .select(F.col("first").alias("a"), F.col("doc_id").alias("b")),
        "same",
    )
    classes = usable.join(copies, "fp", "left").filter(
        F.col("first").isNull() | (F.col("first") == F.col("doc_id"))
    ).select(F.col("doc_id").alias("id"), "n", "bands", "sketch", "parity")
    classes = write_scratch(classes, "classes")

    members = classes.select(F.posexplode("bands").alias("band", "bucket"), "id")
    buckets = write_scratch(
        members.groupBy("bucket", "band").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count(F.lit(1)).alias("size"))
        .filter("size > 1"),
        "buckets",
    )
    large = buckets.filter("size > 2").select("bucket", "band", "size")
    crowded = write_scratch(members.join(large, ["bucket", "band"]).select("bucket", "band", "size", "id"), "crowded")
    bitmaps = classes.select("id", "n", "sketch", "parity")
    likely = _likely_links(crowded.filter(F.col("band") < settings.forest_bands).join(bitmaps, "id"), settings)
    pairs = buckets.filter("size = 2").select("a", "b").union(likely).distinct()
    links = _confirmed(docs, classes, pairs, settings)
    release(docs.sparkSession)
    labels = connected_components(links).withColumnRenamed("node", "id")

    # Buckets of three or more whose members still have different labels.
    labelled = crowded.join(labels, "id", "left").select("bucket", "size", "id", F.coalesce("component", "id").alias("label"))
    labelled = write_scratch(labelled, "labelled")
    several = write_scratch(
        labelled.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y").select("bucket"), "several"
    )
    more = _other_links(docs, labelled.join(several, "bucket").join(bitmaps, "id"), settings)

    more = write_scratch(more, "more")
    release(docs.sparkSession)
    whole = connected_components(links.union(more).union(same))
    whole = whole.withColumnRenamed("node", "doc_id")
    out = signed.select("doc_id", "n").join(whole, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )
