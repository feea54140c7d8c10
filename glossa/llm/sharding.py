"""Shards by jump consistent hashing (Lamping and Veach, 2014): no ring table, only DataFrame functions.

The generator of the paper multiplies unsigned 64-bit integers; here they are exact decimals,
since a product of two such numbers has 38 digits at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.session import write_scratch

# Fixed values of the published algorithm.
MULTIPLIER = "2862933555777941757"
TWO_31, TWO_33, TWO_64 = "2147483648", "8589934592", "18446744073709551616"

ROW_OVERHEAD = 16
_PLACE_BITS = 33


def _number(text: str) -> Column:
    return F.lit(text).cast("decimal(20,0)")


def jump_shards(key: Column, *counts: int) -> Column:
    """Array of the shard of ``key`` (a long; null counts as -1) for each number of shards in ``counts``.

    The jumps of a key do not depend on the number of shards, only where they stop does, so one
    walk serves all counts. A walk has at most as many jumps as shards.
    """
    if not counts or min(counts) < 1:
        raise ValueError("the number of shards must be at least 1")
    most = max(counts)
    seed = F.coalesce(key, F.lit(-1)).cast("decimal(20,0)")
    start = F.struct(
        F.when(seed < 0, seed + _number(TWO_64)).otherwise(seed).cast("decimal(20,0)").alias("state"),
        F.lit(0).cast("long").alias("next"),
        F.array(*[F.lit(-1).cast("long") for _ in counts]).alias("shard"),
    )

    def jump(at: Column, _: Column) -> Column:
        state = ((at["state"] * F.lit(MULTIPLIER).cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)")) % _number(TWO_64)).cast("decimal(20,0)")
        draw = F.floor(state / _number(TWO_33)).cast("double") + 1
        following = F.floor((at["next"] + 1).cast("double") * (F.lit(float(TWO_31)) / draw))
        landed = F.array(*[
            F.when(at["next"] < n, at["next"]).otherwise(at["shard"][i]) for i, n in enumerate(counts)
        ])
        moved = F.struct(state.alias("state"), following.alias("next"), landed.alias("shard"))
        return F.when(at["next"] < most, moved).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, jump)["shard"]


def assign_shards(
    docs: DataFrame, n_shards: int, key: str = "doc_id", text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """All rows of ``docs`` with their shard under the law ``key``; ``keep`` names the columns to return, all by default.

    Adds size (UTF-8 bytes of the text plus 16), text_crc32 (unsigned), law, shard, slot (gapless from
    0 in each shard) and grown_shard (the shard if there were one shard more). Input columns of
    these names are replaced.

    * null text: no bytes, so size 16 and crc32 0; null key: counts as -1
    * repeated rows and keys: the same shard, each row a slot of its own; empty table: no rows

    Rows are written once with their place in their partition; a slot is the place among the
    partition's rows of that shard plus what earlier partitions hold. Only a table of one row per
    partition and shard is joined, so a hot key costs nothing, and rows stay where they are while Spark finds that
    table small enough to broadcast.
    """
    added = ["size", "text_crc32", "law", "shard", "slot", "grown_shard", "_part", "_place"]
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    columns = [c for c in keep or docs.columns if c not in added]
    both = jump_shards(F.col(key).cast("long"), n_shards, n_shards + 1)
    placed = (
        docs.withColumn("_both", both)
        .withColumns({
            "size": F.octet_length(body).cast("long") + ROW_OVERHEAD,
            "text_crc32": F.crc32(body),
            "law": F.lit("key"),
            "shard": F.col("_both")[0].cast("int"),
            "grown_shard": F.col("_both")[1].cast("int"),
        })
        .select(*columns, *[c for c in added if c in ("size", "text_crc32", "law", "shard", "grown_shard")])
        .sortWithinPartitions("shard", *[c for c in (key,) if c in columns])
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", _PLACE_BITS).cast("int"))
    )
    placed = write_scratch(placed, "shards")
    cells = placed.groupBy("_part", "shard").agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    # Rows of one shard in all earlier partitions; one row per partition and shard.
    earlier = "sum(_rows) over (partition by shard order by _part rows between unbounded preceding and 1 preceding)"
    cells = cells.select("_part", "shard", "_first", F.coalesce(F.expr(earlier), F.lit(0)).alias("_before"))
    return (
        placed.join(cells, ["_part", "shard"])
        .withColumn("slot", F.col("_before") + F.col("_place") - F.col("_first"))
        .select(*columns, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    )
