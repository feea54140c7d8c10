"""From raw documents to sharded training text: five stages, each written and read again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.llm import decontaminate, mixing, near_dup, quality, sharding
from glossa.llm.common import id_remainder, prepare, repeats_an_id, table
from glossa.llm.queries import N_SHARDS, TARGETS
from glossa.session import write_scratch

# Five words and a similarity of 0.8.
NEAR_DUP = near_dup.NearDupSettings()
# Every document stays at least once; domains below their target are repeated.
MIX = mixing.MixSettings(min_rate=1.0)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. Labels of the held-out third stay unused.

    Nulls, empty texts, repeated rows and clashing columns: as in ``score_quality``.
    """
    taught = table(prepare(spark), sf_dir, "labels").filter(id_remainder("doc_id", 3) != 1)
    model = quality.learn_quality(docs, taught)
    return quality.keep_predicted(docs, model)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of each near-duplicate component; one row per doc_id.

    Rows without a doc_id stay. Of rows that repeat a doc_id the smallest, by text and then the other columns, stays.
    """
    prepare(spark)
    named = docs.filter(F.col("doc_id").isNotNull())
    if repeats_an_id(named.select("doc_id")):
        rest = ["text", *[c for c in docs.columns if c not in ("doc_id", "text")]]
        one = named.groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("_row")).select("doc_id", "_row.*")
        docs = write_scratch(one.select(*docs.columns).union(docs.filter(F.col("doc_id").isNull())), "named")
    dropped = near_dup.near_duplicates(docs, NEAR_DUP).filter(~F.col("kept")).select("doc_id")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.drop_contaminated(docs, table(prepare(spark), sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that the languages meet their target shares."""
    labelled = table(spark, sf_dir, "labels").select("doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    return mixing.apply_mix(mixing.mix_to_targets(docs, labelled, TARGETS, settings=MIX), docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot."""
    return sharding.assign_shards(docs, N_SHARDS)


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", keep_one_of_each_group),
    ("benchmark decontamination", drop_benchmark),
    ("mixing to target weights", mix),
    ("sharding", shard),
]

# Classifiers and sketches are not SQL; tests compare the stages with plain restatements.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written as Parquet and read again."""
    docs = table(prepare(spark), sf_dir, "documents")
    *others, (_, last) = STAGES
    docs = reduce(lambda d, stage: write_scratch(stage[1](spark, d, sf_dir), "stage"), others, docs)
    return last(spark, docs, sf_dir)
