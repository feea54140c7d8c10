"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.llm import (
    decontaminate, html_text, language, mixing, near_dup, nearest, prefix_trie, quality, sharding, suffix_dedup,
    spelling, toxicity, warc,
)
from glossa.llm.common import id_remainder, prepare, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Production parameters.
N_SHARDS = 40
TARGETS = {"en": 0.55, "de": 0.16, "fr": 0.16, "es": 0.13}
NEAREST = 20
NEAR_DUP = near_dup.NearDupSettings(shingle=3, percent=85)


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


@query
def op1_html_text(spark, sf):
    """Main text of every page."""
    return html_text.extract_main_text(table(spark, sf, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op2_nearest(spark, sf):
    """The 20 vectors of largest inner product for every twentieth vector."""
    return nearest.nearest(table(spark, sf, "embeddings"), F.col("id") % 20 == 0, NEAREST)


@query
def op3_warc(spark, sf):
    """Every page written to WARC archives and read back."""
    files = warc.archive_pages(table(spark, sf, "pages"))
    read = warc.read_archives(files, with_data=False).filter("last")
    return read.select(
        "page_id", F.col("bytes_so_far").alias("payload_bytes"), F.col("digest_so_far").alias("payload_digest"), "record_type", "refers_to"
    )


@query
def op4_mixing(spark, sf):
    """Rates at which documents meet the target shares of the languages, by predicted language."""
    docs = table(spark, sf, "documents")
    labelled = table(spark, sf, "labels").select("doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    mixed = mixing.mix_to_targets(docs, labelled, TARGETS, keep=["doc_id", "source"])
    shares = [F.col("membership")[i].alias(f"p_{name}") for i, name in enumerate(TARGETS)]
    return mixed.select("doc_id", "source", "tokens", *shares, "rate", "copies")


@query
def op5_quality(spark, sf):
    """Quality scores, learned from labels outside the held-out third."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    held_out = id_remainder("doc_id", 3) == 1
    model = quality.learn_quality(docs, labels.filter(~held_out))
    return quality.score_quality(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op6_suffix_dedup(spark, sf):
    """Bytes covered by 50-byte strings of an earlier document, taken out."""
    return suffix_dedup.remove_repeats(table(spark, sf, "documents"))


@query
def op7_decontaminate(spark, sf):
    """Benchmark items found in documents."""
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op8_language(spark, sf):
    """Predicted language, learned from documents outside the held-out quarter."""
    docs = table(spark, sf, "documents")
    held_out = id_remainder("doc_id", 4) == 2
    model = language.learn_languages(docs.filter(~held_out).select("text", "lang"))
    return language.predict_language(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "lang_set"
    )


@query
def op9_sharding(spark, sf):
    """All documents in 40 shards, and where they would be with 41."""
    docs = table(spark, sf, "documents")
    return sharding.assign_shards(docs, N_SHARDS, keep=["doc_id"])


@query
def op10_near_dup(spark, sf):
    """Components of documents whose three-word shingle sets are at least 85 % alike."""
    return near_dup.near_duplicates(table(spark, sf, "documents"), NEAR_DUP)


ORACLE: dict[str, str] = {}


@query
def op11_prefix_trie(spark, sf):
    """Trie of conversations whose first turns are grafted from the first of their group of twenty."""
    convs = table(spark, sf, "conversations")
    return prefix_trie.prefix_trie(prefix_trie.graft_prefixes(convs), members=convs.select("conv_id"))


@query
def op12_toxicity(spark, sf):
    """Toxicity scores, learned from labels outside the held-out quarter."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    held_out = id_remainder("doc_id", 4) == 2
    model = toxicity.learn_toxicity(docs, labels.filter(~held_out))
    return toxicity.score_toxicity(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op13_spelling(spark, sf):
    """Spelling variants of the words of all documents, each with its most common near form and root."""
    return spelling.spelling_variants(table(spark, sf, "documents"))
