"""Mixing documents to target domain weights, with DataFrame functions only.

A classifier learned on labelled rows gives each document a posterior over domains (its soft
membership). Documents then get nonnegative rates, fitted by projected-gradient least squares,
so that the expected tokens of each domain meet its target share.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import sample_per_group
from glossa.session import write_scratch

_WORD = "[^a-z\\x{80}-\\x{10FFFF}]+"


@dataclass(frozen=True)
class MixSettings:
    """``rows_per_domain``: bound of the labelled rows learned from, per domain, lowest hash first.

    ``buckets``: hashed words of the model. ``sharpness``: words' mean log-likelihood counts as that
    of so many words. ``grain``: posteriors are multiples of its inverse. ``min_rate``: 0 thins
    documents out, 1 keeps each at least once. ``tolerance``: largest relative miss of a target.
    """

    rows_per_domain: int = 1000
    buckets: int = 4096
    sharpness: float = 24.0
    grain: int = 1000
    min_rate: float = 0.0
    max_steps: int = 200
    tolerance: float = 1e-4
    seed: int = 17


def _words(text: Column) -> Column:
    """Lower-case words: runs of letters a-z and of characters beyond ASCII."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _WORD), lambda w: w != "")


def _bucket(word: Column, buckets: int) -> Column:
    return F.pmod(F.hash(word), F.lit(buckets))


def token_count(text: Column) -> Column:
    """Words between white space; null and blank texts have none."""
    trimmed = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x09-\\x0D]", " "))
    return F.when(trimmed == "", 0).otherwise(F.regexp_count(trimmed, F.lit("[^ ]+"))).cast("long")


def learn_domains(
    docs: DataFrame, labelled: DataFrame, domain: str, domains: list[str], settings: MixSettings
) -> dict[str, list[float]]:
    """Log-likelihood per hashed word of each domain, from at most ``rows_per_domain`` documents of each.

    ``labelled``: (doc_id, domain). The driver gets ``len(domains) * buckets`` numbers. A domain
    without labelled rows has the uniform model.
    """
    named = labelled.select("doc_id", F.col(domain).alias("_domain")).filter(F.col("_domain").isin(domains))
    sample = sample_per_group(named, "_domain", settings.rows_per_domain, settings.seed)
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    chosen = chosen.groupBy("doc_id", "_domain").agg(F.min("text").alias("text"))
    counts = (
        chosen.select("_domain", F.explode(_words(F.col("text"))).alias("w"))
        .groupBy("_domain", _bucket(F.col("w"), settings.buckets).alias("b"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    seen = {d: [0.5] * settings.buckets for d in domains}
    for row in counts.collect():
        seen[row["_domain"]][row["b"]] += row["n"]
    return {d: [math.log(n / sum(seen[d])) for n in seen[d]] for d in domains}


def posterior(text: Column, model: dict[str, list[float]], settings: MixSettings) -> Column:
    """Array of each domain's share of the document in steps of ``1 / grain``; uniform without words.

    In-row array functions: no explode, no join and no shuffle, whatever the ids are.
    """
    size = len(model)
    ids = F.transform(_words(text), lambda w: _bucket(w, settings.buckets))

    def score(ids: Column, weights: list[float]) -> Column:
        # One text literal, folded to a constant array; thousands of literals would be slow to plan.
        per_bucket = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
        total = F.aggregate(ids, F.lit(0.0), lambda a, i: a + F.get(per_bucket, i))
        return total / F.greatest(F.size(ids), F.lit(1)) * settings.sharpness

    # transform over one element names the bucket array, so it is evaluated once.
    scores = F.transform(F.array(ids), lambda x: F.array(*[score(x, w) for w in model.values()]))[0]
    powers = F.transform(F.array(scores), lambda s: F.transform(s, lambda v: F.exp(v - F.array_max(s))))[0]
    shares = F.transform(
        F.array(powers),
        lambda p: F.transform(p, lambda v: F.round(v / F.aggregate(p, F.lit(0.0), lambda a, b: a + b) * settings.grain)),
    )[0]
    # Rounding is settled on the largest share, so that shares sum to exactly one.
    return F.transform(
        F.array(shares),
        lambda s: F.transform(
            s,
            lambda v, i: (
                v + F.when(
                    i == F.array_position(s, F.array_max(s)).cast("int") - 1,
                    F.lit(settings.grain) - F.aggregate(s, F.lit(0.0), lambda a, b: a + b),
                ).otherwise(0.0)
            ) / settings.grain,
        ),
    )[0] if size > 1 else F.array(F.lit(1.0))


def _rate(membership: Column, steps: list[list[float]], floor: float) -> Column:
    """The rate after the projected-gradient ``steps``; each holds a correction per domain."""
    if not steps:
        return F.greatest(F.lit(1.0), F.lit(floor))

    def step(rate: Column, move: Column) -> Column:
        change = F.aggregate(F.zip_with(membership, move, lambda p, m: p * m), F.lit(0.0), lambda a, b: a + b)
        return F.greatest(rate + change, F.lit(floor))

    moves = F.array(*[F.array(*[F.lit(v) for v in s]) for s in steps])
    return F.aggregate(moves, F.greatest(F.lit(1.0), F.lit(floor)), step)


def fit_steps(members: DataFrame, targets: dict[str, float], settings: MixSettings) -> tuple[list[list[float]], list[float], float]:
    """Gradient steps that bring domain totals to their targets; the totals reached; tokens in all.

    Minimises the sum over domains of (total - target)^2 / (tokens of the domain). In the metric that
    weighs documents by their tokens the gradient's Lipschitz constant is at most 1, so steps of 1
    descend. A document's rate depends on its posterior alone, so documents of equal posterior are
    summed once and the steps run over distinct posteriors: exact, and far fewer rows. Each step
    is one distributed aggregation that returns one number per domain.
    """
    k = len(targets)
    grouped = write_scratch(
        members.groupBy("membership").agg(F.sum("tokens").alias("tokens")).filter(F.col("tokens") > 0), "posteriors"
    )

    def totals(steps: list[list[float]]) -> list[float]:
        rate = _rate(F.col("membership"), steps, settings.min_rate)
        row = grouped.select("membership", (rate * F.col("tokens")).alias("t")).agg(
            *[F.coalesce(F.sum(F.col("t") * F.col("membership")[i]), F.lit(0.0)).alias(f"s{i}") for i in range(k)]
        ).first()
        return [row[f"s{i}"] for i in range(k)]

    # Sums at rate 1, whatever the floor.
    row = grouped.agg(*[F.coalesce(F.sum(F.col("tokens") * F.col("membership")[i]), F.lit(0.0)).alias(f"s{i}") for i in range(k)]).first()
    here = [row[f"s{i}"] for i in range(k)]
    tokens = sum(here)
    shares = [v / sum(targets.values()) for v in targets.values()]
    scale = tokens
    if settings.min_rate > 0:
        # No document may fall below the floor, so the mix is as large as the most abundant domain needs.
        scale = max([tokens] + [settings.min_rate * n / s for n, s in zip(here, shares) if s > 0])
    goal = [scale * s for s in shares]
    steps: list[list[float]] = []
    reached = totals(steps)
    for _ in range(settings.max_steps):
        reachable = [(g, r, n) for g, r, n in zip(goal, reached, here) if n > 0]
        if all(abs(r - g) <= settings.tolerance * max(g, 1.0) for g, r, n in reachable):
            break
        steps.append([(g - r) / n if n > 0 else 0.0 for g, r, n in zip(goal, reached, here)])
        before, reached = reached, totals(steps)
        # Where the floor keeps a domain above its goal no step changes that.
        if all(abs(a - b) <= 0.01 * settings.tolerance * max(g, 1.0) for a, b, g in zip(before, reached, goal)):
            break
    return steps, reached, scale


def mix_to_targets(
    docs: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    domain: str = "lang",
    settings: MixSettings = MixSettings(),
    keep: list[str] | None = None,
) -> DataFrame:
    """All rows of ``docs`` with tokens, membership (array, order of ``targets``), rate and copies.

    ``keep`` names the columns of ``docs`` to return, all by default.

    ``labelled`` holds doc_id and the ``domain`` column; rows of other domains teach nothing.
    ``copies`` is the whole part of the rate, plus one for the documents whose hash falls below the rest, so
    the expected domain totals are those of the rates. Input columns of these names are replaced.

    * null, empty and wordless texts: uniform membership; without tokens they weigh nothing in the fit
    * repeated rows: the same rate and copies; empty table: no rows; no labelled rows: uniform membership
    * a target that no document can serve stays unmet
    """
    if not targets or min(targets.values()) < 0 or sum(targets.values()) <= 0:
        raise ValueError("targets must be nonnegative weights with a positive sum")
    model = learn_domains(docs, labelled, domain, list(targets), settings)
    added = {
        "tokens": token_count(F.col("text")),
        "membership": posterior(F.col("text"), model, settings),
        "_luck": F.pmod(F.xxhash64("doc_id", "text", F.lit(settings.seed)), F.lit(1_000_003)) / 1_000_003.0,
    }
    kept = [c for c in keep or docs.columns if c not in (*added, "rate", "copies")]
    scored = write_scratch(docs.select(*kept, *[value.alias(name) for name, value in added.items()]), "membership")
    steps, _, _ = fit_steps(scored.select("tokens", "membership"), targets, settings)
    rate = _rate(F.col("membership"), steps, settings.min_rate)
    extra = F.when(F.col("_luck") < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return scored.withColumn("rate", rate).withColumn("copies", (F.floor("rate") + extra).cast("int")).drop("_luck")


def apply_mix(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Each row of ``mix_to_targets`` as often as its copies say, with ``columns`` only."""
    repeated = mixed.filter(F.col("copies") > 0).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))
    )
    return repeated.select(*columns)
