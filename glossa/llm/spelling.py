"""Spelling variants: words one edit apart, found by dynamic programming over a sorted vocabulary.

Method. The vocabulary is sorted; for every query word the sorted list is scanned with a banded edit-distance
matrix (cells more than one apart from the diagonal are never needed for a distance of one). The rows of a
candidate's prefix are kept, so the next candidate recomputes only the rows after its longest common prefix
with the previous one; once a row's smallest cell exceeds one edit, every candidate that shares that prefix
is skipped by a binary search in the sorted list.

Two words at distance one, both of at least ``least`` >= 6 code points, share their first three or their
last three code points; the vocabulary is therefore split into blocks by either, each block a Spark group,
and every pair is found in at least one block. Within a block only words that share half their code points,
and whose lengths differ by one at most, are scanned.
"""

from __future__ import annotations

import bisect

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.session import write_scratch

# Fixed values of the contract: letters of a run, and the rule that thins runs by their hash.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
THIN = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
FACTOR = 5
# Code points shared by all words of a block, from the start or from the end.
BLOCK = 3
_TOP = chr(0x10FFFF)


def word_occurrences(docs: DataFrame, least: int = 0) -> DataFrame:
    """One row (word) per maximal letter run of every whole text, A-Z lower-cased, thinned by its hash.

    The run's code point h % length is deleted where 199 divides h, the unsigned crc32 of the UTF-8
    text ``<doc_id>:<run>``; a null doc_id is written as the empty text. Null texts have no runs. Runs
    shorter than ``least`` code points, which cannot give a word of that length, are left out.
    """
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
        F.explode(F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(RUN), 0)).alias("_run"),
    ).filter(F.length("_run") >= least).select("_id", F.translate("_run", UPPER, LOWER).alias("_run"))
    h = F.crc32(F.concat("_id", F.lit(":"), "_run").cast("binary"))
    at = (h % F.length("_run")).cast("int")
    thinned = F.concat(F.substring("_run", F.lit(1), at), F.substring("_run", at + 2, F.length("_run")))
    return runs.select(F.when(h % THIN == 0, thinned).otherwise(F.col("_run")).alias("word"))


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """Distinct words of at least ``least_length`` code points and ``least_count`` occurrences: word, n."""
    words = word_occurrences(docs, least_length).filter(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def one_edit(query: str, words: list[str], start: int = 0, skip: str | None = None) -> list[str]:
    """Words of the sorted list ``words`` exactly one insertion, deletion or substitution away from ``query``.

    Only ``words[start:]`` are scanned, and none that starts with ``skip`` (a range of the sorted list).
    """
    found: list[str] = []
    if start >= len(words):
        return found
    m, far = len(query), 2
    # Cells behind the query's end are never read by those before it.
    padded = query + "\0\0"
    # rows[k]: distances of the candidate's prefix of length k to query[:j], for j = k - 1, k and k + 1.
    rows = [(far, 0, 1)]
    prefix = ""
    i, last = start, len(words)
    while i < last:
        word = words[i]
        if skip and word.startswith(skip):
            i = bisect.bisect_left(words, skip + _TOP, i + 1)
            continue
        common = 0
        for x, y in zip(prefix, word):
            if x != y:
                break
            common += 1
        del rows[common + 1:]
        prefix = word
        low, mid, high = rows[common]
        pruned = -1
        for k in range(common + 1, min(len(word), m + 1) + 1):
            char = word[k - 1]
            # Each cell: one deletion or insertion more, or the diagonal with a replacement if the code points differ.
            below = min(mid + 1, low + (padded[k - 2] != char), far)
            on = min(high + 1, below + 1, mid + (padded[k - 1] != char), far)
            above = min(on + 1, high + (padded[k] != char), far)
            low, mid, high = below, on, above
            rows.append((low, mid, high))
            if low >= far and mid >= far and high >= far:
                pruned = k
                break
        if pruned >= 0:
            # Every word that starts with this prefix is more than one edit away.
            i = bisect.bisect_left(words, word[:pruned] + _TOP, i + 1)
            prefix = word[:pruned]
            del rows[pruned:]
            continue
        if abs(m - len(word)) <= 1 and rows[len(word)][m - len(word) + 1] == 1:
            found.append(word)
        # Rows end behind the query's end.
        prefix = word[:len(rows) - 1]
        i += 1
    return found


def _block_pairs(block: pd.DataFrame) -> pd.DataFrame:
    """Pairs of a block, each found once: from its shorter word, or of two of one length from the smaller.

    Of a pair whose shorter word has ``size`` code points, the edit lies behind the first ``size // 2`` (then the words
    share those) or among them (then they share the last ``size - size // 2``). So a block is cut into parts by
    ``size`` and by that many first code points, or last ones where the block shares its last (side 1), and a
    word is scanned against its part alone. Side 1 skips words that share the query's first code points
    too: those pairs are found in the block of their first code points.
    """
    backward = bool(len(block)) and int(block["_side"].iloc[0]) == 1
    parts: dict[tuple[int, str], tuple[list[str], list[str]]] = {}
    for word in sorted(block["word"].tolist()):
        for size in (len(word), len(word) - 1):
            half = max(BLOCK, size // 2)
            shared = word[-max(BLOCK, size - half):] if backward else word[:half]
            parts.setdefault((size, shared), ([], []))[len(word) - size].append(word)
    left, right = [], []
    for (size, _), (words, longer) in parts.items():
        half = max(BLOCK, size // 2)
        for at, query in enumerate(words):
            skip = query[:half] if backward else None
            for near in (one_edit(query, words, at + 1, skip), one_edit(query, longer, 0, skip)):
                for other in near:
                    left.append(min(query, other))
                    right.append(max(query, other))
    return pd.DataFrame({"a": pd.Series(left, dtype=object), "b": pd.Series(right, dtype=object)})


def near_pairs(vocab: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b in code-point order, of vocabulary words exactly one edit apart; each pair once.

    A pair whose words share the first half of the shorter one comes from the block of their first ``BLOCK`` code
    points alone; any other pair (its edit in that half) from the block of their last ``BLOCK`` alone.
    """
    blocks = vocab.select("word", F.substring("word", 1, BLOCK).alias("_block"), F.lit(0).alias("_side")).unionByName(
        vocab.select("word", F.substring(F.reverse("word"), 1, BLOCK).alias("_block"), F.lit(1).alias("_side"))
    )
    return blocks.groupBy("_side", "_block").applyInPandas(_block_pairs, "a string, b string")


def spelling_variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, factor: int = FACTOR) -> DataFrame:
    """Every vocabulary word with its form (the near word of largest n, ties smallest, if that n >= ``factor`` times its own), root and counts.

    ``docs``: doc_id, text; other columns are ignored whatever their names. Null texts have no words, null
    doc_ids hash as the empty text, repeated rows count again, and very long texts count in whole. An
    empty table gives no rows. Returns word, form, root (the end of the chain of forms; the word itself if it has
    no form), n, n_near (0 if none), form_n (null without a form). Forms always have a larger n, so chains end.
    """
    vocab = vocabulary(docs, least_length, least_count)
    vocab = write_scratch(vocab, "vocabulary")
    pairs = write_scratch(near_pairs(vocab), "near-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    counted = both.join(vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("neg"), F.col("near").alias("near"))).alias("_best")
    )
    forms = vocab.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("_best.neg") >= factor * F.col("n"), F.col("_best.near")).alias("form"),
        F.when(-F.col("_best.neg") >= factor * F.col("n"), -F.col("_best.neg")).cast("long").alias("form_n"),
    )
    forms = write_scratch(forms, "forms")
    # Pointer doubling: each round replaces a word's root by its root's root, so chains of length L take log L rounds.
    roots = forms.select("word", F.coalesce("form", "word").alias("root"))
    while True:
        step = roots.alias("r").join(roots.alias("s"), F.col("r.root") == F.col("s.word")).select(
            F.col("r.word").alias("word"), F.col("s.root").alias("root"), (F.col("s.root") != F.col("r.root")).alias("_moved")
        )
        step = write_scratch(step, "roots")
        if not step.filter("_moved").limit(1).count():
            roots = step.drop("_moved")
            break
        roots = step.drop("_moved")
    return forms.join(roots, "word").select("word", "form", "root", "n", "n_near", "form_n")
