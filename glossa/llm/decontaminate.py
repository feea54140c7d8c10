"""Benchmark passages in documents, also with other numbers, names and units.

Words are made canonical twice: as literals (lower case, without outer punctuation) and as templates, in
which numbers, names and units become typed placeholders. Windows of a document's words are looked up in a
hash table of the benchmark's. Along each alignment of item and document the placeholders must stand
for the same things throughout. An item is found by its share of windows, by a long run of words, or by
nearly all its words in their places.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import keep_texts, with_text_columns
from glossa.llm.hashing import mix
from glossa.llm.html_text import STOP_WORDS


@dataclass(frozen=True)
class DecontaminationSettings:
    """``window`` words (shorter items: the whole item). ``coverage``: least share of an item's windows found.

    ``run``: consecutive words (or the whole item) on one alignment that are enough whatever the share.
    ``agree``: share of an item's words in their places on one alignment, but for one word put in or left out, that
    is enough too; items of ``least_template`` words or more are looked up by ``seed`` words for it.
    ``literals``: least words of a template window that are no placeholders. ``inconsistent``: largest share
    of placeholders that contradict others. ``slice_windows``: bound of the benchmark windows
    in a broadcast; a larger benchmark takes several passes over the documents.
    """

    window: int = 8
    coverage: float = 0.4
    run: int = 13
    agree: float = 0.85
    seed: int = 4
    literals: int = 4
    inconsistent: float = 0.1
    least_template: int = 8
    slice_windows: int = 1_000_000


# Units of measure and money, and number words.
UNITS = frozenset(
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers"
    " kilometre kilometres mg g kg t oz lb lbs gram grams kilogram kilograms pound pounds ton tons ounce ounces ml cl l"
    " liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks"
    " month months year years % percent °c °f degree degrees k hz khz mhz w kw v a j kj pa n usd eur gbp dollar dollars euro"
    " euros cent cents € $ £".split()
)
NUMBERS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen"
    " nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million".split()
)

# Stripped from both ends of a word; signs of units and money stay.
_EDGE = "!\"#&'()*+,-./:;<=>?@[\\]^_`{|}~«»‹›“”„‘’‚…–—·•¡¿"
_NUMBER_START = frozenset("0123456789€$£")
_NUMBER = re.compile(r"[€$£]?\d[\d.,:/]*")
_NUM, _NAME, _UNIT = 1, 2, 3
_PLACEHOLDERS = np.array([0, 0x6E756D, 0x6E616D65, 0x756E6974], dtype=np.uint64)


_HITS = "array<struct<item_id: long, kind: string, n_windows: long, coverage: double>>"
_HITS_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("kind", pa.string()), ("n_windows", pa.int64()), ("coverage", pa.float64())]))


def _word_id(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace")) | 1


# Words a task remembers before it starts anew.
MOST_WORDS = 300_000


class Vocabulary(dict):
    """Numbers words as they come; per number, the literal's hash, its kind and the literal itself."""

    def __init__(self) -> None:
        super().__init__()
        self.clear_all()

    def clear_all(self) -> None:
        self.clear()
        self.ids: list[int] = []
        self.kinds: list[int] = []
        self.words: list[str] = []
        self.filled = 0
        self.arrays = (np.empty(4096, np.uint64), np.empty(4096, np.int8))

    def __missing__(self, word: str) -> int:
        bare = word.strip(_EDGE)
        low = bare.lower()
        first = bare[:1]
        kind = 0
        if first in _NUMBER_START and _NUMBER.fullmatch(low) or low in NUMBERS:
            kind = _NUM
        elif low in UNITS:
            kind = _UNIT
        elif first != low[:1] and (len(bare) == 1 or bare[1:] != bare[1:].upper()) and low not in STOP_WORDS:
            kind = _NAME
        number = self[word] = len(self.ids)
        self.ids.append(_word_id(low) if low else 0)
        self.kinds.append(kind)
        self.words.append(low)
        return number

    def lookup(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.ids)
        if self.filled < n:
            if len(self.arrays[0]) < n:
                self.arrays = tuple(np.concatenate([a, np.empty(n, a.dtype)]) for a in self.arrays)
            for array, values in zip(self.arrays, (self.ids, self.kinds)):
                array[self.filled : n] = values[self.filled : n]
            self.filled = n
        return self.arrays[0][numbers], self.arrays[1][numbers]


@dataclass
class Canonical:
    numbers: np.ndarray  # of the vocabulary
    literal: np.ndarray
    kind: np.ndarray  # 0 for literals; a unit counts as one only behind a number
    template: np.ndarray


_DIGIT = re.compile(r"\d")
_JOINED = re.compile(r"(?<!\S)([€$£]?[+-]?\d[\d.,]*)([a-zA-Z°%]{1,3})(?=[\s.,;:!?)]|\Z)")


def canonical(text: str | None, vocabulary: Vocabulary) -> Canonical:
    """The words of a whole text; words of punctuation alone are left out, ``5km`` is two words."""
    text = text or ""
    if _DIGIT.search(text):
        text = _JOINED.sub(r"\1 \2", text)
    words = text.split()
    numbers = np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words))
    literal, kind = vocabulary.lookup(numbers)
    if not literal.all():
        keep = literal != 0
        numbers, literal, kind = numbers[keep], literal[keep], kind[keep]
    if len(kind):
        after = np.concatenate([[False], kind[:-1] == _NUM])
        kind = np.where((kind == _UNIT) & ~after, 0, kind)
    return Canonical(numbers, literal, kind, np.where(kind > 0, _PLACEHOLDERS[kind], literal))


def window_hashes(ids: np.ndarray, width: int) -> np.ndarray:
    n = len(ids) - width + 1
    if n < 1:
        return np.empty(0, np.uint64)
    total = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + ids[i : i + n]
    return mix(total)


@dataclass
class WindowTable:
    """Sorted window hashes of the benchmark: kind 0 literal, 1 template, 2 literal seed of a short item."""

    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray
    kind: np.ndarray
    widths: list[tuple[int, int]]  # kind and words of the windows
    names: list[int | None]  # item_id per item
    windows: dict[int, int]  # per item
    words: dict[int, list[str]]  # literal words per item
    kinds: dict[int, np.ndarray]
    ids: dict[int, tuple[np.ndarray, np.ndarray]]  # literals and templates per item
    maybe: np.ndarray  # by the top 20 bits


def window_table(items: list[tuple[int | None, str]], settings: DecontaminationSettings) -> WindowTable:
    """Items are numbered as they come; ``names`` has their ids, which may be null or repeat."""
    vocabulary, rows, widths = Vocabulary(), [], set()
    windows, words, kinds, ids = {}, {}, {}, {}
    for item, (_, text) in enumerate(items):
        c = canonical(text, vocabulary)
        width = min(settings.window, len(c.literal))
        if not width:
            continue
        widths.add((0, width))
        ids[item] = c.literal, c.template
        words[item], kinds[item] = [vocabulary.words[n] for n in c.numbers], c.kind
        literal = window_hashes(c.literal, width)
        windows[item] = len(literal)
        rows += [(h, item, j, 0) for j, h in enumerate(literal.tolist())]
        if len(c.literal) >= settings.least_template:
            widths.add((1, width))
            bare = np.convolve(c.kind == 0, np.ones(width, int), "valid")
            rows += [
                (h, item, j, 1) for j, h in enumerate(window_hashes(c.template ^ np.uint64(0xA5A5), width).tolist())
                if bare[j] >= settings.literals
            ]
            # With one word of fewer than two windows changed no window may be left, but half the item is.
            if len(c.literal) < 2 * settings.window:
                widths.add((2, settings.seed))
                seeds = window_hashes(c.literal ^ np.uint64(0x5EED), settings.seed)
                rows += [(h, item, j, 2) for j, h in enumerate(seeds.tolist())]
    rows.sort()
    hashes = np.array([r[0] for r in rows], dtype=np.uint64)
    maybe = np.zeros(1 << 20, dtype=bool)
    maybe[(hashes >> np.uint64(44)).astype(np.int64)] = True
    return WindowTable(
        hashes, *[np.array([r[i] for r in rows], dtype=np.int64) for i in (1, 2, 3)], sorted(widths),
        [name for name, _ in items], windows, words, kinds, ids, maybe,
    )


def _consistent(table: WindowTable, item: int, doc: Canonical, vocabulary: Vocabulary, shift: int, covered: list[int], settings) -> bool:
    """Whether along the alignment each name and unit of the item stands for one of the document, and names back."""
    pairs = [
        (int(table.kinds[item][j]), table.words[item][j], vocabulary.words[doc.numbers[j + shift]])
        for j in covered if table.kinds[item][j] and doc.kind[j + shift]
    ]
    wrong = 0
    there: dict = {}
    back: dict = {}
    for kind, a, b in pairs:
        # Equal numbers may become different and different ones equal; different names may not.
        first = kind == _NUM or there.setdefault((kind, a), b) == b
        second = kind != _NAME or back.setdefault((kind, b), a) == a
        wrong += not (first and second)
    return wrong <= settings.inconsistent * len(pairs)


def _runs(places: list[int], width: int) -> list[tuple[int, int]]:
    """First and last word (exclusive) of the runs of words that windows at ``places`` (in order) cover."""
    runs: list[tuple[int, int]] = []
    for j in places:
        if runs and j <= runs[-1][1]:
            runs[-1] = runs[-1][0], j + width
        else:
            runs.append((j, j + width))
    return runs


def _agreement(item: np.ndarray, doc: np.ndarray, shift: int) -> tuple[float, list[tuple[int, np.ndarray]]]:
    """Largest share of the item's words in their places in ``doc``, and these words by their shift.

    The words may move by one behind any place (a word put in) or before it (a word left out).
    """
    n = len(item)

    def equal(at: int) -> np.ndarray:
        out = np.zeros(n, dtype=bool)
        low, high = max(0, -at), min(n, len(doc) - at)
        if low < high:
            out[low:high] = item[low:high] == doc[low + at : high + at]
        return out

    same = {at: equal(at) for at in (shift - 1, shift, shift + 1)}
    words = np.flatnonzero(same[shift])
    best, found = len(words), [(shift, words)]
    for a, b in ((shift - 1, shift), (shift, shift - 1), (shift, shift + 1), (shift + 1, shift)):
        ahead = np.concatenate([[0], np.cumsum(same[a])])
        behind = np.concatenate([[0], np.cumsum(same[b])])
        total = ahead + behind[-1] - behind
        split = int(total.argmax())
        if total[split] > best:
            best = int(total[split])
            found = [(a, np.flatnonzero(same[a][:split])), (b, split + np.flatnonzero(same[b][split:]))]
    return best / n, found


def passages(text: str | None, table: WindowTable, vocabulary: Vocabulary, settings: DecontaminationSettings) -> list[tuple]:
    """(item, kind, windows found, share of the item's windows) of every benchmark item in the text.

    An item found by its words alone may have no whole window left: then both numbers are 0.
    """
    if len(vocabulary.ids) > MOST_WORDS:
        vocabulary.clear_all()
    doc = canonical(text, vocabulary)
    hits: dict[tuple[int, int], dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
    seeds: dict[tuple[int, int], set[int]] = defaultdict(set)
    width_of: dict[int, int] = {}
    ids_of = (doc.literal, doc.template ^ np.uint64(0xA5A5), doc.literal ^ np.uint64(0x5EED))
    for kind, width in table.widths:
        hashes = window_hashes(ids_of[kind], width)
        at_all = np.flatnonzero(table.maybe[(hashes >> np.uint64(44)).astype(np.int64)])
        # All places at once: most pass the filter by chance and are in no window of the benchmark.
        lows = np.searchsorted(table.hashes, hashes[at_all], "left")
        highs = np.searchsorted(table.hashes, hashes[at_all], "right")
        met = np.flatnonzero(lows < highs)
        for at, low, high in zip(at_all[met].tolist(), lows[met].tolist(), highs[met].tolist()):
            for r in range(low, high):
                if table.kind[r] == kind:
                    item, j = int(table.item[r]), int(table.place[r])
                    if kind == 2:
                        seeds[(item, 0)].add(at - j)
                    else:
                        hits[(item, kind)][at - j].append(j)
                        width_of[item] = width
    found = {}
    for item, kind in sorted({*hits, *seeds}):
        shifts = hits.get((item, kind), {})
        size = len(table.words[item])
        places: set[int] = set()
        enough = False
        for shift, at in shifts.items():
            runs = _runs(sorted(at), width_of[item])
            long = [(a, b) for a, b in runs if b - a >= min(settings.run, size)]
            if kind == 0 or _consistent(table, item, doc, vocabulary, shift, [j for a, b in runs for j in range(a, b)], settings):
                places.update(at)
                enough = enough or bool(long)
                continue
            for a, b in long:  # what contradicts may stand elsewhere on the alignment
                if _consistent(table, item, doc, vocabulary, shift, list(range(a, b)), settings):
                    places.update(j for j in at if a <= j < b)
                    enough = True
        share = len(places) / table.windows[item]
        if not enough and share < settings.coverage and size >= settings.least_template:
            for shift in {*shifts, *seeds.get((item, kind), ())}:
                agree, parts = _agreement(table.ids[item][kind], doc.template if kind else doc.literal, shift)
                enough = enough or agree >= settings.agree and (
                    kind == 0 or all(_consistent(table, item, doc, vocabulary, s, w.tolist(), settings) for s, w in parts)
                )
        if (enough or places and share >= settings.coverage) and (item not in found or share > found[item][3]):
            found[item] = (item, "template" if kind else "literal", len(places), share)
    return list(found.values())


def _slices(benchmark: DataFrame, settings: DecontaminationSettings) -> Iterator[list[tuple[int | None, str]]]:
    """Distinct benchmark items, with or without an id, in runs of bounded size."""
    part, size, last = [], 0, None
    for row in benchmark.select("item_id", "text").filter(F.col("text").isNotNull()).orderBy("item_id", "text").toLocalIterator():
        if row == last:
            continue
        last = row
        n = 2 * len(row["text"].split())
        if part and size + n > settings.slice_windows:
            yield part
            part, size = [], 0
        part.append((row["item_id"], row["text"]))
        size += n
    yield part


def contaminated(docs: DataFrame, benchmark: DataFrame, settings: DecontaminationSettings = DecontaminationSettings()) -> DataFrame:
    """(doc_id, item_id, kind, n_windows, coverage): benchmark items found in each row of ``docs``.

    * null or empty text, null item text: nothing is found; items under ``least_template`` words: literally only
    * repeated rows: found each time; texts that share an item_id or have none are items of their own, a row for each
    * empty tables: no rows; other columns are not read
    """
    out = None
    for items in _slices(benchmark, settings):
        sent = docs.sparkSession.sparkContext.broadcast(vars(window_table(items, settings)))

        vocabulary = Vocabulary()

        def find(texts: list, sent=sent, vocabulary=vocabulary) -> list:
            found = WindowTable(**sent.value)
            return [[[
                {"item_id": found.names[i], "kind": kind, "n_windows": n, "coverage": share}
                for i, kind, n, share in passages(t, found, vocabulary, settings)
            ] for t in texts]]

        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        part = with_text_columns(rows, "text", {"_hits": (_HITS, _HITS_ARROW)}, find).select("doc_id", F.inline("_hits"))
        out = part if out is None else out.union(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, settings: DecontaminationSettings = DecontaminationSettings()) -> DataFrame:
    """All rows and columns of ``docs`` but the rows in which a benchmark item is found."""
    out = docs
    for items in _slices(benchmark, settings):
        sent = docs.sparkSession.sparkContext.broadcast(vars(window_table(items, settings)))

        vocabulary = Vocabulary()

        def clean(texts: list, sent=sent, vocabulary=vocabulary) -> list[bool]:
            found = WindowTable(**sent.value)
            return [not passages(t, found, vocabulary, settings) for t in texts]

        out = keep_texts(out, "text", clean)
    return out
