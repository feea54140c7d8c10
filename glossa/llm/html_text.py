"""Main text of web pages by two passes of block rules.

The first pass classifies each block by stop-word density, length and link density, and by the elements
it stands in (menus, footers, asides, forms and the like are decided against, whatever they say). On a page
with few stop words, as in a language without a list here, length and link density decide alone. The second gives blocks that are too short or too odd to decide the label of the nearest decided neighbours.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from glossa.llm.common import with_text_columns

# Frequent function words of common languages.
STOP_WORDS = frozenset(
    # English
    "a about all also an and are as at be been but by can for from had has have he her his i if in into is it its"
    " more no not of on one or our out she so than that the their there they this to was we were what which who will with you"
    # German
    " aber als am auch auf aus bei das dass dem den der des die durch ein eine einen einer er es für hat ich ihr im"
    " ist mit nach nicht nur oder sich sie sind über um und vom von war wie wir wird zu zum zur"
    # French
    " au aux avec ce ces cette dans de du elle en est et il ils je la le les leur mais ne nous ou par pas plus pour"
    " que qui sa se ses son sont sur un une vous à"
    # Spanish
    " al como con cuando del ella ellos entre era esta este fue hay las lo los me mi muy nos o para pero por porque"
    " si sin sobre su sus también y ya".split()
)

# Fixed values of HTML: what an element means for the text around it.
_DROPPED = frozenset("head script style noscript template iframe object svg math canvas select textarea button audio video title datalist".split())
_RAW = frozenset("script style textarea title iframe noscript".split())
_AROUND = frozenset("nav footer aside form menu dialog".split())
_MAIN = frozenset(("article", "main"))
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BREAK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_SPACED = frozenset("br td th img wbr".split()) - {"wbr"}
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

# Words of class, id and role that mark what is not the article.
_UNWANTED = (
    r"(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|alert|popup|modal|overlay"
    r"|comments?|disqus|respond|replies|sidebar|side-bar|widget|menu|navbar|nav|navigation|breadcrumbs?|pagination|pager|toolbar"
    r"|footer|masthead|site-?header|page-?header|topbar|share|sharing|social|related|recommend\w*|newsletter|subscribe|signup|login"
    r"|contentinfo|complementary|search)"
)
_NOT_ARTICLE = re.compile(rf"(?:^|[^a-z0-9]){_UNWANTED}(?=$|[^a-z0-9])")
_COMMENT = re.compile(r"(?:^|[^a-z0-9])(?:comments?|replies|disqus)(?=$|[^a-z0-9])")
# Inside an article a class, id or role counts as a whole: these words alone, or with words of containers around them.
_CONTAINER = (
    r"(?:site|page|post|posts|article|articles|entry|js|inline|top|bottom|left|right|inner|outer|main|box|boxes|container|wrapper|wrap|block"
    r"|section|area|list|items?|links?|buttons?|icons?|bar|bars|unit|units|slot|form|panel|content|group|row|\d+)"
)
_WHOLLY_UNWANTED = re.compile(rf"(?:{_CONTAINER}-+)*{_UNWANTED}(?:-+(?:{_CONTAINER}|{_UNWANTED}))*")
_WHOLLY_COMMENT = re.compile(rf"(?:{_CONTAINER}-+)*(?:comments?|replies|disqus)(?:-+{_CONTAINER})*")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")


@dataclass(frozen=True)
class BlockRules:
    """Lengths in characters; densities as shares. See ``first_pass``."""

    short: int = 70
    long: int = 200
    few_stops: float = 0.12
    many_stops: float = 0.25
    links: float = 0.4


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    heading: bool
    around: bool  # inside an element that is never the article
    article: int  # number of the article or main element it stands in; 0: none
    label: bool | None = None
    odd: bool = False  # long, with few stop words


@dataclass
class _Open:
    name: str
    dropped: bool
    refused: bool  # by its own name or attributes
    around: bool  # refused, or inside what is
    article: int


def _marks(name: str, attributes: str, inside: bool) -> tuple[bool, bool]:
    """Whether the element's attributes say that it is hidden, and that it is not the article; ``inside`` one, where
    the words of a class or id may be the article's own subject (ids of headings and sections are made of their titles)."""
    if not attributes.strip():
        return False, False
    values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    hidden = "hidden" in values or values.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(values.get("style", "")))
    given = {k: html.unescape(values.get(k, "")).lower().replace("_", "-") for k in ("class", "id", "role")}
    if name in ("html", "body", "main"):
        return hidden, False
    if inside and name not in _MAIN:
        tokens = given["class"].split() + given["role"].split()
        titled = name in _HEADINGS or name == "section" or "section" in tokens
        return hidden, any(map(_WHOLLY_UNWANTED.fullmatch, tokens)) or bool(
            name not in _HEADINGS and (_WHOLLY_COMMENT if titled else _WHOLLY_UNWANTED).fullmatch(given["id"].strip())
        )
    named = " ".join(given.values())
    return hidden, bool((_COMMENT if name in _MAIN else _NOT_ARTICLE).search(named))


def parse_blocks(page: str) -> list[Block]:
    """The text blocks of a page in order. Tag soup is read in one pass: an end tag closes the innermost
    element of its name, and is ignored if there is none."""
    stack: list[_Open] = [_Open("", False, False, False, 0)]
    blocks: list[Block] = []
    pieces: list[str] = []
    linked = [0]
    articles = 0
    link_depth = 0

    def flush() -> None:
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            top = stack[-1]
            heading = any(o.name in _HEADINGS for o in stack[-3:])
            blocks.append(Block(text, min(linked[0], len(text)), heading, top.around, top.article))
        linked[0] = 0

    def add(raw: str) -> None:
        if raw and not stack[-1].dropped:
            text = html.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if link_depth:
                linked[0] += len(" ".join(text.split()))

    def close(at: int) -> None:
        nonlocal link_depth
        for gone in stack[at:]:
            link_depth -= gone.name == "a"
        del stack[at:]

    at, n = 0, len(page)
    while at < n:
        start = page.find("<", at)
        if start < 0:
            add(page[at:])
            break
        m = _TAG.match(page, start)
        if m is None:  # a lone "<" is text
            add(page[at : start + 1])
            at = start + 1
            continue
        add(page[at:start])
        at = m.end()
        if m[2] is None:
            continue
        name, top = m[2].lower(), stack[-1]
        if m[1]:
            if name in _BREAK:
                flush()
            elif name in _SPACED:
                pieces.append(" ")
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    if name not in _BREAK and any(o.name in _BREAK for o in stack[i + 1 :]) and name != "a":
                        break  # an inline end tag does not close blocks
                    close(i)
                    break
            continue
        if name in _BREAK:
            flush()
            if any(o.name == "p" for o in stack[-4:]):  # a block ends an open paragraph
                i = max(i for i, o in enumerate(stack) if o.name == "p")
                close(i)
        elif name in _SPACED:
            pieces.append(" ")
        for i in range(len(stack) - 1, max(0, len(stack) - 6), -1):
            if stack[i].name in _CLOSES.get(name, ()):
                close(i)
                break
            if stack[i].name in ("ul", "ol", "table", "dl", "select"):
                break
        if name in _VOID or m[0].endswith("/>"):
            continue
        if name in _RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else n
            if end:
                close_tag = page.find(">", at)
                at = close_tag + 1 if close_tag >= 0 else n
            continue
        top = stack[-1]
        hidden, unwanted = _marks(name, m[3], bool(top.article))
        article = top.article
        refused = name in _AROUND or unwanted or (name == "header" and not top.article)
        around = top.around or refused
        if name in _MAIN and not unwanted:
            if not top.article:
                articles += 1
                article = articles
            # A form around the whole page is no reason to refuse its article.
            around = any(o.refused and o.name != "form" for o in stack)
        stack.append(_Open(name, top.dropped or name in _DROPPED or hidden, refused, around, article))
        link_depth += name == "a"
    flush()
    return blocks


# A character of these scripts says about as much as three letters, and words have no blanks between them.
_DENSE = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\U00020000-\U0003ffff]")


def _length(text: str) -> int:
    return len(text) if text.isascii() else len(text) + 2 * len(_DENSE.findall(text))


def _stops(block: Block) -> float:
    words = block.text.lower().split()
    return sum(w.strip(".,;:!?\"'()«»“”") in STOP_WORDS for w in words) / len(words)


def few_stop_words(blocks: list[Block], rules: BlockRules) -> bool:
    """Whether the blocks that may be main text have few stop words as a whole."""
    size = stops = 0
    for b in blocks:
        if not b.around and not b.heading and b.linked <= rules.links * len(b.text) and _length(b.text) >= rules.short:
            size += _length(b.text)
            stops += _length(b.text) * _stops(b)
    return stops < rules.few_stops * size


def first_pass(block: Block, rules: BlockRules, few: bool = False) -> bool | None:
    """True: main text; False: not; None: left to the second pass. ``few``: see ``few_stop_words``."""
    if block.around:
        return False
    if block.linked > rules.links * len(block.text):
        return False
    size = _length(block.text)
    if size < rules.short or block.heading:
        return None
    stops = _stops(block)
    if stops >= rules.many_stops:
        return True
    if stops >= rules.few_stops:
        return True if size >= rules.long else None
    # Few stop words: a table, code or names, or another language. Where all is like that, it is the text.
    if few and not block.article:
        return True
    block.odd = size >= rules.long
    return None


def second_pass(blocks: list[Block]) -> None:
    """Undecided blocks take the label of the nearest decided blocks before and after.

    If these differ, blocks of an article and long ones are text and others are not. Headings go with what follows.
    Only neighbours in the same article count for its blocks, and refused elements are never neighbours
    there; an article without a decided block is text.
    """
    n = len(blocks)
    before: list[bool | None] = [None] * n
    after: list[bool | None] = [None] * n

    def counts(b: Block) -> bool:
        return b.label is not None and not (b.around and b.article)

    last: dict[int, bool] = {}
    for i, b in enumerate(blocks):
        before[i] = last.get(b.article)
        if counts(b):
            last[b.article] = b.label
    last = {}
    for i in range(n - 1, -1, -1):
        b = blocks[i]
        after[i] = last.get(b.article)
        if counts(b):
            last[b.article] = b.label
    for i, b in enumerate(blocks):
        if b.label is None:
            near = [x for x in ((after[i],) if b.heading and after[i] is not None else (before[i], after[i])) if x is not None]
            b.label = (any(near) if b.article or b.odd else all(near)) if near else bool(b.article)


def main_text(page: str | None, rules: BlockRules = BlockRules()) -> str:
    """The page's main text: blocks joined by newlines; empty for null, empty and textless pages."""
    if not page:
        return ""
    blocks = parse_blocks(page)
    few = any(not b.article and not b.around for b in blocks) and few_stop_words(blocks, rules)
    for b in blocks:
        b.label = first_pass(b, rules, few)
    second_pass(blocks)
    return "\n".join(b.text for b in blocks if b.label)


def extract_main_text(pages: DataFrame, rules: BlockRules = BlockRules(), column: str = "html") -> DataFrame:
    """All rows and columns of ``pages`` but ``column``, with text and n_chars (code points).

    Input columns named text or n_chars are replaced. Null or empty pages give the empty text; pages of
    any length are read whole; repeated rows give equal texts; an empty table gives no rows.
    """

    def extract(texts: list) -> list:
        found = [main_text(p, rules) for p in texts]
        return [found, [len(t) for t in found]]

    fields = {"text": ("string", pa.string()), "n_chars": ("long", pa.int64())}
    return with_text_columns(pages, column, fields, extract, rows=200).drop(*{column} - {"text"})
