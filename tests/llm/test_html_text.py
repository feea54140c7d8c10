from __future__ import annotations

import pytest

from glossa.llm.html_text import BlockRules, extract_main_text, first_pass, main_text, parse_blocks, second_pass

P1 = "The house that they had on the hill was old, and it was not for the people who came to it in the night."
P2 = "She said that it is what you can see from the road, but not all of it, and that is the way it was."
LIST = '<ul><li><a href="/a">First story of the day</a></li><li><a href="/b">Second story of the day</a></li></ul>'


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>t</title>{head}</head><body>{body}</body></html>"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("   \n ", ""),
        ("<p></p><br>", ""),
        (page(f"<article><h1>A title</h1><p>{P1}</p></article>"), f"A title\n{P1}"),
        # menus, footers, asides, forms, adverts, notices, comments
        (page(f"<nav>{P2}</nav><article><p>{P1}</p></article><footer>{P2}</footer>"), P1),
        (page(f"<header><h1>Site</h1></header><article><header><h1>Own title</h1></header><p>{P1}</p></article>"), f"Own title\n{P1}"),
        (page(f'<article><p>{P1}</p><aside>{P2}</aside><div class="ad-box">{P2}</div></article>'), P1),
        (page(f'<div class="cookie-notice">{P2}</div><div id="main"><p>{P1}</p></div>'), P1),
        (page(f'<article><p>{P1}</p></article><section id="comments"><p>{P2}</p><article class="comment"><p>{P2}</p></article></section>'), P1),
        (page(f"<form><label>{P2}</label><input><textarea>{P2}</textarea></form><article><p>{P1}</p></article>"), P1),
        (page(f"<form id='page'><article><p>{P1}</p></article></form>"), P1),
        # scripts, styles, comments, hidden text
        (page(f'<script>var t="</p>{P2}";</script><style>p{{}}</style><!-- {P2} --><article><p>{P1}</p></article>'), P1),
        (page(f'<article><p style="display: none">{P2}</p><p hidden>{P2}</p><p>{P1}</p></article>'), P1),
        # characters and white space
        (page("<article><p>Fish &amp; chips &#233;&#x41;&nbsp;and\n\t the &lt;b&gt; of  it &bogus;</p></article>"), "Fish & chips éA and the <b> of it &bogus;"),
        (page("<article><p>one<br>two</p><p>a<b>b</b>c</p></article>"), "one two\nabc"),
        # tag soup: open paragraphs and an element cut off
        (page("<article><p><b>one.<br><p>two.<p>three</article>"), "one.\ntwo.\nthree"),
        (f"<article><p>{P1}</p><p>cut &am", f"{P1}\ncut &am"),
        (f"<article><p>{P1}</p><a href=\"x", P1),
        ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
        # no article: block rules alone
        (page(f"<div>{LIST}</div><div><p>{P1}</p><p>So it was.</p><p>{P2}</p></div><div>{LIST}</div>"), f"{P1}\nSo it was.\n{P2}"),
        (page(f"<div>Top</div><div>{LIST}</div><p>{P1} {P2}</p><div>{LIST}</div><div>End</div>"), f"{P1} {P2}"),
        # odd blocks and tables of an article are text, link lists are not
        (page(f"<article><p>{P1}</p><p>{'qwrt | zxcv | ' * 20}</p>{LIST}<p>{P2}</p></article>"), f"{P1}\n{' '.join(('qwrt | zxcv | ' * 20).split())}\n{P2}"),
    ],
)
def test_pages(html, text):
    assert main_text(html) == text


POLISH = "Stary dom stał przy drodze, którą codziennie szli ludzie ze wsi, lecz nikt nie wiedział, kto kiedyś tam mieszkał."
CHINESE = "山上的老房子已经很旧了，住在那里的人都知道它不会永远屹立不倒，可是他们仍然每天晚上点亮灯火，等待远方的亲人回来。"
NAMES = ", ".join(f"Anna{i} Kowalska{i}" for i in range(20))
CODE = "def add(x, y):\n    return x + y\n" * 12


@pytest.mark.parametrize("text", [POLISH, CHINESE, NAMES])
def test_pages_of_few_stop_words_without_an_article(text):
    menu = '<div><a href="/a">Pierwsza strona</a> <a href="/b">Druga strona</a></div>'
    assert main_text(page(f"{menu}<div><p>{text}</p><p>{text} 2</p></div><nav>{text}</nav>{menu}")) == f"{text}\n{text} 2"


@pytest.mark.parametrize("odd", [NAMES, CODE])
def test_odd_blocks_of_a_page_without_an_article(odd):
    plain = " ".join(odd.split())
    assert main_text(page(f"<div>{LIST}</div><div><p>{P1}</p><pre>{odd}</pre><p>{P2}</p></div><div>{LIST}</div>")) == f"{P1}\n{plain}\n{P2}"
    assert main_text(page(f"<div>{LIST}</div><div><pre>{odd}</pre><p>{P2}</p></div><div>{LIST}</div>")) == f"{plain}\n{P2}"


@pytest.mark.parametrize(
    "own",
    [
        f"<section id='search-algorithms'><p>{P2}</p></section>", f"<div class='section' id='search'><p>{P2}</p></div>",
        f"<p class='social-history'>{P2}</p>", f"<div id='notice-of-change'>{P2}</div>",
    ],
)
def test_subjects_of_an_article_are_its_text(own):
    assert main_text(page(f"<article><p>{P1}</p>{own}</article>")) == f"{P1}\n{P2}"
    assert main_text(page(f"<article><h2 id='related-work'>Work</h2><p>{P1}</p></article>")) == f"Work\n{P1}"


@pytest.mark.parametrize(
    "mark", ["class='ads'", "class='x share-buttons'", "class='related_posts'", "id='comments'", "role='navigation'", "class='post-nav'"]
)
def test_marked_elements_of_an_article_are_not(mark):
    assert main_text(page(f"<article><p>{P1}</p><div {mark}>{P2}</div></article>")) == P1


def test_heading_goes_with_what_follows():
    blocks = parse_blocks(page(f"<h2>Story</h2><p>{P1} {P2}</p><h2>More</h2>{LIST}"))
    for b in blocks:
        b.label = first_pass(b, BlockRules())
    second_pass(blocks)
    assert [b.text for b in blocks if b.label] == ["Story", f"{P1} {P2}"]


def test_long_page_is_read_whole():
    body = "".join(f"<p>{P1} {i}</p>" for i in range(20_000))
    text = main_text(page(f"<article>{body}</article>"))
    assert text.count("\n") == 19_999 and text.endswith("19999")


def test_table(spark):
    rows = [(1, "u", page(f"<article><p>{P1}</p></article>"), "x"), (1, "u", None, "y"), (None, None, "<p>a", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract_main_text(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(1, "u", P1, len(P1)), (1, "u", "", 0), (None, None, "", 0)], key=repr
    )
    assert extract_main_text(df.limit(0)).collect() == []


def test_every_article_of_the_table(small):
    import html
    import re

    pages = small("pages").collect()
    got = {r.page_id: r.text for r in extract_main_text(small("pages")).collect()}
    for p in pages:
        article = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert got[p.page_id] == "\n".join(b for b in blocks if b)
