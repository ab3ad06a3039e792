import os
import time

import pytest

from scrimtally.llm import html_text as op

SF_DIR = "/root/testdata/sf0.001"


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


LONG = "This is a sentence of the article, with some commas, and it goes on for a while. " * 3


def test_article_without_what_surrounds_it():
    text = op.main_text(
        page(
            f"""<header><h1>Site</h1></header><nav><ul><li><a href="/x">Menu, one</a><li><a>two</a></ul></nav>
            <div class="cookie-notice">{LONG}</div><!-- ad > <p>no</p> --><div id="topAd">Buy. Now.</div>
            <article><h1>Title &amp; more</h1><p><b>First  line<br>
            goes&nbsp;on<p>Is.</p><div class="ad">{LONG}</div><ul><li>a<li>b &lt;c&gt;</ul>
            <form><p>{LONG}</p></form><script>var t="</p><p>x";</script><style>p {{}}</style>
            <section class="comments"><p>{LONG}</p></section></article>
            <aside><p>{LONG}</p></aside><footer>&copy; us. {LONG}</footer>"""
        )
    )
    assert text == "Title & more\nFirst line goes on\nIs.\na\nb <c>"


def test_an_article_s_own_header_keeps_its_headings():
    text = op.main_text(page(f"<article><header><h1>Head</h1><p>by me</p></header><p>{LONG}</p></article>"))
    assert text == "Head\n" + LONG.strip()


def test_pages_without_an_article():
    links = "".join(f'<li><a href="{i}">link {i}</a></li>' for i in range(9))
    text = op.main_text(page(f"<div><ul>{links}</ul></div><div><p>{LONG}</p><p>{LONG}</p></div><div>Tiny</div>"))
    assert text == "\n".join([LONG.strip()] * 2)
    assert op.main_text(page(f"<article></article><div><p>{LONG}</p></div>")) == LONG.strip()
    assert op.main_text(page(f'<main><p>{LONG}</p><p>Yes.</p></main><div>other text, too</div>')) == LONG.strip() + "\nYes."


@pytest.mark.parametrize(
    "text, want",
    [
        (None, ""), ("", ""), ("<p", ""), ("plain words", "plain words"), ("a < b & c &am", "a < b & c &am"),
        ("<article><p>cut off &amp", "cut off &"), ("<article><p>x</p><p cla", "x"), ("<!-- open <p>x", ""),
        ("<script>if (a<b) {", ""), ("<article>" * 3000 + "deep", "deep"), ("</p></div><p>x", "x"),
        ("<article><p>one<h2>two</h2>three</article>", "one\ntwo\nthree"), ('<p title="a>b">x</p>', "x"),
        ("<article>a<span>b</span>c <a href=x>d</a>e</article>", "abc de"), ("<p><a " + '"' * 5001, ""),
    ],
)
def test_odd_pages(text, want):
    assert op.main_text(text) == want


def test_table(spark):
    rows = [(1, "u", "<article>é😀</article>", 5), (1, "u", "<article>é😀</article>", 5), (2, None, None, 5), (None, "v", "", 5)]
    data = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    got = sorted((tuple(r) for r in op.extract(data).collect()), key=str)
    assert got == sorted([(1, "u", "é😀", 2), (1, "u", "é😀", 2), (2, None, "", 0), (None, "v", "", 0)], key=str)
    assert op.extract(data.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")
def test_given_pages(spark):
    """The given pages hold one article element each: its blocks are the text."""
    import html
    import re

    got = {r.page_id: r.text for r in op.extract(spark.read.parquet(f"{SF_DIR}/pages.parquet")).collect()}
    for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect():
        inner = r.html.partition("<article>")[2].partition("</article>")[0]
        pieces = re.split(r"</?(?:p|h1)>", inner)
        pieces = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in pieces]
        assert got[r.page_id] == "\n".join(p for p in pieces if p)


@pytest.mark.parametrize(
    "text, want",
    [
        ('<article><p>One.</p><svg class="i"/><p>Two.</p></article>', "One.\nTwo."),
        ("<article><p>One.<svg-icon></svg-icon></p><title-bar></title-bar><p>Two.</article>", "One.\nTwo."),
        ("<article><p>1</p><svg><style/><title/><path d='<p>'/></svg><p>2</p></article>", "1\n2"),
        ("<article><p>1</p><svg><foreignObject><p>in</p></foreignObject><svg></svg>t</svg><p>2", "1\n2"),
        ("<article><div><svg><path></div><p>Two.</p><svg></svg>x</article>", "Two.\nx"),
        ("<article><svg class=a/><p>z</article>", "z"),
        ("<article><p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math>.</p><math/><p>Two.", "So x=1.\nTwo."),
        ("<article><math><mi>x</mi><annotation>no</annotation></math><p>y", "x\ny"),
        ('<article><p title="class=ad">x</p><div data-class="ad">y</div>', "x\ny"),
        ('<article><section id="related-work"><h2 id="share">A</h2><p id="legal">b', "A\nb"),
        ('<article><p>a</p><section class="comments"><p>no</p></section><div id="ad">no</div>', "a"),
    ],
)
def test_no_tail_is_lost(text, want):
    assert op.main_text(text) == want


def test_deep_pages_take_time_in_proportion():
    deep = "<div>" * 20_000 + "</section>" * 20_000 + "<p>One.</p>"
    lines = "<p>" + "<b>" * 20_000 + "</i>" * 20_000 + "<a>" * 20_000 + "</a>" * 20_000 + "Two.</p>"
    began = time.monotonic()
    found = [[b[2:] for b in op.blocks(page)] for page in (deep, lines)]
    assert time.monotonic() - began < 5
    assert found == [[("One.", 0)], [("Two.", 0)]]


def test_links_below_many_open_elements():
    # the end of an inner element never ends the link around it
    text = "<p>" + "<b>" * 100 + "<a>in<b>side</b> it</a> behind</p>"
    assert [b[2:] for b in op.blocks(text)] == [("inside it behind", 9)]


def menu(n, word="menu"):
    return "<ul>" + "".join(f'<li><a href="/{i}">{word} {i}</a></li>' for i in range(n)) + "</ul>"


PROSE = f"<p>{LONG}</p>" * 3
PROSE_TEXT = "\n".join([LONG.strip()] * 3)


@pytest.mark.parametrize(
    "body",
    [
        # a name or a form around the whole page
        f'<div class="layout has-sidebar"><article>{PROSE}</article><div class="sidebar">{LONG}</div></div><footer>{LONG}</footer>',
        f'<div class="legal-news"><article>{PROSE}</article></div>',
        f'<div class="layout has-sidebar"><div class="sidebar">side</div><div>{PROSE}</div></div>',
        f"<form>{PROSE}</form>",
        f'<a href="#x">Skip</a><form><nav>{menu(3)} more</nav><div>{PROSE}</div><footer>us</footer></form>',
        f'<article class="post sponsored">{PROSE}<form>{LONG}</form></article>',
        # teasers beside the text
        "".join(f'<article class="card"><h3>Card {i}</h3><p>A few words, that say what you can read.</p></article>' for i in range(3))
        + f"<main>{PROSE}</main>",
        # links within the article
        f'<article><p>{LONG}</p>{menu(8, "Buy thing number")}<p>{LONG}</p><div><a href="/x">Get 50% off, click here!</a></div><p>{LONG}</p></article>',
        # readers write more than the author
        f'<article>{PROSE}</article><ol class="comment-list"><li><article><p>{LONG * 9}</p></article></li></ol>',
    ],
)
def test_mixed_layouts(body):
    assert op.main_text(page(body)) == PROSE_TEXT


def test_left_out_containers_alone_give_no_text():
    for body in (f"<footer>{LONG}</footer>", f"<nav>{menu(3)}</nav>", f'<div class="cookie-notice">{LONG}</div>', f'<div class="comments">{LONG}</div>'):
        assert op.main_text(page(body)) == ""


def test_the_ratios_decide(monkeypatch):
    """Without text and punctuation a block, or without the share of links, the result is another."""
    unnamed = page(f"<div>{menu(9, 'see')}</div><div>{PROSE}</div><div><span>Tiny</span></div>")
    linked = page(f"<article>{PROSE}{menu(8)}<h2><a>Own title</a></h2><p>See <a>this</a>, too.</p></article>")
    want = [op.main_text(p) for p in (unnamed, linked)]
    assert want == [PROSE_TEXT, PROSE_TEXT + "\nOwn title\nSee this, too."]
    with monkeypatch.context() as patch:
        patch.setattr(op, "ratios", lambda kept: {b[0]: 1.0 for b in kept})
        assert op.main_text(unnamed) != want[0]
    with monkeypatch.context() as patch:
        patch.setattr(op, "_unlinked", lambda text, linked: len(text))
        assert op.main_text(linked) != want[1]


def test_scores_against_a_plain_version():
    """Path by path and block by block, as the module describes them."""
    import math
    import random
    import re

    dice = random.Random(5)
    for _ in range(200):
        found = []
        for _ in range(dice.randint(1, 30)):
            text = "".join(dice.choice("ab ,.") for _ in range(dice.randint(1, 60))).strip() or "x"
            tag = dice.choice(["p", "li", "h2"])
            found.append((dice.choice([1, 2, 3]) + 3 * (tag == "h2"), ("article", tag, None), text, dice.randint(0, len(text))))
        ratio = op.ratios(found)
        score = op.scores(found, ratio)
        plain = {}
        for path in {b[0] for b in found}:
            own = [b for b in found if b[0] == path]
            chars = sum(len(b[2]) - b[3] + 0.2 * b[3] for b in own) / len(own)
            marks = sum(len(re.findall("[,.]", b[2])) for b in own) / len(own)
            plain[path] = math.log(1 + chars) + math.log(1 + marks)
            assert ratio[path] == pytest.approx(plain[path])
        for path in plain:
            near = []
            for i, b in enumerate(found):
                if b[0] == path:
                    before, after = found[max(0, i - 1)], found[min(len(found) - 1, i + 1)]
                    near.append(plain[before[0]] / 4 + plain[path] / 2 + plain[after[0]] / 4)
            own = [b for b in found if b[0] == path]
            outside = sum(max(len(b[2]) - b[3], len(b[2]) / 2 if b[1][1] == "h2" else 0) for b in own)
            share = outside / sum(len(b[2]) for b in own)
            assert score[path] == pytest.approx(sum(near) / len(near) * share**2)
