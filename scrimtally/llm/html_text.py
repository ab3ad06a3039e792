"""Main text of web pages by tag-path ratios.

A page is read once into blocks: runs of text between block-level tags, each
with the path of the tags from the root to it. Per path of a page the length of
the text outside links and its punctuation are averaged over the path's blocks;
both ratios are put on a log scale, added, smoothed along the page and weighed
down by the share of the path's text that links hold. A path is content when
its score reaches a share of the best one, so a path of links is none, in an
article either.

Paths are compared within one class: below an article element, below a main
element or a container named as content, or anywhere else. The class with most
text outside links counts, each path's text times its ratio and the class's
weight; an empty article element or a few teasers do not hide a page.

Menus, headers, footers, sidebars, notices, adverts, forms and reader comments
are known by their elements, roles and names, and their text is left out. Where
such a container holds most of the page's text and an article, it surrounds the
page, and its name says nothing about what is in it (``_surrounding``).

Cases: a null or empty page and a page without text give the empty text; broken
and cut-off markup never fails; repeated rows repeat their result; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrimtally.llm.base import columns

# shares of the best score that make a path content, by the class of its paths
SHARES = {"article": 0.05, "main": 0.05, "other": 0.55}
# weight of a class's text against that of others
WEIGHTS = {"article": 4, "main": 2, "other": 1}
# shares of the page's text from which a container that is left out by its name may surround the page
MOST, NEARLY_ALL = 0.5, 0.8
# titles are often links to their own page: so much of a heading's text counts as outside links
HEADING_TEXT = 0.5
KERNEL = (0.25, 0.5, 0.25)

# Elements and words of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(
    """annotation annotation-xml iframe noembed noframes noscript script style template textarea title xmp""".split()
)
# of these, an end in the opening tag counts; in SVG it counts for every element
FOREIGN = frozenset("annotation annotation-xml svg".split())
BLOCK = frozenset(
    """address article aside blockquote body button caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li
    main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th
    thead tr ul""".split()
)
# an opening tag ends these elements when they are open without their container in between
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# elements of HTML inside SVG; any other block or one of these ends an SVG that is still open
EMBEDDED = frozenset("desc foreignobject".split())
BREAKS = BLOCK | frozenset("b big br code em embed i img nobr ruby s small span strike strong sub sup tt u var".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6", "hgroup"))
# elements of running text: within content, words of their names say nothing about what surrounds it
TEXT = HEADINGS | frozenset("blockquote caption dd dt figcaption p pre td th tr".split())
DROPPED_TAGS = frozenset("aside button dialog footer form head menu nav search select".split())
DROPPED_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising alert aside banner breadcrumb breadcrumbs
    comment comments commentlist consent cookie cookies copyright discussion disqus footer form gdpr
    legal login masthead menu modal nav navbar navigation newsletter notice notices pager pagination
    popup promo promoted recommended related replies respond search share sharing sidebar signup
    social sponsor sponsored subscribe tagcloud teaser toolbar widget""".split()
)
DROPPED_ROLES = frozenset(
    "alert banner complementary contentinfo dialog form menu menubar navigation search".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist discussion disqus replies respond".split())
CONTENT_WORDS = frozenset("article articlebody content entry main post story".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE) for tag in RAW}
_ATTRIBUTE = re.compile(r"([^\s/>=\"'][^\s/>=]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")


class _Mark:
    """A container that is left out by its element or name: why, the class around it and the next one around it."""

    __slots__ = ("around", "kind", "number", "reason")

    def __init__(self, number: int, reason: str, kind: str, around: _Mark | None):
        self.number, self.reason, self.kind, self.around = number, reason, kind, around


class _Open:
    """An open element: its tag, the number of its path, the class of text in it and the innermost mark."""

    __slots__ = ("kind", "mark", "path", "tag")

    def __init__(self, tag: str, path: int, kind: str, mark: _Mark | None = None):
        self.tag, self.path, self.kind, self.mark = tag, path, kind, mark


def _attributes(attrs: str) -> dict[str, str]:
    """Values by lower-cased name; of a repeated name the first counts."""
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(attrs):
        found.setdefault(name.lower(), value[1:-1] if value[:1] in ("'", '"') else value)
    return found


def _closed(attrs: str) -> bool:
    """Whether an opening tag ends its element; a slash of an unquoted value does not."""
    return _ATTRIBUTE.sub("", attrs).endswith("/")


def _kind(tag: str, attrs: str, outer: str) -> tuple[str, str, str | None]:
    """Class of the text in an element, the class attribute that is part of its path, and why it is left out."""
    words, ids, role, hidden, names = set(), set(), "", False, ""
    if attrs.strip(" /"):
        for name, value in _attributes(attrs).items():
            if name == "role":
                role = value.lower()
            elif name == "style":
                hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
            elif name == "hidden":
                hidden = True
            elif name == "aria-hidden":
                hidden |= value.lower() == "true"
            elif name in ("class", "id", "itemprop"):
                (ids if name == "id" else words).update(w.lower() for w in _WORD.findall(value))
                names += f".{value}" if name == "class" else ""
    if outer == "hidden" or tag in ("html", "body"):
        return outer, names, None
    if hidden:
        return "hidden", names, None
    if outer == "heading" and tag in HEADINGS:
        return "article", names, None
    # ids of headings and sections are made from their titles
    asked = words | ids
    if tag in TEXT and outer in ("article", "main"):
        asked = set()
    elif tag == "section" and outer == "article":
        asked = words
    kind = outer
    if tag == "article" or outer == "article" or role == "article":
        kind = "article"
    elif tag == "main" or role == "main" or ((words | ids) & CONTENT_WORDS and tag in ("div", "section", "td")):
        kind = "main" if outer != "heading" else outer
    if asked & COMMENT_WORDS:
        return kind, names, "comments"
    if tag in DROPPED_TAGS or role in DROPPED_ROLES:
        return kind, names, "form" if tag == "form" else "element"
    if asked & DROPPED_WORDS:
        return kind, names, "name"
    if (tag == "header" or "header" in asked) and tag not in HEADINGS:
        # of an article's own header, the headings belong to it
        if outer == "article":
            return "heading", names, None
        return kind, names, "element" if tag == "header" else "name"
    return kind, names, None


Block = tuple[int, tuple[str, str, _Mark | None], str, int]


def blocks(page: str) -> list[Block]:
    """Blocks in page order: number of the tag path, place (class, innermost tag, mark), text, characters within links."""
    stack = [_Open("", 0, "other")]
    paths: dict[tuple[int, str], int] = {}
    found, parts, linked = [], [], [0]
    marks = 0

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            top = stack[-1]
            found.append((top.path, (top.kind, top.tag, top.mark), text, linked[0]))
        parts.clear()
        linked[0] = 0

    inline: list[str] = []
    # how many elements of a name are open: end tags of others search nothing
    opened: Counter = Counter()
    within_line: Counter = Counter()

    def close(upto: int) -> None:
        flush()
        opened.subtract(e.tag for e in stack[upto:])
        del stack[upto:]
        inline.clear()
        within_line.clear()

    def add(piece: str) -> None:
        if piece:
            parts.append(html.unescape(piece))
            if within_line["a"]:
                linked[0] += len(piece)

    at = 0
    # open elements of SVG that decide where it ends
    drawing: list[str] = []
    while token := _TOKEN.search(page, at):
        if not drawing:
            add(page[at : token.start()])
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        closed = (drawing or tag in FOREIGN) and token["attrs"].endswith("/") and _closed(token["attrs"])
        if tag in RAW and not token["end"]:
            if not closed:
                ended = _RAW_END[tag].search(page, at)
                at = ended.end() if ended else len(page)
            continue
        if tag == "svg" and not token["end"]:
            if not closed:
                drawing.append(tag)
            continue
        if drawing:
            if tag == "svg" or tag in EMBEDDED:
                if not token["end"]:
                    drawing += [] if closed else [tag]
                elif tag in drawing:
                    del drawing[len(drawing) - 1 - drawing[::-1].index(tag) :]
                continue
            if drawing[-1] in EMBEDDED or tag not in BREAKS:
                continue
            drawing.clear()
        if tag == "br":
            parts.append(" ")
        elif tag not in BLOCK:
            if token["end"]:
                while within_line[tag]:
                    last = inline.pop()
                    within_line[last] -= 1
                    if last == tag:
                        break
            elif tag not in VOID:
                inline.append(tag)
                within_line[tag] += 1
        elif token["end"]:
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i].tag == tag:
                    close(i)
                    break
        else:
            flush()
            ended, within = ENDS.get(tag, ((), ()))
            for i in range(len(stack) - 1, 0, -1) if any(opened[t] for t in ended) else ():
                if stack[i].tag in within:
                    break
                if stack[i].tag in ended:
                    close(i)
                    break
            # a block ends an open paragraph
            if stack[-1].tag == "p":
                close(len(stack) - 1)
            if tag in VOID:
                continue
            outer = stack[-1]
            kind, names, reason = _kind(tag, token["attrs"], outer.kind)
            mark = outer.mark
            if reason:
                marks += 1
                mark = _Mark(marks, reason, outer.kind, mark)
            key = (outer.path, tag + names)
            stack.append(_Open(tag, paths.setdefault(key, len(paths) + 1), kind, mark))
            opened[tag] += 1
    if not drawing:
        add(page[at:])
    flush()
    return found


def _smoothed(values: list[float]) -> list[float]:
    """A three-point kernel along the page; the ends count themselves twice."""
    padded = [values[0], *values, values[-1]]
    left, middle, right = KERNEL
    return [left * a + middle * b + right * c for a, b, c in zip(padded, padded[1:], padded[2:], strict=False)]


def _unlinked(text: str, linked: int) -> int:
    return max(0, len(text) - linked)


def _surrounding(found: list[Block]) -> set[int]:
    """Numbers of the marks that surround the page, with all marks around them.

    That is a container outside of articles with most of the page's text that holds an
    article or main element or is a form, and one left out for its name alone that holds
    nearly all text and other marks, as a page's layout does. Comments never do.
    """
    chars: Counter = Counter()
    kinds: dict[int, set[str]] = {}
    known: dict[int, _Mark] = {}
    for _, (kind, _, mark), text, linked in found:
        chars[mark.number if mark else 0] += _unlinked(text, linked)
        if mark:
            kinds.setdefault(mark.number, set()).add(kind)
        while mark and mark.number not in known:
            known[mark.number] = mark
            mark = mark.around
    total = sum(chars.values())
    layout = set()
    # an outer mark has a smaller number
    for number in sorted(known, reverse=True):
        if around := known[number].around:
            chars[around.number] += chars[number]
            kinds.setdefault(around.number, set()).update(kinds[number])
            layout.add(around.number)
    free = set()
    for number in sorted(known):
        mark = known[number]
        if mark.around and mark.around.number not in free or mark.kind not in ("main", "other") or mark.reason == "comments":
            continue
        inner = {"article", "main"} if mark.kind == "other" else {"article"}
        page = chars[number] > MOST * total and (mark.reason == "form" or bool(kinds[number] & inner))
        if page or mark.reason == "name" and number in layout and chars[number] > NEARLY_ALL * total:
            free.add(number)
    return free


def ratios(kept: list[Block]) -> dict[int, float]:
    """Per path: text and punctuation a block, on a log scale. Linked text counts for a fifth."""
    length, marks, count = Counter(), Counter(), Counter()
    for path, _, text, linked in kept:
        length[path] += _unlinked(text, linked) + 0.2 * min(linked, len(text))
        marks[path] += len(_PUNCTUATION.findall(text))
        count[path] += 1
    return {p: math.log1p(length[p] / n) + math.log1p(marks[p] / n) for p, n in count.items()}


def scores(kept: list[Block], ratio: dict[int, float]) -> dict[int, float]:
    """Per path: its ratio smoothed along the page, times the square of the share of its text outside links."""
    total, chars, free, count = Counter(), Counter(), Counter(), Counter()
    for (path, (_, tag, _), text, linked), value in zip(kept, _smoothed([ratio[b[0]] for b in kept]), strict=True):
        outside = _unlinked(text, linked)
        total[path] += value
        chars[path] += len(text)
        free[path] += max(outside, HEADING_TEXT * len(text)) if tag in HEADINGS else outside
        count[path] += 1
    return {p: total[p] / count[p] * (free[p] / chars[p]) ** 2 for p in count}


def content(found: list[Block]) -> list[str]:
    """The texts of the blocks whose path is content."""
    found = [b for b in found if b[1][0] in SHARES]
    free = _surrounding(found)
    kept = [b for b in found if not b[1][2] or b[1][2].number in free]
    if not kept:
        return []
    ratio = ratios(kept)
    score = scores(kept, ratio)
    weight: dict[str, float] = {}
    for path, (kind, *_), text, linked in kept:
        weight[kind] = weight.get(kind, 0) + WEIGHTS[kind] * _unlinked(text, linked) * ratio[path]
    # of equal weights, as of pages of links alone, the first class counts
    chosen = max((k for k in SHARES if k in weight), key=weight.__getitem__)
    top = max(score[b[0]] for b in kept if b[1][0] == chosen)
    return [b[2] for b in kept if b[1][0] == chosen and score[b[0]] >= SHARES[chosen] * top]


def main_text(page: str | None) -> str:
    return "\n".join(content(blocks(page or "")))


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(main_text)

    pages = columns(pages, (("page_id", "bigint"), ("url", "string"), ("html", "string")))
    texts = pages.select("page_id", "url", text_of(F.coalesce("html", F.lit(""))).alias("text"))
    return texts.withColumn("n_chars", F.char_length("text").cast("bigint"))
