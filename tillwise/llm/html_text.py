"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive and tags negative; a single scan finds the contiguous region
with the largest sum, which is the main content: long runs of words with few tags between them. The weights come from
labelled pages. The weight of a tag is how much denser it is among boilerplate words than among content words; an
attribute word (a part of a class, id or role) or an element counts as boilerplate, or as content, by the log odds of the
words below it. Words of links score what linked words are worth on the labelled pages. What stands in boilerplate elements
is no content. Where a page has elements that are known for content, their tags and the words outside them score nothing,
so that no box, list, table or text between two articles cuts them.

Inside known content one attribute word is weak evidence. Element kinds, roles and hidden elements still count. A word counts
on a box (an element that holds blocks) if the rest of its class or id names only structure, as in `comment-list` and unlike
`related-work`; on paragraphs, headings, cells and inline elements only words for adverts and the like count. Otherwise,
and for headers of articles without a heading, the element is boilerplate if most of its words are linked.

The text of the region, widened to whole blocks, is decoded, white space inside a block becomes one space, blocks are joined by a line feed.
Null and empty pages, and pages without words, have an empty text. Broken markup never fails: unclosed elements end with
their parents, unknown end tags are ignored, an unclosed comment or script runs to the end of the page.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from tillwise.llm.common import with_results

# Fixed values of HTML: kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noframes noembed template svg annotation annotation-xml select option button object canvas audio video".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 "
    "h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Blocks that hold running text; all other blocks are boxes.
TEXT_BLOCKS = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 hgroup li dt dd td th tr caption figcaption summary legend body html".split())
#: Words that name the structure of a box, not its purpose.
STRUCTURE = frozenset(
    "area article bar block body bottom box button buttons container content entry group inline inner item items left link links list main "
    "outer page panel post right section site slot top unit widget wrap wrapper".split()
)
#: Words for headers: the header of an article holds its title.
HEADERS = frozenset("header masthead top".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words that mark boilerplate on paragraphs and inline elements too.
CLEAR = frozenset(
    "ad ads advert advertisement breadcrumb breadcrumbs cookie cookies newsletter pager pagination promo sponsor sponsored".split()
)
ATTRIBUTE = re.compile(r"""(?<![^\s"'=<>/])([^\s"'=<>/]++)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]++))""")
QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|>|$)", re.I)
NOT_SHOWN = re.compile(r"display\s*+:\s*+none", re.I)
NAMES = re.compile(r"[a-z]+")
QUOTE_OR_END = re.compile(r"[\"'>]")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")

#: Labelled pages: what stands in an element with data-y is main content, all else is not.
LABELLED = (
    '<body><header class="site-header masthead top"><a href="/">Daily paper</a><form class="search"><input><label>Search this site</label></form></header>'
    '<nav class="menu navbar navigation"><ul><li><a href="/a">Home</a></li><li><a href="/b">World</a></li><li><a href="/c">Sports</a></li></ul></nav>'
    '<div class="breadcrumb breadcrumbs"><a href="/">Home</a> / <a href="/n">News</a></div>'
    '<article data-y class="article post entry"><h1>Rain is on its way</h1><p>After a long dry summer the <b>rain</b> comes back to the valley this week, and farmers are glad.</p>'
    "<p>The harvest was small. Many wells had run dry by the end of July, said the head of the water board.<br>Nobody had seen such a year before.</p></article>"
    '<div class="share social sharing"><a href="#">Share</a> <a href="#">Tweet</a></div>'
    '<section class="comments comment discussion" id="comments"><h3>Comments</h3><p class="comment reply">I saw this coming long ago.</p></section>'
    '<aside class="sidebar widget related"><h4>Related</h4><ul><li><a href="/x">Older news</a></li><li><a href="/y">Most read</a></li></ul></aside>'
    '<footer class="footer site-footer copyright">Copyright <a href="/i">Imprint</a> <a href="/p">Privacy</a></footer></body>',
    '<body><div class="cookie cookies consent notice banner gdpr">We use cookies to make this site better. <a href="/c">More</a></div>'
    '<div id="header" role="banner"><a href="/">Logo</a></div><div role="navigation" id="nav"><a href="/1">One</a> <a href="/2">Two</a></div>'
    '<div class="ad ads advert advertisement sponsored promo">Buy two shirts and get one for free today only.</div>'
    '<main role="main" data-y id="content" class="content main"><h2>How to bake bread</h2><p>Mix flour, water, salt and yeast, and knead the dough until it is smooth and elastic.</p>'
    "<ol><li>Let it rest for two hours in a warm place.</li><li>Shape it and let it rise again.</li></ol><blockquote>Good bread takes time, as my grandmother used to say.</blockquote>"
    "<table><tr><td>Flour</td><td>500 g</td></tr><tr><td>Water</td><td>350 g</td></tr></table><pre>oven at 240</pre></main>"
    '<form class="newsletter subscribe signup login"><label>Your address</label><p>Sign up for our letter and get news each week.</p></form>'
    '<div role="complementary" class="recommended recommendations teaser">You may also like <a href="/z">Ten cakes</a></div>'
    '<div class="pagination pager"><a href="?2">Next page</a></div><div id="footer" role="contentinfo"><a href="/t">Terms</a> All rights reserved</div></body>',
    '<body><div class="menu"><a href="/">Start</a><a href="/k">Contact</a></div><div class="alert popup modal overlay">Please turn off your blocker to go on.</div>'
    '<div data-y class="text body story site-content wrapper page top container search-result"><p>The old bridge was built by hand from stones of the river, and it still carries carts.</p>'
    "<p>Every spring the water rises up to the third arch. <i>It has never been higher</i>, people say, and they should know.</p><h3>The new bridge</h3>"
    "<p>Ten miles down the stream there is now a bridge of steel for the road.</p></div>"
    '<div class="disqus respond replies" id="respond"><p>First! Great read, thank you.</p><p>I do not agree at all with this.</p></div>'
    '<div class="sponsor banner ad">Cheap flights to all cities, book now.</div><div class="notice notification">This site is closed on Monday.</div></body>',
)


@dataclass
class Weights:
    """Scores of tags, and the names of elements and attribute words known for boilerplate or content."""

    tag: dict[str, float] = field(default_factory=dict)
    other_tag: float = -0.3
    word: float = 1.0
    linked: float = 0.1
    noise: frozenset[str] = frozenset()
    content: frozenset[str] = frozenset()


def pieces(page: str):
    """("text", string), ("open", name, attributes) and ("close", name), in page order, in one linear walk."""
    at, size = 0, len(page)
    ends: dict[str, bool] = {}  # quotes that occur no more
    while at < size:
        start = page.find("<", at)
        if start < 0:
            yield "text", page[at:], ""
            return
        if page.startswith("<!--", start):
            if start > at:
                yield "text", page[at:start], ""
            end = page.find("-->", start + 4)
            at = size if end < 0 else end + 3
            continue
        mark = page[start + 1 : start + 2]
        if mark in ("!", "?"):
            if start > at:
                yield "text", page[at:start], ""
            end = page.find(">", start)
            at = size if end < 0 else end + 1
            continue
        name = NAME.match(page, start + 2 if mark == "/" else start + 1)
        if name is None:  # a sign in the text
            yield "text", page[at : start + 1], ""
            at = start + 1
            continue
        if start > at:
            yield "text", page[at:start], ""
        end = name.end()
        while True:
            found = QUOTE_OR_END.search(page, end)
            if found is None:
                end = size
                break
            end = found.end()
            if found.group() == ">":
                break
            if found.group() not in ends:
                after = page.find(found.group(), end)
                if after < 0:
                    ends[found.group()] = True
                else:
                    end = after + 1
        tag = name.group().lower()
        if mark == "/":
            yield "close", tag, ""
        else:
            yield "open", tag, page[name.end() : end]
            if tag in RAW and page[end - 2 : end] != "/>":
                closing = re.compile(rf"</{re.escape(tag)}\s*/?>?", re.I).search(page, end)
                end = size if closing is None else closing.start()
        at = end


def features(tag: str, attributes: str) -> set[str]:
    """The element's name, the words of its class, id and role, and its roles once more with a mark."""
    found = {f"<{tag}>"}
    if attributes and "=" in attributes:
        for name, *values in ATTRIBUTE.findall(attributes):
            if name.lower() in ("class", "id", "role"):
                words = NAMES.findall("".join(values).lower())
                found.update(words)
                if name.lower() == "role":
                    found.update(f"@{word}" for word in words)
    return found


def tells(attributes: str, marks: frozenset[str]) -> bool:
    """Whether a class or id consists of at least one of the marks and otherwise of words of structure."""
    for name, *values in ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id"):
            for token in "".join(values).lower().split():
                words = set(NAMES.findall(token))
                if words & marks and words <= marks | STRUCTURE:
                    return True
    return False


@dataclass
class Element:
    """An open element: what it says of itself, how many words stand in it and in its links, and how many headings it has or is."""

    name: str
    attributes: str
    parent: int
    words: int = 0
    linked: int = 0
    headings: int = 0
    noise: bool = False
    content: bool = False
    link: bool = False


def is_hidden(attributes: str) -> bool:
    """Whether the element has the attribute `hidden` (not the word in some value), or a style or state that hides it."""
    if "hid" not in attributes.lower() and "none" not in attributes.lower():
        return False
    if HIDDEN.search(QUOTED.sub("", attributes)):
        return True
    given = [(name.lower(), "".join(values)) for name, *values in ATTRIBUTE.findall(attributes)]
    return any(name == "style" and NOT_SHOWN.search(value) or name == "aria-hidden" and value.lower() == "true" for name, value in given)


def judge(element: Element, parent: Element, weights: Weights) -> None:
    """Set whether the element is boilerplate, content and linked, by itself and by the element around it."""
    own = features(element.name, element.attributes)
    element.link = parent.link or element.name == "a"
    element.content = parent.content or bool(own & weights.content)
    found = own & weights.noise
    if parent.noise or element.name in RAW or element.name == "head" or is_hidden(element.attributes):
        element.noise = True
    elif found and element.name not in ("body", "html"):
        if not parent.content:
            element.noise = True
        elif any(x[0] in "<@" and x != "<header>" for x in found):
            element.noise = True
        else:
            box = element.name in BLOCK and element.name not in TEXT_BLOCKS
            marks = weights.noise - HEADERS if box else CLEAR
            titled = element.headings and found <= HEADERS | {"<header>"}
            element.noise = tells(element.attributes, marks) or not titled and 2 * element.linked > element.words


def walk(page: str, weights: Weights) -> list[tuple[str, str, Element]]:
    """("tag", name, element) and ("text", string, element) in page order; a tag belongs to its own element."""
    elements = [Element("", "", 0)]
    events: list[tuple[str, str, int]] = []
    stack: list[int] = [0]
    depth: Counter = Counter()

    def leave(name: str) -> None:
        while len(stack) > 1:
            last = elements[stack.pop()]
            depth[last.name] -= 1
            elements[last.parent].words += last.words
            elements[last.parent].linked += last.linked
            elements[last.parent].headings += last.headings
            if last.name == name:
                return

    for kind, value, attributes in pieces(page):
        if kind == "text":
            inside = elements[stack[-1]]
            if inside.name not in RAW:
                words = len(value.split())
                inside.words += words
                inside.linked += words if depth["a"] else 0
            events.append(("text", value, stack[-1]))
            continue
        if kind == "open" and depth["p"] and value in BLOCK:
            leave("p")
        if kind == "open" and value not in VOID:
            elements.append(Element(value, attributes, stack[-1], headings=int(value in HEADINGS)))
            stack.append(len(elements) - 1)
            depth[value] += 1
        events.append(("tag", value, stack[-1]))
        if kind == "close" and depth[value]:
            leave(value)
    leave("")  # all that was never closed
    for element in elements[1:]:  # parents come first
        judge(element, elements[element.parent], weights)
    return [(kind, value, elements[at]) for kind, value, at in events]


def fit(labelled: tuple[str, ...] = LABELLED) -> Weights:
    """Weights from labelled pages, by counting words and tags in and out of the marked elements."""
    words, tags = Counter(), Counter()
    below: dict[bool, Counter] = {True: Counter(), False: Counter()}
    tag_counts: dict[bool, Counter] = {True: Counter(), False: Counter()}
    for page in labelled:
        stack: list[tuple[str, set[str], bool]] = []
        for kind, value, attributes in pieces(page):
            marked = bool(stack) and stack[-1][2]
            if kind == "text":
                n = len(value.split())
                words[marked] += n
                for name in set().union(*(x[1] for x in stack)):
                    below[marked][name] += n
            elif kind == "open":
                marked = marked or "data-y" in attributes
                tags[marked] += 1
                tag_counts[marked][value] += 1
                if value not in VOID:
                    stack.append((value, features(value, attributes), marked))
            elif any(x[0] == value for x in stack):
                while stack.pop()[0] != value:
                    pass
    linked = {y: below[y]["<a>"] for y in (True, False)}
    weights = Weights(linked=(linked[True] + 0.5) / (linked[True] + linked[False] + 1))
    odds = {
        name: math.log((below[True][name] + 0.5) / (words[True] + 1)) - math.log((below[False][name] + 0.5) / (words[False] + 1))
        for name in below[True].keys() | below[False].keys()
    }
    inner = {"<body>", "<p>", "<a>", "<ul>", "<li>", "<div>", "<h3>", "<h4>", "<label>", "<section>"}  # hold either kind
    weights.noise = frozenset(x for x, y in odds.items() if y < -1 and x not in inner and below[True][x] == 0)
    weights.content = frozenset(x for x, y in odds.items() if y > 1 and x in ("<article>", "<main>"))
    for name in tag_counts[True].keys() | tag_counts[False].keys():
        dense = [(tag_counts[y][name] + 0.5) / (words[y] + 1) for y in (True, False)]
        weights.tag[name] = -min(1.0, max(0.05, 0.25 * math.log(1 + dense[1] / dense[0])))
    for name in ("p", "br", "b", "i", "em", "strong", "span", "h1", "h2", "h3", "h4", "h5", "h6"):  # never more than a word over a few of them
        weights.tag[name] = max(weights.tag.get(name, -0.1), -0.1)
    return weights


FITTED = fit()


def main_text(page: str | None, weights: Weights = FITTED) -> str:
    """The text of the best region of one page."""
    if not page:
        return ""
    events = walk(page, weights)
    known = any(x.content and not x.noise and kind == "text" and not value.isspace() for kind, value, x in events)
    best = total = 0.0
    begin, region = 0, (0, -1)
    for i, (kind, value, inside) in enumerate(events):
        if known and (kind == "tag" or not inside.content):
            score = 0.0
        elif kind == "tag":
            score = weights.tag.get(value, weights.other_tag)
        elif inside.noise:
            score = 0.0  # the words belong to the element, whose tags score
        else:
            score = len(value.split()) * (weights.linked if inside.link and not known else weights.word)
        if total <= 0:
            total, begin = 0.0, i
        total += score
        if total > best:
            best, region = total, (begin, i)
    first, last = region
    if last >= 0:  # a link at an end must not cut a block
        while first > 0 and not (events[first][0] == "tag" and events[first][1] in BLOCK):
            first -= 1
        while last + 1 < len(events) and not (events[last + 1][0] == "tag" and events[last + 1][1] in BLOCK):
            last += 1
    blocks: list[str] = []
    parts: list[str] = []

    def end_block() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            blocks.append(text)

    for kind, value, inside in events[first : last + 1]:
        if kind == "tag":
            if value in BLOCK:
                end_block()
            elif value == "br":
                parts.append(" ")
        elif not inside.noise and (inside.content or not known):
            parts.append(html.unescape(value))
    end_block()
    return "\n".join(blocks)


def extract(pages: DataFrame, column: str = "html", name: str = "text", weights: Weights = FITTED) -> DataFrame:
    """Add the main text of every page."""
    return with_results(pages, column, {name: pa.string()}, lambda found: [[main_text(x, weights) for x in found]])
