"""Main text of raw web pages by composite text density.

Every page is parsed on its own (a tolerant tag scanner that settles implied end
tags); Spark partitions the pages and an Arrow batch function maps html to text.

For each DOM node: ``C`` characters, ``T`` tags, ``LC`` link characters, ``LT`` link
tags in its subtree. The link-adjusted density is

    C/T * log_b( C/LC * T/LT ),  b = ln( C/(C-LC) * LC + LC_body/C_body * C + e )

(zero denominators count as 1). The density sum of a node adds its children's
densities, its own direct text being one more child. The node with the largest sum
is the core. The lowest density on the path from the body to the core is the
threshold. From the body down, every child that reaches the threshold keeps the subtree of
its largest density sum. Beside a kept part, a block below the threshold (heading, date,
caption, short paragraph) stays if it is not mostly links: text elements anywhere, other blocks
before a kept part; so does direct text with its inline elements. A core inside a ``main`` or
``article`` starts the same walk there instead of at the body (an ``article`` inside ``main`` when
it holds most of its text, so that teasers beside it go), and blocks behind the last kept part stay, too.
Inside what is kept, blocks below the threshold whose text is mostly links go.

Parts that are not the article (navigation, page headers and footers, asides, forms,
scripts, styles, adverts, notices, reader comments: by tag, ``role``, or a whole token of
``class``/``id``, or its known prefix, last part or consent word) carry no characters. Labels and buttons
outside forms are words of the sentence they stand in. A form that holds an ``article``
or ``main`` is not dropped, nor is any part that holds one when none stands outside such
parts. On a page without these elements a form stays when it holds most of the body's text outside
links, and a part by role or layout token when it holds four fifths of it. The text of a block has character references
decoded and white space runs as one space; blocks are joined by two newlines.

Defined results: null or empty html, and a page without article text, give the empty
string; broken markup (unclosed, stray or cut tags) is read as far as it goes; repeated
rows are extracted each; an empty table gives an empty result; other columns are kept out.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col

# Element names by role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split())
DROP = frozenset(
    "head script style noscript template iframe object embed svg canvas audio video select "
    "textarea input option menu dialog title xmp noembed noframes".split())
DROP_PARTS = frozenset("nav footer aside form header".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# Whole class or id tokens; a token of the second set is never around an article's text.
DROP_LAYOUT = frozenset(
    "banner nav navbar navigation menu breadcrumb breadcrumbs sidebar side footer header masthead notice notices alert modal "
    "overlay signup login share sharing social related recommended respond widget toolbar pagination pager skip "
    "site-header site-footer page-footer main-nav main-menu site-nav nav-menu top-nav top-bar skip-link skip-to-content "
    "related-posts related-articles related-links related-stories social-links social-media social-icons social-share "
    "share-buttons share-links share-bar left-sidebar right-sidebar discussion discussions".split())
DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion cookie cookies consent gdpr "
    "popup newsletter subscribe subscription comment comments commentlist reply replies disqus ad-slot ad-banner ad-box "
    "ad-container ad-unit ad-wrapper ad-block author-comments user-comments post-comments".split())
_PREFIX = re.compile(
    r"(?:ads|advert|advertisement|sponsor|sponsored|cookie|cookies|gdpr|newsletter|comment|comments|disqus|popup|promo)[-_]")
_LAYOUT_PREFIX = re.compile(r"(?:sidebar|navbar|breadcrumb|breadcrumbs|pagination)[-_]")
_CONSENT = re.compile(r"(?:^|[-_])(?:consent|cookie|cookies|gdpr)(?:[-_]|$)")
# a token's last part names what it is, unless the token says what a wrapper has or lacks
_LAST = re.compile(r"(?!(?:has|no|with|without)[-_]).+[-_](?:comments|discussion|notice|notices|ad|ads|advert|adverts|sidebar|popup|newsletter)$")
# Start tags that end an open element of the listed names.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody", "thead"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
         "option": {"select"}, "tbody": {"table"}, "tfoot": {"table"}}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>(?>(?:[^>\"']+|\"[^\"]*\"|'[^']*')*)|[^>]*)(?:>|\Z)", re.S)
_NAMES = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
KEEP, LAYOUT, FORM, PART, GONE = 0, 1, 2, 3, 4  # what an element is by itself
# Elements that are text by themselves, wherever they stand beside kept parts.
TEXT = frozenset("blockquote dl figcaption figure h1 h2 h3 h4 h5 h6 hgroup ol p pre table ul".split())
_BREAK = None


def _kind(tag: str, attrs: str, in_article: bool) -> int:
    """``KEEP``, or why the element is not the article; ``GONE`` without regard to what it holds."""
    if tag in DROP:
        return GONE
    if tag in DROP_PARTS and not (tag == "header" and in_article):
        return FORM if tag == "form" else PART
    if not attrs or tag in ("html", "body", "main"):
        return KEEP
    kind = KEEP
    for m in _NAMES.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if tag == "article":  # an article unless it is one reader's comment
            if name == "class" and not {"comment", "comment-body"}.isdisjoint(value.split()):
                return PART
            continue
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return PART
        if name == "role" and value in DROP_ROLES:
            kind = max(kind, FORM if value == "form" else LAYOUT)
        if name in ("class", "id") and not (name == "id" and tag in TEXT):  # ids of headings are their words
            for token in value.split():
                if token in DROP_WORDS or _PREFIX.match(token) or _CONSENT.search(token):
                    return PART
                if token in DROP_LAYOUT or _LAYOUT_PREFIX.match(token) or _LAST.match(token):
                    kind = max(kind, LAYOUT)
    return kind


class _Page:
    """Nodes in document order with their counts, and the events (text or block break) in page order."""

    __slots__ = ("tag", "parent", "chars", "links", "n_links", "first", "last", "events", "body", "kind", "size")

    def __init__(self):
        self.tag, self.parent, self.chars, self.links, self.n_links = ["#root"], [-1], [0], [0], [0]
        self.first, self.last, self.events, self.body = [0], [0], [], 0
        self.kind, self.size = [KEEP], [1]

    def open(self, tag: str, parent: int, kind: int = KEEP) -> int:
        self.tag.append(tag)
        self.kind.append(kind)
        self.size.append(1)
        self.parent.append(parent)
        for c in (self.chars, self.links, self.n_links, self.last):
            c.append(0)
        self.first.append(len(self.events))
        return len(self.tag) - 1


def parse(src: str) -> _Page:
    """One pass over the markup, then over the nodes: dropped parts leave no characters and no text."""
    page = _Page()
    stack, names = [0], ["#root"]
    skip_from = 0  # stack height at which a dropped part began (0: none)
    articles = anchors = 0
    pos, n, events = 0, len(src), page.events

    def pop():
        nonlocal skip_from, articles, anchors
        node, name = stack.pop(), names.pop()
        if skip_from:
            if len(stack) < skip_from:
                skip_from = 0
            return
        page.last[node] = len(events)
        articles -= name in ("article", "main")
        anchors -= name == "a"
        if name in BLOCK:
            events.append(_BREAK)

    def text(a: int, b: int):
        if skip_from or a >= b:
            return
        t = _html.unescape(src[a:b])
        k = len("".join(t.split()))
        events.append(t)
        if k:
            page.chars[stack[-1]] += k
            if anchors:
                page.links[stack[-1]] += k

    while pos < n:
        m = _TAG.search(src, pos)
        if not m:
            text(pos, n)
            break
        text(pos, m.start())
        pos = m.end()
        if end := m["end"]:
            end = end.lower()
            if end == "br":
                events.append(" ")
            elif end in names:
                at = len(names) - 1 - names[::-1].index(end)
                # an inline end tag does not close a block that began after it
                if end in BLOCK or BLOCK.isdisjoint(names[at + 1:]):
                    while len(stack) > at:
                        pop()
            continue
        if not (tag := m["start"]):
            continue
        tag, attrs = tag.lower(), m["attrs"] or ""
        if tag in BLOCK and "p" in names:
            at = len(names) - 1 - names[::-1].index("p")
            if not {"td", "th", "caption", "button", "object", "table"} & set(names[at + 1:]):
                while len(stack) > at:
                    pop()
        if tag in CLOSES:
            for at in range(len(names) - 1, 0, -1):
                if names[at] in SCOPE[tag]:
                    break
                if names[at] in CLOSES[tag]:
                    while len(stack) > at:
                        pop()
                    break
        if tag == "body" and not skip_from:
            while len(stack) > 1 and names[-1] != "html":  # an unclosed head ends here
                pop()
        elif tag == "body" and "head" in names:
            while "head" in names:
                pop()
        kind = GONE if skip_from else _kind(tag, attrs, articles > 0)
        dropped = kind == GONE
        if tag in RAW and tag not in VOID:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(src, pos)
            if not dropped:
                text(pos, close.start() if close else n)
            end_at = src.find(">", close.end()) if close else -1
            pos = end_at + 1 if end_at >= 0 else n
            continue
        if tag in VOID or attrs.rstrip().endswith("/") and tag not in BLOCK:
            if not skip_from:
                events.append(_BREAK if tag == "hr" else " " if tag == "br" else "")
                if tag not in DROP and tag != "br":
                    page.last[page.open(tag, stack[-1], kind)] = len(events)
            continue
        if dropped:
            if not skip_from:
                skip_from = len(stack) + 1
                events.append(_BREAK if tag in BLOCK else " ")
            stack.append(-1)
            names.append(tag)
            continue
        if tag in BLOCK:
            events.append(_BREAK)
        node = page.open(tag, stack[-1], kind)
        if tag == "a":
            anchors += 1
            page.n_links[node] = 1
        if tag in ("article", "main"):
            articles += 1
        if tag == "body" and not page.body:
            page.body = node
        stack.append(node)
        names.append(tag)
    while stack:
        pop()
    page.last[0] = len(events)
    _drop(page)
    return page


def _drop(page: _Page) -> None:
    """Empty the parts that are not the article; parts that hold it are taken back."""
    n, parent, kind = len(page.tag), page.parent, page.kind
    in_form = [False] * n
    for i in range(1, n):
        in_form[i] = in_form[parent[i]] or page.tag[i] == "form"
        if page.tag[i] in ("label", "button") and (in_form[i] or not page.chars[parent[i]]):
            kind[i] = GONE  # a control of its own, not a word of a sentence
    if not any(kind):
        return
    plain = [c - k for c, k in zip(page.chars, page.links)]  # characters outside links, and outside parts by tag
    chars, holds = list(page.chars), [False] * n
    for i in range(n - 1, 0, -1):
        p = parent[i]
        chars[p] += chars[i]
        plain[p] += plain[i] if kind[i] != PART else 0
        holds[i] = (holds[i] or page.tag[i] in ("article", "main")) and chars[i] > 0 and not (
            kind[i] == PART and page.tag[i] == "article")
        holds[p] = holds[p] or holds[i]
    # an article outside all parts (a form around it is like a div) leaves what other parts hold as teasers
    inside, free = [False] * n, False
    for i in range(1, n):
        inside[i] = inside[parent[i]] or kind[i] in (LAYOUT, PART)
        free = free or page.tag[i] in ("article", "main") and holds[i] and not inside[i]
    gone = [False] * n
    for i in range(1, n):
        if gone[parent[i]]:
            gone[i] = True
        elif kind[i]:
            if kind[i] == GONE:
                gone[i] = True
            elif holds[0]:
                gone[i] = not holds[i] or free and kind[i] != FORM
            else:
                gone[i] = kind[i] == PART or plain[i] <= (0.5 if kind[i] == FORM else 0.8) * plain[page.body]
            if gone[i]:
                for e in range(page.first[i], page.last[i]):
                    if page.events[e] is not _BREAK:
                        page.events[e] = " "
        if gone[i]:
            page.chars[i] = page.links[i] = page.n_links[i] = page.size[i] = 0


def select(page: _Page) -> list[tuple[int, int]]:
    """The ranges of events that are the main text, in page order."""
    n, parent = len(page.tag), page.parent
    chars, links, n_links, tags = list(page.chars), list(page.links), list(page.n_links), list(page.size)
    for i in range(n - 1, 0, -1):  # children follow their parents
        p = parent[i]
        chars[p] += chars[i]
        links[p] += links[i]
        n_links[p] += n_links[i]
        tags[p] += tags[i]
    body = page.body
    link_share = links[body] / max(chars[body], 1)

    def density(c: int, t: int, lc: int, lt: int) -> float:
        if not c:
            return 0.0
        base = math.log(c / max(c - lc, 1) * lc + link_share * c + math.e)
        return c / t * math.log(max(c / max(lc, 1) * t / max(lt, 1), 1.0)) / math.log(max(base, 1.0 + 1e-9)) if base > 1.0 + 1e-9 else c / t

    d = [density(chars[i], tags[i], links[i], n_links[i]) for i in range(n)]
    total = [density(page.chars[i], 1, page.links[i], page.n_links[i]) for i in range(n)]
    for i in range(1, n):
        total[parent[i]] += d[i]
    inside = [i for i in range(body, n)] if body else list(range(n))
    best = max(inside, key=lambda i: (total[i], -i))
    path = [best]
    while path[-1] != body and parent[path[-1]] >= 0:
        path.append(parent[path[-1]])
    threshold = min(d[i] for i in path)
    children: dict[int, list[int]] = {}
    for i in range(1, n):
        children.setdefault(parent[i], []).append(i)
    marked = [k for k, i in enumerate(path) if page.tag[i] in ("article", "main")]
    if marked:  # the walk starts at the outermost, or at an article that holds most of what that holds
        top = next((k for k in marked if page.tag[path[k]] == "article" and 2 * chars[path[k]] > chars[path[marked[-1]]]), marked[-1])
        path = path[:top + 1]
        threshold = min(d[i] for i in path)

    # the node of the largest sum in every subtree, and the subtrees that are kept
    largest = list(range(n))
    for i in range(n - 1, 0, -1):
        p = parent[i]
        if (total[largest[i]], -largest[i]) > (total[largest[p]], -largest[p]):
            largest[p] = largest[i]
    root = path[-1]
    reached, kept, holds = [False] * n, [False] * n, [False] * n
    for i in range(root, n):
        reached[i] = d[i] >= threshold and (i == root or reached[parent[i]])
        if reached[i]:
            kept[largest[i]] = True
    for i in range(n - 1, 0, -1):
        if kept[i] or holds[i]:
            holds[parent[i]] = True

    def whole(i: int) -> list[tuple[int, int]]:
        """A kept subtree without its blocks of links below the threshold."""
        cut, look = [], [i]
        while look:
            for c in children.get(look.pop(), ()):
                if page.tag[c] in BLOCK and d[c] < threshold and 2 * links[c] > chars[c]:
                    cut.append((page.first[c], page.last[c]))
                else:
                    look.append(c)
        at, ranges = page.first[i], []
        for a, b in sorted(cut):
            ranges.append((at, a))
            at = b
        return [*ranges, (at, page.last[i])]

    out, todo = [], [(root, 0, 0)]  # (node, 0, 0), or (-1, first, last) for a range
    while todo:
        i, a, b = todo.pop()
        if i < 0 or kept[i]:
            out += [(a, b)] if i < 0 else whole(i)
            continue
        below = children.get(i, [])
        parts = [c for c in below if kept[c] or holds[c]]
        inline = [c for c in below if page.tag[c] not in BLOCK and not holds[c]]
        line = page.chars[i] + sum(chars[c] for c in inline)
        line_stays = 2 * (page.links[i] + sum(links[c] for c in inline)) <= line
        at, steps = page.first[i], []
        for c in below:
            if line_stays:
                steps.append((-1, at, page.first[c]))
            at = page.last[c]
            if kept[c] or holds[c]:
                steps.append((c, 0, 0))
            elif page.tag[c] not in BLOCK:
                if line_stays:
                    steps.append((-1, page.first[c], at))
            elif 2 * links[c] <= chars[c] and (marked or page.tag[c] in TEXT or c < parts[-1]):
                steps.append((-1, page.first[c], at))
        if line_stays:
            steps.append((-1, at, page.last[i]))
        todo += reversed(steps)
    return out


def main_text(src: str | None) -> str:
    """The article text of one page."""
    if not src:
        return ""
    page = parse(src)
    blocks, parts, end = [], [], 0
    for first, last in [*select(page), (len(page.events), len(page.events))]:
        # a block break in what was left out still ends a block
        cut = [_BREAK] if any(e is _BREAK for e in page.events[end:first]) or first == len(page.events) else []
        end = last
        for e in [*cut, *page.events[first:last]]:
            if e is _BREAK:
                if parts:
                    t = " ".join("".join(parts).split())
                    if t:
                        blocks.append(t)
                    parts = []
            else:
                parts.append(e)
    if parts and (t := " ".join("".join(parts).split())):
        blocks.append(t)
    return "\n\n".join(blocks)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text)`` for every page row."""
    @F.pandas_udf("string")
    def to_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(main_text, na_action=None)

    return pages.select(col(id_col).alias("page_id"), col(url_col).alias("url"),
                        to_text(F.coalesce(col(html_col).cast("string"), F.lit(""))).alias("text"))
