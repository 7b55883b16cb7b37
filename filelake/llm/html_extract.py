"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What HTML says about elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br img".split()
)
# A start of one of these ends an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
# Elements that a start of the same kind ends.
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
    "tfoot": {"tbody", "tr", "td", "th"},
}
LIMITS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
# Elements of one block of text, or of list and table items.
SINGLE = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd pre blockquote figcaption tr td th address center".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements, roles and words of class or id that never hold the article.
NEVER = frozenset(
    "head nav footer aside form button select option datalist menu dialog svg canvas object audio video map template "
    "math applet frameset frame iframe noscript script style textarea title noembed noframes xmp".split()
)
NEVER_ROLE = frozenset(
    "navigation banner contentinfo complementary search form menu menubar toolbar dialog alert alertdialog".split()
)
NEVER_WORD = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertis\w*|adsense|adbox|adslot|banners?|breadcrumbs?|comments?|commentlist|"
    r"disqus|cookies?|consent|gdpr|footers?|footnotes?nav|headers?bar|masthead|topbar|navbar|navs?|navigation|menus?|"
    r"notices?|popups?|modals?|overlay|newsletters?|subscribe|subscription|signup|login|promos?|promotions?|"
    r"promoted|sponsor\w*|sidebars?|sidenav|pagination|pager|"
    r"respond|skip-link|site-header|page-header|site-footer|toolbar|hidden|sr-only)(?:$|[\s_-])",
    re.I,
)
# Words that name such parts alone or beside a word for a part of a page ("related-posts"), and are part of a
# subject beside another ("related-work"): there the ratios of the paths decide.
TWOFOLD = frozenset(
    "related recommend recommended recommendation recommendations share sharing social search alert alerts widget "
    "widgets reply replies".split()
)
PART = frozenset(
    "article articles area bar block body bottom box btn button buttons container content entries footer form header "
    "heading icon icons inner input item items left link links list main media module news outer page pages panel post "
    "posts right row section site sites stories story tab tabs this title tool tools top topics wrap wrapper".split()
)
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*+(?:>|\Z)|<\?[^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WHITE = re.compile(r"[ \t\n\r\f\v \u0085  -     　]+")

# Smoothing of neighbouring paths, and the part of the mean fused ratio that content paths reach.
SMOOTHING = 1.0
THRESHOLD = 0.5


@dataclass(slots=True)
class Elements:
    """The block elements of a page by number, in the order of their start tags: parents come before children."""

    parent: list[int]
    tag: list[str]

    def last(self) -> list[int]:
        """The last element inside each element; those inside are numbered from its own number to this one."""
        last = list(range(len(self.parent)))
        for n in range(len(last) - 1, 0, -1):
            last[self.parent[n]] = max(last[self.parent[n]], last[n])
        return last

    def weights(self, content: list[Block]) -> list[int]:
        """Characters of the blocks inside each element."""
        weight = [0] * len(self.parent)
        for b in content:
            weight[b.element] += len(b.text)
        for n in range(len(weight) - 1, 0, -1):
            weight[self.parent[n]] += weight[n]
        return weight


@dataclass(slots=True)
class Block:
    """Text of one block: the numbers of its tag path, of the element around it and of the outermost element
    around it whose name is doubtful (0: none), and whether it is ruled out."""

    path: int
    element: int
    doubt: int
    never: bool
    heading: bool
    text: str
    linked: int


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(source)} if source.strip(" /\n\t\r") else {}


def _is_never(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in NEVER or (tag == "header" and not in_article) or "hidden" in attributes:
        return True
    if attributes.get("aria-hidden") == "true" or attributes.get("role", "").lower() in NEVER_ROLE:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", ""), re.I):
        return True
    if tag in ("html", "body", "article", "main", *HEADINGS):
        return False
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    return bool(NEVER_WORD.search(names)) or any(rest <= PART for rest in _twofold(names))


def _twofold(names: str) -> list[set[str]]:
    """For each class or id with a twofold word its other words, numbers aside."""
    words = [{w for w in re.split(r"[-_\d]+", name) if w} for name in names.lower().split()]
    return [w - TWOFOLD for w in words if w & TWOFOLD]


def _is_doubtful(attributes: dict[str, str]) -> bool:
    return bool(_twofold(f"{attributes.get('class', '')} {attributes.get('id', '')}"))


def blocks(page: str) -> tuple[list[Block], Elements]:
    """Blocks of text in page order, and the elements. Inline elements belong to the block around them."""
    found: list[Block] = []
    elements = Elements([0], [""])
    # A path is a number for each triple of the path above, a tag and its classes, numbers aside.
    paths: dict[tuple[int, str, str], int] = {}
    # Open block elements: (tag, number, path, ruled out, in the article, in a heading, doubtful one around), and how
    # many there are of a tag.
    stack: list[tuple[str, int, int, bool, bool, bool, int]] = [("", 0, 0, False, False, False, 0)]
    open_tags: Counter[str] = Counter()
    pieces: list[str] = []
    links = linked = 0
    skipped: list[str] = []
    at = 0

    def end_block() -> None:
        nonlocal linked
        text = WHITE.sub(" ", html.unescape("".join(pieces))).strip(" ")
        if text:
            _, number, path, never, _, heading, doubt = stack[-1]
            found.append(Block(path, number, doubt, never, heading, text, linked))
        pieces.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        pieces.append(text)
        if links:
            linked += len(text)

    def close(tags: set[str], limits: set[str]) -> None:
        if not any(open_tags[t] for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in limits:
                return
            if stack[i][0] in tags:
                end_block()
                open_tags.subtract(t for t, *_ in stack[i:])
                del stack[i:]
                return

    while at < len(page):
        mark = page.find("<", at)
        if mark < 0:
            if not skipped:
                add(page[at:])
            break
        if mark > at and not skipped:
            add(page[at:mark])
        m = TOKEN.match(page, mark)
        if m is None:
            if not skipped:
                add("<")
            at = mark + 1
            continue
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing = bool(m[1] or m[4])
        if tag in RAW and not closing:
            # Their content is text for another program: up to the end tag, or the end of the page.
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in INLINE:
            # An inline element that never holds text of the article hides what is in it.
            source = m[3] or m[6] or ""
            if skipped:
                if tag == skipped[0]:
                    if closing:
                        skipped.pop()
                    elif tag not in VOID:
                        skipped.append(tag)
            elif tag == "a":
                links = max(0, links - 1) if closing else links + 1
            elif not closing and tag not in VOID and source and _is_never(tag, _attributes(source), False):
                skipped.append(tag)
            continue
        skipped.clear()
        if closing:
            if open_tags[tag]:
                close({tag}, set())
            elif tag == "p":
                end_block()
            continue
        if tag in ENDS_P:
            close({"p"}, {"table", "td", "th", "button", "article", "section", "div", "body"})
        if tag in SIBLINGS:
            close(SIBLINGS[tag], LIMITS.get(tag, set()))
        end_block()
        if tag in VOID:
            continue
        links = 0
        above = stack[-1]
        attributes = _attributes(m[3] or m[6] or "")
        article = above[4] or tag in ("article", "main") or attributes.get("role", "").lower() in ("main", "article")
        classes = re.sub(r"\d+", "", " ".join(sorted(set(attributes.get("class", "").lower().split()))))
        path = paths.setdefault((above[2], tag, classes), len(paths) + 1)
        never = above[3] or _is_never(tag, attributes, above[4])
        number = len(elements.tag)
        doubt = above[6] or (number if _is_doubtful(attributes) else 0)
        stack.append((tag, number, path, never, article, above[5] or tag in HEADINGS, doubt))
        elements.parent.append(above[1])
        elements.tag.append(tag)
        open_tags[tag] += 1
    end_block()
    return found, elements


def path_scores(candidates: list[Block]) -> dict[int, float]:
    """Fused, smoothed ratios of the tag paths: characters and punctuation marks to each block of a path."""
    count: dict[int, list[float]] = {}
    for b in candidates:
        own = count.setdefault(b.path, [0, 0, 0])
        own[0] += max(0, len(b.text) - 2 * b.linked)
        own[1] += len(PUNCTUATION.findall(b.text))
        own[2] += 1
    paths = list(count)

    def smoothed(values: list[float]) -> list[float]:
        out = []
        for i in range(len(values)):
            near = range(max(0, i - 2), min(len(values), i + 3))
            weights = [math.exp(-((i - j) ** 2) / (2 * SMOOTHING**2)) for j in near]
            out.append(sum(w * values[j] for w, j in zip(weights, near)) / sum(weights))
        return out

    text = smoothed([count[p][0] / count[p][2] for p in paths])
    marks = smoothed([count[p][1] / count[p][2] for p in paths])
    return {p: t * (1 + m) for p, t, m in zip(paths, text, marks)}


def main_text(page: str | None) -> str:
    """Text of the article of one page, its blocks joined by line ends."""
    found, elements = blocks(page or "")
    candidates = [b for b in found if not b.never]
    if not candidates:
        return ""
    scores = path_scores(candidates)
    # The mean over characters: a page of long paragraphs asks more of a path than one of short ones.
    total = sum(len(b.text) for b in candidates)
    limit = THRESHOLD * sum(scores[b.path] * len(b.text) for b in candidates) / total
    chosen = {p for p, s in scores.items() if s >= limit}
    # A part with a doubtful name is content if most of its text is in chosen paths.
    for_it: Counter[int] = Counter()
    for b in candidates:
        for_it[b.doubt] += len(b.text) if b.path in chosen else -len(b.text)
    candidates = [b for b in candidates if not b.doubt or for_it[b.doubt] > 0]
    # The article is the innermost part of the page with nearly all text of the chosen paths: an article
    # or main element if one has it, else any that can hold several blocks. All in it belongs to it.
    content = [b for b in candidates if b.path in chosen]
    weight, last = elements.weights(content), elements.last()
    least = 0.8 * sum(len(b.text) for b in content)
    around = [e for e, w in enumerate(weight) if w >= least and w and elements.tag[e] not in SINGLE]
    article = max([e for e in around if elements.tag[e] in ("article", "main")] or around, default=0)
    inner = [b for b in candidates if article <= b.element <= last[article]]
    if elements.tag[article] in ("div", "section") and not any(b.heading for b in inner):
        # Its heading may stand before it in the element around both.
        outer = content[0].element
        while outer and (outer >= article or elements.tag[outer] in SINGLE):
            outer = elements.parent[outer]
        near = [b for b in candidates if outer <= b.element <= last[outer]]
        if elements.tag[outer] in ("div", "section") and all(b.heading or article <= b.element <= last[article] for b in near):
            inner = near
    # An article or main element says what the article is. Lists of links in another element are menus.
    stated = elements.tag[article] in ("article", "main")
    kept = [b for b in inner if stated or b.path in chosen or b.heading or 2 * b.linked <= len(b.text)]
    return "\n".join(b.text for b in kept)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text``, the main text of each page, and ``n_chars``, its code points.

    Blocks of text get the path of block elements and their classes from the root. For each path, characters
    outside links and punctuation marks per block are smoothed over neighbouring paths and multiplied; paths above a
    part of the mean are content. The innermost element with four fifths of the content is the article; its blocks
    are returned in page order. Where it is neither an article nor a main element, blocks outside content paths that
    are mostly links are menus. Footers, page headers, sidebars, forms, scripts and elements named after adverts,
    notices or comments are left out before; where a name may also tell a subject, as "related-work", the part is left
    out unless most of its text is in content paths.

    Character references are decoded, white space in a block becomes one space. Whole pages are read,
    broken and cut off ones too. A null or empty page and one without text have an empty text. Pages are
    taken one by one, so repeated rows get equal texts; no rows give no rows. ``text`` and ``n_chars`` replace
    columns of these names.
    """

    @F.pandas_udf("string")
    def extracted(htmls: pd.Series) -> pd.Series:
        return htmls.map(main_text, na_action=None)

    return pages.withColumn("text", extracted(F.col(html_col))).withColumn("n_chars", F.length("text").cast("long"))
