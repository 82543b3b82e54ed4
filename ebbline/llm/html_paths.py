"""Main text of web pages by tag-path ratios.

A page is read into blocks of text, each with its path of tags from the root to
the block.  For every path the text length, the punctuation and the share of
link text are summed over its blocks and fused into one ratio.  Tags that never hold
an article bar what is below them; class names, ids and roles that seldom do are
a factor in the ratio, unless the element holds most of the text.  The ratios are
smoothed over the tree of paths: what counts for a block is how much of the
page's text lies in the containers around it.  An article or main element with
most of it is the article, or else the deepest container that is reached by
steps that leave nearly nothing out.  Where that is the page's body, the
paths whose own ratio is high enough tell where the article begins and ends, and
all between is kept: subheadings, lists, captions and cells have low ratios.

Every page is handled alone in its task, so the job is one scan.

Defined cases: a null or empty html, and a page without text, give the empty
string; comments and tags that never end are read to the end of the page, as
browsers do; repeated rows are extracted one by one; very long and very deep
pages take time and memory in proportion to their length.
"""
from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import texts_of

DOMINANT = 0.5      # share of the text that an article or main element holds at least
NEARLY_ALL = 0.95   # share of a container's text that one within it holds at least to take its place
MARK_FACTOR = 0.1   # on the ratio and the mass of what lies in an element with a listed word
MOST = 0.5          # share of the text from which on such an element is taken for the article's own
LOW_RATIO = 0.25    # of the mean ratio: from it on a path tells where the article begins and ends
PROSE = 200         # characters of a block from which on more length does not raise the ratio
MOST_DOTS = 0.05    # punctuation per character from which on more does not raise the ratio
MOSTLY_LINKS = 0.5  # share of link text from which on a list, cell or heading does not prolong the article

# Element kinds of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav
    noscript ol optgroup option p pre search section select summary table tbody td template tfoot th thead tr ul""".split())
CLOSES = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option",
          "tbody": "thead tbody tr td th", "tfoot": "thead tbody tr td th"}
STOPS = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table", "td": "tr table", "th": "tr table",
         "option": "select", "tbody": "table", "tfoot": "table"}
# Elements that can hold an article
CONTAINERS = frozenset("html body div section article main center details dir dl fieldset figure ol table tbody td tr ul".split())
# What prolongs an article beyond its first and last paragraph
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROLONGS = HEADINGS | frozenset("li dt dd td th caption figcaption blockquote pre".split())
# Tags and words of class names, ids and roles that mark what is not article text
NOT_ARTICLE = frozenset("""head script style noscript template nav menu footer aside form button select textarea option
    iframe object svg canvas audio video dialog search""".split())
NOT_ARTICLE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising banner banners breadcrumb
    breadcrumbs comment comments commentlist complementary consent contentinfo cookie cookies disqus disclaimer footer
    form gdpr header hidden login masthead menu modal nav navbar navigation newsletter notice notices notification
    outbrain overlay pager pagination popup privacy promo promoted promotion recommended related replies reply
    respond responses search share sharing sidebar sidebars signup skip social sponsor sponsored subscribe subscription
    taboola toolbar warning widget widgets""".split())

# Listed words that mark an element only in a name made of listed words alone
ONLY_ALONE = frozenset("""banner banners form header hidden modal overlay respond response responses search share
    sharing skip social warning widget widgets""".split())
# Words that say what a page has, so that the word after them is not what the element is
OF_THE_PAGE = frozenset("has no not with without".split())
# Words that make a header the site's
OF_THE_SITE = frozenset("site global top".split())
# Words of reader comments, which may well be longer than the article
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies reply".split())

MARKUP = re.compile(r"<(?:(/?)(?=[A-Za-z])|(?=[!?]))")
COMMENT = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
TAG_NAME = re.compile(r"[^\s/>]*+")
# attributes up to the end of the tag; stops at a quote behind an equals sign that is never closed
ATTRIBUTES = re.compile(r"""(?:[^=>]++|=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])))*+""")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
PARTS = re.compile(r"[-_\d]+|(?<=[a-z])(?=[A-Z])")
PUNCTUATION = re.compile(r"[.,;:!?…。、，！？]")


class Block(NamedTuple):
    element: int     # number of the element that holds it; 0 is the page
    text: str
    link: int        # characters of it inside links


class Page:
    """A page's blocks of text, its elements and the tree of their tag paths.

    Elements and paths are numbered from the page (0) on; each knows its parent's
    number, which is smaller, so that sums run up and properties down in one pass.
    """

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.parent, self.path, self.barred, self.mark = [0], [0], [False], [""]
        self.path_parent, self.path_tag, self.path_depth = [0], [""], [0]
        self._paths: dict[tuple[int, str], int] = {}

    def add(self, parent: int, tag: str, barred: bool, mark: str) -> int:
        above = self.path[parent]
        path = self._paths.setdefault((above, tag), len(self.path_tag))
        if path == len(self.path_tag):
            self.path_parent.append(above)
            self.path_tag.append(tag)
            self.path_depth.append(self.path_depth[above] + 1)
        self.parent.append(parent)
        self.path.append(path)
        self.barred.append(barred or self.barred[parent])
        self.mark.append(mark)
        return len(self.parent) - 1

    def path_of(self, b: Block) -> int:
        return self.path[b.element]


def summed_up(values: list, parent: list[int]) -> list:
    """Each node's value and those of all below it."""
    out = list(values)
    for i in range(len(out) - 1, 0, -1):
        out[parent[i]] += out[i]
    return out


def at_or_above(holds: list[bool], parent: list[int]) -> list[bool]:
    """Whether a node or one that it lies in holds."""
    out = list(holds)
    for i in range(1, len(out)):
        out[i] = out[i] or out[parent[i]]
    return out


def is_barred(tag: str, attributes: list[tuple[str, str]], in_article: bool) -> bool:
    if tag in NOT_ARTICLE or tag == "header" and not in_article:
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    return any(name == "hidden" or name == "aria-hidden" and value.lower() == "true"
               or name == "style" and re.search(r"display\s*:\s*none", value, re.I) is not None
               for name, value in attributes)


def mark_of(tag: str, attributes: list[tuple[str, str]], in_article: bool) -> str:
    """The listed word of a class, id or role (``comments-area``), or "".

    Words that also name parts of articles mark only in names of listed words
    alone; a word behind ``has`` or ``no`` tells of the page, not of the element.
    """
    if tag in ("html", "body", "article", "main") or tag == "header" and in_article:
        return ""
    for name, value in attributes:
        if name in ("class", "id", "role"):
            for token in value.split():
                parts = [x.lower() for x in PARTS.split(token) if x]
                if not OF_THE_PAGE.isdisjoint(parts):
                    parts = parts[:min(i for i, x in enumerate(parts) if x in OF_THE_PAGE)]
                alone = NOT_ARTICLE_WORDS.issuperset(parts)
                for x in parts:
                    if x in NOT_ARTICLE_WORDS and (alone or x not in ONLY_ALONE
                                                   or x == "header" and not OF_THE_SITE.isdisjoint(parts)):
                        return x
    return ""


def read_page(html: str) -> Page:
    """The page's blocks of text in order, read in one pass.

    Which elements are open is kept by tag, so that no step looks through the
    stack.  A tag whose quote is never closed ends at the next ``>``; without
    one it ends with the page, as comments do.
    """
    page = Page()
    stack: list[tuple[int, str]] = []          # number and tag of every open element
    open_at: dict[str, list[int]] = {}         # places of each tag in the stack
    open_blocks: list[int] = []                # places of blocks in the stack
    parts: list[str] = []
    link, at, end = 0, 0, len(html)

    def close_block() -> None:
        nonlocal link
        if parts:
            if text := " ".join(unescape("".join(parts)).split()):
                page.blocks.append(Block(stack[open_blocks[-1]][0] if open_blocks else 0, text, link))
            parts.clear()
        link = 0

    def pop_to(place: int) -> None:
        if open_blocks and open_blocks[-1] >= place:
            close_block()
        while len(stack) > place:
            _, tag = stack.pop()
            open_at[tag].pop()
            if tag in BLOCK:
                open_blocks.pop()

    def last_open(tags: str) -> int:
        return max((open_at[t][-1] for t in tags.split() if open_at.get(t)), default=-1)

    def pop_open(tags: str, stops: str) -> None:
        place = last_open(tags)
        if place > last_open(stops):
            pop_to(place)

    while at < end:
        m = MARKUP.search(html, at)
        piece = html[at:m.start()] if m else html[at:]
        if piece:
            parts.append(piece)
            link += len(piece) if open_at.get("a") else 0
        if not m:
            break
        if m[1] is None:
            at = COMMENT.match(html, m.start()).end()
            continue
        name_end = TAG_NAME.match(html, m.end()).end()
        close = ATTRIBUTES.match(html, name_end).end()
        if close < end and html[close] != ">":
            close = html.find(">", close)
        if not 0 <= close < end:
            break
        at = close + 1
        tag = html[m.end():name_end].lower()
        if m[1]:
            if open_at.get(tag):
                pop_to(open_at[tag][-1])
            continue
        if tag == "br" or tag in VOID and tag not in BLOCK:
            parts.append(" " if tag == "br" else "")
            continue
        if tag in BLOCK:
            close_block()
            if tag not in ("html", "body"):
                pop_open("p", "table td th li article section div body")
            if tag in CLOSES:
                pop_open(CLOSES[tag], STOPS[tag])
        if tag in VOID:
            continue
        if tag in RAW:
            close_tag = re.compile(rf"</{tag}\s*+>", re.I).search(html, at)
            at = close_tag.end() if close_tag else end
            continue
        attributes = [(n.lower(), "".join(v)) for n, *v in ATTRIBUTE.findall(html, name_end, close)]
        in_article = bool(open_at.get("article") or open_at.get("main"))
        number = page.add(stack[-1][0] if stack else 0, tag, is_barred(tag, attributes, in_article),
                          mark_of(tag, attributes, in_article))
        open_at.setdefault(tag, []).append(len(stack))
        if tag in BLOCK:
            open_blocks.append(len(stack))
        stack.append((number, tag))
    close_block()
    return page


def marked_elements(page: Page, blocks: list[Block]) -> list[bool]:
    """Which elements are, or lie in, one with a listed word.

    One that holds most of the blocks' text is the article's own and marks
    nothing; one of reader comments must hold nearly all of it.
    """
    held = [0] * len(page.parent)
    for b in blocks:
        held[b.element] += len(b.text)
    held = summed_up(held, page.parent)
    return at_or_above([mark != "" and size < (NEARLY_ALL if mark in COMMENT_WORDS else MOST) * held[0]
                        for mark, size in zip(page.mark, held, strict=True)], page.parent)


def path_ratios(page: Page, blocks: list[Block], marked: list[bool]) -> dict[tuple[int, bool], tuple[float, float]]:
    """Mass and fused ratio of every path, in marked elements and out of them.

    The mass is the text's length; the ratio the mean length (of a block up to
    ``PROSE``), more for punctuation, less for links.  Marks lower both.
    """
    sums: dict[tuple[int, bool], list[int]] = {}
    for b in blocks:
        s = sums.setdefault((page.path_of(b), marked[b.element]), [0, 0, 0, 0, 0])
        size = len(b.text)
        for i, v in enumerate((1, size, min(size, PROSE), len(PUNCTUATION.findall(b.text)), min(b.link, size))):
            s[i] += v
    return {(p, m): (size * (MARK_FACTOR if m else 1), held / n * (1 + 100 * min(dots / size, MOST_DOTS))
                     * (1 - linked / size) * (MARK_FACTOR if m else 1))
            for (p, m), (n, size, held, dots, linked) in sums.items()}


def low_ratio(ratios: dict[tuple[int, bool], tuple[float, float]]) -> float:
    """The ratio below which a path tells nothing of the article."""
    return LOW_RATIO * sum(mass * r for mass, r in ratios.values()) / sum(mass for mass, _ in ratios.values())


def article_container(page: Page, ratios: dict[tuple[int, bool], tuple[float, float]]) -> int:
    """The path of the article: the outermost article or main with most of the text, or the deepest container with nearly all.

    A container is left only for one within it that holds nearly all of its
    text, by plain length, and only if no heading and nothing like a paragraph is left behind.
    """
    low, tag = low_ratio(ratios), page.path_tag
    mass, telling = [0.0] * len(tag), [0] * len(tag)
    for (p, marked), (size, r) in ratios.items():
        mass[p] += size
        telling[p] += r >= low or not marked and tag[p] in HEADINGS
    below, telling = summed_up(mass, page.path_parent), summed_up(telling, page.path_parent)
    inner: dict[int, int] = {}      # of each path the one within it that holds nearly all of its text
    for p in range(len(tag) - 1, 0, -1):
        up = page.path_parent[p]
        if below[p] > 0 and below[p] >= NEARLY_ALL * below[up]:
            inner[up] = p
    named = [p for p in range(1, len(tag)) if tag[p] in ("article", "main") and below[p] >= DOMINANT * below[0]]
    if named:
        top = at = min(named, key=lambda p: (page.path_depth[p], -below[p]))
        among = set(named)
        while tag[top] == "main" and at in inner:
            at = inner[at]
            if below[at] < NEARLY_ALL * below[top] or telling[at] < telling[top]:
                break
            if at in among:
                top = at
        return top
    top = 0
    while top in inner and tag[inner[top]] in CONTAINERS:
        if tag[top] not in ("", "html") and telling[inner[top]] < telling[top]:
            break
        top = inner[top]
    return top


def article_range(page: Page, blocks: list[Block], high: list[bool]) -> tuple[int, int]:
    """First and last block of an article that lies straight in the body, by its paths of high ratio.

    The last h1 before them begins it; headings, lists, cells and quotes next to
    them belong to it, but not those of links nor a heading that nothing follows.
    """
    first, last = high.index(True), len(high) - 1 - high[::-1].index(True)
    in_heading = at_or_above([t in HEADINGS for t in page.path_tag], page.path_parent)
    in_prolonging = at_or_above([t in PROLONGS for t in page.path_tag], page.path_parent)

    def prolongs(b: Block) -> bool:
        return in_prolonging[page.path_of(b)] and b.link < MOSTLY_LINKS * len(b.text)

    at = last + 1
    while at < len(blocks) and prolongs(blocks[at]):
        if not in_heading[page.path_of(blocks[at])]:
            last = at
        at += 1
    while first and prolongs(blocks[first - 1]):
        first -= 1
    h1 = [i for i, b in enumerate(blocks) if page.path_tag[page.path_of(b)] == "h1"]
    if not any(first <= i <= last for i in h1):
        first = max((i for i in h1 if i < first), default=first)
    return first, last


def main_text(html: str) -> str:
    """The article's blocks, joined by newlines; time and memory grow with the page's length."""
    page = read_page(html)
    blocks = [b for b in page.blocks if not page.barred[b.element]]
    if not blocks:
        return ""
    any_mark = at_or_above([mark != "" for mark in page.mark], page.parent)
    top = article_container(page, path_ratios(page, blocks, any_mark))
    inside = at_or_above([p == top for p in range(len(page.path_tag))], page.path_parent)
    blocks = [b for b in blocks if inside[page.path_of(b)]]
    marked = marked_elements(page, blocks)
    ratios = path_ratios(page, blocks, marked)
    low = low_ratio(ratios)
    high = [ratios[page.path_of(b), marked[b.element]][1] >= low for b in blocks]
    # what is marked stays only with a high ratio of its own
    kept = [(b, h) for b, h in zip(blocks, high, strict=True) if h or not marked[b.element]]
    blocks, high = [b for b, _ in kept], [h for _, h in kept]
    if page.path_tag[top] in ("", "html", "body"):
        first, last = article_range(page, blocks, high)
        blocks = blocks[first:last + 1]
    return "\n".join(b.text for b in blocks)


def extract_text(pages: DataFrame) -> DataFrame:
    """All columns of ``pages`` and main_text; such a column is replaced."""
    pages = pages.drop("main_text")
    schema = T.StructType([*pages.schema.fields, T.StructField("main_text", T.StringType())])
    at = pages.columns.index("html")

    def run(batches):
        for b in batches:
            text = pa.array([main_text(h) for h in texts_of(b.column(at))], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, text], names=[*b.schema.names, "main_text"])

    return pages.mapInArrow(run, schema)


def query(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    from pyspark.sql import functions as F
    return extract_text(pages.select("page_id", "url", "html")).select(
        "page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))
