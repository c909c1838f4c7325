"""Main text of web pages by scoring the tree of elements.

Markup is read into a tree of flat lists. Page furniture (menus, page headers and footers, sidebars,
notices, adverts, forms, scripts, styles, comment sections) is cut out by element, role and the
words of its class and id; words alone do not cut what holds an article, a main part or most of the
paragraph text, nor what is also named as content. Every paragraph passes points for its length and its commas to its parent
in full, to the grandparent by half and further up by less; a container's points are discounted by
the share of its text that is link text. The best container is kept, together with those of its
siblings that score well or are plain prose. Its blocks are written in page order; lists of links
stay where they stand between other blocks.

Defined cases: null or empty html gives an empty text; markup that stops anywhere, stray end tags
and unclosed elements are accepted; a page without a scoring container falls back to its article,
main part or body, and a page that is empty after that is read again without cuts by words; repeated rows are read one by one; other columns of the input are not touched.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from logwarden.llm.tables import small_batches

# Fixed sets of the HTML language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCKS - frozenset("body caption html legend optgroup option tbody td tfoot th thead tr summary".split())
# Start tag: the open elements it ends, and the elements at which the search for them stops.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "optgroup"}),
}
# Page furniture by element, by role, and by the words of class and id.
FURNITURE = frozenset(
    "nav aside footer form script style noscript template iframe object embed button input select option textarea svg "
    "canvas audio video dialog menu head title link meta base map fieldset label".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form "
                  "tablist status note".split())
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adslot adsense adbox sponsor sponsored sponsors promo promoted "
    "promotion banner cookie cookies consent gdpr notice notices notification popup modal overlay lightbox dialog alert "
    "sidebar sidebars aside rail nav navbar navigation navi menu menus submenu breadcrumb breadcrumbs crumbs toc pagination pager "
    "footer foot colophon masthead topbar toolbar skip comment comments commentlist disqus respond replies reply "
    "discussion share sharing social follow related recommended recommendations trending popular newsletter subscribe "
    "subscription signup login signin register search searchform form widget widgets hidden invisible paywall "
    "disclaimer copyright legal".split())
HEADER_WORDS = frozenset("header head sitehead siteheader pageheader".split())
REMARKS = frozenset("comment comments commentlist disqus respond replies reply discussion".split())
# Words that make a name speak of the layout around an element: has-sidebar, page-with-banner.
LAYOUT = frozenset("has no with without layout".split())
LIKELY = frozenset("article body content entry main page post text blog story".split())
TAG = re.compile(r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)|<[!?][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)", re.S)
CLOSED = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
STOP = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPLIT_NAME = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
COMMAS = re.compile("[,،、，]")
LEAST_PARAGRAPH = 25


class Page:
    """Elements in page order; each has a tag, a parent, attributes and a list of texts and child numbers."""

    def __init__(self, html: str):
        self.tags, self.parents, self.attributes, self.children = ["#root"], [-1], [""], [[]]
        self._last: dict[str, int] | None = None  # where the last quote of each kind stands, once a tag did not end
        self._stray: set[int] = set()  # opening quotes from which no tag end is reached
        self._open_tags: Counter[str] = Counter()
        self._read(html)

    def _tag_end(self, html: str, spot: int) -> int:
        """Where the tag ends whose attributes begin at ``spot``.

        That is after the first ``>`` outside quotes; without one, as when a quote never ends, after the first of all,
        so that the quote does not swallow the page. Quotes found to lead nowhere are remembered, and no quote is
        tried twice, so a page of open quotes takes time in proportion to its length.
        """
        if self._last is None:
            found = CLOSED.match(html, spot)
            if found:
                return found.end()
            self._last = {q: html.rfind(q) for q in "\"'"}
        at, passed = spot, []
        while (stop := STOP.search(html, at)) is not None:
            at = stop.start()
            if html[at] == ">":
                return at + 1
            if at in self._stray or at >= self._last[html[at]]:
                break
            passed.append(at)
            at = html.find(html[at], at + 1) + 1
        self._stray.update(passed)
        first = html.find(">", spot)
        return first + 1 if first >= 0 else len(html)

    def _open(self, tag: str, attributes: str, parent: int) -> int:
        self.tags.append(tag)
        self.parents.append(parent)
        self.attributes.append(attributes)
        self.children.append([])
        at = len(self.tags) - 1
        self.children[parent].append(at)
        return at

    def _read(self, html: str) -> None:
        stack, spot, find = [0], 0, TAG.search
        tags, children = self.tags, self.children
        lower = None
        while True:
            found = find(html, spot)
            if found is None:
                break
            if found.start() > spot:
                children[stack[-1]].append(unescape(html[spot:found.start()]))
            spot = found.end()
            name = found.group(2)
            if name is None:
                continue
            begin, spot = spot, self._tag_end(html, spot)
            attributes = html[begin:spot - 1] if html[spot - 1] == ">" and spot > begin else html[begin:spot]
            tag = name.lower()
            if found.group(1):
                if self._open_tags[tag]:
                    self._close(stack, tag)
                continue
            if tag in ENDS:
                ended, stop = ENDS[tag]
                for depth in range(len(stack) - 1, 0, -1):
                    open_tag = tags[stack[depth]]
                    if open_tag in stop:
                        break
                    if open_tag in ended:
                        self._pop(stack, depth)
                        if tag != "tr":
                            break
            if tag in CLOSES_P:
                for depth in range(len(stack) - 1, 0, -1):
                    open_tag = tags[stack[depth]]
                    if open_tag == "p":
                        self._pop(stack, depth)
                        break
                    if open_tag in BLOCKS:
                        break
            at = self._open(tag, attributes, stack[-1])
            if tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
                continue
            if tag in RAW:
                if lower is None:
                    lower = html.lower()
                end = lower.find("</" + tag, spot)
                spot = len(html) if end < 0 else end
            stack.append(at)
            self._open_tags[tag] += 1
        if spot < len(html):
            children[stack[-1]].append(unescape(html[spot:]))

    def _pop(self, stack: list[int], depth: int) -> None:
        for at in stack[depth:]:
            self._open_tags[self.tags[at]] -= 1
        del stack[depth:]

    def _close(self, stack: list[int], tag: str) -> None:
        block = tag in BLOCKS
        for depth in range(len(stack) - 1, 0, -1):
            open_tag = self.tags[stack[depth]]
            if open_tag == tag:
                self._pop(stack, depth)
                return
            if not block and open_tag in BLOCKS:
                return  # an inline end tag stays within its block
            if block and open_tag in ("td", "th", "article", "main") and tag not in ("article", "main", "table", "tr", "tbody", "body", "html"):
                return


def _named(attributes: str) -> dict[str, str]:
    return {m.group(1).lower(): unescape(m.group(2) or m.group(3) or m.group(4) or "") for m in ATTRIBUTE.finditer(attributes)}


def _words(attributes: dict[str, str]) -> set[str]:
    return {w.lower() for w in SPLIT_NAME.split(f"{attributes.get('class', '')} {attributes.get('id', '')}") if w}


def _furniture_words(attributes: dict[str, str]) -> set[str]:
    """Words of class and id that speak of furniture; none where one name says content and nothing else."""
    names = [{w.lower() for w in SPLIT_NAME.split(name) if w} for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split()]
    if any(name and name <= LIKELY for name in names):
        return set()
    return {w for name in names if not name & LAYOUT for w in name & (WORDS | HEADER_WORDS)}


def _page_forms(page: Page) -> frozenset[int]:
    """Forms that stand around the article, as on pages built as one form: most of the paragraphs, or an article, lie in them."""
    forms = frozenset(at for at, tag in enumerate(page.tags) if tag == "form")
    if not forms:
        return forms
    prose, holds = _weights(page, forms)
    return frozenset(at for at in forms if 2 * prose[at] > prose[0] or holds[at])


def _weights(page: Page, forms: frozenset[int] = frozenset()) -> tuple[list[int], list[bool]]:
    """Per element: characters of paragraphs, or of all text on a page without them, and whether an article or main part lies in it.

    ``forms`` are read like any container.
    """
    n = len(page.tags)
    prose, text, holds = [0] * n, [0] * n, [False] * n
    for at in range(n - 1, -1, -1):
        if page.tags[at] in FURNITURE and at not in forms:
            continue
        for child in page.children[at]:
            if isinstance(child, str):
                text[at] += len(" ".join(child.split()))
            else:
                text[at] += text[child]
                prose[at] += prose[child]
                holds[at] |= holds[child] or page.tags[child] in ("article", "main")
        if page.tags[at] in ("p", "pre", "blockquote"):
            prose[at] = text[at]
    return prose if prose[0] else text, holds


def _cut(page: Page, by_words: bool = True) -> tuple[list[bool], list[float]]:
    """Which elements are furniture, or lie in it, and the points that a container starts with."""
    n = len(page.tags)
    weights: tuple[list[int], list[bool]] | None = None
    forms = _page_forms(page)
    gone, start = [False] * n, [0.0] * n
    inside = [False] * n  # an article or main part
    heading = [False] * n  # holds a headline
    for at in range(n - 1, 0, -1):
        if page.tags[at] in ("h1", "h2"):
            heading[at] = True
        if heading[at] and page.tags[at] not in ("article", "main", "body"):
            heading[page.parents[at]] = True
    for at in range(1, n):
        tag, parent = page.tags[at], page.parents[at]
        inside[at] = inside[parent] or tag in ("article", "main")
        if gone[parent] or tag in FURNITURE and at not in forms:
            gone[at] = True
            continue
        if tag == "header":
            gone[at] = not (inside[parent] and heading[at])
        words: set[str] = set()
        if page.attributes[at].strip():
            named = _named(page.attributes[at])
            words = _words(named)
            style = named.get("style", "").replace(" ", "").lower()
            if tag not in ("html", "body", "article", "main"):
                gone[at] |= (named.get("role", "").lower() in ROLES or "hidden" in named
                             or named.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style)
                found = _furniture_words(named) if by_words and not gone[at] and words & (WORDS | HEADER_WORDS) else set()
                if found & WORDS or found and not (inside[parent] and heading[at]):
                    prose, holds = weights = weights or _weights(page, forms)
                    most = 2 * prose[at] > prose[0] and not found & REMARKS
                    # Comments can outgrow the article, and may be articles themselves.
                    gone[at] = not (most or holds[at] and not found & REMARKS)
            elif tag == "article" and words & {"comment", "comments", "reply", "ad", "ads", "advert", "promo", "sponsored", "related"}:
                gone[at] = True
            if named.get("role", "").lower() in ("main", "article"):
                tag = "main"
        start[at] = {"article": 30.0, "main": 25.0, "section": 3.0, "div": 5.0, "pre": 3.0, "td": 3.0, "blockquote": 3.0,
                     "ul": -3.0, "ol": -3.0, "dl": -3.0, "li": -3.0, "th": -5.0, "body": 0.0, "html": -25.0}.get(tag, 0.0)
        if words & LIKELY and tag != "body":
            start[at] += 25.0
    return gone, start


def _measure(page: Page, gone: list[bool]) -> tuple[list[int], list[int], list[int], list[bool]]:
    """Per element: characters, characters in links, commas, and whether a block lies in it."""
    n = len(page.tags)
    size, linked, commas, holds = [0] * n, [0] * n, [0] * n, [False] * n
    for at in range(n - 1, -1, -1):
        if gone[at]:
            continue
        for child in page.children[at]:
            if isinstance(child, str):
                size[at] += len(" ".join(child.split()))
                commas[at] += len(COMMAS.findall(child))
            elif not gone[child]:
                size[at] += size[child]
                linked[at] += size[child] if page.tags[child] == "a" else linked[child]
                commas[at] += commas[child]
                holds[at] |= holds[child] or page.tags[child] in BLOCKS
    return size, linked, commas, holds


def _chosen(page: Page, gone: list[bool], start: list[float]) -> list[int]:
    """The best container and those of its siblings that belong to it, in page order."""
    size, linked, commas, holds = _measure(page, gone)
    points: dict[int, float] = {}
    for at in range(1, len(page.tags)):
        if gone[at] or size[at] < LEAST_PARAGRAPH:
            continue
        if page.tags[at] not in ("p", "pre", "td", "blockquote", "li", "dd") and (holds[at] or page.tags[at] not in BLOCKS):
            continue
        if holds[at] and page.tags[at] != "p":
            continue
        density = linked[at] / size[at]
        worth = (1 + commas[at] + min(size[at] / 100, 3.0)) * (1 - density)
        up, level = page.parents[at], 0
        while up > 0 and level < 5:
            points[up] = points.get(up, start[up]) + worth / (1 if level == 0 else 2 if level == 1 else level * 3)
            up, level = page.parents[up], level + 1
    final = {at: value * (1 - linked[at] / max(1, size[at])) for at, value in points.items()}
    if not final:
        for tag in ("article", "main", "body"):
            found = [at for at in range(1, len(page.tags)) if page.tags[at] == tag and not gone[at] and size[at]]
            if found:
                return [max(found, key=lambda at: size[at])]
        return [0]
    best = max(final, key=lambda at: (final[at], -at))
    # Lists, rows and cells are parts of the container around them; an article around the best part is the article.
    up = best
    while up > 0:
        if page.tags[up] in ("article", "main"):
            best = up
            break
        up = page.parents[up]
    while page.tags[best] in ("li", "ul", "ol", "dl", "dd", "td", "tr", "tbody", "table", "p", "blockquote", "pre") and page.parents[best] > 0:
        best = page.parents[best]
    least = max(10.0, final.get(best, 0.0) * 0.2)
    if page.tags[best] in ("article", "main", "body"):
        least = max(least, final.get(best, 0.0) * 0.5)
    chosen = []
    for child in page.children[page.parents[best]]:
        if isinstance(child, str) or gone[child]:
            continue
        density = linked[child] / max(1, size[child])
        prose = page.tags[child] == "p" and size[child] > 80 and density < 0.25
        if child == best or final.get(child, 0.0) >= least and density < 0.3 or prose:
            chosen.append(child)
    return chosen


def _blocks(page: Page, gone: list[bool], tops: list[int]) -> list[str]:
    """Texts of the blocks below the chosen elements, white space collapsed, without empty ones."""
    size, linked, _, _ = _measure(page, gone)
    out: list[str] = []
    run: list[str] = []
    held: list[str] = []  # blocks of link lists since the last other block
    lists = 0

    def end() -> None:
        text = " ".join("".join(run).split())
        if text and lists:
            held.append(text)
        elif text:
            out.extend([*held, text] if out else [text])
            held.clear()
        run.clear()

    for top in tops:
        walk: list = [top]
        while walk:
            item = walk.pop()
            if item is None:
                end()
            elif item is walk:
                lists -= 1
            elif isinstance(item, str):
                run.append(item)
            else:
                tag = page.tags[item]
                if gone[item]:
                    continue
                if tag in ("br", "wbr", "img"):
                    run.append(" " if tag == "br" else "")
                    continue
                if item != top and tag in ("ul", "ol", "table", "div", "section", "dl") and linked[item] > 0.8 * size[item] > 0:
                    end()
                    lists += 1
                    walk.append(walk)
                if tag in BLOCKS:
                    end()
                    walk.append(None)
                walk.extend(reversed(page.children[item]))
        end()
    return out


def main_text(html: str | None) -> str:
    """The main text of a page, one block a line."""
    if not html:
        return ""
    page = Page(html)
    for by_words in (True, False):
        gone, start = _cut(page, by_words)
        blocks = _blocks(page, gone, _chosen(page, gone, start))
        if blocks:
            break
    return "\n".join(blocks)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py()) for html in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    kinds = [pages.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return small_batches(pages).select(pages["page_id"], pages["url"], pages["html"]).mapInArrow(
        run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
