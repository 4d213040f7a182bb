"""Main text of web pages by tree scoring.

A page becomes a tree of elements. Every block of text (a paragraph, a heading, the text
directly inside a container) earns points for its length and its commas, less the share
that lies in links. The points go to the element that holds the block, half of them to the
next ancestor, a quarter to the one after, and so on. The element with the most points,
discounted by its own link density, is the container; siblings with a fifth of its points,
and headings and running text beside it, stay with it. Menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments are cut from the tree before,
by element, role, class and id.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loadpanel.llm.common import slices

# The elements of HTML by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre search section "
    "select summary table tbody td tfoot th thead tr ul".split()
)
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
HEAD_ONLY = frozenset("meta link title script style base noscript template".split())
# A start tag of these ends an open paragraph.
ENDS_P = BLOCK - frozenset("body caption html optgroup option select tbody td tfoot th thead tr".split())
# Elements whose own text counts for themselves; that of all others counts for their parent.
CONTAINER = frozenset("article body center details div dialog fieldset figure footer form header html main nav section td th".split())
# Start tag -> (open elements that it ends, elements beyond which none is looked for).
IMPLIED = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir table".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl", "table"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    **{k: (frozenset(["thead", "tbody", "tfoot", "caption"]), frozenset(["table"])) for k in ("thead", "tbody", "tfoot")},
}
SCOPE = frozenset("table td th caption template object button".split())

# Never text of an article.
CUT = frozenset(
    "head script style template noscript iframe object embed svg math canvas audio video title textarea select button input "
    "label legend option optgroup datalist output fieldset xmp noembed noframes progress meter map".split()
)
# Cut unless the article itself turns out to be inside, as after a forgotten end tag.
SOFT = frozenset("form nav header menu search".split())
HARD = frozenset("aside footer dialog".split())
SOFT_ROLES = frozenset("navigation banner search form menu menubar toolbar tablist".split())
HARD_ROLES = frozenset("complementary contentinfo alert alertdialog dialog status".split())
# First or last words of a class or id.
SOFT_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar toolbar pager pagination login signup "
    "search form skip".split()
)
HARD_WORDS = frozenset(
    "ad ads adsbygoogle adv advert adverts advertisement advertisements advertising adsense adslot banner sponsor sponsors sponsored promo "
    "promos promotion sidebar aside footer cookie cookies consent gdpr notice notices notification notifications alert alerts "
    "popup modal overlay disclaimer copyright newsletter subscribe subscription share sharing social related recommended "
    "recommendations widget comment comments commentlist disqus respond reply replies discussion".split()
)
# A modifier such as has-sidebar or no-comments names no part of the page.
MODIFIERS = frozenset("has with no not is without js wp".split())

HEADER = re.compile(r"(?i)header|masthead")
OPEN = re.compile(r"<([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""[\s/]*(?:(>)|([^\s/>=][^\s/>=]*|=[^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*))?)?)""")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}
COMMAS = ",，、،"
# Open elements inside each other; deeper ones stand beside the last, as in browsers.
DEEPEST = 512
# What an element named as the article has ahead of others.
AHEAD = {"article": 10.0, "main": 5.0}
# Elements that are menus when they are mostly links.
LISTS = frozenset("ul ol dl div section table center".split())


def _named(value: str) -> str | None:
    """What a class or id says of its element: ``hard`` or ``soft`` for parts beside the article."""
    found = None
    for name in value.split():
        words = [w.lower() for w in WORDS.findall(name)]
        if not words or words[0] in MODIFIERS:
            continue
        if words[0] in HARD_WORDS or words[-1] in HARD_WORDS:
            return "hard"
        if words[0] in SOFT_WORDS or words[-1] in SOFT_WORDS:
            found = "soft"
    return found


class _Page:
    """Elements in page order, a parent before its children, and blocks of text with their element."""

    def __init__(self, html: str) -> None:
        self.tag, self.parent, self.bad, self.link = ["#"], [0], [None], [False]
        self.blocks: list[tuple[int, str, int, int]] = []  # element, text, length, length inside links
        self.links: list[int] = []
        self._open = [0]
        self._held: list[tuple[str, bool]] = []
        self._read(html)
        self._end_block()

    def _end_block(self) -> None:
        if not self._held:
            return
        text = " ".join("".join(t for t, _ in self._held).split())
        if text:
            owner = next(e for e in reversed(self._open) if self.tag[e] in BLOCK or self.tag[e] in CUT or e == 0)
            linked = sum(len(" ".join(t.split())) for t, inside in self._held if inside)
            self.blocks.append((owner, text, len(text), min(linked, len(text))))
        self._held = []

    def _text(self, text: str) -> None:
        if text:
            self._held.append((unescape(text) if "&" in text else text, self.link[self._open[-1]]))

    def _close(self, depth: int) -> None:
        if any(self.tag[e] in BLOCK or self.tag[e] in CUT for e in self._open[depth:]):
            self._end_block()
        del self._open[depth:]

    def _close_open(self, names: frozenset[str], beyond: frozenset[str]) -> None:
        for depth in range(len(self._open) - 1, 0, -1):
            name = self.tag[self._open[depth]]
            if name in names:
                return self._close(depth)
            if name in beyond:
                return None

    def _start(self, name: str, attributes: dict[str, str], closed: bool) -> None:
        if name in ("html", "body", "head") and name in self.tag:
            return
        if name not in HEAD_ONLY and name != "head":
            self._close_open(frozenset(["head"]), frozenset())
        if name in ENDS_P:
            self._close_open(frozenset(["p"]), SCOPE)
        if name in IMPLIED:
            self._close_open(*IMPLIED[name])
        if name in HEADING and self.tag[self._open[-1]] in HEADING:
            self._close(len(self._open) - 1)
        if name in BLOCK or name in CUT:
            self._end_block()
        if name == "br":
            self._held.append((" ", False))
        if name in VOID:
            return
        if len(self._open) > DEEPEST:
            self._close(DEEPEST)
        up = self._open[-1]
        self.tag.append(name)
        self.parent.append(up)
        self.link.append(self.link[up] or (name == "a" and "href" in attributes))
        self.bad.append(self._judged(name, attributes))
        if name == "a" and "href" in attributes:
            self.links.append(len(self.tag) - 1)
        if not (closed and name in ("svg", "math")):
            self._open.append(len(self.tag) - 1)

    def _judged(self, name: str, attributes: dict[str, str]) -> str | None:
        if name in CUT:
            return "cut"
        role = attributes.get("role", "").strip().lower()
        named = None if name in ("html", "body", "main") else _named(f"{attributes.get('class', '')} {attributes.get('id', '')}")
        if name in HARD or role in HARD_ROLES or named == "hard":
            return "hard"
        header = name == "header" or (named == "soft" and HEADER.search(f"{attributes.get('class', '')} {attributes.get('id', '')}"))
        if header and any(self.tag[e] in AHEAD for e in self._open):
            return "heading"  # the article's own header: its headings belong to it
        return "soft" if name in SOFT or role in SOFT_ROLES or named == "soft" else None

    def _end(self, name: str) -> None:
        inline = name not in BLOCK and name not in CUT
        for depth in range(len(self._open) - 1, 0, -1):
            own = self.tag[self._open[depth]]
            if own == name:
                return self._close(depth)
            if (inline and own in BLOCK) or (own in ("table", "td", "th", "template") and name not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html")):
                return None

    def _read(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            tag = html.find("<", at)
            if tag < 0:
                return self._text(html[at:])
            self._text(html[at:tag])
            after = html[tag + 1 : tag + 2]
            if after.isascii() and after.isalpha():
                at = self._read_start(html, tag)
            elif after == "/" and html[tag + 2 : tag + 3].isascii() and html[tag + 2 : tag + 3].isalpha():
                close = html.find(">", tag)
                if close < 0:
                    return None
                self._end(re.split(r"[\s/]", html[tag + 2 : close], maxsplit=1)[0].lower())
                at = close + 1
            elif html.startswith("<!--", tag):
                if html.startswith((">", "->"), tag + 4):
                    at = html.find(">", tag) + 1
                    continue
                close = html.find("-->", tag + 4)
                if close < 0:
                    return None
                at = close + 3
            elif after and after in "!?/":
                close = html.find(">", tag)
                if close < 0:
                    return None
                at = close + 1
            else:
                self._text("<")
                at = tag + 1

    def _read_start(self, html: str, tag: int) -> int:
        """Reads the start tag at ``tag``; the place behind it, or behind the raw text that follows it."""
        m = OPEN.match(html, tag)
        name, at, attributes, closed = m[1].lower(), m.end(), {}, False
        while True:
            m = ATTRIBUTE.match(html, at)
            if m is None:  # the page ends inside the tag
                return len(html)
            closed = m[1] is not None and html[m.end() - 2] == "/"
            at = m.end()
            if m[1]:
                break
            attributes.setdefault(m[2].lower(), m[3] or m[4] or m[5] or "")
        self._start(name, attributes, closed)
        if name in RAW:
            end = RAW_END[name].search(html, at)
            return end.start() if end else len(html)
        return at


def main_text(html: str | None) -> str:
    """The text of the article of one page, blocks joined by an empty line; empty if there is none."""
    if not html:
        return ""
    page = _Page(html)
    tag, parent, bad = page.tag, page.parent, page.bad
    n = len(tag)

    # Which elements hold the article by name: ``main``, and ``article`` unless it is a comment or a teaser.
    has_main, has_article = [False] * n, [False] * n
    for e in range(n - 1, 0, -1):
        has_main[e] |= tag[e] == "main"
        has_article[e] |= tag[e] == "article" and bad[e] is None
        has_main[parent[e]] |= has_main[e]
        has_article[parent[e]] |= has_article[e]
    cut = [False] * n
    in_header = [False] * n
    in_heading = [False] * n
    for e in range(1, n):
        up = parent[e]
        inside = has_main[e] or has_article[e]
        cut[e] = cut[up] or bad[e] == "cut" or (bad[e] == "hard" and not has_main[e]) or (bad[e] == "soft" and not inside)
        in_header[e] = in_header[up] or bad[e] == "heading"
        in_heading[e] = in_heading[up] or tag[e] in HEADING
    blocks = [b for b in page.blocks if not cut[b[0]] and not (in_header[b[0]] and not in_heading[b[0]])]
    if not blocks:
        return ""

    points, size, linked, links = [0.0] * n, [0] * n, [0] * n, [0] * n
    for owner, text, length, inside in blocks:
        earned = (1 + sum(text.count(c) for c in COMMAS) + length / 100) * (1 - inside / length)
        points[owner if tag[owner] in CONTAINER else parent[owner]] += earned
        size[owner] += length
        linked[owner] += inside
    for e in page.links:
        links[e] = 1
    for e in range(n - 1, 0, -1):
        up = parent[e]
        points[up] += points[e] / 2
        size[up] += size[e]
        linked[up] += linked[e]
        links[up] += links[e]

    def density(e: int) -> float:
        return linked[e] / size[e] if size[e] else 0.0

    score = [0.0] * n
    for e in range(1, n):
        if size[e] and not cut[e] and tag[e] in BLOCK and tag[e] not in HEADING and tag[e] != "p":
            score[e] = (points[e] + AHEAD.get(tag[e], 0.0)) * (1 - density(e))
    best = max(range(n), key=score.__getitem__)
    if not score[best]:
        best = 0  # text outside every container

    last = {owner: text for owner, text, _, _ in blocks}
    keep = [False] * n
    keep[best] = True
    for e in range(1, n):
        if best and e != best and parent[e] == parent[best] and size[e] and not cut[e]:
            few = density(e) < 0.25
            running = tag[e] == "p" and few and (size[e] > 80 or last.get(e, "").endswith((".", "!", "?", "。")))
            keep[e] = (score[e] >= 0.2 * score[best] and density(e) < 0.5) or running or (tag[e] in HEADING and few and e < best)
        if keep[parent[e]]:
            menu = tag[e] in LISTS and links[e] >= 3 and density(e) > 0.75
            keep[e] = not menu
    return "\n\n".join(text for owner, text, _, _ in blocks if keep[owner])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row.

    A null or empty page, and one with nothing but parts beside the article, gives an empty text. Rows are taken
    one by one: repeated rows and ids stay, an empty table gives no rows, other columns are left alone, and a page
    of any length is read whole. White space is what ``str.split`` takes for it, no-break spaces included; a line
    break (``br``) is white space. A page that ends inside a tag or comment ends there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(iter([whole]), "html", 4 << 20):
                texts = [main_text(h) for h in batch.column(2).to_pylist()]
                columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    kinds = dict(pages.dtypes)
    read = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    return read.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
