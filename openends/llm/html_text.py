"""The main text of web pages by composite text density.

Every node's density is its characters per tag, lowered by the share of links. The densities of a
node's children are added up; the node with the largest sum is the article. Other parts
beside the way from the body to it count only if they are as dense as the least dense
node on that way.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openends.llm.common import unique

# Kinds of HTML elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe svg math xmp noframes".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - set("body caption html legend li summary tbody td tfoot th thead tr dd dt".split())
# An opening tag ends open elements of these names, up to the given container.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
NOT_TEXT = set(
    "head nav footer aside form button select option input label fieldset menu dialog object "
    "audio video canvas map datalist output progress meter".split()
)
ROLES = set(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar "
    "toolbar tablist button status".split()
)
# Words in a class or id that mark what is not the article.
MARKS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion "
    "banner nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar side rail aside footer "
    "masthead topbar toolbar cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login social share sharing related recommended "
    "recommendations pagination pager comment comments commentlist discussion disqus reply replies "
    "respond responses feedback widget widgets search searchbox form copyright legal disclaimer "
    "skip hidden paywall outbrain taboola tagcloud".split()
)
COMMENT_MARKS = {"comment", "comments", "commentlist", "discussion", "disqus", "reply", "replies"}
# Marks of a column beside the article.
SIDE_MARKS = {"sidebar", "related", "recommended", "recommendations"}
COMMENT_HEADING = re.compile(
    r"\W*(\d+\s+)?(reader |user )?(comments?|kommentare?|commentaires?|comentarios?|"
    r"leave a (reply|comment)|responses|discussion)\b.{0,20}$",
    re.I | re.S,
)
# Elements that are a list's entries if several siblings are named alike.
ENTRIES = {"article", "dd", "div", "li", "section", "tr"}
# A heading that counts comments; a chapter's number stands before other words.
COMMENT_COUNT = re.compile(
    r"\W*\d+\s+(reader |user )?(comments?|kommentare?|commentaires?|comentarios?|responses)\W*$", re.I
)
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)>"
    r"|<[!?][^>]*+>?|</[^a-zA-Z][^>]*+>?",
    re.S,
)
# A tag or comment that the page ends in.
_UNENDED = re.compile(r"<[a-zA-Z/!?].*\Z", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
_SPACE = re.compile(r"\s+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}


class Page:
    """A page as a tree: per node its parent, tag, attributes and texts, in page order."""

    def __init__(self, source: str):
        self.tag = ["#page"]
        self.parent = [0]
        self.rest = [""]
        # (node, text) in page order; a node's own appearance is told apart by breaks.
        self.items: list[tuple[int, str]] = []
        self._read(source)

    def _read(self, source: str) -> None:
        stack, open_ = [0], {}
        at = 0
        last = source.rfind(">") + 1  # beyond it no tag ends

        def close(to: int) -> None:
            while len(stack) > to:
                open_[self.tag[stack.pop()]] -= 1
            self.items.append((stack[-1], ""))

        while True:
            found = _TAG.search(source, at, last) if at < last else None
            text = source[at : found.start()] if found else _UNENDED.sub("", source[at:])
            if text:
                self.items.append((stack[-1], html.unescape(text)))
            if not found:
                return
            at = found.end()
            name = (found["name"] or found["name2"] or "").lower()
            if not name:
                continue
            if found["end"] or found["end2"]:
                if open_.get(name):
                    to = len(stack) - 1
                    while self.tag[stack[to]] != name:
                        # The end of an inline element does not end the blocks inside it.
                        if name not in BLOCK and self.tag[stack[to]] in BLOCK:
                            to = 0
                            break
                        to -= 1
                    if to:
                        close(to)
                continue
            if name in CLOSES_P and open_.get("p"):
                to = len(stack) - 1
                while to and self.tag[stack[to]] != "p" and self.tag[stack[to]] not in BLOCK:
                    to -= 1
                if self.tag[stack[to]] == "p":
                    close(to)
            if name in IMPLIED_END:
                ends, within = IMPLIED_END[name]
                to = len(stack) - 1
                ended = 0
                while to and self.tag[stack[to]] not in within:
                    if self.tag[stack[to]] in ends:
                        ended = to
                    to -= 1
                if ended:
                    close(ended)
            node = len(self.tag)
            rest = found["rest"] or found["rest2"] or ""
            self.tag.append(name)
            self.parent.append(stack[-1])
            self.rest.append(rest)
            self.items.append((node, ""))
            if name in ("svg", "math") and rest.endswith("/"):
                continue  # an empty element
            if name in RAW:
                ended = _RAW_END[name].search(source, at)
                at = ended.end() if ended else len(source)
                if name not in ("title", "noscript") and not ended:
                    return
            elif name not in VOID and not (rest.endswith("/") and name not in BLOCK):
                stack.append(node)
                open_[name] = open_.get(name, 0) + 1

    def marks(self, node: int) -> tuple[set[str], bool]:
        """Words of class and id, and whether the node is no part of a visible article anyway."""
        words: set[str] = set()
        gone = False
        rest = self.rest[node]
        if rest:
            for name, value in _ATTRIBUTE.findall(rest):
                name, value = name.lower(), value.strip("\"'")
                if name in ("class", "id"):
                    words.update(w.lower() for w in _WORD.findall(value))
                elif name == "role":
                    gone |= value.lower() in ROLES
                elif name == "style":
                    gone |= "display:none" in value.replace(" ", "").lower()
                elif name == "hidden":
                    gone = True
                else:
                    gone |= value.lower() == "true"
        return words, gone


def main_text(source: str | None) -> str:
    """The article's text: its blocks in page order, joined by an empty line.

    White space inside a block becomes one space and character references are decoded.
    Left out are elements that never belong to an article (menus, footers, asides, forms,
    scripts, styles), those named as notices, adverts, side columns or reader comments
    if they are small, mostly links, a list of like entries or a form and the name
    does not hold most of the page's text, and, where the page does not name its article, parts less dense than the way to it
    that do not look like a part of that way.
    """
    if not source:
        return ""
    page = Page(source)
    n = len(page.tag)
    tag, parent = page.tag, page.parent
    chars, links = [0] * n, [0] * n
    texts_of: dict[int, list[str]] = {}
    in_link = [False] * n
    for node in range(1, n):
        in_link[node] = in_link[parent[node]] or tag[node] == "a"
    for node, text in page.items:
        if text and not text.isspace():
            size = len("".join(text.split()))
            chars[node] += size
            links[node] += size if in_link[node] else 0
            texts_of.setdefault(node, []).append(text)
    all_chars, all_links = chars[:], links[:]
    holds = [False] * n  # an article, a main part or a page's heading inside
    named = [tag[i] in ("article", "main") for i in range(n)]
    comment, counts = [False] * n, [False] * n
    head = [0] * n  # characters of a heading of comments
    for node in range(n - 1, 0, -1):
        up = parent[node]
        all_chars[up] += all_chars[node]
        all_links[up] += all_links[node]
        if tag[node] in ("article", "main", "h1") and not page.marks(node)[0] & COMMENT_MARKS:
            holds[node] = True
        holds[up] |= holds[node]
        if re.fullmatch("h[2-6]", tag[node]) and tag[up] not in ("article", "main", "body"):
            heading = " ".join(texts_of.get(node, ()))
            if COMMENT_HEADING.match(heading) and tag[up] != "#page":
                comment[up] = True
                counts[up] |= bool(COMMENT_COUNT.match(heading))
                head[up] += all_chars[node]

    # What a name says of a node is held against the text: a word that marks most of the page
    # marks nothing, and lists of like entries and forms are told apart from plain parts.
    marks = [page.marks(node) for node in range(n)]
    under: list[frozenset[str]] = [frozenset()] * n
    entries: set[tuple] = set()
    evident = [False] * n
    held: dict[str, int] = {}
    for node in range(1, n):
        up = parent[node]
        new = marks[node][0] & MARKS if tag[node] not in ("html", "body") else frozenset()
        under[node] = under[up] | new if new else under[up]
        if chars[node] and under[node]:
            for word in under[node]:
                held[word] = held.get(word, 0) + chars[node]
        entry = (up, tag[node], frozenset(marks[node][0]))
        evident[up] |= tag[node] in ENTRIES and bool(entry[2]) and entry in entries
        entries.add(entry)
    for node in range(n - 1, 0, -1):
        evident[parent[node]] |= evident[node] or tag[node] == "form"
    most = all_chars[0] / 2
    signs = MARKS - {word for word, size in held.items() if size > most}

    # Comments and side columns go whatever their size, if the page has an article beside them: plain
    # paragraphs under no mark at all. Where there are none, such a mark may stand for the whole page.
    apart, lead, own_article = [False] * n, n, False
    twins: dict[tuple[int, str], int] = {}
    for node in range(1, n):
        up, name = parent[node], tag[node]
        apart[node] = apart[up] or comment[node] or name in NOT_TEXT or bool(
            marks[node][0] & MARKS and name not in ("html", "body")
        )
        if all_chars[node]:
            twins[up, name] = twins.get((up, name), 0) + 1
            if not apart[node]:
                own_article |= name in ("article", "main")
                if name == "p":
                    lead = min(lead, node)

    def beside(node: int) -> bool:
        """Whether a node is a part for comments or a side column of a page with an article elsewhere."""
        words = marks[node][0]
        if lead == n or holds[node] and not own_article:
            return False
        if words & COMMENT_MARKS or comment[node]:
            repeats = any(twins.get((node, name), 0) > 1 for name in ENTRIES | {"p"})
            sure = bool(words & COMMENT_MARKS) and (comment[node] or lead < node or repeats)
            return sure or (comment[node] and (bool(counts[node]) or evident[node]))
        return bool(words & SIDE_MARKS)

    # What cannot be the article goes first, with all inside it.
    gone = [False] * n
    inside_named = [False] * n
    for node in range(1, n):
        up = parent[node]
        name = tag[node]
        inside_named[node] = inside_named[up] or named[node]
        if gone[up]:
            gone[node] = True
            continue
        if name in ("html", "body"):
            continue
        if name in RAW or name in VOID:
            gone[node] = name != "br"
            continue
        words, hidden = marks[node]
        strong = evident[node] or counts[node] or 2 * all_links[node] > all_chars[node]
        strong = strong or (comment[node] and bool(words & COMMENT_MARKS))
        marked = bool(words & signs) and (strong or 4 * all_chars[node] <= all_chars[0])
        marked = (marked or (comment[node] and strong)) and (
            2 * (all_chars[node] - head[node]) <= all_chars[0] - head[node]
        )
        if name in ("article", "main") and not words & COMMENT_MARKS:
            marked = False
        large = holds[node] or (name == "form" and 2 * all_chars[node] > all_chars[0])
        gone[node] = hidden or beside(node) or (
            (marked or name in NOT_TEXT or (name == "header" and not inside_named[up]))
            and not (large and name not in ("nav", "footer", "aside", "head"))
        )

    # Densities of what is left.
    c, lc = [0] * n, [0] * n
    t, lt = [0] * n, [0] * n
    for node in range(n - 1, 0, -1):
        if gone[node]:
            continue
        up = parent[node]
        c[node] += chars[node]
        lc[node] += links[node]
        c[up] += c[node]
        lc[up] += lc[node]
        t[up] += t[node] + 1
        lt[up] += lt[node] + (tag[node] == "a")
    c[0] += chars[0]
    body = next((i for i in range(n) if tag[i] == "body" and not gone[i]), 0)
    body_share = lc[body] / max(1, c[body])
    density = [0.0] * n
    for node in range(n):
        if c[node] and not gone[node]:
            size, tags = c[node], max(1, t[node])
            linked, link_tags = max(1, lc[node]), max(1, lt[node])
            plain = max(1, size - lc[node])
            base = math.log(size / plain * linked + body_share * size + math.e)
            ratio = math.log(size / linked * tags / link_tags) / math.log(base) if base > 1 else 1.0
            density[node] = size / tags * max(0.0, ratio)
    sums = [0.0] * n
    for node in range(n - 1, 0, -1):
        sums[parent[node]] += density[node]
    best = max((i for i in range(n) if not gone[i]), key=lambda i: (sums[i], -i))

    way = [best]
    while way[-1]:
        way.append(parent[way[-1]])
    for place, node in enumerate(way):
        if named[node]:
            best = node  # the page names its article: all of it
            way = way[place:]
            break
    chosen = [False] * n
    chosen[best] = True
    if not named[best]:
        upto = way[: way.index(body) + 1] if body in way else way
        least = min((density[i] for i in upto), default=0.0)
        near_way = {parent[node]: node for node in way}
        near_way[best] = 0
        for node in range(1, n):
            if not gone[node] and node not in near_way and parent[node] in near_way:
                twin = near_way[parent[node]]
                alike = bool(page.rest[twin]) and (tag[node], page.rest[node]) == (
                    tag[twin],
                    page.rest[twin],
                )
                heading = tag[node] in ("h1", "h2") and tag[parent[node]] != "#page"
                dense = (alike or density[node] >= least) and 2 * lc[node] < c[node]
                chosen[node] = parent[node] != best and (heading or dense)
    for node in range(1, n):
        chosen[node] = (chosen[node] or chosen[parent[node]]) and not gone[node]

    blocks: list[str] = []
    piece: list[str] = []
    last = -1
    block_of = [0] * n
    for node in range(1, n):
        block_of[node] = node if tag[node] in BLOCK else block_of[parent[node]]
    for node, text in page.items:
        if block_of[node] != last or (not text and tag[node] in BLOCK):
            blocks.append("".join(piece))
            piece, last = [], block_of[node]
        if tag[node] == "br":
            piece.append(" ")
        if text and chosen[node]:
            piece.append(text)
    blocks.append("".join(piece))
    return "\n\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points), without a shuffle.

    Null html is an empty page. Rows without an id are left out, rows that repeat an id count once.
    """
    rows = unique(
        pages.select(
            F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
        ),
        "page_id",
    )

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame[["page_id", "url"]].assign(text=list(map(main_text, frame["html"])))

    kind = rows.schema["page_id"].dataType.simpleString()
    out = rows.mapInPandas(read, f"page_id {kind}, url string, text string")
    return out.withColumn("n_chars", F.char_length("text").cast("bigint"))
