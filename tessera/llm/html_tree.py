"""Pages as trees of block elements, and the features of their nodes.

A tolerant reader of markup: one pass over the tags, linear in the page.  Only
elements that stand as blocks become nodes; inline elements add their text to
the block around them.  What is never shown as text (scripts, styles, controls,
comments) is left out here; everything else is for the model to judge.
"""

from __future__ import annotations

import html
import math
import re

# <!--comment-->, <tag attributes>, </tag>, <!declaration> or <?instruction>
TAG = re.compile(r"""<(?:!--(?:.*?-->|.*)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)>|[!?/][^>]*>?)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAMES = re.compile(r"[a-z]+")

# What HTML says of elements.
RAW = {"script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes", "noscript"}
NEVER_TEXT = {"template", "select", "button", "svg", "math", "object", "canvas", "audio", "video", "datalist", "map"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "label", "mark", "meter", "nobr", "output", "picture", "progress", "q", "rp", "rt", "ruby", "s", "samp",
          "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
ENDS_P = {"address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset",
          "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu",
          "nav", "ol", "p", "pre", "search", "section", "summary", "table", "ul"}
# an opening tag ends the open ones of these kinds, up to the element around them
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "body": ({"head"}, {"html"})}

# Kinds of nodes; the parent-child potentials are told apart by the child's.
KINDS = {kind: k for k, kinds in enumerate((
    ("page", "html", "body"), ("div", "center", "details", "fieldset"), ("section",), ("article",), ("main",), ("p",), ("h1",),
    ("h2", "h3", "h4", "h5", "h6", "summary"), ("ul", "ol", "menu", "dl"), ("li", "dt", "dd"), ("table", "thead", "tbody", "tfoot", "tr"),
    ("td", "th", "caption"), ("blockquote", "pre"), ("figure", "figcaption"), ("nav",), ("header", "hgroup"), ("footer",), ("aside",),
    ("form", "dialog", "search"), ("head",))) for kind in kinds}
OTHER = max(KINDS.values()) + 1
N_KINDS = OTHER + 1

# Words of class, id and role that tell what a block is for.
AGAINST = set("""nav navbar navigation menu submenu breadcrumb breadcrumbs topbar toolbar masthead banner header footer foot sidebar
    aside rail widget widgets cookie cookies consent gdpr notice alert popup modal overlay subscribe subscription newsletter signup
    login register search share sharing social follow related recommended recommendations popular trending more tags tag tagcloud
    pagination pager paging prev next copyright legal disclaimer contentinfo complementary skip toc print
    hdr hd ftr ft top bottom side bar""".split())
ADVERTS = set("ad ads adv advert adverts advertisement advertising banner promo promotion promoted sponsor sponsored teaser commercial".split())
REMARKS = set("comment comments commentlist respond reply replies discussion disqus reactions feedback".split())
IN_FAVOUR = set("article content contents post entry story body text main maincontent lead intro paragraph prose hentry".split())


class Page:
    """Nodes in order of their start tags (0 is the page itself) and the runs
    of text between block boundaries: (node, text)."""

    def __init__(self, source: str):
        self.tags, self.attributes, self.parents, self.depths = ["page"], [""], [-1], [0]
        self.blocks: list[tuple[int, str]] = []
        self.chars, self.linked = [0], [0]
        self._text: list[str] = []
        self._open = [0]
        self._in_link = False
        self._read(source)

    def _end_block(self):
        if self._text:
            text = " ".join("".join(self._text).split())
            self._text = []
            if text:
                self.blocks.append((self._open[-1], text))
                self.chars[self._open[-1]] += len(text)

    def _say(self, raw: str):
        if raw:
            said = html.unescape(raw) if "&" in raw else raw
            self._text.append(said)
            if self._in_link:
                self.linked[self._open[-1]] += len(said.strip())

    def _pop_to(self, place: int):
        self._end_block()
        self._in_link = False
        del self._open[place:]

    def _close(self, kinds, around):
        place = None
        for k in range(len(self._open) - 1, 0, -1):
            tag = self.tags[self._open[k]]
            if tag in around:
                break
            if tag in kinds:
                place = k
        if place is not None:
            self._pop_to(place)

    def _start(self, tag: str, attributes: str):
        self._end_block()
        if tag in ENDS_P:
            self._close({"p"}, {"td", "th", "table", "button", "caption"})
        if tag in ENDS:
            self._close(*ENDS[tag])
        self._in_link = False
        if tag == "hr":
            return
        self.parents.append(self._open[-1])
        self.depths.append(len(self._open))
        self._open.append(len(self.tags))
        self.tags.append(tag)
        self.attributes.append(attributes)
        self.chars.append(0)
        self.linked.append(0)

    def _read(self, source: str):
        at, end = 0, len(source)
        while at < end:
            m = TAG.search(source, at)
            if m is None:
                break
            self._say(source[at:m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                if tag == "a":
                    self._in_link = False
                elif tag not in INLINE:
                    for k in range(len(self._open) - 1, 0, -1):
                        if self.tags[self._open[k]] == tag:
                            self._pop_to(k)
                            break
                    else:
                        self._end_block()
            elif tag == "br":
                self._say(" ")
            elif tag in RAW or tag in NEVER_TEXT:
                if not m[3].rstrip().endswith("/") or tag in RAW:
                    close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(source, at)
                    at = end if close is None else close.start()
                self._say(" ")
            elif tag == "a":
                self._in_link = True
            elif tag not in INLINE and tag not in VOID or tag == "hr":
                self._start(tag, m[3])
        self._say(source[at:])
        self._end_block()

    def names(self, node: int) -> tuple[set[str], dict[str, str]]:
        """Words of the class, id and role, and all attributes of a node."""
        raw = self.attributes[node]
        if not raw or raw.isspace():
            return set(), {}
        found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(raw)}
        split = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", " ".join(found.get(k, "") for k in ("class", "id", "role")))
        return set(NAMES.findall(split.lower())), found


SENTENCE_ENDS = (".", "!", "?", "…", "。", ":", "”", '"', "|", ",", ";")
N_FEATURES = N_KINDS + 17


def features(page: Page) -> list[list[float]]:
    """A row of N_FEATURES numbers for every node."""
    n = len(page.tags)
    chars, linked = page.chars[:], page.linked[:]
    for k in range(n - 1, 0, -1):
        chars[page.parents[k]] += chars[k]
        linked[page.parents[k]] += linked[k]
    whole = max(1, chars[0])
    own: list[list[str]] = [[] for _ in range(n)]
    before, told = [0] * n, 0
    for node, text in page.blocks:
        own[node].append(text)
    for k in range(n):
        before[k] = told
        told += page.chars[k]
    rows = []
    for k in range(n):
        row = [0.0] * N_FEATURES
        row[KINDS.get(page.tags[k], OTHER)] = 1.0
        names, attributes = page.names(k)
        text = own[k][-1] if own[k] else ""
        said = page.chars[k]
        link_share = min(1.0, linked[k] / chars[k]) if chars[k] else 0.0
        tail = row[N_KINDS:]
        tail[0] = 1.0
        tail[1] = float(bool(names & AGAINST))
        tail[2] = float(bool(names & ADVERTS))
        tail[3] = float(bool(names & REMARKS))
        tail[4] = float(bool(names & IN_FAVOUR) and not names & (AGAINST | ADVERTS | REMARKS))
        tail[5] = float("hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", ""))
        tail[6] = link_share
        tail[7] = float(link_share > 0.6)
        tail[8] = math.log1p(chars[k]) / 8
        tail[9] = chars[k] / whole
        tail[10] = float(said > 0)
        tail[11] = math.log1p(said) / 8
        tail[12] = float(text.endswith(SENTENCE_ENDS))
        tail[13] = float(0 < said < 40)
        tail[14] = float("©" in text[:400] or "©" in text[-400:])
        tail[15] = before[k] / whole
        tail[16] = float(chars[k] == 0)
        row[N_KINDS:] = tail
        rows.append(row)
    return rows
