"""Article pages: list extraction, body extraction, article blocks and the
crawl work list (X18 X19 X20 S17 F12 F13 F14 Y3).

HTML parsing is the one place where per-row Python is needed (markup is not a
SQL type).  It runs in Arrow-batched pandas UDFs over the `html` column with
the standard library parser; the rules (container / item selectors) are small
parameters shipped with the function.  Everything around it - the work list,
URL arithmetic, explode of links, block formatting - is column expressions.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import url_date

# Article block separator (S17) and the body marker for pages
# holding a table.
BLOCK_STARS = "*" * 200
TABLE_BODY = "table"
_VOID = {"br", "img", "meta", "link", "input", "hr", "area", "base", "col", "embed", "source", "wbr"}
_CLOSES_P = {"p", "div", "ul", "ol", "table", "h1", "h2", "h3", "h4", "h5", "h6", "article", "section",
             "nav", "header", "footer", "pre", "blockquote"}

# An opening tag closes open ones of these kinds, up to the element around them.
_CLOSES = {"li": ({"li"}, {"ul", "ol"}), "option": ({"option"}, {"select"}), "tr": ({"tr", "td", "th"}, {"table"}),
           "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}


class _Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def _in_order(self):
        """Strings and nodes below, in document order; a stack, since unclosed
        markup nests thousands of levels deep."""
        stack = [iter(self.children)]
        while stack:
            for c in stack[-1]:
                yield c
                if not isinstance(c, str):
                    stack.append(iter(c.children))
                    break
            else:
                stack.pop()

    def text(self) -> str:
        return "".join(c for c in self._in_order() if isinstance(c, str))

    def walk(self):
        return (c for c in self._in_order() if not isinstance(c, str))


class _Tree(HTMLParser):
    """Tolerant DOM: script/style text is dropped, an open <p> is closed by a
    block element, an open list item, option, cell or row by the next one,
    unknown end tags are ignored."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("#root", {}, None)
        self.cur = self.root

    def handle_starttag(self, tag, attrs):
        if tag in _CLOSES_P:
            n = self.cur
            while n is not self.root and n.tag != "p":
                n = n.parent
            if n.tag == "p":
                self.cur = n.parent
        if tag in _CLOSES:
            kinds, around = _CLOSES[tag]
            n = self.cur
            while n is not self.root and n.tag not in around:
                if n.tag in kinds:
                    self.cur = n.parent
                n = n.parent
        node = _Node(tag, dict(attrs), self.cur)
        self.cur.children.append(node)
        if tag not in _VOID:
            self.cur = node

    def handle_endtag(self, tag):
        n = self.cur
        while n is not self.root and n.tag != tag:
            n = n.parent
        if n is not self.root:
            self.cur = n.parent

    def handle_data(self, data):
        if self.cur.tag not in ("script", "style"):
            self.cur.children.append(data)


def _parse(html):
    t = _Tree()
    t.feed(html or "")
    t.close()
    return t.root


def _matches(node, simple: str) -> bool:
    """`tag`, `tag.class`, `tag#id`, `.class`, `#id`."""
    tag, cls, ident = simple, None, None
    if "#" in simple:
        tag, ident = simple.split("#", 1)
    elif "." in simple:
        tag, cls = simple.split(".", 1)
    if tag and node.tag != tag:
        return False
    if cls and cls not in (node.attrs.get("class") or "").split():
        return False
    if ident and node.attrs.get("id") != ident:
        return False
    return True


def select(root, selector: str):
    """Child-combinator selectors (`a > b > c`) and descendant steps (`a b`)."""
    steps = [s for s in selector.replace(">", " > ").split()]
    current = [root]
    child = False
    for s in steps:
        if s == ">":
            child = True
            continue
        nxt = []
        for n in current:
            pool = [c for c in n.children if not isinstance(c, str)] if child else list(n.walk())
            nxt.extend(c for c in pool if _matches(c, s))
        seen, current = set(), []
        for n in nxt:
            if id(n) not in seen:
                seen.add(id(n))
                current.append(n)
        child = False
    return current


def body_of(html: str, rules, table_marker: bool = False):
    """Rules are (container, item) pairs tried in order; the first whose
    container exists gives the body: '\\n' + text of every item child; no
    container -> None (page skipped).  `table_marker`: a page with any
    <table> has the body 'table'."""
    return _body(_parse(html), rules, table_marker)


def _body(root, rules, table_marker: bool):
    if table_marker and any(n.tag == "table" for n in root.walk()):
        return TABLE_BODY
    for container, item in rules:
        found = select(root, container)
        if found:
            return "".join("\n" + it.text() for c in found for it in select(c, "> " + item))
    return None


def links_of(html: str, item_selector: str, time_selector: str | None = None):
    """(title, href, time) of every link of a list page; with a time
    selector the i-th link pairs with the i-th time element."""
    root = _parse(html)
    links = select(root, item_selector)
    times = select(root, time_selector) if time_selector else []
    out = []
    for i, a in enumerate(links):
        t = times[i].text().strip() if i < len(times) else None
        out.append({"title": a.attrs.get("title") or a.text().strip(), "href": a.attrs.get("href"), "time": t})
    return out


def title_of(html: str):
    return _title(_parse(html))


def _title(root):
    for sel in ("h1", "title"):
        found = select(root, sel)
        if found:
            return found[0].text().strip()
    return None


# ---------------------------------------------------------------- Spark side

def extract_bodies(pages: DataFrame, rules, table_marker: bool = False, html: str = "html") -> DataFrame:
    """X19 over a DataFrame: adds `title` and `body` (NULL body = skipped page)."""
    rules = [tuple(r) for r in rules]

    @F.pandas_udf(T.StructType([T.StructField("title", T.StringType()), T.StructField("body", T.StringType())]))
    def _extract(h: pd.Series) -> pd.DataFrame:
        roots = (_parse(x) for x in h)  # one parse a page
        return pd.DataFrame([(_title(r), _body(r, rules, table_marker)) for r in roots], columns=["title", "body"])

    # not deterministic for the planner: a filter on a field must not run the parser again
    return pages.withColumn("_x", _extract.asNondeterministic()(F.col(html))).select("*", "_x.title", "_x.body").drop("_x")


_LINK = T.ArrayType(T.StructType([T.StructField("title", T.StringType()), T.StructField("href", T.StringType()),
                                  T.StructField("time", T.StringType())]))


def extract_links(pages: DataFrame, item_selector: str, time_selector: str | None = None,
                  html: str = "html", url: str = "url") -> DataFrame:
    """X18 + F14: one row per link, href made absolute against the page URL."""
    @F.pandas_udf(_LINK)
    def _links(h: pd.Series) -> pd.Series:
        return pd.Series([links_of(x, item_selector, time_selector) for x in h])

    x = pages.select("*", F.posexplode(_links(F.col(html))).alias("pos", "link"))
    href = F.col("link.href")
    origin = F.regexp_extract(F.col(url), r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)", 1)
    base_dir = F.regexp_extract(F.col(url), r"^(.*/)", 1)
    absolute = (F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
                 .when(href.startswith("./"), F.concat(base_dir, F.substring(href, 3, 1 << 30)))
                 .when(href.startswith("/"), F.concat(origin, href))
                 .otherwise(F.concat(base_dir, href)))
    return x.select(*[c for c in pages.columns if c != html], "pos", F.col("link.title").alias("title"),
                    absolute.alias("link_url"), F.col("link.time").alias("time"))


def publication_time(url_col, label_col):
    """`YYYY年<label>` when the URL holds an 8-digit date starting with 20."""
    d = url_date(url_col)
    return F.when(d.isNotNull(), F.concat(F.substring(d, 1, 4), F.lit("年"), F.coalesce(label_col, F.lit(""))))


def article_blocks(articles: DataFrame) -> DataFrame:
    """`title\\ntime\\nurl\\n\\nbody\\n\\n` + 200 stars + `\\n\\n` per article."""
    c = lambda n: F.coalesce(F.col(n), F.lit(""))
    return articles.select("*", F.concat(c("title"), F.lit("\n"), c("time"), F.lit("\n"), c("url"), F.lit("\n\n"),
                                         c("body"), F.lit("\n\n" + BLOCK_STARS + "\n\n")).alias("block"))


def write_blocks(blocks: DataFrame, path: str, mode: str = "overwrite") -> None:
    # every block ends in a newline; the writer's "\n" separator puts it back
    value = F.expr("substring(block, 1, length(block) - 1)")
    blocks.select(value.alias("value")).write.mode(mode).option("lineSep", "\n").text(path)


def read_blocks(spark, path: str) -> DataFrame:
    """S17 source: split the files on the star line, drop the blank tail."""
    raw = spark.read.option("lineSep", BLOCK_STARS).text(path)
    b = raw.select(F.regexp_replace("value", r"^\n+", "").alias("v")).where(F.trim("v") != "")
    parts = F.split("v", "\n")
    body = F.array_join(F.slice(parts, 5, 1 << 20), "\n")
    return b.select(F.get(parts, 0).alias("title"), F.get(parts, 1).alias("time"), F.get(parts, 2).alias("url"),
                    F.regexp_replace(body, r"\n+$", "").alias("body"))


def worklist(hosts: DataFrame, start: str, end: str, template: str) -> DataFrame:
    """Every host x every day of [start, end] (inclusive) as a URL list;
    `{host}`, `{month}` (yyyyMM), `{day}` (yyyyMMdd) in `template`.  The days
    are generated per host row (`sequence` + `explode`), no join."""
    parts = template.replace("{host}", "%1$s").replace("{month}", "%2$s").replace("{day}", "%3$s")
    days = F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("day")
    return hosts.select("host", days).select(
        "host", "day", F.format_string(parts, "host", F.date_format("day", "yyyyMM"),
                                       F.date_format("day", "yyyyMMdd")).alias("url"))
