"""Main text of pages by a tree-structured graphical model of their DOM.

Every block element is a binary variable: content or not.  Its own potential is
linear in its features; a parent-child potential, one table per kind of child,
connects it to the element around it.  Sum-product messages go up and down the
trees, for all pages of a batch at once, and give every element's exact
marginal; text whose element is more likely content than not is kept.  The
potentials are trained from labelled pages by the gradient of their conditional
likelihood, whose expectations are the same messages.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.html_tree import KINDS, N_FEATURES, N_KINDS, OTHER, Page, features

TRAINING_PAGES = 2000  # labelled pages taken at most (a bounded sample)
STEPS, RATE, RIDGE = 400, 0.05, 1e-4
AT_ONCE = 1 << 21  # characters of html whose trees are held at once (one page at least)
LABEL = "data-keep"  # of a labelled page's elements, 1 or 0; goes for all inside until set again


# -------------------------------------------------------------- sum-product

class Forest:
    """Trees of several pages, laid out by depth."""

    def __init__(self, pages: list[Page]):
        self.sizes = np.array([len(p.tags) for p in pages])
        first = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]) if len(pages) else np.zeros(0, int)
        self.parent = np.concatenate([np.array(p.parents) + f for p, f in zip(pages, first)])
        self.root = np.zeros(len(self.parent), bool)
        self.root[first] = True
        self.kind = np.concatenate([[KINDS.get(t, OTHER) for t in p.tags] for p in pages])
        self.x = np.concatenate([np.array(features(p)) for p in pages])
        depth = np.concatenate([p.depths for p in pages])
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)

    def messages(self, weights: np.ndarray, tables: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Marginals (node, state), pair marginals (node, state of its parent,
        own state) and the log of the partition function."""
        belief = np.zeros((len(self.parent), 2))
        belief[:, 1] = self.x @ weights  # log potentials, upward messages added
        up = np.zeros((len(self.parent), 2))
        for at in self.levels[:0:-1]:
            up[at] = np.logaddexp.reduce(tables[self.kind[at]] + belief[at][:, None, :], axis=2)
            np.add.at(belief, self.parent[at], up[at])
        log_z = np.logaddexp.reduce(belief[self.root], axis=1).sum()
        pairs = np.zeros((len(self.parent), 2, 2))
        for at in self.levels[1:]:
            around = belief[self.parent[at]] - up[at]  # all the parent knows but from this child
            joint = around[:, :, None] + tables[self.kind[at]] + belief[at][:, None, :]
            down = np.logaddexp.reduce(around[:, :, None] + tables[self.kind[at]], axis=1)
            belief[at] += down
            pairs[at] = np.exp(joint - np.logaddexp.reduce(joint.reshape(len(at), 4), axis=1)[:, None, None])
        belief -= np.logaddexp.reduce(belief, axis=1, keepdims=True)
        return np.exp(belief), pairs, float(log_z)


class Model:
    def __init__(self, weights: np.ndarray, tables: np.ndarray):
        self.weights, self.tables = weights, tables

    def kept(self, pages: list[Page]) -> list[str]:
        """The kept text of every page."""
        forest = Forest(pages)
        content = forest.messages(self.weights, self.tables)[0][:, 1] > 0.5
        out, first = [], 0
        for page, size in zip(pages, forest.sizes):
            out.append("\n".join(text for node, text in page.blocks if content[first + node]))
            first += size
        return out


# ------------------------------------------------------------------ training

def labels_of(page: Page) -> np.ndarray:
    """0 or 1 for every node of a labelled page; 0 where nothing is said."""
    y = np.zeros(len(page.tags), int)
    y[0] = len(y) > 1 and page.names(1)[1].get(LABEL) == "1"  # the page goes with its first element
    for k in range(1, len(y)):
        said = page.names(k)[1].get(LABEL)
        y[k] = y[page.parents[k]] if said is None else int(said == "1")
    return y


def fit(sources: list[str]) -> Model:
    """Potentials of the greatest conditional likelihood of labelled pages."""
    pages = [Page(s) for s in sources]
    forest, y = Forest(pages), np.concatenate([labels_of(p) for p in pages])
    inner = np.flatnonzero(~forest.root)
    seen = np.zeros((N_KINDS, 2, 2))
    np.add.at(seen, (forest.kind[inner], y[forest.parent[inner]], y[inner]), 1.0)
    told = forest.x[y == 1].sum(axis=0)
    theta = np.zeros(N_FEATURES + 4 * N_KINDS)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        weights, tables = theta[:N_FEATURES], theta[N_FEATURES:].reshape(N_KINDS, 2, 2)
        one, two, _ = forest.messages(weights, tables)
        expected = np.zeros((N_KINDS, 2, 2))
        np.add.at(expected, forest.kind[inner], two[inner])
        slope = np.concatenate([told - forest.x.T @ one[:, 1], (seen - expected).ravel()]) / len(y) - RIDGE * theta
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope ** 2
        theta = theta + RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return Model(theta[:N_FEATURES], theta[N_FEATURES:].reshape(N_KINDS, 2, 2))


def train(labelled: DataFrame, html_col: str = "html") -> Model:
    """From pages whose elements say what to keep (attribute `data-keep`); at
    most TRAINING_PAGES of them are read."""
    sources = [r[0] for r in labelled.where(F.col(html_col).isNotNull()).select(html_col).limit(TRAINING_PAGES).collect()]
    if not sources:
        raise ValueError("no labelled page")
    return fit(sources)


@functools.cache
def default_model() -> Model:
    from tessera.llm.labelled_pages import labelled_pages
    return fit(labelled_pages())


# ------------------------------------------------------------------ on Spark

def _in_parts(sources: list[str | None]) -> Iterator[list[str]]:
    part, held = [], 0
    for s in sources:
        s = s or ""
        if part and held + len(s) > AT_ONCE:
            yield part
            part, held = [], 0
        part.append(s)
        held += len(s)
    if part:
        yield part


def main_text(pages: DataFrame, model: Model | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: page_id, url, text, n_chars (code points of the text).

    Null and empty html give an empty text, as do pages without content.  White
    space is what Unicode says it is, the no-break space included; `<br>` is
    white space.  Blocks come in page order.  Rows that repeat stay, null ids
    and urls too; only the three columns are read; an empty table gives no rows.
    Any markup is read, unclosed or deeply nested too; work is linear in a page.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or default_model())  # a few hundred numbers
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    types = {f.name: f.dataType.simpleString() for f in rows.schema}

    def read(batches):
        for b in batches:
            for start in range(0, b.num_rows, 512):
                some = b.slice(start, 512)
                texts = [t for part in _in_parts(some.column("html").to_pylist()) for t in shared.value.kept([Page(s) for s in part])]
                yield pa.RecordBatch.from_arrays([some.column("page_id"), some.column("url"), pa.array(texts, pa.string()),
                                                  pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(read, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")


def as_table(spark: SparkSession, sources: list[str]) -> DataFrame:
    return spark.createDataFrame([(s,) for s in sources], "html string")
