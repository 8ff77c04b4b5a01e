"""Ranked lexical search by NRA (no random access) over impact-sorted lists.

One scan of the texts writes an index of the queries' terms: per document its
length and the counts of those terms.  N, L and the document frequencies are
aggregates of that table.  A second job reads it: each task cuts its documents
into shards of bounded size, sorts every term's postings of a shard by impact,
and reads all lists of an item sequentially, in blocks of doubling depth.  After
a block a document's lower bound is the sum of what was read of it, its upper
bound adds the list heads' impacts of the terms not yet read of it.  Documents
whose upper bound is under the k-th best score known to the task drop out;
reading goes on until the bounds of all others are equal, so that membership,
ties and scores are exact.  A task carries each item's k best from shard to
shard and sends only those; the k best of all tasks are the result.

No list is cut, no document is sampled, and no key gathers rows: a task's work
is its documents, whatever copies or frequent words they hold.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import scratch_path, written

K = 10
BLOCK_TERMS = 200_000  # query terms (repeats too) searched at once; more are searched in further blocks
SHARD_DOCS, SHARD_POSTINGS = 1 << 15, 1 << 20
FIRST_DEPTH = 32
NO_ID = np.iinfo(np.int64).max  # stands for a null doc_id while ranking

# Terms are runs of 0-9, A-Z, a-z and everything beyond ASCII; in UTF-8 all
# other characters are single bytes, so one byte table cuts and lower-cases.
_KEPT = re.compile(rb"[0-9a-z\x80-\xff]")
_TABLE = bytes(c if _KEPT.match(bytes([c])) else 32 for c in bytes(range(256)).lower())


def terms_of(text: str | bytes | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8, A-Z lower-cased; none of null."""
    raw = b"" if text is None else text.encode() if isinstance(text, str) else text
    return raw.translate(_TABLE).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A posting's share of the score before its term's weight (under 10^6)."""
    lengths, at = np.unique(n, return_inverse=True)
    m = np.array([25 + 75 * int(x) * n_docs // n_terms for x in lengths], dtype=np.int64)[at]
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


# ------------------------------------------------------------------ one shard

class Shard:
    """Impact-sorted lists of the documents `ids` (ids[doc] is the doc_id)."""

    def __init__(self, ids, doc, term, impact):
        order = np.argsort((term.astype(np.int64) << 20) + ((1 << 20) - 1 - impact), kind="stable")
        self.ids, self.doc, self.impact = ids, doc[order].astype(np.int32), impact[order]
        term = term[order]
        cuts = np.flatnonzero(np.diff(term)) + 1
        starts = np.append(0, cuts) if len(term) else cuts
        self.at = {int(term[s]): (int(s), int(e)) for s, e in zip(starts, np.append(cuts, len(term)))}

    def best(self, wanted: list[tuple[int, int]], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids) of the k best documents with a score of at least
        `floor`, for `wanted`: (term, its weight times its repeats)."""
        lists = [(*self.at[t], w) for t, w in wanted if t in self.at and w > 0]
        if sum(int(self.impact[s]) * w for s, _, w in lists) < floor:  # no document can reach it
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lower = np.zeros(len(self.ids), np.int64)
        seen = np.zeros((len(lists), len(self.ids)), bool)
        alive, depth, read = np.ones(len(self.ids), bool), FIRST_DEPTH, 0
        while True:
            rest = np.zeros(len(self.ids), np.int64)
            for i, (start, end, w) in enumerate(lists):
                block = slice(min(start + read, end), min(start + depth, end))
                doc, impact = self.doc[block], self.impact[block]
                if not alive.all():
                    on = alive[doc]
                    doc, impact = doc[on], impact[on]
                lower[doc] += w * impact  # a document stands once in a list
                seen[i, doc] = True
                if start + depth < end:  # the list goes on: what the unread may still bring
                    rest += np.where(seen[i], 0, w * int(self.impact[start + depth]))
            if np.count_nonzero(lower) >= k:
                floor = max(floor, int(np.partition(lower, -k)[-k]))
            alive &= lower + rest >= floor
            if not rest[alive].any():
                break
            read, depth = depth, 2 * depth
        found = np.flatnonzero(alive & (lower >= floor))
        return _best(lower[found], self.ids[found], k)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _shards(batches: Iterator[pa.RecordBatch], n_docs: int, n_terms: int) -> Iterator[Shard]:
    """Shards of bounded size from the rows of the index."""
    def shard(rows):
        t = pa.Table.from_batches(rows)
        sizes = t.column("terms").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        flat = lambda c: t.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(t.num_rows), sizes)
        n = t.column("n").to_numpy()[doc]
        ids = t.column("doc_id").fill_null(NO_ID).to_numpy()
        return Shard(ids, doc, flat("terms"), impacts(flat("counts").astype(np.int64), n, n_docs, n_terms))

    held, docs, postings = [], 0, 0
    for b in batches:
        ends = np.cumsum(b.column("terms").value_lengths().to_numpy(zero_copy_only=False))
        start = 0
        while start < b.num_rows:
            before = ends[start - 1] if start else 0
            end = int(np.searchsorted(ends, before + SHARD_POSTINGS - postings, side="right"))
            end = min(max(end, start + (not held)), start + SHARD_DOCS - docs, b.num_rows)  # one row at least
            if end > start:
                held.append(b.slice(start, end - start))
                docs, postings, start = docs + end - start, postings + int(ends[end - 1] - before), end
            if start < b.num_rows or docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                yield shard(held)
                held, docs, postings = [], 0, 0
    if held:
        yield shard(held)


# ------------------------------------------------------------------- on Spark

def index(documents: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, terms, counts): per row its number of terms and the counts
    of the terms in `vocabulary`, written to the shared folder."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)  # a block's terms

    def postings(batches):
        known = shared.value
        for b in batches:
            ns, terms, counts = [], [], []
            for raw in b.column("text").cast(pa.large_binary()):
                found = terms_of(raw.as_py())
                ns.append(len(found))
                hits = [(known[t], c) for t, c in Counter(found).items() if t in known]
                terms.append([t for t, _ in hits])
                counts.append([c for _, c in hits])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ns, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                                              pa.array(counts, pa.list_(pa.int64()))], ["doc_id", "n", "terms", "counts"])

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return written(rows.mapInArrow(postings, "doc_id long, n long, terms array<int>, counts array<long>"), "lexical-index")


def _search(documents: DataFrame, block: list[tuple[object, Counter]], k: int, id_col: str, text_col: str) -> DataFrame:
    """(query, doc_id, score) of the k best of every query of a block;
    `query` is its place in the block."""
    vocabulary: dict[bytes, int] = {}
    for _, counts in block:
        for t in counts:
            vocabulary.setdefault(t, len(vocabulary))
    rows = index(documents, vocabulary, id_col, text_col)
    n_docs, n_terms = rows.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    df = dict(rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # a block's terms
    weights = {t: weight(n_docs, df[i]) for t, i in vocabulary.items() if i in df}
    queries = [[(vocabulary[t], c * weights[t]) for t, c in counts.items() if t in weights] for _, counts in block]
    shared = documents.sparkSession.sparkContext.broadcast(queries)

    def read(batches):
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in shared.value]
        for s in _shards(batches, n_docs, n_terms):
            for q, wanted in enumerate(shared.value):
                scores, ids = best[q]
                floor = max(1, int(scores[k - 1])) if len(scores) == k else 1
                more = s.best(wanted, k, floor)
                if len(more[0]):
                    best[q] = _best(np.append(scores, more[0]), np.append(ids, more[1]), k)
        sizes = [len(scores) for scores, _ in best]
        ids = np.concatenate([np.zeros(0, np.int64), *(i for _, i in best)])
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(best)), sizes)), pa.array(ids, mask=ids == NO_ID),
                                          pa.array(np.concatenate([np.zeros(0, np.int64), *(s for s, _ in best)]))], ["query", "doc_id", "score"])

    return rows.where("size(terms) > 0").mapInArrow(read, "query long, doc_id long, score long")


def ranked(documents: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): every item's k best documents with a
    score above 0 (all, if fewer), equal scores by ascending doc_id, null last.

    Every row of `items` is a query and every row of `documents` a document,
    also where ids repeat or are null.  Null and empty texts have no terms: as
    items they give no rows, as documents they are not counted.  Only the id
    and text columns are read; an empty table gives no rows.  The driver holds
    one partition of `items` and one block of at most BLOCK_TERMS terms (or one
    item, if that is longer).
    """
    spark = documents.sparkSession
    schema = f"item_id {items.schema[item_col].dataType.simpleString()}, rank int, doc_id long, score long"
    blocks, block, held = [], [], 0

    def search():
        found = _search(documents, block, k, id_col, text_col)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], f"query long, {schema.split(',')[0]}")
        blocks.append(top.join(names, "query").select("item_id", "rank", "doc_id", "score"))

    for item, text in items.select(item_col, item_text_col).toLocalIterator():
        counts = Counter(terms_of(text))
        if block and held + counts.total() > BLOCK_TERMS:
            search()
            block, held = [], 0
        if counts:
            block.append((item, counts))
            held += counts.total()
    if block:
        search()
    if not blocks:
        return spark.createDataFrame([], schema)
    if len(blocks) > 1:  # each block's rows once, in the shared folder
        path = scratch_path(spark, "lexical-ranks")
        for b in blocks:
            b.write.mode("append").parquet(path)
        return spark.read.schema(schema).parquet(path)
    return blocks[0]
