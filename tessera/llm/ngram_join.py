"""N-gram Jaccard join by chosen paths.

The self-join of documents by the Jaccard similarity of their word shingles,
without emitting the pairs of a group:

1. Documents with equal shingle sets form a class; one of them goes on.
2. Chosen paths: in every run a set goes to the bucket of one of its tokens,
   sampled with a hash that all sets share (its minimum hash number c), so two
   sets share the bucket with a probability equal to their similarity.  Buckets
   of more than `SMALL` sets split again on the next sampled token.
3. Small buckets are compared by brute force on `TOKENS` minimum hashes with a
   margin of about four standard deviations below the threshold; what passes
   is linked as a candidate.  A large bucket most of whose sets agree with one
   of them, or one that is still large after `LEVELS` splits, is linked whole:
   that can only add candidates, and a large group of near copies is done with
   at the first level instead of going through all of them.
4. Runs come in rounds.  A set that ended at depth d in a run kept a partner at
   the threshold t with probability t^d; rounds, each with hashes of its own,
   go on until no set is left for which the product of (1 - t^d) over the runs
   is above 1 - `RECALL`.
5. Candidates' components are verified exactly, all pairs of a component, on
   the whole shingle sets.  A component of more than `BLOCK` sets or
   `BLOCK_SHINGLES` shingles is cut into blocks, and each pair of blocks is a
   task of its own; tasks return counts and one link a set, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tessera.llm import shingles as sh
from tessera.llm.common import in_groups, join_to_groups, packed, rows_with, written
from tessera.llm.components import components

SIMILARITY = 0.8
RECALL = 0.999
TOKENS = 96  # minimum hashes a set
RUNS, LEVELS = 12, 8  # a round uses RUNS * LEVELS sampled tokens
SMALL = 256
AGREEING = 0.5  # share of a large bucket that agrees with one of its sets when it is linked whole
COMPARED = 48  # minimum hashes on which that is seen
BLOCK, BLOCK_SHINGLES = 512, 1 << 19


def _sets(table: DataFrame, size: int, draw: int = 0) -> DataFrame:
    """(rid, n, digest, tokens) of the rows (rid, text) that have a shingle;
    the tokens of a later `draw` are independent of the first ones."""
    schema = StructType([StructField("rid", LongType()), StructField("n", LongType()),
                         StructField("digest", BinaryType()), StructField("tokens", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [[], [], [], []]
            for rid, text in zip(b.column("rid").to_pylist(), b.column("text")):
                hashes = sh.shingles(text.as_py(), size)
                if len(hashes):
                    for column, value in zip(out, (rid, len(hashes), sh.set_digest(hashes), sh.minhashes(hashes, TOKENS, draw).tobytes())):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                                             schema.fieldNames())

    return table.mapInArrow(run, schema)


def _token(level: int):
    """The token on which a run splits at a level: another one in every run
    and level."""
    return F.substring(F.col("tokens"), (F.col("run") * LEVELS + level) * 4 + 1, F.lit(4))


def _cohesive(large: DataFrame, level: int, similarity: float, rows: int) -> DataFrame:
    """The paths of the large buckets (path, rep, size, tokens) most of whose
    sets agree with one set of the bucket, drawn anew at every level."""
    drawn = F.xxhash64("rep", F.lit(level))
    leader = large.groupBy("path", "size").agg(F.min_by("tokens", drawn).alias("first"))
    both = join_to_groups(large.select("path", "tokens"), leader, "path", "size", rows)
    same = sum(((F.substring("tokens", 4 * k + 1, 4) == F.substring("first", 4 * k + 1, 4)).cast("int") for k in range(COMPARED)), F.lit(0))
    need = COMPARED * similarity - 4.5 * math.sqrt(COMPARED * similarity * (1 - similarity))
    agree = both.groupBy("path", "size").agg(F.count_if(same >= need).alias("agree"))
    return agree.where(F.col("agree") >= F.col("size") * AGREEING).select("path", "size")


def _round(sets: DataFrame, round_: int, n: int, similarity: float) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """One round of runs over `n` sets (rep, tokens): buckets (path, rep) to
    compare, buckets (path, rep, size) to link whole, and (rep, deeper): how
    much splitting again cost the set in log(probability of a miss).

    Paths are shuffled without the tokens; the sets in large buckets, few,
    fetch theirs."""
    runs = F.explode(F.sequence(F.lit(0), F.lit(RUNS - 1)))
    now = sets.select("rep", "tokens", F.lit(round_).cast("long").alias("path"), runs.alias("run"))
    rows, compare, whole, deeper = n * RUNS, [], [], []
    for level in range(LEVELS):
        now = now.select("rep", "run", F.xxhash64("path", "run", _token(level)).alias("path"))
        sizes = now.groupBy("path").agg(F.count("*").alias("size")).where("size > 1")
        now = written(join_to_groups(now, sizes, "path", "size", rows), "paths")
        small, large = now.where(F.col("size") <= SMALL), now.where(F.col("size") > SMALL)
        compare.append(small.select("path", "rep"))
        rows = large.count()
        if rows == 0:
            break
        if level == LEVELS - 1:
            whole.append(large.select("path", "rep", "size"))
            break
        if level == 0:
            wanted = written(large.select("rep").distinct(), "splitting")
            tokens = written(rows_with(sets, "rep", wanted, wanted.count(), "left_semi"), "splitting-sets")
        large = written(large.join(tokens, "rep"), "large-buckets")
        alike = written(_cohesive(large, level, similarity, rows), "alike-buckets")
        if alike.count():
            marked = large.join(F.broadcast(alike.select("path", F.lit(True).alias("alike"))), "path", "left")  # one row a large bucket
            whole.append(marked.where("alike").select("path", "rep", "size"))
            large = marked.where("alike is null").drop("alike")
            rows = large.count()
            if rows == 0:
                break
        cost = math.log1p(-similarity ** (level + 2)) - math.log1p(-similarity ** (level + 1))
        deeper.append(large.select("rep", F.lit(cost).alias("deeper")))
        now = large.drop("size")
    return (_union(compare), _union(whole) if whole else None,
            _union(deeper).groupBy("rep").agg(F.sum("deeper").alias("deeper")) if deeper else None)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _forest(n: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Root (least index) of each of n nodes under the links first-second."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[first], root[second])
        nxt = root.copy()
        np.minimum.at(nxt, root[first], low)
        np.minimum.at(nxt, root[second], low)
        nxt = nxt[nxt]
        if (nxt == root).all():
            return root
        root = nxt


_EDGES = StructType([StructField("a", LongType()), StructField("b", LongType())])


def _compared(buckets: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between the sets of each small bucket whose sketches agree
    enough: one link a set, to the least set of its component in the bucket."""
    need = math.floor(TOKENS * similarity - 4.5 * math.sqrt(TOKENS * similarity * (1 - similarity)))
    rows = buckets.join(sketches, "rep").repartition("path").sortWithinPartitions("path", "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found_a, found_b = [], []
        for bucket in in_groups(batches, "path"):
            reps = bucket.column("rep").to_numpy()
            marks = np.frombuffer(b"".join(bucket.column("sketch").to_pylist()), np.uint8).reshape(len(reps), TOKENS)
            if len(reps) == 2:
                if np.count_nonzero(marks[0] == marks[1]) >= need:
                    found_a.append(reps[1:])
                    found_b.append(reps[:1])
                continue
            alike = np.stack([np.count_nonzero(marks == m, axis=1) for m in marks]) >= need
            first, second = np.nonzero(np.triu(alike, 1))
            if len(first):
                root = _forest(len(reps), first, second)
                moved = root != np.arange(len(reps))
                found_a.append(reps[moved])
                found_b.append(reps[root[moved]])
            if len(found_a) > 1000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (found_a, found_b)], ["a", "b"])
                found_a, found_b = [], []
        if found_a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (found_a, found_b)], ["a", "b"])

    return rows.mapInArrow(run, _EDGES).distinct()


def candidate_links(sets: DataFrame, similarity: float, recall: float, drawn) -> DataFrame:
    """Links (a, b) of the sets (rep, tokens) that the chosen paths bring
    together and whose sketches agree.  `drawn(reps, n, round)` gives (rep,
    tokens) of the n sets `reps` with the tokens of a later round."""
    # the low byte of each minimum hash
    sketch = F.concat(*[F.substring("tokens", 4 * k + 1, 1) for k in range(TOKENS)])
    now, n, links = sets, sets.count(), []
    missed = None  # (rep, missed): log(probability of a miss) so far
    first = RUNS * math.log1p(-similarity)
    round_ = 0
    while True:
        compare, whole, deeper = _round(now, round_, n, similarity)
        links.append(written(_compared(compare, now.select("rep", sketch.alias("sketch")), similarity), "links"))
        if whole is not None:
            least = whole.groupBy("path").agg(F.min("rep").alias("b"), F.count("*").alias("n"))
            links.append(join_to_groups(whole.select("path", F.col("rep").alias("a")), least, "path", "n", n * RUNS).where("a != b").select("a", "b").distinct())
        # a round always lowers a set's probability of a miss, so this ends
        deeper = deeper if deeper is not None else now.select("rep", F.lit(0.0).alias("deeper")).limit(0)
        if missed is None:
            left = deeper.select("rep", (F.col("deeper") + first).alias("missed"))
        else:
            left = missed.join(deeper, "rep", "left").select("rep", (F.col("missed") + F.coalesce("deeper", F.lit(0.0)) + first).alias("missed"))
        missed = written(left.where(F.col("missed") > math.log(1 - recall)), "unfinished")
        n, round_ = missed.count(), round_ + 1
        if n == 0:
            break
        # a pair of which one set is finished is found with the recall already
        now = written(drawn(missed.select("rep"), n, round_), "again")
    return _union(links)


def _overlaps(hashes: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 blocks over the
    shingles that two sets or more hold."""
    rows = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
    _, column, count = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    number = np.cumsum(count > 1) - 1
    rows, column = rows[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    out = np.zeros((len(hashes), len(hashes)), np.float32)
    width = 4096
    cuts = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + width, width))
    for k, (start, end) in enumerate(zip(cuts[:-1], cuts[1:])):
        block = np.zeros((len(hashes), width), np.float32)
        block[rows[start:end], column[start:end] - k * width] = 1
        out += block @ block.T
    return out.astype(np.int64)


_VERIFIED = StructType([StructField("rep", LongType()), StructField("links", LongType()), StructField("root", LongType())])


def verified_links(members: DataFrame, similarity: float) -> DataFrame:
    """Exact links within components.  `members`: rep, m (rows of its class),
    hashes (binary), root, size and shingles of its component.  Gives, per set
    and pair of blocks: links (rows of the linked classes) and the least set
    that it is connected to there."""
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("long")
    rows = members.select("rep", "m", "hashes", "root", blocks.alias("blocks"), F.pmod(F.xxhash64("rep"), blocks).alias("block"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    rows = rows.select("*", other.alias("other")).select(
        F.xxhash64("root", F.least("block", "other"), F.greatest("block", "other")).alias("task"), "rep", "m", "hashes",
        F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).alias("side"))
    rows = rows.repartition("task").sortWithinPartitions("task", "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task in in_groups(batches, "task"):
            reps, m, side = (task.column(c).to_numpy() for c in ("rep", "m", "side"))
            hashes = [np.frombuffer(h.as_buffer(), np.uint64) for h in task.column("hashes")]
            n = np.array([len(h) for h in hashes])
            both = _overlaps(hashes)
            linked = both >= similarity * (n[:, None] + n[None, :] - both) - 1e-9
            np.fill_diagonal(linked, False)
            if side.any():  # two blocks: pairs within a block have a task of their own
                linked &= side[:, None] != side[None, :]
            first, second = np.nonzero(np.triu(linked, 1))
            if len(first):
                root, some = _forest(len(reps), first, second), linked.any(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(reps[some]), pa.array((linked @ m)[some]), pa.array(reps[root[some]])],
                                                 _VERIFIED.fieldNames())

    return rows.mapInArrow(run, _VERIFIED)


def _classes(table: DataFrame, similarity: float, size: int, recall: float) -> DataFrame:
    """(rid, keep_rid, class_id, n_links, class_size) of the rows (rid, id,
    text) that have a shingle."""
    ids = table.select("rid", "id")
    sets = written(_sets(table.select("rid", "text"), size), "sets")
    n = sets.count()
    equal = written(sets.groupBy("digest").agg(F.min("rid").alias("rep"), F.count("*").alias("m")), "equal")
    copies = equal.where("m > 1")
    dropped = join_to_groups(sets.select("rid", "digest"), copies, "digest", "m", n).where("rid != rep").select("rid")
    dropped = written(dropped, "equal-sets")
    ones = written(rows_with(sets, "rid", dropped, dropped.count(), "left_anti").select(F.col("rid").alias("rep"), "n", "tokens"), "representatives")

    def drawn(reps: DataFrame, n_reps: int, round_: int) -> DataFrame:
        some = rows_with(table.select("rid", "text"), "rid", reps.withColumnRenamed("rep", "rid"), n_reps, "left_semi")
        return _sets(some, size, round_).select(F.col("rid").alias("rep"), "tokens")

    found = written(components(candidate_links(ones.select("rep", "tokens"), similarity, recall, drawn)).withColumnRenamed("node", "rep"), "candidates")
    n_found = found.count()
    texts = rows_with(table.select("rid", "text"), "rid", found.select(F.col("rep").alias("rid")), n_found, "left_semi")

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [sh.shingles(t.as_py(), size).tobytes() for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("rid"), pa.array(made, pa.binary())], ["rep", "hashes"])

    whole_sets = texts.mapInArrow(hashes, StructType([StructField("rep", LongType()), StructField("hashes", BinaryType())]))
    facts = written(found.join(ones.select("rep", "n"), "rep").join(equal.select("rep", "m"), "rep"), "facts")
    sizes = facts.groupBy("root").agg(F.count("*").alias("size"), F.sum("n").alias("shingles"))
    facts = join_to_groups(facts, sizes, "root", "size", n_found)
    links = written(verified_links(facts.join(whole_sets, "rep"), similarity), "verified")
    roots = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "rep")
    linked = written(roots.join(links.groupBy("rep").agg(F.sum("links").alias("links")), "rep"), "linked")

    keep = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "rid"))
    by_digest = sets.join(ids, "rid").groupBy("digest").agg(keep.alias("keep"))
    classes = written(equal.join(by_digest, "digest").join(linked, "rep", "left")
                      .withColumn("root", F.coalesce("root", "rep")).na.fill(0, ["links"]), "classes")
    by_root = classes.groupBy("root").agg(F.min("keep").alias("first"), F.sum("m").alias("class_size"), F.count("*").alias("n_sets"))
    classes = join_to_groups(classes.drop("keep"), by_root, "root", "n_sets", n).select(
        "digest", "m", F.col("first.rid").alias("keep_rid"), F.col("first.id").alias("class_id"),
        (F.col("links") + F.col("m") - 1).alias("n_links"), "class_size")
    return join_to_groups(sets.select("rid", "digest"), classes, "digest", "m", n).drop("digest", "m")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
                 size: int = sh.SIZE, recall: float = RECALL) -> DataFrame:
    """One row per row of `docs`: doc_id, class_id (least id of the documents
    connected by links), n_links (other rows whose shingle set has a Jaccard
    similarity of `similarity` or more), class_size, kept (one row a class).

    Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased; a text of fewer than
    `size` words is one shingle.  A null or empty text has none: it is a class
    of its own without links.  Rows that repeat are links of one another, of
    which one is kept; a null id comes last.  Only id and text are read."""
    table = written(docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), F.col(text_col).alias("text")), "texts", "zstd")
    classes = written(_classes(table, similarity, size, recall), "joined")
    one = F.lit(1).cast("long")
    return table.select("rid", "id").join(classes, "rid", "left").select(
        F.col("id").alias("doc_id"), F.when(F.col("class_size").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("class_size", one).alias("class_size"),
        F.coalesce(F.col("keep_rid") == F.col("rid"), F.lit(True)).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
                     size: int = sh.SIZE, recall: float = RECALL) -> DataFrame:
    """The rows of `docs` that `jaccard_join` keeps, with all their columns."""
    table = written(packed(docs, rid=F.monotonically_increasing_id()), "texts", "zstd")
    narrow = table.select("rid", F.col("row")[id_col].alias("id"), F.col("row")[text_col].alias("text"))
    dropped = written(_classes(narrow, similarity, size, recall).where("rid != keep_rid").select("rid"), "dropped")
    return rows_with(table, "rid", dropped, dropped.count(), "left_anti").select("row.*")
