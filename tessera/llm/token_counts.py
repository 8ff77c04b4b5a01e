"""Token counts behind a digest cache.

Every text is reduced to a digest of its normalised content together with a
digest of the tokenizer file.  Digests are joined to the stored counts, only
the distinct digests without one are encoded, and their counts are appended to
the cache.  The cache is a Parquet folder: (digest, n_tokens) parts, one
append per run; a part is visible only when complete, and a digest appended
twice by concurrent runs has the same count in both.

Normalising collapses runs of ASCII white space to one space and trims the
ends.  No count depends on that for a tokenizer whose normaliser does the same
and which never joins characters across white space; `WordCounter` checks it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tessera.llm.common import (WHITE, WHITE_RUN, bit_words, filter_width, join_to_groups, text_or_empty, top_bits, with_bit,
                                written)

REMEMBERED = 400_000  # words in each of the two generations whose counts a worker keeps
LONGEST_REMEMBERED = 64
ENCODED_AT_ONCE = 2_000


class WordCounter:
    """Counts by the tokenizers library, word by word.

    Exact when white space always separates tokens: the pre-tokenizer removes
    what does not match a pattern that no white space matches, and no added
    token holds white space or strips it.  Otherwise whole texts are encoded.
    """

    def __init__(self, tokenizer_json: bytes):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_str(tokenizer_json.decode())
        spec = json.loads(tokenizer_json)
        pre = spec.get("pre_tokenizer") or {}
        first = (pre.get("pretokenizers") or [pre])[0]
        added = spec.get("added_tokens") or []
        self.by_word = (first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
                        and not any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["content"].split() != [a["content"]] for a in added)
                        and self._count([" ", *[f"a{w}b" for w in WHITE]]) == [0] + [2] * len(WHITE))
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def _count(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, text: str) -> int:
        if not self.by_word:
            return self._count([text])[0]
        split = text.split(" ")
        known = self.known
        try:
            return sum(map(known.__getitem__, split))
        except KeyError:
            pass
        fresh = {w for w in split if w not in known}
        found = {w: self.older[w] for w in fresh if w in self.older}
        new = [w for w in fresh if w not in found]
        for at in range(0, len(new), ENCODED_AT_ONCE):
            some = new[at:at + ENCODED_AT_ONCE]
            found.update(zip(some, self._count(some)))
        total = sum(known[w] if w in known else found[w] for w in split)
        kept = {w: n for w, n in found.items() if len(w) <= LONGEST_REMEMBERED}
        if len(known) + len(kept) > REMEMBERED:  # the younger generation grows old, the old one goes
            self.older, self.known = known, {}
        if len(kept) <= REMEMBERED:
            self.known.update(kept)
        return total


_loaded: dict[bytes, WordCounter] = {}


def counter(tokenizer_json: bytes) -> WordCounter:
    key = hashlib.sha256(tokenizer_json).digest()
    if key not in _loaded:
        _loaded[key] = WordCounter(tokenizer_json)
    return _loaded[key]


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, WHITE_RUN, " "))


def digest(text: Column, version: str) -> Column:
    return F.unhex(F.sha2(F.concat(F.lit(version + "\n"), text), 256))


def stored(spark, cache: str) -> DataFrame | None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    return spark.read.schema("digest binary, n_tokens bigint").parquet(cache)


def count_tokens(docs: DataFrame, tokenizer_path: str, cache: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048) -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens (no special tokens added,
    no truncation or padding), over_limit (n_tokens > limit).

    `cache` is a folder that all executors see; it is made if missing and may
    serve several tokenizers.  A null text counts as empty (no bytes, no
    tokens).  Rows that repeat get a row each, an empty table gives none; other
    columns are not read.
    """
    with open(tokenizer_path, "rb") as f:
        tokenizer_json = f.read()
    version = hashlib.sha256(tokenizer_json).hexdigest()
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    by_digest = written(docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"),
                                    digest(normalised(text), version).alias("digest")), "text-digests")
    n = by_digest.count()
    sizes = by_digest.groupBy("digest").agg(F.count("*").alias("size"), F.min("doc_id").alias("one_id"))
    sizes = written(sizes, "distinct-digests")
    before = stored(spark, cache)
    misses = sizes if before is None else sizes.join(before.select("digest").distinct(), "digest", "left_anti")
    # A text whose digest is neither repeated nor stored is encoded where it is
    # read.  A filter finds the rows that may be either; only those are shuffled,
    # to the row of each missing digest that is encoded.
    other = sizes.where("size > 1").select("digest")
    if before is not None:
        other = other.unionByName(sizes.select("digest").join(before.select("digest"), "digest", "left_semi")).distinct()
    bits = filter_width(other.count())
    filled = written(bit_words(other.select(top_bits(bits, "digest").alias("at")).distinct()), "repeat-filter")
    texts = docs.select(F.col(id_col).alias("doc_id"), normalised(text).alias("text"))
    texts = with_bit(texts.withColumn("digest", digest(F.col("text"), version)), top_bits(bits, "digest"), filled, "maybe")
    alone = texts.where("not maybe").select("digest", "text")
    wanted = misses.select(F.col("digest").alias("wanted"), "one_id")
    chosen = texts.where("maybe").join(wanted, (F.col("digest") == F.col("wanted")) & F.col("doc_id").eqNullSafe(F.col("one_id")))
    fresh = alone.unionByName(chosen.select("digest", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer_json).count
        for b in batches:
            n_tokens = [count(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(n_tokens, pa.int64())], ["digest", "n_tokens"])

    schema = StructType([StructField("digest", BinaryType()), StructField("n_tokens", LongType())])
    fresh.mapInArrow(run, schema).write.mode("append").parquet(cache)
    counts = stored(spark, cache).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    counts = sizes.select("digest", "size").join(counts, "digest")
    out = join_to_groups(by_digest, counts, "digest", "size", n)
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
