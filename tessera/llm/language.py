"""Language ID by compression.

For every language of the training rows a zstandard dictionary of raw content
is made from a bounded sample of its texts.  A text is compressed with every
dictionary; the language whose dictionary makes it smallest wins.  A narrow
margin between the best two is a rejection.

Bounds: per language `SAMPLES` blocks of at most `BLOCK` characters, so each
dictionary is under `4 * SAMPLES * BLOCK` bytes; only those blocks come to the
driver.  Whole texts are compressed, in pieces of `PIECE` bytes so that a long
text does not become its own dictionary.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from tessera.llm.common import held_out

SAMPLES = 64  # blocks per language
BLOCK = 1536  # characters of a block
PIECE = 8192  # bytes compressed at once
LEVEL = 6
NARROW = 0.02  # rejected: second best within 2 % of the best
FOLDS = 4
UNDETERMINED = "und"


def training_blocks(docs: DataFrame, id_col: str, text_col: str, lang_col: str, folds: int) -> DataFrame:
    """(lang, block): per language and hash bucket the block of one training
    row, texts of `BLOCK` characters or more first.  Each text's block starts
    at a place that its id decides."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col, folds))
    salted = F.xxhash64(F.col(id_col).cast("string"), F.lit("sample"))
    short = F.char_length(text_col) < BLOCK
    rank = F.shiftrightunsigned(salted, 2) + F.when(short, F.lit(1 << 62)).otherwise(F.lit(0))
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
                       F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("bucket")), F.lit(SAMPLES)).alias("bucket"),
                       rank.alias("rank"))
    first = rows.groupBy("lang", "bucket").agg(F.min("rank").alias("rank"))
    # at most SAMPLES rows a language
    chosen = rows.join(F.broadcast(first), ["lang", "bucket", "rank"])
    start = F.pmod(F.col("rank"), F.greatest(F.lit(1), F.char_length("text") - BLOCK + 1)) + 1
    return chosen.groupBy("lang", "bucket").agg(
        F.max(F.substring("text", start.cast("int"), F.lit(BLOCK))).alias("block"))


class Compressors:
    """One compressor per language, in the order of the names."""

    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard

        self.names = sorted(dictionaries)
        self.each = []
        for name in self.names:
            content = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            self.each.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=content, write_content_size=False,
                                                      write_checksum=False, write_dict_id=False))

    def sizes(self, text: str) -> list[int]:
        data = text.lower().encode("utf-8", "replace")
        pieces = [data[i:i + PIECE] for i in range(0, len(data), PIECE)]
        return [sum(len(c.compress(p)) for p in pieces) for c in self.each]

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected).  Equal sizes go to the first name."""
        if text is None or not self.names or not has_letter(text):
            return UNDETERMINED, 0.0, True
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        if len(sizes) == 1:
            return self.names[best], 1.0, False
        second = min(s for k, s in enumerate(sizes) if k != best)
        margin = (second - sizes[best]) / second
        return self.names[best], 1 - math.exp(-margin / NARROW * math.log(2)), margin < NARROW


def has_letter(text: str) -> bool:
    return bool(re.search("[A-Za-z]", text)) or any(map(str.isalpha, text))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          folds: int = FOLDS) -> dict[str, bytes]:
    """Dictionary content by language, from the rows that are not held out."""
    rows = training_blocks(docs, id_col, text_col, lang_col, folds).collect()  # SAMPLES a language at most
    out: dict[str, bytes] = {}
    for lang, _, block in sorted(rows, key=lambda r: (r[0], r[1])):
        out[lang] = out.get(lang, b"") + block.lower().encode("utf-8", "replace") + b"\n"
    return out


_made: dict[str, Compressors] = {}


def identify(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text",
             folds: int = FOLDS) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score (0 to 1; 0.5 at a margin of
    `NARROW`), rejected (below that margin).

    `und` (score 0, rejected) if the text is null or has no letter, or nothing
    was learned.  Rows that repeat are judged alike; an empty table gives no
    rows; only id and text are read."""
    key = hashlib.sha256(repr(sorted(dictionaries.items())).encode()).hexdigest()
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col, folds).alias("held_out"), F.col(text_col).alias("text"))
    schema = StructType([rows.schema["doc_id"], rows.schema["held_out"], StructField("lang_pred", StringType()),
                         StructField("score", DoubleType()), StructField("rejected", BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _made:
            _made.clear()
            _made[key] = Compressors(dictionaries)
        for b in batches:
            judged = [_made[key].judge(t.as_py()) for t in b.column("text")]
            columns = [pa.array([j[k] for j in judged], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), *columns], schema.fieldNames())

    return rows.mapInArrow(run, schema)
