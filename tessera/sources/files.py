"""File sources and sinks.

Everything here is a `spark.read` / `df.write` call with the options that give
the reference's file semantics; nothing is read on the driver.

S1   key files: one key per line of every file matching a glob, stripped
S3   merge part files with a name prefix into one output (gz/bz2 by suffix is
     Spark's own codec detection); a single output file only on request
S4   idempotent output: skip when the output exists, or overwrite on retry
S10  word lists: stop list, hot-stop list, blacklist, whitelist with a score
     (default 2.0), blanks dropped (Q12, Q28)
S19  bulk Stata `.dta` -> CSV with a leading row-number column
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: score of a whitelist word without one.
DEFAULT_WORD_SCORE = 2.0


def read_keys(spark: SparkSession, pattern: str) -> DataFrame:
    """(key) per line of every file matching `pattern`, whitespace
    stripped.  Files are split and packed by `spark.sql.files.maxPartitionBytes`;
    many tiny files are combined into one task (the reference's split combiner)."""
    return spark.read.text(pattern).select(F.trim(F.col("value")).alias("key"))


def merge_parts(spark: SparkSession, prefix: str, dest: str, partitions: int | None = None,
                single_file: bool = False, retry: bool = True) -> DataFrame:
    """S3: every line of the files whose path starts with `prefix` written to
    `dest` as text.  Compressed parts are decoded by their suffix.  The output
    keeps the input's parallelism unless `partitions` is given; `single_file`
    (one output file, hence one writing task) is an explicit opt-in for small
    outputs only."""
    lines = spark.read.text(prefix + "*")
    if single_file:
        lines = lines.coalesce(1)
    elif partitions:
        lines = lines.repartition(partitions)
    write_once(lines, dest, fmt="text", retry=retry)
    return spark.read.text(dest)


def write_once(df: DataFrame, path: str, fmt: str = "parquet", retry: bool = False,
               partition_by=(), **options) -> bool:
    """Write `df` to `path` unless it is already there; with `retry` the
    old output is replaced.  Returns True when data was written.  The check is
    the committed-output marker, so a half-written output of a lost job is
    redone, never served."""
    jvm = df.sparkSession.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    fs = p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p) and not retry:
        return False
    w = df.write.mode("overwrite").format(fmt).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return True


def read_word_list(spark: SparkSession, path: str, with_score: bool = False,
                   default_score: float = DEFAULT_WORD_SCORE) -> DataFrame:
    """(word) or (word, score) from a text file, one entry per line,
    `word[<whitespace>score]`; every line trimmed (Q28), blank lines dropped
    (Q12).  Word lists are small job inputs: callers broadcast them."""
    lines = spark.read.text(path).select(F.trim(F.col("value")).alias("line")).where(F.col("line") != "")
    parts = F.split(F.col("line"), r"\s+", 2)
    if not with_score:
        return lines.select(parts[0].alias("word")).distinct()
    score = F.coalesce(F.try_element_at(parts, F.lit(2)).try_cast("double"), F.lit(default_score))
    return lines.select(parts[0].alias("word"), score.alias("score"))


def stata_rows(spark: SparkSession, pattern_dir: str, schema: str, glob: str = "*dta",
               chunk_rows: int = 100_000) -> DataFrame:
    """S19 read side: rows of every file under `pattern_dir` whose name ends
    in `dta`, as (file, row_no, <schema columns>).  One file is one task (the
    format is not splittable); inside it the file is decoded in chunks of
    `chunk_rows`, so memory holds one chunk of output at a time.  `row_no`
    counts from 0 inside each file (the leading index column of the CSV)."""
    out_schema = f"file string, row_no bigint, {schema}"
    names = [f.strip().split(" ", 1)[0] for f in schema.split(",")]

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                start = 0
                with pd.read_stata(io.BytesIO(content), iterator=True, convert_categoricals=False) as rd:
                    while True:
                        try:
                            chunk = rd.read(chunk_rows)
                        except StopIteration:
                            break
                        if chunk is None or len(chunk) == 0:
                            break
                        chunk = chunk.reset_index(drop=True)
                        out = pd.DataFrame({"file": path.rsplit("/", 1)[-1],
                                            "row_no": range(start, start + len(chunk))})
                        for n in names:
                            out[n] = chunk[n].values if n in chunk.columns else None
                        start += len(chunk)
                        yield out

    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .load(pattern_dir).select("path", "content"))
    # binaryFile never splits a file, so each file decodes inside one task and
    # no file content is shuffled
    return files.mapInPandas(decode, out_schema)


def stata_to_csv(spark: SparkSession, src_dir: str, dest: str, schema: str,
                 retry: bool = True) -> DataFrame:
    """Every `.dta` file under `src_dir` as CSV with a header and the
    leading row-number column, one output folder per source file."""
    rows = stata_rows(spark, src_dir, schema)
    write_once(rows, dest, fmt="csv", retry=retry, partition_by=("file",), header="true")
    return rows
