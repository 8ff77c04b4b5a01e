"""Derived tables written once to the shared checkpoint folder.

The forward index (`doc_terms`) and the assembled corpus are what the
reference keeps in its full-text index: built by the load step, read by every
scoring job.  Here they are Parquet tables under `spark.checkpoint.dir`
(the cluster's shared folder), keyed by a name, the builder's parameters and a
fingerprint of the input files (size, file count, modification time), so a
changed input is never served from a stale table.  Reading them back cuts the
lineage: later plans start from a plain Parquet scan (column pruning, filter
pushdown) and a lost executor only re-reads files.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.session import checkpoint_dir


# Raised with any change to what a builder writes, so that no table of an
# earlier version of the code is served.
VERSION = 6


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def fingerprint(spark: SparkSession, inputs) -> str:
    h = hashlib.sha1()
    for path in sorted(inputs):
        fs, p = _fs(spark, path)
        if fs.exists(p):
            cs = fs.getContentSummary(p)
            st = fs.getFileStatus(p)
            h.update(f"{path}|{cs.getLength()}|{cs.getFileCount()}|{st.getModificationTime()}".encode())
        else:
            h.update(f"{path}|missing".encode())
    return h.hexdigest()[:16]


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def derived_table(spark: SparkSession, name: str, inputs, build: Callable[[], DataFrame],
                  params: str = "") -> DataFrame:
    """The table `build()` describes, written once per (name, params, inputs)."""
    return spark.read.parquet(derived_path(spark, name, inputs, build, params))


def derived_path(spark: SparkSession, name: str, inputs, build: Callable[[], DataFrame],
                 params: str = "") -> str:
    """Folder of the Parquet files of `build()`, written once per (name,
    params, inputs); one file per partition of the built DataFrame."""
    return derived_folder(spark, name, inputs, lambda path: build().write.option("compression", "zstd").parquet(path), params)


def derived_folder(spark: SparkSession, name: str, inputs, build: Callable[[str], object],
                   params: str = "") -> str:
    """The folder that `build(path)` fills, made once per (name, params, inputs)."""
    key = hashlib.sha1(f"{VERSION}|{name}|{params}|{fingerprint(spark, inputs)}".encode()).hexdigest()[:20]
    path = f"{checkpoint_dir(spark).rstrip('/')}/derived/{name}-{key}"
    if not exists(spark, path + "/_SUCCESS"):
        # build into a private folder next to the target, then rename: two
        # jobs building the same table never write into each other, and a
        # reader sees either no table or a complete one
        tmp = f"{path}.tmp-{uuid.uuid4().hex}"
        build(tmp)
        if not exists(spark, tmp + "/_SUCCESS"):
            write_text(spark, tmp + "/_SUCCESS", "")
        fs, src = _fs(spark, tmp)
        _, dst = _fs(spark, path)
        if exists(spark, path + "/_SUCCESS") or not fs.rename(src, dst):
            fs.delete(src, True)  # another job got there first: use its table
        else:
            # a rename onto a folder that appeared meanwhile puts ours inside it
            _, inside = _fs(spark, f"{path}/{src.getName()}")
            if fs.exists(inside):
                fs.delete(inside, True)
    return path


def materialised(df: DataFrame, name: str, file_rows: int = 0) -> DataFrame:
    """`df` written to the shared folder and read again: the lineage is cut by
    files that survive a lost executor, and every reader sees the same rows.
    A file has at most `file_rows` rows (0: any number)."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/steps/{name}-{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --------------------------------------------------- manifests of versioned tables

def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file (a manifest, a marker), written whole or not at all."""
    fs, p = _fs(spark, path)
    _, tmp = _fs(spark, f"{path}.tmp-{uuid.uuid4().hex}")
    out = fs.create(tmp)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(tmp, p):
        fs.delete(tmp, False)
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    source = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
    finally:
        source.close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder, sorted; none if it is missing."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


class Manifest:
    """What a versioned table consists of: `<root>/manifest/<version>.json`.

    Data files are written first, under names of their own; then one new
    manifest makes them the table.  Readers take the newest manifest, so they
    see all of a change or nothing of it; a job that dies before its manifest
    leaves the table as it was.  Two writers that start from one version cannot
    both win: the second finds its version taken and raises FileExistsError."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def load(self) -> tuple[int, dict]:
        """(version, content); (0, {}) of a new table."""
        found = [n for n in names_in(self.spark, f"{self.root}/manifest") if n.endswith(".json")]
        if not found:
            return 0, {}
        return int(found[-1][:-5]), json.loads(read_text(self.spark, f"{self.root}/manifest/{found[-1]}"))

    def swap(self, version: int, content: dict) -> None:
        """`content` becomes version + 1."""
        path = f"{self.root}/manifest/{version + 1:012d}.json"
        if exists(self.spark, path):
            raise FileExistsError(path)
        write_text(self.spark, path, json.dumps(content, sort_keys=True))
