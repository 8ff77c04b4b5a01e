"""A table in key buckets that changes are merged into.

Rows lie in cells: a bucket of the key's hash, within a partition value if the
table has a partition column.  A batch of changes reads and rewrites the cells
that its keys fall into and no others, into a new folder; then one manifest
makes the new folders of those cells the table's.  Readers see the table before
or after a batch, never in between; a job that dies leaves it as it was, and a
batch whose number is already in the manifest changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.store import Manifest, materialised, names_in

CELL = "_cell"


class BucketedTable:
    def __init__(self, spark: SparkSession, root: str, keys: list[str], n_buckets: int = 16, partition: str | None = None):
        """`keys` find a row; `partition` is a column with few values, such as
        a report date, that every change names.  `n_buckets` stays as it was
        when the table was made."""
        self.spark, self.root, self.keys, self.n_buckets, self.partition = spark, root.rstrip("/"), keys, n_buckets, partition
        self.manifest = Manifest(spark, root)

    def _cell(self) -> Column:
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.n_buckets)).cast("string")
        if self.partition is None:
            return bucket
        value = F.coalesce(F.col(self.partition).cast("string"), F.lit("null"))
        return F.concat_ws("~", F.regexp_replace(value, "[^0-9A-Za-z.-]", "_"), bucket)

    def _write(self, rows: DataFrame) -> dict[str, str]:
        """Rows to a new folder; its cells and their folders."""
        folder = f"data/{uuid.uuid4().hex}"
        # rebalanced by cell: small cells are one file, a large one is split
        rows.withColumn(CELL, self._cell()).hint("rebalance", CELL).write.partitionBy(CELL).parquet(f"{self.root}/{folder}")
        found = [n for n in names_in(self.spark, f"{self.root}/{folder}") if n.startswith(f"{CELL}=")]
        return {n.split("=", 1)[1]: f"{folder}/{n}" for n in found}

    def create(self, rows: DataFrame) -> None:
        version, _ = self.manifest.load()
        self.manifest.swap(version, {"schema": rows.schema.json(), "cells": self._write(rows), "batches": []})

    def read(self, cells: set[str] | None = None) -> DataFrame:
        content = self.manifest.load()[1]
        return self._rows(content, [p for c, p in content["cells"].items() if cells is None or c in cells])

    def _rows(self, content: dict, folders: list[str]) -> DataFrame:
        import json
        schema = T.StructType.fromJson(json.loads(content["schema"]))
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in sorted(folders)])

    def merge(self, changes: DataFrame, apply: Callable[[DataFrame, DataFrame], DataFrame], batch: str) -> dict[str, int]:
        """`apply(old rows, changes)` gives the rows of the touched cells anew.
        Returns how many cells were touched and how many there are; nothing
        happens, and 0 are touched, if the batch was merged before."""
        version, content = self.manifest.load()
        cells = content["cells"]
        if batch in content["batches"]:
            return {"touched": 0, "cells": len(cells)}
        changes = materialised(changes.withColumn(CELL, self._cell()), "changes")
        touched = {r[0] for r in changes.select(CELL).distinct().collect()}  # buckets of the batch's partitions
        old = self._rows(content, [p for c, p in cells.items() if c in touched])
        columns = old.columns
        made = self._write(apply(old, changes.drop(CELL)).select(*columns))
        kept = {c: p for c, p in cells.items() if c not in touched}
        self.manifest.swap(version, content | {"cells": kept | made, "batches": [*content["batches"], batch]})
        return {"touched": len(touched), "cells": len(kept | made)}
