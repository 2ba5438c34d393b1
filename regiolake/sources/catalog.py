"""SRC-10 / SRC-11 / SRC-12: the declared table catalog and whole-table reads."""
from __future__ import annotations

import os
import re
from collections.abc import Iterable, Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Names of the driver tables this repository is tested on.
DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


class Catalog:
    """Name -> parquet path, read lazily.  ``tables()`` returns DataFrames whose scans
    are pruned and filtered by Catalyst when the caller selects/filters."""

    def __init__(self, spark: SparkSession, base_dir: str, names: Iterable[str] = DRIVER_TABLES,
                 fmt: str = "parquet", paths: Mapping[str, str] | None = None):
        self.spark = spark
        self.base_dir = base_dir
        self.fmt = fmt
        self.paths = dict(paths or {n: os.path.join(base_dir, f"{n}.{fmt}") for n in names})

    def path(self, name: str) -> str:
        return self.paths[name]

    def read(self, name: str) -> DataFrame:
        return self.spark.read.format(self.fmt).load(self.paths[name])

    def __getitem__(self, name: str) -> DataFrame:
        return self.read(name)

    def names(self) -> list[str]:
        return list(self.paths)

    def register_views(self, prefix: str = "") -> None:
        """SRC-11: one temp view per declared table, for ``spark.sql``."""
        for n in self.paths:
            self.read(n).createOrReplaceTempView(prefix + n)

    def row_counts(self) -> DataFrame:
        """SRC-10 whole-table read of every table, one (table_name, row_count) row each.

        Each count is answered from Parquet footers where possible (no
        columns are read)."""
        parts = [self.read(n).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(n).alias("table_name"), F.col("row_count")) for n in self.paths]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def latest_file(spark: SparkSession, pattern: str, fmt: str = "binaryFile", by: str = "file_name",
                options: Mapping[str, str] | None = None) -> DataFrame:
    """SRC-12: rows of the file whose name (``by="file_name"``) or full path (``by="file_path"``) sorts last among those matching
    ``pattern``; of files with one name in several folders, of all.

    The choice is made from the listing, which every read of a pattern makes, so the scan holds that file alone and no other is
    opened.  No match is an error, as for any read."""
    files = [unquote(f) for f in spark.read.format("binaryFile").load(pattern).inputFiles()]
    if not files:
        raise FileNotFoundError(f"no file matches {pattern}")

    def rank(f: str) -> str:
        return f.rsplit("/", 1)[-1] if by == "file_name" else f
    last = max(map(rank, files))
    chosen = [re.sub(r"([\\{}\[\]*?])", r"\\\1", f) for f in files if rank(f) == last]      # a name, no pattern
    return spark.read.format(fmt).options(**(options or {})).load(chosen)
