"""Small helpers shared by the training-data operators."""
from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiolake.session import materialize, scratch_path

__all__ = ["Parts", "arrow_rows", "col", "fit_in_task", "others", "plain_names", "read", "sha_hex", "stored", "values", "text_or_empty"]


def col(name: str) -> Column:
    """A column by its exact name; dots and spaces in the name are no syntax."""
    return F.col("`" + name.replace("`", "``") + "`")


def others(df: DataFrame, own: Iterable[str]) -> list[str]:
    """Input columns that don't clash with an operator's own columns.  Spark compares names without
    case, so ``Shard`` clashes with ``shard``; an operator's column replaces the input's."""
    own = {c.lower() for c in own}
    return [c for c in df.columns if c.lower() not in own]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives a lost
    executor, and every later use sees the same rows."""
    return materialize(df, name)


class Parts:
    """A table in the shared folder that is written part by part: however many parts there are, the plan that reads
    them stays one scan."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self.schema, self.n = spark, scratch_path(spark, name), None, 0

    def add(self, df: DataFrame) -> None:
        df.write.parquet(f"{self.path}/part={self.n}")
        self.schema, self.n = df.schema, self.n + 1

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path).drop("part")


def arrow_rows(df: DataFrame, most: int = 256) -> DataFrame:
    """Bound the rows that a Python worker gets at once: whole texts in batches of ten thousand take
    hundreds of megabytes in the worker and in the JVM.  A setting of the session, lowered only."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= most:
        conf.set(name, most)
    return df


def fit_in_task(rows: DataFrame, fit: Callable[[Iterable[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> list[np.ndarray]:
    """The model that ``fit`` makes of a bounded sample, as one row of arrays.  The sample meets in one task: the
    driver gets the model only, and neither the rows nor the fit take its memory.  A table without partitions has no task."""
    got = arrow_rows(rows).repartition(1).mapInArrow(fit, schema).toArrow()
    if not got.num_rows:
        got = pa.Table.from_batches(list(fit(())))
    return [c[0].values.to_numpy(zero_copy_only=False).copy() for c in got.columns]


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def sha_hex(c: Column) -> Column:
    return F.sha2(c, 256)


def values(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A small driver-side table as a local relation: no Python worker, and Spark knows its size, so
    its own threshold decides between a broadcast and a shuffle."""
    fields = [f.strip().split(" ") for f in schema.split(",")]
    if not rows:
        return spark.sql("SELECT " + ", ".join(f"CAST(NULL AS {t}) AS {n}" for n, t in fields) + " WHERE false")

    def lit(v, t):
        if v is None:
            return f"CAST(NULL AS {t})"
        return f"{v!r}D" if t == "double" else str(v)
    body = ", ".join("(" + ", ".join(lit(v, t) for v, (_, t) in zip(r, fields)) + ")" for r in rows)
    names = ", ".join(n for n, _ in fields)
    cast = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in fields)
    return spark.sql(f"SELECT {cast} FROM VALUES {body} AS t({names})")


def plain_names(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For operators that hand rows to Arrow functions, which don't take column names with dots or
    backticks: such input columns have plain names meanwhile."""
    @wraps(operator)
    def call(docs: DataFrame, *args, **kw) -> DataFrame:
        odd = {c: f"_odd_{i}" for i, c in enumerate(docs.columns) if "." in c or "`" in c}
        if not odd:
            return operator(docs, *args, **kw)
        back = {v: k for k, v in odd.items()}
        out = operator(docs.select(*[col(c).alias(odd.get(c, c)) for c in docs.columns]), *args, **kw)
        return out.select(*[col(c).alias(back.get(c, c)) for c in out.columns])
    return call
