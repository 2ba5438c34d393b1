"""Sinks (SNK-*): CSV export, full-refresh reload, publish under an explicit schema,
load-time column contracts, multi-part append.

A full refresh replaces a table on success only.  Each load writes a new folder below the table (``v-<id>``); when that is
whole and counted, the pointer file ``_current`` is moved over by one atomic rename.  Readers follow the pointer
(:func:`read_table`), so a failed load leaves the table as it was, and no reader sees half of one.  The version
before stays for readers that have begun; older ones go.  A failing table leaves the others loaded, and the report has a row
for each.  Row counts are those of what was written, never collected row by row.
"""
from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTER = "_current"
REPORT_SCHEMA = "table_name string, status string, row_count bigint, error string"


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True, mode: str = "overwrite",
              partition_by: Sequence[str] = ()) -> None:
    """SNK-1: delimited text with a header line, no index column (optionally one folder per
    value of ``partition_by``, written in one parallel job)."""
    w = df.write.mode(mode).option("header", header).option("sep", sep)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def _fs(spark: SparkSession, path: str):
    """Hadoop's path and file system: tables may lie in any store that Spark reaches."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _pointed(spark: SparkSession, table: str) -> str | None:
    p, fs = _fs(spark, f"{table}/{POINTER}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def current_path(spark: SparkSession, table: str) -> str:
    """Folder of the last version of a table that was loaded whole."""
    version = _pointed(spark, table)
    if version is None:
        raise FileNotFoundError(f"{table} has never been loaded")
    return f"{table}/{version}"


def read_table(spark: SparkSession, base_path: str, name: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(current_path(spark, f"{base_path}/{name}"))


def replace_table(spark: SparkSession, df: DataFrame, table: str, fmt: str = "parquet") -> int:
    """Write a new version, count it, and only then make it the current one."""
    version, old = f"v-{uuid.uuid4().hex}", _pointed(spark, table)
    df.write.format(fmt).save(f"{table}/{version}")
    n = spark.read.format(fmt).schema(df.schema).load(f"{table}/{version}").count()
    beside, fs = _fs(spark, f"{table}/{POINTER}.{version}")
    out = fs.create(beside)
    out.write(version.encode())
    out.close()
    # FileContext renames over an existing file in one step, which FileSystem does not
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    over = jvm.org.apache.hadoop.fs.Options.Rename
    kinds = spark.sparkContext._gateway.new_array(over, 1)
    kinds[0] = over.OVERWRITE
    pointer = _fs(spark, f"{table}/{POINTER}")[0]
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(beside, pointer, kinds)
    for status in fs.listStatus(_fs(spark, table)[0]):
        name = status.getPath().getName()
        if name.startswith("v-") and name not in (version, old):
            fs.delete(status.getPath(), True)
    return n


def reload(spark: SparkSession, frames: Mapping[str, DataFrame | None], base_path: str,
           columns: Mapping[str, Sequence[str]] | None = None, fmt: str = "parquet") -> DataFrame:
    """SNK-3: full refresh of every table with an explicit column order.

    A missing frame is reported as ``skipped``; a failing write is reported as ``error``, does not stop the others and
    leaves the table's last version in place.  Returns one report row per table; read with :func:`read_table`."""
    rows = []
    for name, df in frames.items():
        if df is None:
            rows.append((name, "skipped", None, "missing input"))
            continue
        try:
            out = df.select(*columns[name]) if columns and name in columns else df
            rows.append((name, "loaded", replace_table(spark, out, f"{base_path}/{name}", fmt), None))
        except Exception as e:  # noqa: BLE001 - reported per table, like the reference loader
            rows.append((name, "error", None, str(e)))
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to an explicit schema, in schema order (missing columns -> NULL)."""
    cols = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def publish(spark: SparkSession, frames: Mapping[str, DataFrame], schemas: Mapping[str, T.StructType],
            base_path: str, fmt: str = "parquet") -> DataFrame:
    """SNK-4: full-refresh copy of every table under its explicit schema; errors are collected per table, whose published
    copy then stays; the row count of what was written is returned."""
    conformed = {n: conform(df, schemas[n]) for n, df in frames.items() if n in schemas}
    missing = {n: None for n in frames if n not in schemas}
    return reload(spark, {**conformed, **missing}, base_path, fmt=fmt)


@dataclass
class ColumnContract:
    """SNK-5: NOT NULL columns, DEFAULT values and NUMERIC(p, s) columns of a table."""
    not_null: Sequence[str] = ()
    defaults: Mapping[str, object] = field(default_factory=dict)
    decimals: Mapping[str, tuple[int, int]] = field(default_factory=dict)


def enforce(df: DataFrame, c: ColumnContract) -> tuple[DataFrame, DataFrame]:
    """SNK-5: apply defaults and decimal casts, then split rows into (accepted, rejected).

    A row is rejected when a NOT NULL column is NULL after defaults, or when a
    decimal cast overflows (``try_cast`` gives NULL for a non-NULL input).  The
    rejected frame keeps its values as they came and carries a ``reject_reason``.  Each frame is a scan of its own;
    :func:`load_enforced` judges every row once."""
    out, made = _judged(df, c)
    return (_accepted(out.where(F.col("reject_reason").isNull()), c, made),
            out.where(F.col("reject_reason").isNotNull()).drop(*made))


def _judged(df: DataFrame, c: ColumnContract) -> tuple[DataFrame, list[str]]:
    """Defaults filled in, ``reject_reason``, and the decimal columns beside their inputs."""
    out = df
    for col, v in c.defaults.items():
        out = out.withColumn(col, F.coalesce(F.col(col), F.lit(v)))
    reasons = []
    for col, (p, s) in c.decimals.items():
        casted = F.col(col).try_cast(f"decimal({p},{s})")
        reasons.append(F.when(F.col(col).isNotNull() & casted.isNull(), F.lit(f"overflow:{col}")))
        out = out.withColumn(f"__dec_{col}", casted)
    for col in c.not_null:
        reasons.append(F.when(F.col(col).isNull(), F.lit(f"null:{col}")))
    reason = F.concat_ws(",", *reasons) if reasons else F.lit("")
    return out.withColumn("reject_reason", F.nullif(reason, F.lit(""))), [f"__dec_{col}" for col in c.decimals]


def _accepted(ok: DataFrame, c: ColumnContract, made: list[str]) -> DataFrame:
    for col in c.decimals:                             # only accepted rows take the new type
        ok = ok.withColumn(col, F.col(f"__dec_{col}"))
    return ok.drop("reject_reason", *made)


def load_enforced(spark: SparkSession, df: DataFrame, c: ColumnContract, path: str) -> tuple[DataFrame, DataFrame]:
    """SNK-5 in one pass over the input: every row is judged once and written below ``path`` by outcome; (accepted, rejected) are
    read from there, each from its own folder."""
    told, made = _judged(df, c)
    told.withColumn("accepted", F.col("reject_reason").isNull()).write.partitionBy("accepted").mode("overwrite").parquet(path)
    back = spark.read.schema(f"{_ddl(told)}, accepted boolean").parquet(path)
    return _accepted(back.where("accepted").drop("accepted"), c, made), back.where("NOT accepted").drop("accepted", *made)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def append_parts(spark: SparkSession, paths: Sequence[str], schema: str, sep: str = ",",
                 header: bool = True) -> DataFrame:
    """SNK-6: several part files loaded into one table (one parallel read)."""
    return spark.read.option("header", header).option("sep", sep).schema(schema).csv(list(paths))
