"""Records of delimited files, read in splits: quoted cells may hold separators, quotes and line breaks.

Files are read with the ``text`` source, so a large file is read by several tasks.  Each line knows its file, the start of
its split and its place there.  One pass gathers a row a split: the number of its first line, and whether its file has lines with
an odd number of quotes.  Files without such lines have one record a line, and nothing is moved.  For the others a line starts inside a
quoted cell if the quotes before it are odd in number: running sums over the lines of each split, taken where the split is read (no
shuffle, no sort), plus a prefix scan over the splits' sums tell which lines carry on the record above.  Only lines of records of several
lines are moved to be put together.

A record is cut into cells by its quotes: the parts between quotes take turns being outside and inside, an empty part
outside is a doubled quote, and only separators outside cut.  No look-ahead, time in proportion to the length.

Defined results: CRLF, CR and LF end a line; inside a quoted cell each is a line feed; a byte order mark at the start of a file goes; a
quote that is never closed takes the rest of its file into its cell, which like any value must fit in memory; the
noncharacters U+FDD0 to U+FDD2, which are not for exchange, become U+FFFD.
"""
from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

_CUT, _BREAK, _EDGE = "\ufdd0", "\ufdd1", "\ufdd2"       # marks that no text holds after ``clean``


def clean(text: Column) -> Column:
    """No byte order mark, no marks of this module.  Few lines have any: the others are looked through once."""
    cleaned = F.translate(F.regexp_replace(text, "^\ufeff", ""), _CUT + _BREAK + _EDGE, "\ufffd" * 3)
    return F.when(F.rlike(text, F.lit(f"[\ufeff{_CUT}{_BREAK}{_EDGE}]")), cleaned).otherwise(text)


def fields(record: Column, sep: str = ",", quote: str = '"') -> Column:
    """The cells of one record, quotes taken off."""
    parts = F.split(F.concat(F.lit(_EDGE), record, F.lit(_EDGE)), re.escape(quote))
    told = F.transform(parts, lambda x, i: F.when(i % 2 == 1, x).when(x == "", quote)
                       .otherwise(F.replace(x, F.lit(sep), F.lit(_CUT))))
    whole = F.replace(F.array_join(told, ""), F.lit(_EDGE), F.lit(""))
    return F.split(F.replace(whole, F.lit(_BREAK), F.lit("\n")), _CUT)


def records_in(text: Column, quote: str = '"') -> Column:
    """The records of a whole text held in one value; line breaks inside quotes stay until ``fields``."""
    plain = F.regexp_replace(clean(text), "\r\n?", "\n")
    held = F.array_join(F.transform(F.split(plain, re.escape(quote)), lambda x, i: F.when(
        i % 2 == 1, F.replace(x, F.lit("\n"), F.lit(_BREAK))).otherwise(x)), quote)
    return F.split(held, "\n")


def lines_of(spark: SparkSession, path, encoding: str = "UTF-8") -> DataFrame:
    """(file, block, at, line): lines with their file, the start of their split, and a number that grows by one from line
    to line of a split."""
    value = F.col("value")
    if encoding.upper().replace("-", "") != "UTF8":    # the source hands on bytes as they are
        value = F.decode(value.cast("binary"), encoding)
    raw = spark.read.text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("at"), clean(value).alias("line"))


def _odd(line: Column, quote: str) -> Column:
    return (F.length(line) - F.length(F.replace(line, F.lit(quote), F.lit("")))) % 2


def running(lines: DataFrame, quote: str = '"', carry: tuple[str, ...] = ("line",)) -> DataFrame:
    """(file, block, at, ``carry``, odd, above, evens): whether a line has an odd number of quotes, whether the lines above it in its
    split have, and how many lines of the split down to it have an even number above them.  A task reads its splits line
    by line in order, so only a few numbers are kept from batch to batch."""
    df = lines.select("file", "block", "at", *carry, (_odd(F.col("line"), quote) == 1).alias("odd"))
    schema = T.StructType([*df.schema.fields, T.StructField("above", T.BooleanType()), T.StructField("evens", T.LongType())])
    names = schema.names

    def run(batches):
        split, odds, evens = None, 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            file, block = b.column("file"), b.column("block")
            odd = b.column("odd").to_numpy(zero_copy_only=False).astype(np.int64)
            new = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1])).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), b.num_rows]
            above, count = np.empty(b.num_rows, bool), np.empty(b.num_rows, np.int64)
            for x, y in zip(cuts, cuts[1:]):
                if (now := (file[x].as_py(), block[x].as_py())) != split:
                    split, odds, evens = now, 0, 0
                upto = odds + np.cumsum(odd[x:y])
                above[x:y] = (upto - odd[x:y]) % 2 == 1
                count[x:y] = evens + np.cumsum(~above[x:y])
                odds, evens = int(upto[-1]), int(count[y - 1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(above), pa.array(count)], names=names)

    return df.mapInArrow(run, schema)


def split_facts(lines: DataFrame, quote: str = '"') -> DataFrame:
    """A row a split: ``first`` (number of its first line), ``quoted`` (its file has a line with an odd number of quotes), ``inside``
    (it starts inside a quoted cell) and ``records`` (how many records start in the file's splits before it).
    Written, so that the planner knows how small it is."""
    by_split = running(lines, quote, ()).groupBy("file", "block").agg(
        F.min("at").alias("first"), F.max("odd").alias("q"), F.count_if("odd").alias("odds"), F.max("evens").alias("evens"), F.count(F.lit(1)).alias("n"))
    above = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    told = by_split.withColumn("inside", F.coalesce(F.sum("odds").over(above), F.lit(0)) % 2 == 1).withColumn(
        "starts", F.when(F.col("inside"), F.col("n") - F.col("evens")).otherwise(F.col("evens")))
    return materialize(told.select("file", "block", "first", F.max("q").over(Window.partitionBy("file")).alias("quoted"), "inside",
                                   F.coalesce(F.sum("starts").over(above), F.lit(0)).alias("records")), "split_facts")


def read_records(lines: DataFrame, facts: DataFrame, quote: str = '"') -> DataFrame:
    """(file, no, place, rec): records.  ``place`` grows along a file: a split's start plus the line's number in the split, as no
    line is shorter than a byte.  ``no`` is the record's number from 0; null after the first split of a file in which all records
    are lines."""
    place = F.col("block") + F.col("at") - F.col("first")
    plain = lines.join(facts.where(~F.col("quoted")), ["file", "block"]).select(
        "file", F.when(F.col("block") == 0, place).alias("no"), place.alias("place"), F.col("line").alias("rec"))

    told = running(lines, quote).join(facts.where("quoted"), ["file", "block"])
    starts = F.when(F.col("inside"), F.col("at") - F.col("first") + 1 - F.col("evens")).otherwise(F.col("evens"))
    told = told.select("file", (F.col("records") + starts - 1).alias("no"), place.alias("place"), "line",
                       ((F.col("above") == F.col("inside")) & ~F.col("odd")).alias("alone"))
    alone = told.where("alone").select("file", "no", "place", F.col("line").alias("rec"))
    whole = told.where(~F.col("alone")).groupBy("file", "no").agg(F.array_sort(F.collect_list(F.struct("place", "line"))).alias("l"))
    several = whole.select("file", "no", F.get("l", F.lit(0))["place"].alias("place"),
                           F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("rec"))
    return plain.unionByName(alone).unionByName(several)
