"""Occurrences of hashed runs across documents: shared by the sentence-span and the line operator."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, text_or_empty

KEY = ("_r_id", "_r_text")                              # doc_id and the text's hash name a document


def with_key(docs: DataFrame) -> DataFrame:
    return docs.select("*", col("doc_id").alias("_r_id"), F.xxhash64(text_or_empty(col("text"))).alias("_r_text"))


def same_document(a: DataFrame, b: DataFrame, names_a=KEY, names_b=KEY) -> Column:
    """Equality of two documents' keys; a null id equals a null id."""
    x, y = (a[names_a[0]].eqNullSafe(b[names_b[0]])), (a[names_a[1]] == b[names_b[1]])
    return x & y


def later_occurrences(occ: DataFrame) -> DataFrame:
    """Rows of ``occ`` (key, h, p) that aren't the first place of their hash, with that place as ``f``.

    The first place is the least (doc_id, text hash, position), found by a map-side minimum; the join back
    is on the hash, whose hot values Spark splits.  Repeated rows of a document are one place."""
    place = F.struct(*KEY, "p")
    first = occ.groupBy("h").agg(F.min(place).alias("f"), F.max(place).alias("last")).where("f <> last").drop("last")
    return occ.join(first, "h").where(~place.eqNullSafe(F.col("f")))


def without(parts: Column, gone: Column) -> Column:
    """Elements of ``parts`` whose (distinct) numbers aren't in ``gone``; both are columns of the row."""
    numbers = F.when(F.size(parts) > 0, F.sequence(F.lit(0), F.size(parts) - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(F.array_except(numbers, gone), lambda i: F.get(parts, i))
