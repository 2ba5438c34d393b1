"""Substring dedup by sliding sentence spans.

Every run of ``span`` consecutive sentences of every document is hashed; the hashes meet in one global join,
and a sentence goes if any run that covers it isn't the first place of its hash.  The first place is the
least (doc_id, text hash, position), so one copy of each repeated passage stays.

A sentence ends after . ! or ? before white space, or at a line break; sentences are compared in lower
case without white space around them.  Pieces without any visible character are no sentences and
stay.  A run counts only if it has at least ``min_chars`` characters, so that two one-word sentences met by
chance aren't a passage.

Scale: two shuffles of (hash, document, position) rows and one of the texts.  A passage that a
third of all documents share is one minimum (summed map-side) and one hot join key, which Spark splits; its
places never meet in one task.  Lists are gathered per document only, bounded by its own length.

Defined results: a null or empty text has no sentences and an empty result text; a document with fewer
sentences than a span stays whole; rows with the same doc_id and text are one document and are cleaned
alike; a null doc_id sorts first.  Only doc_id and text of the input are used.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, stored, text_or_empty
from .runs import KEY, later_occurrences, same_document, with_key, without

_END = r"(?<=[.!?])(?=[\x20\x09-\x0D])|(?<=\n)"
_BLANKS = " \t\n\x0b\f\r"


def pieces(text: Column) -> Column:
    """The text cut after each sentence; the pieces put together are the text."""
    return F.split(text, _END)


def sentences(parts: Column) -> Column:
    """(number of the piece, its normal form) of the pieces that are sentences."""
    norm = F.transform(parts, lambda x, i: F.struct(i.alias("i"), F.lower(F.btrim(x, F.lit(_BLANKS))).alias("s")))
    return F.filter(norm, lambda x: x["s"] != "")


def dedup_spans(docs: DataFrame, span: int = 2, min_chars: int = 40) -> DataFrame:
    """One row per document: doc_id, n_sentences, n_removed, removed (numbers of the sentences), text."""
    base = with_key(docs.select(col("doc_id"), col("text"))).withColumn("_r_parts", pieces(text_or_empty(col("text"))))
    cut = base.select("doc_id", *KEY, "_r_parts", sentences(F.col("_r_parts")).alias("_r_s"))
    s, n = F.col("_r_s"), F.size("_r_s")
    runs = F.when(n >= span, F.transform(F.sequence(F.lit(0), n - span), lambda p: F.struct(
        p.alias("p"), F.xxhash64(*[F.get(s, p + j)["s"] for j in range(span)]).alias("h"),
        sum((F.length(F.get(s, p + j)["s"]) for j in range(1, span)), F.length(F.get(s, p)["s"])).alias("c"))))
    occ = (cut.select(*KEY, F.explode(runs).alias("r"))
           .where(F.col("r.c") >= min_chars).select(*KEY, F.col("r.p").alias("p"), F.col("r.h").alias("h")))
    later = later_occurrences(stored(occ, "spans"))
    gone = (later.select(*KEY, F.explode(F.sequence(F.col("p"), F.col("p") + span - 1)).alias("k"))
            .groupBy(*KEY).agg(F.sort_array(F.collect_set("k")).alias("removed")))
    gone = gone.select(F.col(KEY[0]).alias("_g_id"), F.col(KEY[1]).alias("_g_text"), "removed")
    full = cut.join(gone, same_document(cut, gone, KEY, ("_g_id", "_g_text")), "left")
    full = full.withColumn("removed", F.coalesce("removed", F.array().cast("array<int>")))
    full = full.withColumn("_r_gone", F.transform("removed", lambda k: F.get(s, k)["i"]))
    return full.select("doc_id", n.cast("long").alias("n_sentences"), F.size("removed").cast("long").alias("n_removed"),
                       "removed", F.array_join(without(F.col("_r_parts"), F.col("_r_gone")), "").alias("text"))
