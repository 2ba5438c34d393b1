"""Line dedup by winnowing over line hashes [native].

The lines of a document that aren't blank are hashed; each run of ``gram`` lines is a fingerprint candidate,
and of every ``window`` consecutive candidates the least hash (the last one on ties) is selected.  So two
documents that share ``gram + window - 1`` lines in a row select a fingerprint in common.  Each selected
place is joined to the first place of its fingerprint; the match is extended line by line in both
directions, and the later run is deleted.

The first place is the least (doc_id, text hash, line), so a deleted line always has an equal line at an
earlier place, and the earliest copy stays.

Scale: winnowing is done inside the row.  Fingerprints meet in a map-side minimum and a join on the
hash, whose hot values Spark splits.  Matches are reduced to one row per pair of documents and diagonal
before the two documents' line hashes are joined to them; a hot first document only meets its own
matches, again split by Spark.  No list is gathered per fingerprint, only per document.

Defined results: lines are compared without blanks at both ends; blank lines are skipped and stay; a null
or empty text gives an empty one; documents with fewer than ``gram`` lines stay whole; a run repeated in
the same document is deleted like any other; rows with the same doc_id and text are one document and
are cleaned alike; a null doc_id sorts first.  Only doc_id and text of the input are used.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, stored, text_or_empty
from .runs import KEY, later_occurrences, same_document, with_key, without

_BLANKS = " \t\x0b\f\r"


def lines_of(parts: Column) -> Column:
    """(number, hash) of the lines that aren't blank."""
    cut = F.transform(parts, lambda x, i: F.struct(i.alias("i"), F.btrim(x, F.lit(_BLANKS)).alias("s")))
    return F.transform(F.filter(cut, lambda x: x["s"] != ""), lambda x: F.struct(x["i"].alias("i"), F.xxhash64(x["s"]).alias("h")))


def selected(g: Column, window: int) -> Column:
    """Places of the window minima of the array column ``g``.  A place is the (last) minimum of some
    window if enough neighbours, counted outwards without a gap, aren't smaller."""
    def chosen(p: Column) -> Column:
        def reach(step: int) -> Column:
            run, total = F.lit(True), F.lit(0)
            for j in range(1, window):
                q = p + step * j
                near = F.when(q >= 0, F.get(g, q))
                own = F.get(g, p)
                run = run & F.coalesce(near > own if step > 0 else near >= own, F.lit(False))
                total = total + run.cast("int")
            return total
        return reach(-1) + reach(1) + 1 >= F.least(F.lit(window), F.size(g))
    places = F.when(F.size(g) > 0, F.sequence(F.lit(0), F.size(g) - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(places, chosen)


def dedup_lines(docs: DataFrame, gram: int = 3, window: int = 3) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, removed (places among the lines that aren't
    blank), text."""
    base = with_key(docs.select(col("doc_id"), col("text"))).withColumn("_r_parts", F.split(text_or_empty(col("text")), "\n"))
    base = base.select("doc_id", *KEY, "_r_parts", lines_of(F.col("_r_parts")).alias("_r_l"))
    hashes = base.select(*KEY, F.transform("_r_l", lambda x: x["h"]).alias("hs"))
    hs, n = F.col("hs"), F.size("hs")
    hashes = hashes.withColumn("g", F.when(n >= gram, F.transform(F.sequence(F.lit(0), n - gram), lambda i: F.xxhash64(
        *[F.get(hs, i + j) for j in range(gram)]))).otherwise(F.array().cast("array<bigint>")))
    hashes = hashes.withColumn("at", selected(F.col("g"), window))
    hashes = hashes.withColumn("sel", F.transform("at", lambda p: F.struct(p.alias("p"), F.get(F.col("g"), p).alias("h"))))
    hashes = stored(hashes.select(*KEY, "hs", "sel").dropDuplicates(list(KEY)), "line-hashes")

    occ = hashes.select(*KEY, F.explode("sel").alias("x")).select(*KEY, "x.p", "x.h")
    m = later_occurrences(occ).select(*KEY, "p", F.col(f"f.{KEY[0]}").alias("f_id"), F.col(f"f.{KEY[1]}").alias("f_text"),
                                      (F.col("p") - F.col("f.p")).alias("shift"))
    m = m.groupBy(*KEY, "f_id", "f_text", "shift").agg(F.collect_set("p").alias("ps"))   # places of one document
    own = hashes.select(F.col(KEY[0]).alias("o_id"), F.col(KEY[1]).alias("o_text"), F.col("hs").alias("a"))
    fst = hashes.select(F.col(KEY[0]).alias("g_id"), F.col(KEY[1]).alias("g_text"), F.col("hs").alias("b"))
    both = m.join(own, same_document(m, own, KEY, ("o_id", "o_text"))).drop("o_id", "o_text")
    both = both.join(fst, same_document(both, fst, ("f_id", "f_text"), ("g_id", "g_text")))
    # places of the later document where the diagonal breaks, with a sentinel at both ends
    a, b, shift = F.col("a"), F.col("b"), F.col("shift")
    breaks = F.concat(F.array(F.lit(-1)), F.filter(
        F.sequence(F.lit(0), F.size(a) - 1),
        lambda i: ~F.coalesce(F.get(a, i) == F.when(i - shift >= 0, F.get(b, i - shift)), F.lit(False))), F.array(F.size(a)))
    both = both.select(*KEY, "ps", breaks.alias("x"))
    x = F.col("x")
    spans = F.array_distinct(F.transform("ps", lambda p: F.struct(
        (F.array_max(F.filter(x, lambda i: i < p)) + 1).alias("s"), (F.array_min(F.filter(x, lambda i: i > p)) - 1).alias("e"))))
    gone = (both.select(*KEY, F.explode(spans).alias("r")).distinct()
            .select(*KEY, F.explode(F.sequence(F.col("r.s"), F.col("r.e"))).alias("k"))
            .groupBy(*KEY).agg(F.sort_array(F.collect_set("k")).alias("removed")))
    gone = gone.select(F.col(KEY[0]).alias("_g_id"), F.col(KEY[1]).alias("_g_text"), "removed")
    full = base.join(gone, same_document(base, gone, KEY, ("_g_id", "_g_text")), "left")
    full = full.withColumn("removed", F.coalesce("removed", F.array().cast("array<int>")))
    full = full.withColumn("_r_gone", F.transform("removed", lambda k: F.get(F.col("_r_l"), k)["i"]))
    return full.select("doc_id", F.size("_r_l").cast("long").alias("n_lines"), F.size("removed").cast("long").alias("n_removed"),
                       "removed", F.array_join(without(F.col("_r_parts"), F.col("_r_gone")), "\n").alias("text"))
