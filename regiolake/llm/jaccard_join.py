"""N-gram Jaccard join: a blocked sparse matrix product of documents by shingles.

Documents link when the Jaccard similarity of their sets of distinct word shingles is at least
``percent`` / 100.  The product of the incidence matrix with its transpose is never formed whole:

1. Documents with the same set are one row (class) of the matrix.
2. A pair at the threshold must share a column among the first ``n - ceil(t n) + 1`` columns of each, in any
   order of columns that all documents share.  The order puts columns of one document first, then
   by frequency class, then by hash, so the columns in use are rare ones.  A document whose
   first columns all belong to it alone can't have a partner and drops out here, without any shuffle.
   Frequencies are counted over all documents for the part ``known`` of the hash space (a column's
   place depends on the column alone, so a partial count orders less well but loses no pair); they
   reach the tasks as Bloom filters whose size has a fixed ceiling.  A false positive only keeps a
   column that could have been dropped.
3. Blocks of columns (shuffle partitions) multiply their lists: overlap counts accumulate per pair, and
   pairs under the size bounds go: ``min(n) >= t max(n)``, and the rest of either row from the first column
   they share must have room for an overlap of ``t / (1 + t) (n_a + n_b)``.  What is left gets its whole
   overlap from the two rows.
4. Lists of thousands of near copies aren't expanded into pairs.  Short lists are compared whole; a longer
   one first meets only its centre, the row with the fewest columns of its own; the links give
   components.  Only longer lists that still hold several components go on: their rows get an exact frequency order among themselves and new
   lists, which meet their centres again and then, exactly, every pair that lies in two components.  A
   pair inside one component can't change the result.

Words are runs of anything but ASCII white space after lower-casing A-Z.  A text with fewer than n words
is one shingle, the whole sequence.  Shingles are 64-bit hashes; a class is a 128-bit digest of its set.

Defined results: a text that is null, empty or without words has an empty set, links with nothing and is
its own component.  Repeated rows are equal sets and link.  A row without doc_id can connect others; its
own component is the smallest id reachable, or null.  Extra columns of the input are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows, col, stored
from .components import connected_components

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63,
                 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3],
                np.uint64)                              # odd multipliers, one per word of a shingle
HOT = (32, 512, 8192)                                  # frequency classes of the column order
FEW = 8                                                # lists up to this size are compared pair by pair


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def shingles(text: str | bytes | None, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of a text's word n-grams."""
    raw = (text or b"") if not isinstance(text, str) else text.encode("utf-8", "surrogatepass")
    words = raw.lower().split()                        # bytes: A-Z only, and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    k = min(n, len(w))
    m = len(w) - k + 1
    h = np.full(m, k, np.uint64)
    for i in range(k):
        h += w[i:i + m] * _ODD[i]
    return np.unique(_mix(h))


def _texts(batch: pa.RecordBatch) -> Iterator[bytes | None]:
    for v in batch.column("text").cast(pa.binary()):
        yield v.as_py()


class Bloom:
    """Bits of two positions per hash; ``words`` holds them as uint64."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(len(words) * 64 - 1)

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for p in (h & self.mask, (h >> np.uint64(33)) & self.mask):
            out &= (self.words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


def bloom(hashes: DataFrame, count: int, max_bits: int) -> Bloom:
    """A filter of the column ``h``: about 10 bits an element, at most ``max_bits``.  Set bits are
    OR-ed by word in Spark; the driver gets at most ``max_bits / 64`` words."""
    bits = 1 << max(12, min(max_bits, 10 * max(count, 1)).bit_length() - 1)
    both = F.array(F.col("h").bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned("h", 33).bitwiseAND(F.lit(bits - 1)))
    rows = (hashes.select(F.explode(both).alias("p"))
            .groupBy(F.shiftright("p", 6).cast("int").alias("i"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("w")).toArrow())
    words = np.zeros(bits // 64, np.uint64)
    words[rows.column("i").to_numpy()] = rows.column("w").to_numpy().view(np.uint64)
    return Bloom(words)


def frequencies(docs: DataFrame, n: int, known: float) -> DataFrame:
    """(h, df) of the shingles in the known part of the hash space that two rows or more hold."""
    top = np.uint64(int(known * 2 ** 64) if known < 1 else 2 ** 64 - 1)

    def run(batches):
        for b in batches:
            parts = []
            for t in _texts(b):
                h = shingles(t, n)
                parts.append(h[:np.searchsorted(h, top)])
            flat = np.concatenate(parts) if parts else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64))], names=["h"])

    return (arrow_rows(docs.select(col("text"))).mapInArrow(run, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("df"))
            .where("df > 1"))


def rows_of_matrix(docs: DataFrame, n: int, percent: int, known: float, shared: Bloom, hot: list[Bloom]) -> DataFrame:
    """One row per document: digest and size of its set; for documents that may have a partner also
    the columns to join on and the whole set."""
    top = np.uint64(int(known * 2 ** 64) if known < 1 else 2 ** 64 - 1)
    filters = docs.sparkSession.sparkContext.broadcast((shared, hot))
    extra = [c for c in docs.columns if c == "text_hash"]
    schema = (docs.select(col("doc_id")).schema.add("k1", "long").add("k2", "long").add("n", "long").add("own", "long")
              .add("cols", T.ArrayType(T.LongType())).add("whole", T.ArrayType(T.LongType())))

    def run(batches):
        shared, hot = filters.value
        for b in batches:
            k1, k2, size, own, cols, whole = [], [], [], [], [], []
            for t in _texts(b):
                h = shingles(t, n)
                m = len(h)
                k1.append(int(np.add.reduce(_mix(h + _ODD[5])).astype(np.int64)) if m else 0)
                k2.append(int(np.add.reduce(_mix(h ^ _ODD[6])).astype(np.int64)) if m else 0)
                size.append(m)
                e = np.searchsorted(h, top)
                alone = ~shared.has(h[:e])
                u = int(alone.sum())
                first = m - (percent * m + 99) // 100 + 1
                own.append(u)
                if m == 0 or u >= first:
                    cols.append(None), whole.append(None)
                    continue
                rest = np.concatenate([h[:e][~alone], h[e:]])
                level = np.zeros(len(rest), np.int8)
                for f in hot:
                    level[:e - u] += f.has(rest[:e - u])
                pick = np.lexsort((rest, level))[:first - u]
                cols.append(rest[pick].view(np.int64))
                whole.append(h.view(np.int64))
            longs = lambda x: pa.array(x, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(size, pa.int64()),
                 pa.array(own, pa.int64()), longs(cols), longs(whole), *(b.column(c) for c in extra)],
                names=["doc_id", "k1", "k2", "n", "own", "cols", "whole", *extra])

    for c in extra:
        schema = schema.add(c, "long")
    return arrow_rows(docs.select(col("doc_id"), col("text"), *extra)).mapInArrow(run, schema)


def _fits(percent: int, na: str, pa: str, nb: str, pb: str):
    """Size bounds for two rows that share the column at places pa and pb of their orders.  An overlap takes
    t / (1 + t) of both sizes.  If this is the first column that they share, the overlap lies in what follows
    it in either row; if it isn't, the first one passes for the pair."""
    need = f"({percent} * ({na} + {nb}))"
    return F.expr(f"100 * least({na}, {nb}) >= {percent} * greatest({na}, {nb}) "
                  f"AND {100 + percent} * least({na} - {pa}, {nb} - {pb}) >= {need}")


def _verified(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose whole overlap reaches the threshold."""
    a = nodes.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("whole").alias("wa"))
    b = nodes.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("whole").alias("wb"))
    both = pairs.select("a", "b").distinct().join(b, "b").join(a, "a")
    o = F.size(F.array_intersect("wa", "wb"))
    return (both.withColumn("o", o.cast("long")).where(F.expr(f"100 * o >= {percent} * (na + nb - o)"))
            .select("a", "b"))


def _heads(lists: DataFrame) -> DataFrame:
    """Size and centre of each list of two rows or more; ``lists``: (s, id, n, own, pos)."""
    return (lists.groupBy("s").agg(F.min(F.struct("own", "n", "id", "pos")).alias("c"), F.count(F.lit(1)).alias("size"))
            .where("size > 1"))


def _candidates(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) under the size bounds: all of a list of at most ``FEW`` rows, and those of a longer
    list's centre."""
    heads = _heads(lists)
    star = (lists.join(heads.where(F.col("size") > FEW), "s").where("id <> c.id")
            .where(_fits(percent, "n", "pos", "c.n", "c.pos"))
            .select(F.col("c.id").alias("a"), F.col("id").alias("b")))
    few = lists.join(heads.where(F.col("size") <= FEW).select("s"), "s", "left_semi")
    return star.unionByName(_across(few, percent, "id_x < id_y")).distinct()


def _across(lists: DataFrame, percent: int, which: str) -> DataFrame:
    """Pairs of rows of one list that ``which`` and the size bounds let through."""
    x, y = (lists.select("s", *[F.col(c).alias(f"{c}_{k}") for c in lists.columns if c != "s"]) for k in "xy")
    return (x.join(y, "s").where(which).where(_fits(percent, "n_x", "pos_x", "n_y", "pos_y"))
            .select(F.col("id_x").alias("a"), F.col("id_y").alias("b")))


def _unsettled(lists: DataFrame, comp: DataFrame) -> DataFrame:
    """Rows of the longer lists that still hold more than one component, with their components."""
    long = lists.join(_heads(lists).where(F.col("size") > FEW).select("s"), "s", "left_semi")
    at = (long.join(comp, long["id"] == comp["node"], "left")
          .withColumn("comp", F.coalesce("root", "id")).drop("node", "root"))
    several = at.groupBy("s").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("s")
    return at.join(several, "s", "left_semi")


def _exact_lists(rest: DataFrame, percent: int) -> DataFrame:
    """Lists (s, id, n, own, pos) in the exact order by frequency among the given rows."""
    e = rest.select("id", "n", F.explode("whole").alias("s"))
    df = e.groupBy("s").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    by_row = e.join(df, "s").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("by"))  # one text
    first = F.col("n") - F.floor((F.lit(percent) * F.col("n") + 99) / 100) + 1
    return (by_row.withColumn("own", F.col("n") - F.size("by")).withColumn("q", (first - F.col("own")).cast("int"))
            .where("q > 0").select("id", "n", "own", F.posexplode(F.expr("slice(by, 1, q)")).alias("k", "x"))
            .select(F.col("x.s").alias("s"), "id", "n", "own", (F.col("own") + F.col("k")).alias("pos")))


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80, known: float = 0.35,
                       max_bloom_bits: int = 1 << 27, by_text: bool = False) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id), one per document.  ``by_text``: also the text's hash and the component
    itself, as several may have one lowest id where an id is repeated with different texts."""
    docs = docs.select(col("doc_id"), col("text"))
    own = ["text_hash", "component"] if by_text else []
    if by_text:
        docs = docs.withColumn("text_hash", F.xxhash64("text"))
    df = stored(frequencies(docs, n, known), "jaccard-df")
    at_least = df.agg(F.count(F.lit(1)).alias("all"), *[F.count_if(F.col("df") >= t).alias(f"t{t}") for t in HOT]).first()
    shared = bloom(df, at_least["all"], max_bloom_bits)
    hot = [bloom(df.where(F.col("df") >= t), at_least[f"t{t}"], max_bloom_bits // 8) for t in HOT]
    m = stored(rows_of_matrix(docs, n, percent, known, shared, hot), "jaccard-rows")

    nodes = stored(m.where("cols IS NOT NULL").groupBy("k1", "k2", "n")
                   .agg(F.first("own").alias("own"), F.first("cols").alias("cols"), F.first("whole").alias("whole"))
                   .withColumn("id", F.monotonically_increasing_id()), "jaccard-classes")
    lists = (nodes.select("id", "n", "own", F.posexplode("cols").alias("k", "s"))
             .select("s", "id", "n", "own", (F.col("own") + F.col("k")).alias("pos")))
    links = stored(_verified(_candidates(lists, percent), nodes, percent), "jaccard-links")
    comp = stored(connected_components(links), "jaccard-components")

    rest = nodes.join(_unsettled(lists, comp).select("id").distinct(), "id", "left_semi")
    rest = stored(rest.select("id", "n", "whole"), "jaccard-rest")
    if not rest.isEmpty():
        exact = stored(_exact_lists(rest, percent), "jaccard-lists")
        links = links.unionByName(stored(_verified(_candidates(exact, percent), nodes, percent), "jaccard-links"))
        comp = stored(connected_components(links), "jaccard-components")
        pairs = _across(_unsettled(exact, comp), percent, "id_x < id_y AND comp_x <> comp_y").distinct()
        links = links.unionByName(stored(_verified(pairs, nodes, percent), "jaccard-links"))
        comp = stored(connected_components(links), "jaccard-components")

    named = nodes.select("k1", "k2", "n", "id").join(comp, F.col("id") == F.col("node")).select("k1", "k2", "n", "root")
    classes = (m.where("n > 0").groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("low"))
               .join(named, ["k1", "k2", "n"], "left"))
    roots = classes.where("root IS NOT NULL").groupBy("root").agg(F.min("low").alias("lowest"))
    alone = F.when(F.col("root").isNull(), F.struct("k1", "k2", "n"))
    classes = classes.join(roots, "root", "left").select("k1", "k2", "n", F.coalesce("lowest", "low").alias("component_id"),
                                                         F.struct("root", alone.alias("alone")).alias("component"))
    full = (m.where("n > 0").select("doc_id", "k1", "k2", "n", *own[:1]).join(classes, ["k1", "k2", "n"])
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id", *own))
    blank = m.where("n = 0").withColumn("component", F.lit(None).cast(full.schema["component"].dataType)) if by_text else m.where("n = 0")
    return full.unionByName(blank.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), *own))
