"""Hard negatives by rotated one-bit codes.

Vectors are made integers (floor(scale * x)), their mean is taken off, and what is left is rotated (random signs and Hadamard
steps) and reduced to one sign bit a dimension.  With each code goes its alignment, the inner product of vector and code, so
that alignment times code is the nearest multiple of the code; the residual gets a code of its own, ``levels`` times.  The
inner product with an anchor is the mean's part, plus the levels' parts, plus that of the last residual: the levels' parts come
from popcounts of the code with the bit planes of the rotated anchor (off by at most the sum of its rounding errors), and
the last one is at most the residual's length times the anchor's (Cauchy-Schwarz).  That gives an interval that certainly holds the
score; only rows whose interval reaches into what is asked for are scored, in 64-bit integers.

``mine`` asks twice: for the positives of each anchor (the highest scores of its own label), then for the negatives of each
positive (the highest scores of other labels between ``low`` and ``high`` percent of the positive's score).

Scale: codes are written once.  Anchors come in blocks of a bounded number of components, read from the written codes and
broadcast with their thresholds; a block is held against all rows, and a task keeps a few rows an anchor.  A scan has a fixed
number of tasks (``tasks``, by default twice the parallelism), each going through its rows in bounded batches, so what the
tasks give grows with the anchors alone.  The work is anchors times rows, as the result asks for all rows.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no part; components saturate at
2**24 after scaling; shorter vectors are filled with zeros; each of several rows with one id is a row of its own, and an anchor is
no positive of itself only; null ids are no anchors unless the condition says so, and come last among equal scores; equal scores go by
id; an empty table gives an empty result.  Ids may have any type that can be ordered; extra columns don't matter.
"""
from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import Parts, col, stored

SATURATED = float(1 << 24)
PLANES = 8
MARGIN = 1e-9                  # relative; far above the rounding errors of the doubles


def rotate(x: np.ndarray, level: int, back: bool = False) -> np.ndarray:
    """Rows rotated by three rounds of random signs and a Hadamard step; orthogonal, the same everywhere."""
    d = x.shape[1]
    signs = np.random.default_rng(1000 + level).integers(0, 2, (3, d)) * 2.0 - 1
    for s in signs[::-1] if back else signs:
        x = _hadamard(x) * s if back else _hadamard(x * s)
    return x


def _hadamard(x: np.ndarray) -> np.ndarray:
    n, d = x.shape
    h = 1
    while h < d:
        pairs = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def encode(x: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows, levels, words), alignments (rows, levels), lengths of the last residuals, rounded up."""
    n, d = x.shape
    codes, alignment, rest = np.zeros((n, levels, d // 64), np.uint64), np.zeros((n, levels)), x
    for level in range(levels):
        r = rotate(rest, level)
        signs = r >= 0
        codes[:, level] = np.packbits(signs, axis=1, bitorder="little").view(np.uint64)
        code = np.where(signs, 1.0, -1.0) / np.sqrt(d)
        alignment[:, level] = (r * code).sum(1)
        rest = rest - rotate(alignment[:, level, None] * code, level, back=True)
    length = np.sqrt((x * x).sum(1))
    return codes, alignment, np.sqrt((rest * rest).sum(1)) + MARGIN * length


class Anchors:
    """Rotated anchors in bit planes, and what bounds their rounding."""

    def __init__(self, q: np.ndarray, mean: np.ndarray, levels: int):
        n, d = q.shape
        f = q.astype(float)
        self.q, self.d, self.levels = q, d, levels
        self.base, self.length = f @ mean, np.sqrt((f * f).sum(1))
        self.planes = np.zeros((n, levels, PLANES, d // 64), np.uint64)
        self.low, self.step, self.sums, self.off = (np.zeros((n, levels)) for _ in range(4))
        for level in range(levels):
            r = rotate(f, level)
            low = r.min(1, keepdims=True)
            step = np.maximum((r.max(1, keepdims=True) - low) / (2 ** PLANES - 1), 1e-30)
            u = np.rint((r - low) / step).astype(np.int64)
            self.low[:, level], self.step[:, level] = low[:, 0], step[:, 0]
            self.sums[:, level] = u.sum(1)
            self.off[:, level] = np.abs(r - low - step * u).sum(1)
            for p in range(PLANES):
                bits = np.packbits((u >> p & 1).astype(bool), axis=1, bitorder="little")
                self.planes[:, level, p] = bits.view(np.uint64)

    def interval(self, a: slice, codes, alignment, length, offset) -> tuple[np.ndarray, np.ndarray]:
        """Middle and half width of the scores (anchors, rows): popcount estimates and residual bounds.  ``offset`` is the
        length of the rows before coding, for the margin."""
        middle = np.repeat(self.base[a, None], len(codes), 1)
        half = self.length[a, None] * length[None, :]
        for level in range(self.levels):
            code = codes[:, level]
            ones = np.bitwise_count(code).sum(1, dtype=np.int64)
            counts = np.zeros((a.stop - a.start, len(codes)))
            for p in range(PLANES):
                plane = self.planes[a, level, p]
                both = sum(np.bitwise_count(plane[:, w, None] & code[None, :, w]).astype(np.float64) for w in range(code.shape[1]))
                counts += both * float(1 << p)
            signed = self.low[a, level, None] * (2 * ones - self.d)[None, :] + self.step[a, level, None] * (
                2 * counts - self.sums[a, level, None])
            share = alignment[:, level] / np.sqrt(self.d)
            middle += signed * share
            half += self.off[a, level, None] * np.abs(share)
        return middle, half + MARGIN * (self.length[a, None] * (offset[None, :] + length.max(initial=0.0)) + np.abs(middle)) + 0.5


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """Lists as rows of ``d`` columns, filled up with zeros."""
    ends = np.diff(np.asarray(column.offsets))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), d), flat.dtype)
    out[np.repeat(np.arange(len(column)), ends), np.arange(len(flat)) - np.repeat(np.cumsum(ends) - ends, ends)] = flat
    return out


def usable(vectors: DataFrame, key: str, vec: str, label: str, scale: int) -> DataFrame:
    """(row, id, label, v) of the rows that take part, with whole components."""
    v = F.transform(col(vec), lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(SATURATED)), F.lit(-SATURATED))).cast("int"))
    bad = F.exists(col(vec), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return (vectors.where(col(label).isNotNull() & col(vec).isNotNull() & ~F.coalesce(bad, F.lit(False)))
            .select(col(key).alias("id"), col(label).alias("label"), v.alias("v"))
            .withColumn("row", F.monotonically_increasing_id()))


def mean_of(rows: DataFrame) -> np.ndarray:
    """Mean of all vectors, as long as the longest one, filled up to a power of two (64 at least)."""
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    d = max(64, 1 << max(0, longest - 1).bit_length())

    def run(batches):
        total, n = np.zeros(d), 0
        for b in batches:
            m = _matrix(b.column("v"), d)
            total, n = total + m.sum(0), n + len(m)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(total), pa.array([n] * d, pa.int64())],
                                             names=["p", "s", "n"])
    got = rows.select("v").mapInArrow(run, "p int, s double, n long").groupBy("p").agg((F.sum("s") / F.sum("n")).alias("m")).toArrow()
    mean = np.zeros(d)
    mean[got.column("p").to_numpy()] = got.column("m").to_numpy()
    return np.rint(mean)       # any point near the middle does; whole numbers keep it exact


def encoded(rows: DataFrame, mean: np.ndarray, levels: int) -> DataFrame:
    d = len(mean)
    schema = T.StructType([*rows.schema.fields, T.StructField("code", T.BinaryType()), T.StructField("alignment", T.ArrayType(T.DoubleType())),
                           T.StructField("rest", T.DoubleType()), T.StructField("length", T.DoubleType())])

    def run(batches):
        for b in batches:
            for s in range(0, b.num_rows, 1024):
                part = b.slice(s, 1024)
                x = _matrix(part.column("v"), d) - mean
                codes, alignment, rest = encode(x, levels)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([c.tobytes() for c in codes], pa.binary()),
                                                  pa.array(alignment.tolist(), pa.list_(pa.float64())), pa.array(rest),
                                                  pa.array(np.sqrt((x * x).sum(1)))], names=[f.name for f in schema.fields])
    return rows.mapInArrow(run, schema)


class Top:
    """The k highest (score, id, ...) of each slot so far."""

    def __init__(self, slots: int, k: int):
        self.k, self.rows, self.least = k, [[] for _ in range(slots)], np.full(slots, np.iinfo(np.int64).min)

    def offer(self, slot: np.ndarray, score: np.ndarray, row: np.ndarray, batch: pa.RecordBatch) -> None:
        good = score >= self.least[slot]
        slot, score, row = slot[good], score[good], row[good]
        order = np.lexsort((-score, slot))
        slot, score, row = slot[order], score[order], row[order]
        starts = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]]) if len(slot) else []
        ids, keys = batch.column("id"), batch.column("row")
        for a, b in zip(starts, [*starts[1:], len(slot)]):
            s = score[a:b]
            n, at = min(self.k, len(s)), int(slot[a])  # rows come by id, so of equal scores the first ones count
            new = [(-int(score[j]), (i := ids[int(row[j])].as_py()) is None, 0 if i is None else i, keys[int(row[j])].as_py())
                   for j in range(a, a + n)]
            self.rows[at] = heapq.nsmallest(self.k, self.rows[at] + new)
            if len(self.rows[at]) == self.k:
                self.least[at] = -self.rows[at][-1][0]


def _scan(codes: DataFrame, block, mean: np.ndarray, levels: int, k: int, tasks: int, low: int, high: int,
          positives: list[list[int]] | None) -> DataFrame:
    """(slot, id, score, row): the k highest of each slot and task.  Slots are the anchors of the block, or with
    ``positives`` (scores by anchor) the anchors' positives in order."""
    rows, labels, q = block
    shared = codes.sparkSession.sparkContext.broadcast((rows, labels, q, positives))
    d, words = len(mean), len(mean) // 64
    id_type = to_arrow_type(codes.schema["id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]):
        rows, labels, q, positives = shared.value
        a = Anchors(q, mean, levels)
        if positives is None:
            first = np.arange(len(rows) + 1)
        else:
            first = np.concatenate([[0], np.cumsum([len(p) for p in positives])]).astype(int)
            goal = np.array([s for p in positives for s in p], np.int64)
            floor = -(-low * goal // 100)              # the least whole score allowed
            ceiling = high * goal // 100
        top = Top(int(first[-1]), k)
        for b in batches:
            for s in range(0, b.num_rows, 1024):
                part = b.slice(s, 1024).sort_by([("id", "ascending"), ("row", "ascending")])     # null ids last
                v = _matrix(part.column("v"), d).astype(np.int64)
                codes_of = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint64).reshape(len(v), levels, words)
                aligned = _matrix(part.column("alignment"), levels)
                rest, length = (part.column(c).to_numpy() for c in ("rest", "length"))
                mine, key = np.array(part.column("label").to_pylist()), part.column("row").to_numpy()
                for at in range(0, len(rows), 256):
                    chunk = slice(at, min(at + 256, len(rows)))
                    middle, half = a.interval(chunk, codes_of, aligned, rest, length)
                    same = labels[chunk, None] == mine[None, :]
                    if positives is None:
                        same &= rows[chunk, None] != key[None, :]
                        x, y = np.nonzero(same & (middle + half >= top.least[chunk, None]))
                    else:
                        slots = range(chunk.start, chunk.stop)
                        least = np.array([min((max(floor[j], top.least[j]) for j in range(first[i], first[i + 1])), default=2 ** 62)
                                          for i in slots], float)
                        most = np.array([max((ceiling[j] for j in range(first[i], first[i + 1])), default=-2 ** 62) for i in slots], float)
                        x, y = np.nonzero(~same & (middle + half >= least[:, None]) & (middle - half <= most[:, None]))
                    for c in range(0, len(x), 1 << 16):
                        i, j = x[c:c + (1 << 16)] + at, y[c:c + (1 << 16)]
                        score = np.einsum("ij,ij->i", q[i], v[j])
                        if positives is None:
                            top.offer(i, score, j, part)
                            continue
                        for p in range(max(first[i + 1] - first[i], default=0)):
                            slot = first[i] + p
                            has = slot < first[i + 1]
                            safe = np.where(has, slot, 0)
                            fit = has & (100 * score >= low * goal[safe]) & (100 * score <= high * goal[safe])
                            top.offer(slot[fit], score[fit], j[fit], part)
        out = [(slot, None if null else i, -neg, row) for slot, best in enumerate(top.rows) for neg, null, i, row in best]
        for s in range(0, len(out), 10_000):
            slot, i, score, row = zip(*out[s:s + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int32()), pa.array(i, id_type), pa.array(score, pa.int64()),
                                              pa.array(row, pa.int64())], names=["slot", "id", "score", "row"])

    schema = T.StructType([T.StructField("slot", T.IntegerType()), T.StructField("id", codes.schema["id"].dataType),
                           T.StructField("score", T.LongType()), T.StructField("row", T.LongType())])
    best = Window.partitionBy("slot").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    return (codes.coalesce(tasks).mapInArrow(run, schema).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k))


def mine(vectors: DataFrame, anchors: Column, key: str = "vec_id", vec: str = "embedding", label: str = "label", scale: int = 256,
         n_positives: int = 5, n_negatives: int = 5, low: int = 80, high: int = 100, levels: int = 4,
         block_components: int = 1 << 20, tasks: int | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that meet the condition
    ``anchors``, a condition on ``id``."""
    spark = vectors.sparkSession
    rows = stored(usable(vectors, key, vec, label, scale), "mining-rows")
    mean = mean_of(rows)
    codes = stored(encoded(rows, mean, levels), "mining-codes")
    tasks = tasks or 2 * spark.sparkContext.defaultParallelism
    asked = codes.where(anchors).select("row", "id", "label", "v")
    n, most = asked.count(), max(1, block_components // len(mean))
    blocks = max(1, -(-n // most))
    while True:                                        # sizes of the blocks are looked at: none has more than ``most``
        dealt = asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
        sizes = {r[0]: r[1] for r in dealt.groupBy("block").count().collect()}      # a number for each block
        if max(sizes.values(), default=0) <= most:
            break
        blocks += -(-blocks // 4)
    dealt = stored(dealt, "mining-anchors")
    found = Parts(spark, "mining-found")
    for block in sorted(sizes):
        got = dealt.where(F.col("block") == block).toArrow().combine_chunks().sort_by("row")
        labels, ids = np.array(got.column("label").to_pylist()), got.column("id").to_pylist()
        q = _matrix(got.column("v").combine_chunks(), len(mean)).astype(np.int64)
        of = (got.column("row").to_numpy(), labels, q)
        near = _scan(codes, of, mean, levels, n_positives, tasks, low, high, None).toArrow()
        near = near.sort_by([("slot", "ascending"), ("rank", "ascending")])         # n_positives an anchor at most
        slots, scores = near.column("slot").to_numpy(), near.column("score").to_numpy()
        ends = np.searchsorted(slots, np.arange(len(ids) + 1))
        goals = [scores[a:b].tolist() for a, b in zip(ends, ends[1:])]
        far = _scan(codes, of, mean, levels, n_negatives, tasks, low, high, goals)
        pairs = pa.table({"slot": pa.array(range(len(slots)), pa.int32()), "positive_id": near.column("id"),
                          "anchor_id": pa.array([ids[i] for i in slots], got.column("id").type), "positive_score": near.column("score")})
        found.add(far.join(spark.createDataFrame(pairs), "slot").select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
    if not found.n:
        i = codes.schema["id"].dataType.simpleString()
        return spark.createDataFrame([], f"anchor_id {i}, positive_id {i}, rank int, negative_id {i}, positive_score long, negative_score long")
    return found.read()
