"""Exact duplicates by content-defined chunk recipes.

A rolling hash over the UTF-8 bytes cuts every text where the content says so, so equal passages give equal
chunks wherever they stand.  Each distinct chunk gets a 128-bit identifier, and the identifiers are verified: all distinct
(identifier, bytes) pairs are formed, and an identifier of two different chunks makes the run start again with another seed.
After that a text is its recipe, the ordered list of its identifiers: two texts are equal exactly if their recipes are.  Only
recipes (16 bytes for about a kilobyte of text) are grouped and joined; texts stay where they are.

Scale: a chunk is shuffled at most once per map task that holds it (distinct before the shuffle), however many documents
repeat it, and the check returns one truth value to the driver.  Groups of more than a thousandth of all rows
(a thousand groups at most, whose recipes together are at most a thousand times the mean recipe) are joined by broadcast,
all others by a shuffle: no task gets a hot group.

Defined results: a null text counts as empty, and empty texts are equal to each other; of equal texts the row with the largest
id stays, null ids coming last; of rows equal in id and text one stays; each input row gives one result row; an
empty table gives an empty result; ids may have any type that can be ordered.  Input columns named like an output column are
replaced.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, col, others, plain_names, sha_hex, stored, text_or_empty

OUT = ("keep_id", "group_size", "kept", "text_sha256")
SMALLEST, LARGEST, MEAN_BITS = 256, 8192, 10
WINDOW, PIECE = 32, 1 << 20
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), seed=7) for b in range(256)], np.uint32)

Digest = Callable[[bytes, int], bytes]


def digest(chunk: bytes, seed: int) -> bytes:
    return xxhash.xxh3_128_digest(chunk, seed)


def places(data: np.ndarray) -> np.ndarray:
    """Ends of possible chunks: where the hash of the last 32 bytes has its top bits clear.  Worked out piece by piece, so
    that memory doesn't follow the length of a text."""
    found = []
    for at in range(0, len(data), PIECE):
        begin = max(0, at - WINDOW + 1)
        h, w = GEAR[data[begin:at + PIECE]], 1
        while w < WINDOW:                              # the hash of 2w bytes from two hashes of w bytes
            wider = h.copy()
            wider[w:] += h[:-w] << np.uint32(w)
            h, w = wider, 2 * w
        hits = np.flatnonzero(h >> np.uint32(32 - MEAN_BITS) == 0) + begin + 1
        found.append(hits[hits > at])
    return np.concatenate(found) if found else np.empty(0, np.int64)


def cuts(start: int, end: int, possible: np.ndarray) -> Iterator[tuple[int, int]]:
    """Chunks of the text at [start, end).  The smallest chunk is longer than the hash window, so what stands
    before the text never matters."""
    while start < end:
        stop = min(end, start + LARGEST)
        k = np.searchsorted(possible, start + SMALLEST)
        if k < len(possible) and possible[k] < stop:
            stop = int(possible[k])
        yield start, stop
        start = stop


def _texts(column: pa.Array) -> tuple[memoryview, np.ndarray]:
    """All bytes of a column of texts and the offsets of its rows."""
    c = column.cast(pa.large_binary())
    offsets = np.frombuffer(c.buffers()[1], np.int64)[c.offset:c.offset + len(c) + 1]
    return memoryview(c.buffers()[2] or b""), offsets


def chunks_of(column: pa.Array) -> Iterator[tuple[int, bytes]]:
    """(row, chunk) of a column of texts without nulls, in order."""
    if not len(column):
        return
    data, offsets = _texts(column)
    first, last = int(offsets[0]), int(offsets[-1])
    possible = places(np.frombuffer(data, np.uint8)[first:last]) + first if last > first else np.empty(0, np.int64)
    for row in range(len(column)):
        for a, b in cuts(int(offsets[row]), int(offsets[row + 1]), possible):
            yield row, bytes(data[a:b])


def distinct_chunks(docs: DataFrame, seed: int, name: Digest = digest) -> DataFrame:
    """Every distinct (identifier, chunk) of the texts."""
    def run(batches):
        for b in batches:
            seen: dict[bytes, bytes] = {}
            ids, bodies = [], []
            for _, body in chunks_of(b.column(0)):
                i = name(body, seed)
                if seen.setdefault(i, body) is not body and seen[i] == body:
                    continue
                ids.append(i)
                bodies.append(body)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(bodies, pa.binary())], names=["id", "body"])

    texts = docs.select(text_or_empty(col("text")).alias("text"))
    return arrow_rows(texts).mapInArrow(run, "id binary, body binary").dropDuplicates(["id", "body"])


def verified_seed(docs: DataFrame, name: Digest = digest, most: int = 8) -> int:
    """The first seed under which no two different chunks have the same identifier."""
    for seed in range(most):
        if distinct_chunks(docs, seed, name).groupBy("id").count().where("count > 1").isEmpty():
            return seed
    raise RuntimeError(f"different chunks share identifiers under each of {most} seeds")


def recipes(docs: DataFrame, seed: int, keep: list[str], name: Digest = digest) -> DataFrame:
    """The columns ``keep`` with ``text_sha256`` and ``__recipe``, the identifiers of the text's chunks in order."""
    df = docs.select(*[col(c) for c in keep], sha_hex(text_or_empty(col("text"))).alias("text_sha256"),
                     text_or_empty(col("text")).alias("__text"))
    schema = df.drop("__text").schema.add("__recipe", "binary")

    def run(batches):
        for b in batches:
            lists = [bytearray() for _ in range(b.num_rows)]
            for row, body in chunks_of(b.column("__text")):
                lists[row] += name(body, seed)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([bytes(x) for x in lists], pa.binary())],
                                             names=schema.names)

    return arrow_rows(df).mapInArrow(run, schema)


@plain_names
def exact_duplicates(docs: DataFrame, key: str = "doc_id", carry: list[str] | None = None, name: Digest = digest) -> DataFrame:
    """One row per document: the columns in ``carry`` (by default all but the text), ``keep_id`` (the id of the
    row that stays), ``group_size``, ``kept`` and ``text_sha256``."""
    keep = others(docs.select(*[col(c) for c in carry]) if carry is not None else docs, (*OUT, "text"))
    named = docs.select(*[col(c) for c in keep], col(key).alias("__id"), col("text"))
    seed = verified_seed(docs, name)
    listed = stored(recipes(named, seed, [*keep, "__id"], name).withColumn("__row", F.monotonically_increasing_id()),
                    "dedup-recipes")                   # written: row numbers are the same for every reader
    groups = stored(listed.groupBy("__recipe").agg(F.count(F.lit(1)).alias("group_size"),
                                                   F.max(F.struct("__id", "__row")).alias("__stays"))
                    .where("group_size > 1"), "dedup-groups")
    hot = groups.where(F.col("group_size") * 1000 > F.lit(listed.count()))
    common = listed.join(F.broadcast(hot), "__recipe")
    rest = (listed.join(F.broadcast(hot.select("__recipe")), "__recipe", "left_anti")
            .join(groups, "__recipe", "left"))
    alone = F.col("__stays").isNull()
    return common.unionByName(rest).select(
        *[col(c) for c in keep], F.when(alone, F.col("__id")).otherwise(F.col("__stays.__id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("__stays.__row") == F.col("__row"))).alias("kept"), "text_sha256")
