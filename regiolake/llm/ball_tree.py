"""Ranked lexical search: exact inner products under a sparse ball tree.

A document is a sparse vector of integer term values, an item of integer term weights, and a score is their inner product.
Each task packs its documents into trees of a few thousand rows.  A node is a ball: its centroid and the distance of its
farthest document, and the largest value of each term in it.  For an item q no document of the ball scores more than
<q, centroid> + |q| * radius, nor more than <q, largest>; both are worked out in doubles on coordinates scaled by the root of the
term's weight (which leaves inner products as they are), with a margin far above the rounding errors.  Subtrees are visited
best first and left out once their bound is below the k-th best score so far; leaves are scored in 64-bit integers.
A bound equal to that score is still searched, as a smaller id may win the tie.

Scale: terms are counted for the items' terms only, in one pass that writes a thin table (id, length, term numbers, counts); the
search reads that table.  Items are taken in blocks of at most ``block_bytes`` of text (one item at least), each block
broadcast; a task gives at most k rows an item, and these are ranked in two steps, so no task gets all rows of an item.  A tree is
bounded in rows and in terms, and goes when its documents are done; texts are cut into terms a megabyte at a time.

Defined results: null and empty texts have no terms, are not counted and match nothing; an item without terms of the documents has
no rows; rows of one id are separate documents, and rows of one item id separate items; null ids come last among equal
scores; an empty table of either kind gives an empty result.  Ids of any type that can be ordered; extra columns don't matter.
"""
from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import Parts, arrow_rows, col, stored

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")              # of UTF-8 bytes in lower case: every character beyond ASCII counts
GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
PIECE = 1 << 20
MARGIN = 1e-9                                          # relative; sums of a million doubles are off by 1e-10 at most


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, some at a time."""
    data, at = (text or "").encode().lower(), 0
    while at < len(data):
        end = len(data)
        if at + PIECE < end and (gap := GAP.search(data, at + PIECE)):
            end = gap.start()
        yield TERM.findall(data, at, end)
        at = end


@dataclass
class Items:
    """A block of items over a vocabulary of ``size`` terms: item k has the terms ``idx[ptr[k]:ptr[k + 1]]``."""
    rows: list[int]
    ptr: np.ndarray
    idx: np.ndarray
    times: np.ndarray
    vocabulary: dict[bytes, int]

    @classmethod
    def of(cls, rows: list[tuple[int, str | None]]) -> "Items":
        vocabulary: dict[bytes, int] = {}
        ptr, idx, times = [0], [], []
        for _, text in rows:
            for t, n in sorted(Counter(t for part in terms(text) for t in part).items()):
                idx.append(vocabulary.setdefault(t, len(vocabulary)))
                times.append(n)
            ptr.append(len(idx))
        return cls([r for r, _ in rows], np.array(ptr), np.array(idx, np.int64), np.array(times, np.int64), vocabulary)


def blocks(items: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """``items`` with ``block``, so dealt that a block has at most ``block_bytes`` of text or one item, and the number of
    blocks; sizes are looked at, not assumed."""
    size = F.octet_length(F.coalesce("text", F.lit("")))
    total, largest = items.agg(F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.max(size), F.lit(0))).first()
    n = max(1, math.ceil(2 * total / block_bytes))
    while True:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n)).cast("int"))
        sums = dealt.groupBy("block").agg(F.sum(size).alias("b"), F.count(F.lit(1)).alias("c"))
        if sums.where((F.col("c") > 1) & (F.col("b") > max(block_bytes, largest))).isEmpty():
            return dealt, n
        n *= 2


def vectors(docs: DataFrame, key: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """(id, n, t, tf) of the documents with terms: their number of terms, and the counts of the vocabulary's terms."""
    df = docs.select(col(key).alias("id"), col("text").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = shared.value
        for b in batches:
            n, t, tf = [], [], []
            for text in b.column("text"):
                total, counts = 0, Counter()
                for part in terms(text.as_py()):
                    total += len(part)
                    counts.update(x for x in part if x in known)
                n.append(total)
                pairs = sorted((known[x], c) for x, c in counts.items())
                t.append([p[0] for p in pairs])
                tf.append([p[1] for p in pairs])
            out = pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int64()), pa.array(t, pa.list_(pa.int32())),
                                              pa.array(tf, pa.list_(pa.int64()))], names=["id", "n", "t", "tf"])
            yield out.filter(pa.array([x > 0 for x in n], pa.bool_()))

    schema = (df.select("id").schema.add("n", "long").add("t", T.ArrayType(T.IntegerType()))
              .add("tf", T.ArrayType(T.LongType())))
    return arrow_rows(df).mapInArrow(run, schema)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def term_values(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Value of a term that occurs ``tf`` times in a document of ``length`` terms."""
    m = np.array([75 + 25 * int(n) * n_docs // n_terms for n in length], np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class Tree:
    """A ball tree over the rows of a sparse matrix: ``ptr``, ``idx``, ``val`` (integers)."""

    def __init__(self, ptr, idx, val, weights, items: Items, leaf: int):
        self.ptr, self.idx, self.val, self.leaf = ptr, idx, val, leaf
        self.items, self.weights, self.size = items, weights, len(weights)
        self.scale = np.sqrt(weights.astype(float))
        self.x = val * self.scale[idx]
        self.row_of = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
        self.norm2 = np.bincount(self.row_of, self.x * self.x, len(ptr) - 1)
        self.q = items.times * self.scale[items.idx]
        self.q_norm = np.sqrt(np.add.reduceat(np.append(self.q * self.q, 0.0), items.ptr[:-1]) * (np.diff(items.ptr) > 0)
                              ) if len(items.rows) else np.empty(0)
        self.bounds, self.children, self.docs, self.leaves = [], [], [], {}
        self._node(np.arange(len(ptr) - 1))

    def _cells(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``idx`` of the documents' cells, and the document of each."""
        n = self.ptr[docs + 1] - self.ptr[docs]
        at = np.repeat(self.ptr[docs] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return at, np.repeat(np.arange(len(docs)), n)

    def _dots(self, at, of, docs, dense) -> np.ndarray:
        return np.bincount(of, self.x[at] * dense[self.idx[at]], len(docs))

    def _over_items(self, dense: np.ndarray) -> np.ndarray:
        i = self.items
        return np.add.reduceat(np.append(self.q * dense[i.idx], 0.0), i.ptr[:-1]) * (np.diff(i.ptr) > 0)

    def _node(self, docs: np.ndarray) -> int:
        at, of = self._cells(docs)
        centre = np.bincount(self.idx[at], self.x[at], self.size) / len(docs)
        largest = np.zeros(self.size)
        np.maximum.at(largest, self.idx[at], self.x[at])
        c2 = centre @ centre
        far2 = self.norm2[docs] - 2 * self._dots(at, of, docs, centre) + c2
        slack = self.norm2[docs].max() + c2
        radius = math.sqrt(max(0.0, far2.max()) + MARGIN * slack)
        ball = self._over_items(centre) + self.q_norm * (radius + MARGIN * math.sqrt(slack))
        corner = self._over_items(largest) * (1 + MARGIN)
        me = len(self.bounds)
        self.bounds.append(np.minimum(ball, corner) + 1)
        self.docs.append(docs)
        self.children.append(())
        if len(docs) > self.leaf:
            pivot = int(far2.argmax())                 # the farthest from the centre, and the farthest from that one
            one = self._dense(docs[pivot])
            d1 = self.norm2[docs] - 2 * self._dots(at, of, docs, one)
            two = self._dense(docs[int(d1.argmax())])
            d2 = self.norm2[docs] - 2 * self._dots(at, of, docs, two)
            lean = (d1 + one @ one) - (d2 + two @ two)
            near = lean < 0
            if 8 * min(near.sum(), (~near).sum()) < len(docs):
                near = np.zeros(len(docs), bool)       # too uneven a split: halves by the same order
                near[np.argsort(lean, kind="stable")[:len(docs) // 2]] = True
            self.children[me] = (self._node(docs[near]), self._node(docs[~near]))
        return me

    def _dense(self, doc: int) -> np.ndarray:
        out = np.zeros(self.size)
        cells = slice(self.ptr[doc], self.ptr[doc + 1])
        out[self.idx[cells]] = self.x[cells]
        return out

    def _scores(self, node: int, item: int) -> np.ndarray:
        """Exact scores of a leaf's documents, in 64-bit integers."""
        if node not in self.leaves:
            docs = self.docs[node]
            at, of = self._cells(docs)
            used, place = np.unique(self.idx[at], return_inverse=True)
            table = np.zeros((len(used), len(docs)), np.int64)
            table[place, of] = self.val[at] * self.weights[self.idx[at]]
            self.leaves[node] = used, table
        used, table = self.leaves[node]
        cells = slice(self.items.ptr[item], self.items.ptr[item + 1])
        mine = self.items.idx[cells]
        at = np.searchsorted(used, mine)
        hit = used[np.minimum(at, len(used) - 1)] == mine if len(used) else np.zeros(len(mine), bool)
        return self.items.times[cells][hit] @ table[at[hit]]

    def search(self, item: int, best: "Best") -> int:
        """Offers all documents that may be among the best of an item; returns how many were scored."""
        scored, queue = 0, [(-self.bounds[0][item], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < best.least:
                break
            if self.children[node]:
                for c in self.children[node]:
                    if self.bounds[c][item] >= best.least:
                        heapq.heappush(queue, (-self.bounds[c][item], c))
                continue
            s = self._scores(node, item)
            scored += len(s)
            good = np.flatnonzero(s >= best.least)
            best.offer(s[good], self.docs[node][good])
        return scored


class Best:
    """The k best (score, id) of an item so far; scores are at least 1."""

    def __init__(self, k: int):
        self.k, self.rows, self.least, self.ids = k, [], 1, None

    def offer(self, scores, docs) -> None:
        if not len(scores):
            return
        ids = self.ids
        self.rows += [(-int(s), (ids[d] is None, ids[d] if ids[d] is not None else 0)) for s, d in zip(scores, docs)]
        if len(self.rows) >= self.k:
            self.rows = heapq.nsmallest(self.k, self.rows)
            self.least = -self.rows[-1][0]


def _search(table: DataFrame, items: Items, weights: np.ndarray, n_docs: int, n_terms: int, k: int, leaf: int,
            tree_rows: int, tree_cells: int) -> DataFrame:
    """(row of the item, id, score): the k best of each task."""
    spark, id_field = table.sparkSession, table.schema["id"]
    shared = spark.sparkContext.broadcast((items.rows, items.ptr, items.idx, items.times, weights))

    def run(batches):
        rows, ptr, idx, times, w = shared.value
        block = Items(rows, ptr, idx, times, {})
        best = [Best(k) for _ in rows]
        held, cells = [], 0

        def searched():
            t, tf, n, ids = (np.concatenate([h[j] for h in held]) if j < 3 else sum((h[3] for h in held), []) for j in range(4))
            at = np.concatenate([[0], np.cumsum(np.concatenate([h[4] for h in held]))])
            values = term_values(tf, np.repeat(n, np.diff(at)), n_docs, n_terms) if len(tf) else tf
            tree = Tree(at, t, values, w, block, leaf)
            for item, b in enumerate(best):
                b.ids = ids
                tree.search(item, b)
        for b in batches:
            for s in range(0, b.num_rows, 256):
                part = b.slice(s, 256)
                counts = np.diff(np.asarray(part.column("t").offsets))
                held.append((part.column("t").flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                             part.column("tf").flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                             part.column("n").to_numpy(zero_copy_only=False), part.column("id").to_pylist(), counts))
                cells += int(counts.sum())
                if sum(len(h[4]) for h in held) >= tree_rows or cells >= tree_cells:
                    searched()
                    held, cells = [], 0
        if held:
            searched()
        out = [(rows[i], None if null else doc, -neg) for i, b in enumerate(best) for neg, (null, doc) in b.rows]
        for s in range(0, len(out), 10_000):
            r, d, v = zip(*out[s:s + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()), pa.array(d, to_arrow), pa.array(v, pa.int64())],
                                             names=["row", "id", "score"])

    to_arrow = to_arrow_type(id_field.dataType)
    schema = table.select(F.lit(0).cast("long").alias("row"), "id", F.lit(0).cast("long").alias("score")).schema
    return table.mapInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", item: str = "item_id",
           block_bytes: int = 1 << 20, leaf: int = 16, tree_rows: int = 4096, tree_cells: int = 1 << 20) -> DataFrame:
    """The k best documents of each item: (item, rank from 1, key, score)."""
    listed = stored(items.select(col(item).alias("item"), col("text").alias("text"))
                    .withColumn("row", F.monotonically_increasing_id()), "search-items")
    dealt, n_blocks = blocks(listed, block_bytes)
    dealt = stored(dealt, "search-blocks")
    found, totals = Parts(docs.sparkSession, "search-found"), None
    for block in range(n_blocks):
        got = dealt.where(F.col("block") == block).select("row", "text").toArrow()     # bounded by block_bytes
        mine = Items.of(sorted(zip(got.column("row").to_pylist(), got.column("text").to_pylist())))
        if not mine.vocabulary and found.n:
            continue
        table = stored(vectors(docs, key, mine.vocabulary), "search-vectors")
        totals = totals or table.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        holds = table.select(F.explode("t").alias("t")).groupBy("t").count().toArrow()  # a row a term of the block
        df = dict(zip(holds.column("t").to_pylist(), holds.column("count").to_pylist()))
        weights = np.array([weight(totals[0], df.get(t, 0)) for t in range(len(mine.vocabulary))], np.int64)
        found.add(_search(table, mine, weights, totals[0], max(1, totals[1]), k, leaf, tree_rows, tree_cells))
    last = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    by_some = Window.partitionBy("row", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy(*last)
    by_item = Window.partitionBy("row").orderBy(*last)
    some = found.read().withColumn("r", F.row_number().over(by_some)).where(F.col("r") <= k).drop("r")
    top = some.withColumn("rank", F.row_number().over(by_item)).where(F.col("rank") <= k)
    return top.join(listed.select("row", "item"), "row").select(
        F.col("item").alias(item), "rank", F.col("id").alias(key), "score")
