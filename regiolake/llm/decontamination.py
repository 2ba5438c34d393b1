"""Benchmark decontamination by training suffix arrays.

Each shard of training documents (an Arrow batch of whole texts inside a task) gets a sorted array of its
word suffixes; every suffix of the test items is binary-searched in it.  The range found gives all
documents and positions where the test words occur verbatim; neighbouring hits on the same diagonal
join to the longest matches.

Words: A-Z lower-cased, runs of ASCII digits, letters and anything beyond ASCII.  A window is ``width``
consecutive words of an item; an item with fewer words, but not none, is one window.  Document words inside
any occurrence of a window are hit; a document is contaminated if ``100 * hit >= percent * words`` and
any word is hit.

Scale: documents don't move; the test items come to them.  The suffix array is sparse: only suffixes
that begin with the first ``min(4, shortest window)`` words of some test suffix are sorted, since no other
can match, and they are compared to the width of a window (a longer match is several windows in a row).
A block of test items has at most ``block_words`` words; a larger benchmark is searched in several blocks,
one after another in the same tasks, with the hits carried along.  Nothing is shuffled.

Defined results: a null or empty text has no words, is never hit and never contaminated; items without words
are no items; a repeated item_id counts once in the item list if any of its texts occurs; repeated
documents are judged alike; an empty benchmark contaminates nothing.  Item ids are given as strings.  Input
columns named like an output column are replaced.
"""
from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows, col, others, plain_names

_KEEP = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isdigit() or 97 <= b <= 122 else 32 for b in range(256))
SPAN = "array<struct<start:int,end:int,item:string,item_start:int>>"
OUT = ("n_words", "n_hit", "matches", "items", "contaminated")


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_KEEP).split()


class Tests:
    """The test suffixes of one block: one row per suffix of window length, sorted."""

    def __init__(self, items: list[tuple[str, bytes]], width: int):
        self.width, self.vocab = width, {}
        rows, self.owner, lens = [], [], []
        for item, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text)]
            k = min(width, len(ids))
            for i in range(len(ids) - k + 1 if k else 0):
                rows.append(ids[i:i + k] + [0] * (width - k))
                self.owner.append((item, i))
                lens.append(k)
        self.lens = np.array(lens, np.int64)
        self.rows = np.array(rows, np.int64).reshape(-1, width)
        self.head = int(min(4, self.lens.min())) if lens else 0
        self.heads = np.unique(self._hash(self.rows[:, :self.head])) if lens else np.empty(0, np.uint64)

    @staticmethod
    def _hash(rows: np.ndarray) -> np.ndarray:
        h = np.zeros(len(rows), np.uint64)
        for j in range(rows.shape[1]):
            h = h * np.uint64(0x9E3779B97F4A7C15) + rows[:, j].astype(np.uint64) + np.uint64(1)
        return h

    @staticmethod
    def keys(rows: np.ndarray, fill: int = 0) -> np.ndarray:
        """Rows of word ids as byte strings whose order is the order of the suffixes."""
        r = rows.astype(">u4")
        if fill:
            r[rows == 0] = 0xFFFFFFFF
        return np.ascontiguousarray(r).view(f"S{4 * rows.shape[1]}").ravel()

    def find(self, docs: list[list[bytes]]) -> list[list[tuple[int, int, str, int]]]:
        """For each document of a shard its matches (start, end, item, start in the item)."""
        found: list[list[tuple[int, int, str, int]]] = [[] for _ in docs]
        if not len(self.lens):
            return found
        get = self.vocab.get
        ids, starts = [], []
        for ws in docs:                                # a 0 between documents and for unknown words
            starts.append(len(ids))
            ids.extend(get(w, 0) for w in ws)
            ids.append(0)
        flat = np.array(ids + [0] * self.width, np.int64)
        n = len(ids)
        ok = flat[:n] > 0
        for j in range(1, self.head):
            ok &= flat[j:n + j] > 0
        at = np.flatnonzero(ok)
        if not len(at):
            return found
        h = np.zeros(len(at), np.uint64)
        for j in range(self.head):
            h = h * np.uint64(0x9E3779B97F4A7C15) + flat[at + j].astype(np.uint64) + np.uint64(1)
        at = at[self.heads[np.minimum(np.searchsorted(self.heads, h), len(self.heads) - 1)] == h]
        if not len(at):
            return found
        suffixes = flat[at[:, None] + np.arange(self.width)]
        suffixes[np.cumsum(suffixes == 0, axis=1) > 0] = 0     # words after a gap don't count
        keys = self.keys(suffixes)
        order = np.argsort(keys, kind="stable")                # the sparse suffix array
        keys, at = keys[order], at[order]
        low = np.searchsorted(keys, self.keys(self.rows), "left")
        high = np.searchsorted(keys, self.keys(self.rows, fill=1), "right")
        doc_starts = np.array(starts)
        runs = defaultdict(list)                               # (document, item, diagonal) -> starts
        for t in np.flatnonzero(high > low):
            item, i = self.owner[t]
            for p in at[low[t]:high[t]].tolist():
                d = int(np.searchsorted(doc_starts, p, "right")) - 1
                q = p - starts[d]
                runs[d, item, q - i].append((q, q + int(self.lens[t]), i))
        for (d, item, _), spans in runs.items():
            spans.sort()
            s, e, i = spans[0]
            for s2, e2, i2 in spans[1:]:
                if s2 <= e:
                    e = max(e, e2)
                else:
                    found[d].append((s, e, item, i))
                    s, e, i = s2, e2, i2
            found[d].append((s, e, item, i))
        return found


def _blocks(benchmark: DataFrame, block_words: int) -> list[DataFrame]:
    """The items in parts of at most about ``block_words`` words."""
    items = benchmark.select(col("item_id").cast("string").alias("item_id"), col("text")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0    # a word takes two bytes at least
    n = max(1, -(-total // (2 * block_words)))
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) for k in range(n)]


@plain_names
def find_matches(docs: DataFrame, benchmark: DataFrame, width: int = 13, block_words: int = 2_000_000,
                 carry: list[str] | None = None, shard_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` (the columns in ``carry``, by default all) with ``n_words``, ``n_hit``, ``matches`` (longest
    verbatim matches: word span, item, place in the item) and ``items`` (ids with an occurring window)."""
    spark = docs.sparkSession
    keep = others(docs.select(*[col(c) for c in carry]) if carry is not None else docs, (*OUT, "_dc_old"))
    has = any(c.lower() == "text" for c in keep)       # a text that is kept anyway isn't sent twice
    base = docs.select(*[col(c) for c in keep], *([] if has else [col("text")]))
    text = next(c for c in base.columns if c.lower() == "text")
    blocks = _blocks(benchmark, block_words)
    for k, block in enumerate(blocks):
        got = block.toArrow()                          # a block has a fixed bound
        pairs = sorted(set(zip(got.column("item_id").to_pylist(), got.column("text").to_pylist())),
                       key=lambda r: (r[0] is None, r))
        tests = spark.sparkContext.broadcast([(i, t.encode("utf-8", "surrogatepass")) for i, t in pairs])
        base = _searched(base, tests, width, shard_bytes, text, keep, first=k == 0, last=k == len(blocks) - 1)
    return base


def _searched(df: DataFrame, tests, width: int, shard_bytes: int, text: str, keep: list[str], first: bool,
              last: bool) -> DataFrame:
    plain = keep if last else [c for c in df.columns if c != "_dc_old"]   # between blocks the text stays
    schema = df.select(*[col(c) for c in plain]).schema
    types = T._parse_datatype_string(f"n_words long, n_hit long, matches {SPAN}, items array<string>") if last else \
        T._parse_datatype_string(f"_dc_old {SPAN}")
    for f in types.fields:
        schema = schema.add(f)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("item", pa.string()), ("item_start", pa.int32())]))

    def shards(b: pa.RecordBatch):
        """Slices of a batch of bounded text size, so that one array of suffixes fits in memory."""
        start, have = 0, 0
        for i, s in enumerate(pc.fill_null(pc.binary_length(b.column(text)), 0).to_pylist()):
            if have and have + s > shard_bytes:
                yield b.slice(start, i - start)
                start, have = i, 0
            have += s
        if b.num_rows > start:
            yield b.slice(start)

    def run(batches):
        arrays = Tests(tests.value, width)
        for whole in batches:
            for b in shards(whole):
                docs = [words_of(v.as_py()) for v in b.column(text).cast(pa.binary())]
                found = arrays.find(docs)
                if not first:
                    for f, old in zip(found, b.column("_dc_old").to_pylist()):
                        f.extend((m["start"], m["end"], m["item"], m["item_start"]) for m in old)
                rows = [[dict(zip(("start", "end", "item", "item_start"), m)) for m in sorted(f, key=lambda m: (m[0], m[1], str(m[2]), m[3]))]
                        for f in found]
                cols = [b.column(c) for c in plain]
                if last:
                    hit = []
                    for f in found:
                        n, end = 0, 0
                        for s, e in sorted((m[0], m[1]) for m in f):
                            n, end = n + max(0, e - max(s, end)), max(e, end)
                        hit.append(n)
                    items = [sorted({str(m[2]) for m in f}) for f in found]
                    cols += [pa.array([len(d) for d in docs], pa.int64()), pa.array(hit, pa.int64()),
                             pa.array(rows, span), pa.array(items, pa.list_(pa.string()))]
                else:
                    cols.append(pa.array(rows, span))
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in schema.fields])

    return arrow_rows(df).mapInArrow(run, schema)


def contaminated(percent: int = 5):
    """At least ``percent`` of the words are inside a verbatim window of the benchmark."""
    return (F.col("n_hit") > 0) & (F.lit(100) * F.col("n_hit") >= F.lit(percent) * F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 13, percent: int = 5) -> DataFrame:
    """``docs`` without the affected documents; input columns only."""
    found = find_matches(docs, benchmark, width)
    return found.where(~contaminated(percent)).select(*[col(c) for c in others(docs, OUT)])
