"""K-d tree sharding [native].

The rows are points in a space of metadata coordinates (source, language, length, ...).  A node with k
shards is cut into floor(k/2) and ceil(k/2) shards along its widest dimension, at the weighted quantile
(the weighted median for even k) of the row bytes.  Leaves are reached when a node's share is one shard,
that is, the target bytes.

How the quantiles are found without moving rows: one aggregate per level gives every node's bytes and
the range of each dimension; then histograms of bytes over equal-width bins of the chosen dimension are
summed map-side, and the bin that holds the quantile is split again until its bytes are below the
tolerance.  The shuffles carry (node, bin) sums only.  The driver holds the tree: one entry per inner
node, fewer than the number of shards.  Each level writes the nodes of the rows; cuts and ranges are constants
in the plan, which holds no join, however deep the tree is.

Skew: every coordinate carries a tie-breaking fraction made of the row's key, so a source or length that
a third of the rows share is cut like any other interval.  Nothing is collected per node.

Defined results
* null metadata counts as '' or 0; a null text has 0 bytes plus the row overhead of 8;
* rows equal in key and text share all coordinates and so always land in the same shard;
* an empty table gives an empty result; with fewer rows than shards some shards are empty;
* input columns named like an output column are replaced by it.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, others, stored, text_or_empty

ROW_OVERHEAD = 8
OUT = ("size", "text_crc32", "shard", "slot")
_X, _W, _NODE, _TIE = "_kd_x", "_kd_w", "_kd_node", "_kd_tie"


def row_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus the row overhead."""
    return (F.octet_length(text_or_empty(text)) + F.lit(ROW_OVERHEAD)).cast("long")


def text_crc(text: Column) -> Column:
    return F.crc32(text_or_empty(text).cast("binary"))


def category(c: Column, tie: Column) -> Column:
    """Coordinate of a categorical value: its CRC as a cell of width 1, the tie inside the cell."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")).cast("double") + tie


def magnitude(c: Column, tie: Column) -> Column:
    """Coordinate of a nonnegative number, on a log scale so that a long tail isn't all of the width."""
    return F.log1p(F.greatest(F.coalesce(c.cast("double"), F.lit(0.0)), F.lit(0.0)) + tie)


@dataclass
class KdTree:
    """Cuts by level: rows (node, dimension, cut) and the leaves' shard numbers."""
    num_shards: int
    levels: list[list[tuple]] = field(default_factory=list)
    shards: dict[int, int] = field(default_factory=dict)

    def assign(self, points: DataFrame) -> DataFrame:
        """Add ``shard`` to rows that carry the coordinates."""
        cuts = [c for level in self.levels for c in level]
        leaf = F.aggregate(F.sequence(F.lit(1), F.lit(len(self.levels))), F.lit(1).cast("long"),
                           lambda node, _: below(node, cuts)) if cuts else F.lit(1).cast("long")
        return points.withColumn("shard", by_node(leaf, self.shards, "int"))


def by_node(node: Column, of: dict[int, float], kind: str) -> Column:
    """What ``of`` holds for a node, null if nothing: one constant array, so that a level of the tree is no join, and every round of
    the search runs the same code on other constants."""
    first = min(of, default=0)
    held = ",".join(repr(of[n]) if n in of else "" for n in range(first, max(of, default=0) + 1))
    return F.get(F.split(F.lit(held), ",").try_cast(f"array<{kind}>"), (node - first).cast("int"))


def below(node: Column, cuts: list[tuple]) -> Column:
    """The child a row goes to; a node without a cut is a leaf, where the row stays."""
    dim, cut = by_node(node, {n: d for n, d, _ in cuts}, "int"), by_node(node, {n: x for n, _, x in cuts}, "double")
    return F.when(dim.isNull(), node).otherwise(node * 2 + (F.get(_X, dim - 1) >= cut).cast("long"))


def points_of(df: DataFrame, dims: dict[str, str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with its size, CRC and coordinates; ``dims`` maps a column to 'category' or 'magnitude'."""
    base = (df.select(*[col(c) for c in others(df, (*OUT, _X, _W))],
                      row_size(col(text)).alias("size"), text_crc(col(text)).alias("text_crc32")))
    # 53 random bits of the key and the text
    base = base.withColumn(_TIE, F.shiftrightunsigned(F.xxhash64(col(key), F.col("text_crc32")), 11) / F.lit(2.0 ** 53))
    kinds = {"category": category, "magnitude": magnitude}
    return base.withColumn(_X, F.array(*[kinds[k](col(c), F.col(_TIE)) for c, k in dims.items()])).drop(_TIE)


def fit(points: DataFrame, n_dims: int, num_shards: int | None = None, target_bytes: int | None = None,
        bins: int = 2048, tolerance: float = 0.002) -> KdTree:
    """Grow the tree on stored ``points`` (size and coordinates).  Give the number of shards or the
    target bytes of a leaf; a cut is within ``tolerance`` of one shard's bytes, or between two rows
    that share a coordinate."""
    if num_shards is None:
        total = points.agg(F.sum("size")).first()[0] or 0
        num_shards = max(1, -(-total // max(1, int(target_bytes))))
    tree = KdTree(num_shards)
    shards = {1: (0, num_shards)}                      # node -> first shard, number of shards
    here, whole = points.select(_X, "size").withColumn(_NODE, F.lit(1).cast("long")), None
    while any(k > 1 for _, k in shards.values()):
        live = sorted(n for n, (_, k) in shards.items() if k > 1)
        stats = (here.groupBy(_NODE).agg(
            F.sum("size").alias("w"),
            *[f(F.element_at(_X, d + 1)).alias(f"{n}{d}") for d in range(n_dims) for n, f in (("lo", F.min), ("hi", F.max))])
            .collect())                                # one row per node
        stats = {r[_NODE]: r for r in stats}
        if whole is None:
            root = stats.get(1)
            whole = [max((root[f"hi{d}"] - root[f"lo{d}"]) if root else 0.0, 1e-300) for d in range(n_dims)]
        search = []                                    # node, dimension, from, to, bytes before, wanted bytes
        for n in live:
            r, k = stats.get(n), shards[n][1]
            if r is None:
                continue
            d = max(range(n_dims), key=lambda i: ((r[f"hi{i}"] - r[f"lo{i}"]) / whole[i], -i))
            lo, hi = r[f"lo{d}"], r[f"hi{d}"]
            search.append((n, d + 1, lo, hi + max(abs(hi), 1.0) * 1e-15, 0.0, r["w"] * (k // 2) / k,
                           tolerance * r["w"] / k))
        cuts = _quantiles(here, search, bins)
        level = []
        for n in live:
            first, k = shards.pop(n)
            if n in cuts:
                level.append((n, *cuts[n]))
                shards[2 * n], shards[2 * n + 1] = (first, k // 2), (first + k // 2, k - k // 2)
            else:                                      # no rows: its shards stay empty
                shards[n] = (first, 1)
        tree.levels.append(level)
        if any(k > 1 for _, k in shards.values()):     # each row's node is written, not found again in every round
            here = stored(here.withColumn(_NODE, below(F.col(_NODE), level)), "kd-nodes")
    tree.shards = {n: first for n, (first, _) in shards.items()}
    return tree


def _quantiles(here: DataFrame, search: list[tuple], bins: int) -> dict[int, tuple[int, float]]:
    """Weighted quantiles of all nodes of a level at once, by histogram refinement."""
    cuts = {}
    while search:
        d, lo, hi, before, want = (by_node(F.col(_NODE), {s[0]: s[i] for s in search}, kind)
                                   for i, kind in enumerate(("int", "double", "double", "double", "double"), 1))
        cells = (here.select(_NODE, "size", F.get(_X, d - 1).alias("x"), lo.alias("lo"), hi.alias("hi"))
                 .where((F.col("x") >= F.col("lo")) & (F.col("x") < F.col("hi")))
                 .withColumn("bin", F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins).cast("int"),
                                            F.lit(bins - 1)))
                 .groupBy(_NODE, "bin").agg(F.sum("size").cast("double").alias("w")))
        upto = Window.partitionBy(_NODE).orderBy("bin")  # at most ``bins`` rows a node
        hit = (cells.withColumn("upto", F.sum("w").over(upto) + before).withColumn("want", want)
               .where((F.col("upto") >= F.col("want")) & (F.col("upto") - F.col("w") <= F.col("want")))
               .groupBy(_NODE).agg(F.min_by(F.struct("bin", "w", "upto"), "bin").alias("b"))
               .select(_NODE, "b.*").collect())         # one row per node
        found = {r[_NODE]: r for r in hit}
        again = []
        for n, d, lo, hi, before, want, close in search:
            r = found.get(n)
            if r is None:                              # rounding at the edge of the range
                cuts[n] = (d, hi)
                continue
            step = (hi - lo) / bins
            a, b = lo + r["bin"] * step, lo + (r["bin"] + 1) * step
            under, over = want - (r["upto"] - r["w"]), r["upto"] - want
            if min(under, over) <= close or step <= max(abs(a), 1.0) * 4e-16:
                cuts[n] = (d, a if under < over else b)
            else:
                again.append((n, d, a, b, r["upto"] - r["w"], want, close))
        search = again
    return cuts


def with_slots(df: DataFrame, key: str = "doc_id", num_shards: int = 24, rows_per_block: int = 4096,
               rows: int | None = None) -> DataFrame:
    """Gapless numbers from 0 inside each shard, without sorting a shard in one task: rows are numbered
    in hash blocks of about ``rows_per_block`` and the blocks' offsets added."""
    rows = df.count() if rows is None else rows
    blocks = max(1, -(-rows // (num_shards * rows_per_block)))
    h = F.xxhash64(col(key), F.col("text_crc32"))
    df = df.withColumn("_kd_block", F.pmod(h, F.lit(blocks)).cast("int"))
    before = Window.partitionBy("shard").orderBy("_kd_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (df.groupBy("shard", "_kd_block").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("_kd_from", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    inside = Window.partitionBy("shard", "_kd_block").orderBy(col(key), F.col("text_crc32"))
    numbered = df.withColumn("_kd_nr", F.row_number().over(inside))
    return (numbered.join(offsets, ["shard", "_kd_block"])
            .withColumn("slot", (F.col("_kd_from") + F.col("_kd_nr") - 1).cast("long"))
            .drop("_kd_block", "_kd_from", "_kd_nr"))


def shard_documents(df: DataFrame, dims: dict[str, str], num_shards: int | None = None,
                    target_bytes: int | None = None, key: str = "doc_id", text: str = "text",
                    carry: bool = True) -> DataFrame:
    """Rows with ``size``, ``text_crc32``, ``shard`` and ``slot``; with ``carry`` all other input columns
    too, else the key only.

    The tree is grown on a stored table of sizes and coordinates, never on texts.  Law: ``bytes``; the
    shards' bytes are near equal and equal texts aren't kept together (a group of copies may be larger
    than a shard)."""
    pts = points_of(df, dims, key, text)
    thin = stored(pts.select(col(key), "size", "text_crc32", _X), "kd-points")
    tree = fit(thin, len(dims), num_shards, target_bytes)
    src = pts if carry else thin
    out = tree.assign(src).drop(_X)
    return with_slots(out, key, tree.num_shards, rows=thin.count())
