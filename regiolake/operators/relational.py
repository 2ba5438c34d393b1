"""Relational helpers that add something over plain DataFrame calls.

Scale notes (apply to every helper here):

* Group-level results are computed with ``groupBy().agg`` (partial, map-side
  aggregation) and joined back, instead of a window over detail rows.  A
  window ``PARTITION BY k`` sends every row of a hot key to one task; an
  aggregate sends one partial row per map task.  The join back is either
  broadcast by AQE (the aggregate is small) or split by AQE's skew-join.
* "First/last row per key" is ``min_by``/``max_by`` over a struct, again a
  partial aggregate, not ``row_number()`` over a window.
* Nothing here calls an action; plans stay lazy and Catalyst prunes and
  pushes filters through every helper.
"""
from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from pyspark.sql import Window

from ..functions.numbers import _c, ColumnOrName, safe_ratio


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


# --------------------------------------------------------------------------- AGG

_AGGS = {
    "sum": F.sum,
    "max": F.max,
    "min": F.min,
    "avg": F.avg,
    "count": F.count,
}


def conditional_pivot(df: DataFrame, by: Sequence[str], on: ColumnOrName, measure: ColumnOrName,
                      values: Mapping[str, object], agg: str = "sum", else_value=None,
                      extra: Sequence[Column] = ()) -> DataFrame:
    """AGG-3/4/5: one output column per ``label -> category value``.

    ``agg(CASE WHEN on = value THEN measure ELSE else_value END)``; use
    ``else_value=0`` with ``sum`` for the "missing category is 0" form (T14),
    leave it NULL for ``max``/``avg`` ("missing is NULL").  A single pass and
    a single shuffle on ``by`` whatever the number of output columns.
    """
    fn = _AGGS[agg]
    on_c, m = _c(on), _c(measure)
    exprs = []
    for label, v in values.items():
        branch = F.when(on_c == F.lit(v), m)
        if else_value is not None:
            branch = branch.otherwise(F.lit(else_value))
        exprs.append(fn(branch).alias(label))
    # ``extra`` aggregates (e.g. a row count) are computed in the same pass
    return df.groupBy(*by).agg(*exprs, *extra)


def latest_snapshot(df: DataFrame, period: Sequence[str] | str, order: ColumnOrName) -> DataFrame:
    """AGG-7 / JN-9: keep only the rows whose ``order`` equals the maximum within their period.

    ``max`` per period is a partial aggregate (tiny: one row per period) and
    is joined back on (period, max); AQE broadcasts it when it is small.
    """
    period = _cols(period)
    o = _c(order)
    tagged = df.withColumn("__ord", o)
    mx = tagged.groupBy(*period).agg(F.max("__ord").alias("__ord"))
    return tagged.join(mx, on=period + ["__ord"], how="inner").drop("__ord")


def group_total(df: DataFrame, by: Sequence[str], measure: str, name: str = "group_total") -> DataFrame:
    """WIN-1: ``SUM(measure) OVER (PARTITION BY by)`` as aggregate + join back (skew-safe)."""
    by = _cols(by)
    tot = df.groupBy(*by).agg(F.sum(measure).alias(name))
    return df.join(tot, on=by, how="left")


def top1_per_group(df: DataFrame, by: Sequence[str], order: str, keep: Sequence[str],
                   tie_break: Sequence[str] = (), descending: bool = True) -> DataFrame:
    """WIN-2 / WIN-7: the first row of each group by ``order`` (desc by default),
    ties broken by ``tie_break`` ascending; returns ``by + keep``.

    Implemented as ``min_by(struct(keep), struct(sort key))``: a partial
    aggregate that never gathers a group in one task.  NULL order values sort
    last.
    """
    by = _cols(by)
    o = F.col(order)
    primary = (-o) if descending else o
    key = F.struct(o.isNull().alias("n"), primary.alias("k"), *[F.col(t).alias(f"t{i}") for i, t in enumerate(tie_break)])
    payload = F.struct(*[F.col(c) for c in keep])
    out = df.groupBy(*by).agg(F.min_by(payload, key).alias("__top"))
    return out.select(*by, *[F.col("__top")[c].alias(c) for c in keep])


def first_per_key(df: DataFrame, key: Sequence[str] | str, order: Sequence[ColumnOrName]) -> DataFrame:
    """WIN-7: ``drop_duplicates`` after a sort, i.e. the first row per key in a given order
    (ascending, NULLs last).  All other columns are kept."""
    key = _cols(key)
    rest = [c for c in df.columns if c not in key]
    sort_key = F.struct(*[F.struct(_c(o).isNull(), _c(o)) for o in order])
    out = df.groupBy(*key).agg(F.min_by(F.struct(*rest), sort_key).alias("__f"))
    return out.select(*key, *[F.col("__f")[c].alias(c) for c in rest])


def dup_groups(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """AGG-13: groups of ``key`` with more than one row, with their size."""
    return df.groupBy(*_cols(key)).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


# --------------------------------------------------------------------------- WIN (series)

def pct_change(df: DataFrame, by: Sequence[str], order: str, col: str, name: str | None = None) -> DataFrame:
    """WIN-5: ``(x - lag x) / lag x`` per group; NULL on the first row and on a zero base (T17).

    Apply to series already aggregated to period grain: the window then sees
    one row per (group, period)."""
    w = Window.partitionBy(*_cols(by)).orderBy(order)
    prev = F.lag(col).over(w)
    return df.withColumn(name or f"{col}_growth", F.try_divide(F.col(col) - prev, prev.cast("double")))


def index_base100(df: DataFrame, by: Sequence[str], order: str, col: str, name: str | None = None) -> DataFrame:
    """WIN-6: ``x / x[first period] * 100`` per group; NULL when the base is 0 or NULL."""
    by = _cols(by)
    base = df.groupBy(*by).agg(F.min_by(col, order).alias("__base"))
    return (df.join(base, on=by, how="left")
              .withColumn(name or f"{col}_index", safe_ratio(col, "__base") * F.lit(100.0))
              .drop("__base"))


def forward_fill(df: DataFrame, partition: Sequence[str], order: str, cols: Sequence[str],
                 block: int | None = None) -> DataFrame:
    """WIN-3: replace NULLs by the last non-NULL value before them (in ``order``) within ``partition``.

    With ``block=None`` this is one window per partition key.  With an
    integer ``block`` (``order`` must be integral) it is a two-level prefix
    scan that stays parallel even if one partition key holds a third of the
    rows: rows are cut into blocks of ``block`` consecutive order values,
    each block is filled on its own, the last value of every block is
    aggregated (one row per block), carried across blocks with a small
    window, and joined back.
    """
    partition = _cols(partition)
    if block is None:
        w = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select(*[F.last(c, ignorenulls=True).over(w).alias(c) if c in cols else F.col(c)
                           for c in df.columns])
    b = F.floor(F.col(order) / F.lit(block)).cast("long")
    blk = df.withColumn("__blk", b)
    # 1) fill inside each block (bounded window: at most `block` order values per task group)
    w_in = Window.partitionBy(*partition, "__blk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    inner = blk.select(*df.columns, "__blk",
                       *[F.last(c, ignorenulls=True).over(w_in).alias(f"__in_{c}") for c in cols])
    # 2) last non-null value of each block: partial aggregate, one row per block
    last_of_block = blk.groupBy(*partition, "__blk").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"__lb_{c}") for c in cols])
    # 3) carry block values forward over earlier blocks (rows = number of blocks)
    w_b = Window.partitionBy(*partition).orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = last_of_block.select(*partition, "__blk",
                                 *[F.last(f"__lb_{c}", ignorenulls=True).over(w_b).alias(f"__cf_{c}") for c in cols])
    joined = inner.join(carry, on=partition + ["__blk"], how="left")
    return joined.select(*[F.coalesce(F.col(f"__in_{c}"), F.col(f"__cf_{c}")).alias(c) if c in cols else F.col(c)
                           for c in df.columns])


def carry_down(df: DataFrame, partition: Sequence[str], order: str, is_header: Column, header_value: Column,
               name: str = "parent", drop_headers: bool = True, block: int | None = None) -> DataFrame:
    """WIN-4: header rows set the current parent; following rows inherit it; headers dropped.

    Rows before any header get NULL.  ``block`` as in :func:`forward_fill`.
    """
    marked = df.withColumn(name, F.when(is_header, header_value)).withColumn("__is_header", is_header)
    filled = forward_fill(marked, partition, order, [name], block=block)
    if drop_headers:
        filled = filled.where(~F.col("__is_header"))
    return filled.drop("__is_header")


def latest_values(df: DataFrame, by: Sequence[str], order: str, cols: Sequence[str]) -> DataFrame:
    """WIN-8 / TS-11: per group, the first and latest period, the values at both ends and the delta."""
    by = _cols(by)
    aggs = [F.min(order).alias(f"first_{order}"), F.max(order).alias(f"latest_{order}")]
    for c in cols:
        aggs += [F.min_by(c, order).alias(f"first_{c}"), F.max_by(c, order).alias(f"latest_{c}")]
    out = df.groupBy(*by).agg(*aggs)
    for c in cols:
        out = out.withColumn(f"delta_{c}", F.col(f"latest_{c}") - F.col(f"first_{c}"))
    return out


# --------------------------------------------------------------------------- SET / JN

def union_all(frames: Iterable[DataFrame], allow_missing: bool = False) -> DataFrame:
    """SET-1 / SET-2: concatenate by column name (``allow_missing`` fills absent columns with NULL)."""
    frames = list(frames)
    if not frames:
        raise ValueError("union_all needs at least one frame")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out


def left_enrich(base: DataFrame, *lookups: tuple[DataFrame, Sequence[str]]) -> DataFrame:
    """JN-4: chain of left joins, each (frame, keys).  Join strategy is left to AQE."""
    out = base
    for frame, keys in lookups:
        out = out.join(frame, on=_cols(keys), how="left")
    return out


def left_default(base: DataFrame, lookup: DataFrame, keys: Sequence[str], col: str, default) -> DataFrame:
    """JN-5: left join and replace a missing ``col`` by ``default`` (``COALESCE(ratio, 1)``)."""
    return base.join(lookup, on=_cols(keys), how="left").withColumn(col, F.coalesce(F.col(col), F.lit(default)))


def not_covered(df: DataFrame, coverage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JN-6 / JN-7: rows of ``df`` whose key is absent from ``coverage`` (``NOT EXISTS``)."""
    keys = _cols(keys)
    return df.join(coverage.select(*keys), on=keys, how="left_anti")


def split_even(df: DataFrame, order: Sequence[str], parts: int = 3, name: str = "part",
               num_ranges: int | None = None) -> DataFrame:
    """SNK-2: cut the rows, in ``order``, into ``parts`` contiguous pieces of ``n div parts``
    rows, the remainder going to the **last** piece.

    Global row numbers without a single-task window: range-partition by the order and number the
    rows inside each range; the numbered ranges are written once to the shared folder, so that the
    counts per range and the rows come from one and the same set of ranges (a second exchange
    would sample other boundaries); prefix-sum the counts and add the offset.  ``order`` must be a total
    order (include a unique key).
    """
    order = _cols(order)                               # names or sort expressions
    n_rng = num_ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n_rng, *order)
                .sortWithinPartitions(*order)
                .withColumn("__pid", F.spark_partition_id())
                .withColumn("__mid", F.monotonically_increasing_id()))
    # position inside the range partition: low 33 bits of monotonically_increasing_id
    ranged = ranged.withColumn("__pos", F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33))
    ranged = materialize(ranged.drop("__mid"), "split")
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    # one row per range (their number is a setting)
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(F.lit(1))
    offsets = counts.select("__pid",
                            F.coalesce(F.sum("__cnt").over(w), F.lit(0)).alias("__off"),
                            F.sum("__cnt").over(w_all).alias("__n"))
    out = ranged.join(offsets, on="__pid", how="inner")
    rn = F.col("__off") + F.col("__pos") + F.lit(1)
    size = F.floor(F.col("__n") / F.lit(parts))
    part = F.when(size == 0, F.lit(parts - 1)).otherwise(
        F.least(F.floor((rn - 1) / size), F.lit(parts - 1)))
    return out.withColumn(name, part.cast("int")).drop("__pid", "__pos", "__off", "__n")
