"""Series analytics (TS-*): priority merge, chain-linking, splicing, residual groups,
growth/index tables, per-group correlation and linear fit, gaps, bucket shares.

Every operator here works on a series already aggregated to (group, period)
grain, and partitions all windows by group; the few per-group scalars
(ratio, base value, correlation, fit) are partial aggregates joined back.
No operator needs the whole series in one task or on the driver.
"""
from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import safe_ratio
from .relational import _cols, pct_change, union_all


def _attach(df: DataFrame, agg: DataFrame, by: Sequence[str], how: str = "left") -> DataFrame:
    """Join a per-group aggregate back on ``by``; with no groups the one-row aggregate is
    attached as scalar subqueries (no cross join)."""
    if by:
        return df.join(agg, on=list(by), how=how)
    out = df
    for c in agg.columns:
        out = out.withColumn(c, agg.select(c).scalar())
    if how == "inner":
        out = out.where(F.col(agg.columns[0]).isNotNull())
    return out


# --------------------------------------------------------------------------- TS-1

def priority_merge(sources: Sequence[tuple[DataFrame, DataFrame | None]], keys: Sequence[str],
                   priority_col: str | None = None) -> DataFrame:
    """TS-1: ``[(rows, coverage), ...]`` in priority order -> one series.

    A row of source *i* is kept only when its key is absent from the
    coverage of every higher source *j < i*.  ``coverage=None`` means "the
    source's own rows" (the ``complete`` mode, N4); pass the raw source keys
    to reproduce the ``raw`` mode where a higher source hides keys even when
    it produced no row for them.

    Plan: the coverage keys of all sources are unioned with their priority and
    reduced to ``min(priority)`` per key (partial aggregation: one shuffle,
    skew-safe), then joined to the union of all rows (second shuffle, or a
    broadcast when small).  Cost does not grow with the number of sources.
    """
    keys = _cols(keys)
    rows, cov = [], []
    for i, (df, coverage) in enumerate(sources):
        rows.append(df.withColumn("__prio", F.lit(i)))
        c = df if coverage is None else coverage
        cov.append(c.select(*keys).withColumn("__prio", F.lit(i)))
    first_cover = union_all(cov).groupBy(*keys).agg(F.min("__prio").alias("__cover"))
    merged = union_all(rows).join(first_cover, on=keys, how="left")
    out = merged.where(F.col("__cover").isNull() | (F.col("__prio") <= F.col("__cover")))
    if priority_col:
        out = out.withColumnRenamed("__prio", priority_col)
    else:
        out = out.drop("__prio")
    return out.drop("__cover")


# --------------------------------------------------------------------------- TS-2 / TS-3

def chain_ratio(old: DataFrame, new: DataFrame, on: Sequence[str], by: Sequence[str],
                old_col: str, new_col: str, name: str = "ratio") -> DataFrame:
    """TS-2: mean over the overlap of ``old / new`` per ``by`` (``by=[]`` for one overall ratio).

    The overlap is an inner join on ``on`` (group + period)."""
    on, by = _cols(on), _cols(by)
    o = old.select(*on, F.col(old_col).alias("__old"))
    n = new.select(*on, F.col(new_col).alias("__new"))
    j = o.join(n, on=on, how="inner")
    r = F.avg(safe_ratio("__old", "__new")).alias(name)
    return j.groupBy(*by).agg(r) if by else j.agg(r)


def splice(old: DataFrame, new: DataFrame, ratio: DataFrame, on: Sequence[str], by: Sequence[str],
           value_col: str, ratio_col: str = "ratio", default_ratio: float = 1.0,
           covered: Iterable[DataFrame] = (), period: str | None = None, only_after: bool = False,
           after_by: Sequence[str] | None = None) -> DataFrame:
    """TS-3: scale ``new`` by the chain ratio of its group (``default_ratio`` when the
    group had no overlap) and append it to ``old`` where it is not covered.

    * ``by``: grouping of the ratio (``[]``: one overall ratio);
    * ``covered``: frames whose keys (``on``) the scaled rows must avoid
      (``old`` itself is always one of them);
    * ``only_after``: with ``period``, keep only new periods later than the
      last old period of the ``after_by`` group (default ``by``).
    Returns ``on + [value_col]`` with a ``source`` column (``old``/``new``).
    """
    on, by = _cols(on), _cols(by)
    scaled = _attach(new, ratio.select(*by, ratio_col), by)
    scaled = scaled.withColumn(value_col, F.col(value_col) * F.coalesce(F.col(ratio_col), F.lit(default_ratio)))
    for cov in [old, *covered]:
        scaled = scaled.join(cov.select(*on).distinct(), on=on, how="left_anti")
    if only_after and period:
        grp = _cols(after_by) if after_by is not None else by
        last = (old.groupBy(*grp) if grp else old).agg(F.max(period).alias("__last"))
        scaled = _attach(scaled, last, grp)
        scaled = scaled.where(F.col("__last").isNull() | (F.col(period) > F.col("__last"))).drop("__last")
    a = old.select(*on, value_col).withColumn("source", F.lit("old"))
    b = scaled.select(*on, value_col).withColumn("source", F.lit("new"))
    return a.unionByName(b)


# --------------------------------------------------------------------------- TS-4

def residual(df: DataFrame, by: Sequence[str], category: str, measures: Sequence[str],
             total_label: str, part_labels: Sequence[str], part_name: str, rest_name: str) -> DataFrame:
    """TS-4: per ``by``, the part (sum of ``part_labels``) and the rest (total - part),
    as two rows labelled ``part_name`` and ``rest_name``.  Groups without a
    part row or without a total row produce no rest (inner-join semantics of
    the reference's self-join).  One conditional aggregation, one shuffle."""
    by = _cols(by)
    cat = F.col(category)
    aggs = []
    for m in measures:
        aggs.append(F.sum(F.when(cat.isin(list(part_labels)), F.col(m))).alias(f"__p_{m}"))
        aggs.append(F.sum(F.when(cat == total_label, F.col(m))).alias(f"__t_{m}"))
    aggs.append(F.count_if(cat.isin(list(part_labels))).alias("__np"))
    aggs.append(F.count_if(cat == total_label).alias("__nt"))
    a = df.groupBy(*by).agg(*aggs)
    # both output rows of a group come from the same aggregate row (one pass, no branch)
    has_part, has_total = F.col("__np") > 0, F.col("__nt") > 0
    rows = F.array(
        F.struct(has_part.alias("__keep"), F.lit(part_name).alias(category),
                 *[F.col(f"__p_{m}").alias(m) for m in measures]),
        F.struct((has_part & has_total).alias("__keep"), F.lit(rest_name).alias(category),
                 *[(F.col(f"__t_{m}") - F.col(f"__p_{m}")).alias(m) for m in measures]))
    return a.select(*by, F.inline(rows)).where(F.col("__keep")).drop("__keep")


# --------------------------------------------------------------------------- TS-5..7

def break_cut(df: DataFrame, by: Sequence[str], order: str, col: str, threshold: float = 0.5) -> DataFrame:
    """TS-5: keep the periods before the first period whose growth exceeds ``threshold``."""
    by = _cols(by)
    g = pct_change(df, by, order, col, "__g")
    brk = g.where(F.col("__g") > threshold)
    first_break = (brk.groupBy(*by) if by else brk).agg(F.min(order).alias("__brk"))
    j = _attach(g, first_break, by)
    return j.where(F.col("__brk").isNull() | (F.col(order) < F.col("__brk"))).drop("__g", "__brk")


def with_min_points(df: DataFrame, by: Sequence[str], min_points: int = 3, name: str = "__n") -> DataFrame:
    """Groups with at least ``min_points`` rows (count per group joined back)."""
    by = _cols(by)
    n = df.groupBy(*by).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) >= min_points)
    return df.join(n, on=by, how="left_semi")


def growth_pair(df: DataFrame, by: Sequence[str], order: str, a: str, b: str, min_points: int = 3) -> DataFrame:
    """TS-6: period-over-period change (in %) of two measures per group; groups with
    fewer than ``min_points`` complete rows are skipped, rows where either change is NULL dropped."""
    by = _cols(by)
    d = with_min_points(df.dropna(subset=[a, b]), by, min_points)
    d = pct_change(d, by, order, a, f"{a}_chg")
    d = pct_change(d, by, order, b, f"{b}_chg")
    d = d.withColumn(f"{a}_chg", F.col(f"{a}_chg") * 100.0).withColumn(f"{b}_chg", F.col(f"{b}_chg") * 100.0)
    return d.dropna(subset=[f"{a}_chg", f"{b}_chg"])


def index_pair(df: DataFrame, by: Sequence[str], order: str, a: str, b: str, min_points: int = 3) -> DataFrame:
    """TS-7: both measures indexed to 100 at the group's first period."""
    by = _cols(by)
    d = with_min_points(df.dropna(subset=[a, b]), by, min_points)
    base = (d.groupBy(*by) if by else d).agg(F.min_by(a, order).alias("__ba"), F.min_by(b, order).alias("__bb"))
    d = _attach(d, base, by)
    return (d.withColumn(f"{a}_index", safe_ratio(a, "__ba") * 100.0)
             .withColumn(f"{b}_index", safe_ratio(b, "__bb") * 100.0).drop("__ba", "__bb"))


# --------------------------------------------------------------------------- TS-8 / TS-9

def corr_by_group(df: DataFrame, by: Sequence[str], x: str, y: str, min_points: int = 3) -> DataFrame:
    """TS-8: Pearson r per group over rows where both are present, NULL for groups
    with fewer than ``min_points`` points or a constant series (T3)."""
    by = _cols(by)
    d = df.dropna(subset=[x, y])
    a = d.groupBy(*by).agg(F.count(F.lit(1)).alias("n_points"),
                           F.stddev_pop(x).alias("__sx"), F.stddev_pop(y).alias("__sy"),
                           F.covar_pop(x, y).alias("__cxy"))
    r = F.when((F.col("n_points") >= min_points) & (F.col("__sx") > 0) & (F.col("__sy") > 0),
               F.try_divide(F.col("__cxy"), F.col("__sx") * F.col("__sy")))
    return a.select(*by, "n_points", r.alias("r"))


def mean_corr(corr: DataFrame, col: str = "r") -> DataFrame:
    """TS-8: average r over groups that have one; 0 when none does."""
    return corr.agg(F.coalesce(F.avg(col), F.lit(0.0)).alias("mean_r"),
                    F.count(col).alias("n_groups"))


def fit_by_group(df: DataFrame, by: Sequence[str], x: str, y: str, min_points: int = 3,
                 fitted: str = "fitted") -> DataFrame:
    """TS-9: least-squares line y = slope * x + intercept per group, joined back with the
    fitted value of every row.  NULL slope when x is constant (T4)."""
    by = _cols(by)
    d = df.dropna(subset=[x, y])
    fit = (d.groupBy(*by) if by else d).agg(
        F.count(F.lit(1)).alias("__n"), F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept")).where(F.col("__n") >= min_points).drop("__n")
    out = _attach(d, fit, by, how="inner")
    return out.withColumn(fitted, F.col("slope") * F.col(x) + F.col("intercept"))


# --------------------------------------------------------------------------- TS-10..13

def category_gap(df: DataFrame, by: Sequence[str], category: str, value: str, a_label: str, b_label: str,
                 name: str = "gap") -> DataFrame:
    """TS-10: per ``by``, value of ``a_label`` minus value of ``b_label`` (NULL if either is missing)."""
    by = _cols(by)
    cat = F.col(category)
    g = df.groupBy(*by).agg(F.max(F.when(cat == a_label, F.col(value))).alias(a_label),
                            F.max(F.when(cat == b_label, F.col(value))).alias(b_label))
    return g.withColumn(name, F.col(a_label) - F.col(b_label))


def bucket_share(df: DataFrame, period: str, bucket_col: Column, value: str, name: str = "bucket") -> DataFrame:
    """TS-12: (period, bucket, sum, share of the period total in %)."""
    s = df.groupBy(period, bucket_col.alias(name)).agg(F.sum(value).alias("total"))
    t = s.groupBy(period).agg(F.sum("total").alias("__pt"))
    return (s.join(t, on=period, how="left").withColumn("share_pct", safe_ratio("total", "__pt") * 100.0)
             .drop("__pt"))


def ratio_of_sums(df: DataFrame, by: Sequence[str], num: str, den: str) -> DataFrame:
    """TS-13: sum(num) / sum(den) * 100 per group (not the mean of per-row ratios)."""
    by = _cols(by)
    return df.groupBy(*by).agg(F.sum(num).alias(num), F.sum(den).alias(den)).withColumn(
        "pct", safe_ratio(num, den) * 100.0)


def with_fallback(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """TS-14: ``primary`` when it has at least one row, else ``fallback``.

    Decided inside the plan with an uncorrelated ``NOT EXISTS`` subquery on
    the primary, so no action runs on the driver while the plan is built."""
    return primary.unionByName(fallback.where(~primary.exists()))
