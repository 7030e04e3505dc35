"""Imputation and group statistics (modes, means, medians, counts, outlier trim).

Global statistics are fitted as driver-side scalars from one-row aggregates
(the "fit" step) and applied as literals, so the transform stays a narrow,
codegen'd projection. Per-group statistics are aggregated (map-side partial
aggregation first, so a hot key costs one combined row per task) and joined
back by key. Every operator fits on its input, or on the ``fit`` table if one is
given (labelled rows only, see ``features.build_features(fit_scope=...)``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifeboat.operators import quantile
from lifeboat.operators.layout import stage
from lifeboat.operators.lookup import attach
from lifeboat.operators.ranks import rank_in_groups


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- A1 / A2: modes ---------------------------------------------------------

def _mode_pick(value: str) -> Column:
    # Most frequent first, ties -> smallest value (pandas ``mode()[0]``).
    return F.min(F.struct((-F.col("_n")).alias("neg_n"), F.col(value).alias("v")))["v"]


def mode_value(df: DataFrame, column: str, default=None):
    """Most frequent non-null value; ties -> smallest; no values -> ``default``."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    row = counts.agg(_mode_pick(column).alias("m")).first()
    return default if row is None or row["m"] is None else row["m"]


def mode_by_group(df: DataFrame, column: str, keys) -> DataFrame:
    """(keys..., ``<column>_mode``): per-group mode, ties -> smallest value."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    counts = (df.where(F.col(column).isNotNull())
              .groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n")))
    return counts.groupBy(*keys).agg(_mode_pick(column).alias(f"{column}_mode"))


def fill_mode(df: DataFrame, column: str, default=None, fit: DataFrame | None = None) -> DataFrame:
    m = mode_value(df if fit is None else fit, column, default)
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(m)))


def fill_mode_by_group(df: DataFrame, column: str, keys, default=None, fit: DataFrame | None = None) -> DataFrame:
    """Fill from the row's group mode, then from the global mode of the filled column."""
    stats = mode_by_group(df if fit is None else fit, column, keys)

    def by_group(d: DataFrame) -> DataFrame:
        return attach(d, stats, keys).withColumn(column, F.coalesce(F.col(column), F.col(f"{column}_mode"))).drop(f"{column}_mode")

    return fill_mode(by_group(df), column, default, None if fit is None else by_group(fit))


# --- A3: global mean / median ----------------------------------------------

def mean_value(df: DataFrame, column: str):
    return df.agg(F.avg(F.col(column)).alias("m")).first()["m"]


def fill_mean(df: DataFrame, column: str, fit: DataFrame | None = None) -> DataFrame:
    m = mean_value(df if fit is None else fit, column)
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(m).cast("double")))


def fill_median(df: DataFrame, column: str, fit: DataFrame | None = None) -> DataFrame:
    m = quantile.median(df if fit is None else fit, column)
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(m).cast("double")))


# --- A4: grouped median ------------------------------------------------------

HOT_GROUP_DISTINCT = 1_000_000


def median_by_group(df: DataFrame, column: str, keys, approx: bool = False,
                    hot_distinct: int = HOT_GROUP_DISTINCT) -> DataFrame:
    """(keys..., ``<column>_median``): exact per-group median (pandas rule).

    Rows are first reduced to (keys, value, count) with map-side partial
    aggregation, so a hot group costs one row per distinct value, not per row.
    Groups with at most ``hot_distinct`` distinct values take the exact
    weighted ``percentile`` of those rows (its buffer is bounded by that
    number). All groups above it are ranked together over range partitions
    (``ranks.rank_in_groups``), so no task holds a hot group, however many
    there are. ``approx=True`` uses a fixed-size sketch.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    name = f"{column}_median"
    clean = df.where(F.col(column).isNotNull() & ~F.isnan(column))
    if approx:
        return clean.groupBy(*keys).agg(F.percentile_approx(column, 0.5, 10_000).cast("double").alias(name))
    counts = stage(clean.groupBy(*keys, F.col(column).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n")), "value-counts")
    sizes = counts.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.count(F.lit(1)).alias("_d"), F.sum("_n").alias("_rows"))
    hot = stage(sizes.where(F.col("_d") > hot_distinct).drop("_d"), "hot-groups")
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    out = counts.join(hot, match, "left_anti").groupBy(*keys).agg(
        F.percentile(F.col("_v"), F.lit(0.5), F.col("_n")).cast("double").alias(name))
    if hot.isEmpty():
        return out
    ranked = rank_in_groups(counts.join(hot, match).drop(*[f"_k{i}" for i in range(len(keys))]), keys, ["_v"], weight="_n", name="_before")

    def holds(rank: Column) -> Column:
        return (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_n"))

    low, high = F.floor((F.col("_rows") - 1) / 2), F.floor(F.col("_rows") / 2)
    exact = ranked.where(holds(low) | holds(high)).groupBy(*keys).agg(
        ((F.min("_v") + F.max("_v")) / 2).alias(name))
    return out.unionByName(exact)


def fill_median_by_group(df: DataFrame, column: str, keys, approx: bool = False, fit: DataFrame | None = None) -> DataFrame:
    """Fill from the (keys) group median, then from the global median of the result."""
    stats = median_by_group(df if fit is None else fit, column, keys, approx)

    def by_group(d: DataFrame) -> DataFrame:
        return attach(d, stats, keys).withColumn(column, F.coalesce(F.col(column), F.col(f"{column}_median"))).drop(f"{column}_median")

    filled = by_group(df)
    return fill_median(filled, column, None if fit is None else by_group(fit))


# --- A5 / A6: group sizes and frequency encoding -----------------------------

def value_counts(df: DataFrame, column: str, name: str) -> DataFrame:
    """(column, name): rows per non-null value."""
    return (df.where(F.col(column).isNotNull())
            .groupBy(column).agg(F.count(F.lit(1)).alias(name)))


def group_size(df: DataFrame, column: str, name: str, low=None, high=None, fit: DataFrame | None = None) -> DataFrame:
    """Add ``name`` = rows sharing this row's value (null value -> null), clipped."""
    out = attach(df, value_counts(df if fit is None else fit, column, name), column)
    c = F.col(name)
    if low is not None:
        c = F.greatest(c, F.lit(low))
    if high is not None:
        c = F.least(c, F.lit(high))
    # greatest/least skip nulls; a null key keeps a null size
    return out.withColumn(name, F.when(F.col(name).isNotNull(), c))


def frequency_encode(df: DataFrame, column: str, name: str, fit: DataFrame | None = None) -> DataFrame:
    """Add ``name`` = count of this row's value as double (null or unseen value -> 0.0)."""
    out = attach(df, value_counts(df if fit is None else fit, column, name), column)
    return out.withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("double"))


# --- A7: outlier trim --------------------------------------------------------

def outlier_bounds(df: DataFrame, columns, sigmas: float) -> dict:
    """Per column (mean, sample std) in one aggregate."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"{c}__m"), F.stddev_samp(c).alias(f"{c}__s")]
    row = df.agg(*aggs).first()
    return {c: (row[f"{c}__m"], row[f"{c}__s"]) for c in columns}


def outlier_mask(bounds: dict, sigmas: float) -> Column:
    """True where any column lies more than ``sigmas`` std from its mean.

    Comparisons against a null mean/std (too few rows) are false, as in pandas.
    """
    cond = F.lit(False)
    for c, (m, s) in bounds.items():
        if m is None or s is None:
            continue
        far = F.abs(F.col(c) - F.lit(m)) > F.lit(sigmas) * F.lit(s)
        cond = cond | F.coalesce(far, F.lit(False))
    return cond


def trim_outliers(df: DataFrame, columns, sigmas: float) -> DataFrame:
    bounds = outlier_bounds(df, columns, sigmas)
    return df.where(~outlier_mask(bounds, sigmas))
