"""Numeric row-level features and fixed-edge binning as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def family_size(sibsp: Column | str = "sibsp", parch: Column | str = "parch",
                include_self: bool = True) -> Column:
    """Relatives aboard, plus one for the passenger when ``include_self``."""
    total = _col(sibsp) + _col(parch)
    return total + F.lit(1) if include_self else total


def flag(condition: Column) -> Column:
    """Boolean -> 0/1 int, where a null condition counts as false (pandas NaN rule)."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def is_female(sex: Column | str = "sex") -> Column:
    return flag(_col(sex) == F.lit("female"))


def has_value(c: Column | str) -> Column:
    return _col(c).isNotNull().cast("int")


def is_alone(fam: Column | str = "family_size") -> Column:
    return flag(_col(fam) == F.lit(1))


def clip(c: Column | str, low: float, high: float) -> Column:
    """``Series.clip(low, high)``; null stays null (``greatest``/``least`` alone skip nulls)."""
    c = _col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def product(a: Column | str, b: Column | str) -> Column:
    """Interaction term a*b."""
    return _col(a) * _col(b)


def bin_right_closed(x: Column | str, edges: tuple | list, default: int | None = None) -> Column:
    """Index of the right-closed interval (e[i], e[i+1]] holding x; e[0] itself -> 0.

    Values outside [e[0], e[-1]] and nulls give ``default`` (null when None).
    This is ``pd.cut(..., right=True, include_lowest=True, labels=False)``;
    Spark's Bucketizer is left-closed and would move every edge value.
    """
    x = _col(x)
    expr = F.when(x.isNull(), F.lit(None))
    expr = expr.when((x < F.lit(edges[0])) | (x > F.lit(edges[-1])), F.lit(None))
    expr = expr.when(x <= F.lit(edges[1]), F.lit(0))
    for i in range(1, len(edges) - 1):
        expr = expr.when(x <= F.lit(edges[i + 1]), F.lit(i))
    out = expr.cast("int")
    return F.coalesce(out, F.lit(default)) if default is not None else out


def bin_by_inner_edges(x: Column | str, inner_edges: list) -> Column:
    """Bin index = number of inner edges strictly below x (edges ascending).

    With the lowest edge at the column minimum this equals the right-closed,
    lowest-included rule for values inside the range. A null x stays null.
    """
    x = _col(x)
    idx = F.lit(0)
    for e in inner_edges:
        idx = idx + (x > F.lit(float(e))).cast("int")
    return F.when(x.isNull(), F.lit(None)).otherwise(idx).cast("int")
