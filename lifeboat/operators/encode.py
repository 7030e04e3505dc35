"""Encoders: ordinal category codes, one-hot (first dropped), standard scaling."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifeboat.operators.lookup import attach, literal_map
from lifeboat.operators.ranks import rank_in_groups

#: A column with at most so many values gets its codes from a map in the projection (a map
#: lookup walks its keys), any other by a join; both give the same codes.
MAP_VALUES = 100
_FLOATS = ("float", "double")


def _present(df: DataFrame, column: str) -> Column:
    """Has a value: not null and, as pandas counts it, not NaN."""
    c = F.col(column)
    return c.isNotNull() & ~F.isnan(c) if dict(df.dtypes)[column] in _FLOATS else c.isNotNull()


def _distinct(df: DataFrame, column: str) -> DataFrame:
    return df.where(_present(df, column)).select(column).distinct()


def dense_index(values: DataFrame, column: str, name: str) -> DataFrame:
    """0-based position of each (distinct) value in ascending order, fully distributed."""
    return rank_in_groups(values, [], [column], name=name).withColumn(name, F.col(name).cast("int"))


def _typed(kind: str, texts: list[str]) -> list:
    """Values of a column type from their text, in the type's order."""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return sorted(int(t) for t in texts)
    if kind in _FLOATS:
        return sorted(float(t) for t in texts)
    if kind.startswith("decimal"):
        return sorted(Decimal(t) for t in texts)
    return sorted(texts)        # strings; booleans, dates and timestamps in their ISO form


def _literal(kind: str, value) -> Column:
    """A value as a literal of the column's own type."""
    return F.lit(str(value)).cast(kind)


def _codes_by_map(df: DataFrame, column: str, kind: str, values: list, name: str) -> DataFrame:
    if not values:
        return df.withColumn(name, F.lit(-1))
    pairs = [x for i, v in enumerate(values) for x in (_literal(kind, v), F.lit(i))]
    code = F.try_element_at(F.create_map(*pairs), F.col(column))
    return df.withColumn(name, F.coalesce(code, F.lit(-1)).cast("int"))


def _codes_by_join(df: DataFrame, fit: DataFrame, column: str, name: str) -> DataFrame:
    out = attach(df, dense_index(_distinct(fit, column), column, "_code"), column)
    return out.withColumn(name, F.coalesce(F.col("_code"), F.lit(-1)).cast("int")).drop("_code")


def category_codes(df: DataFrame, column: str, name: str | None = None, map_values: int = MAP_VALUES,
                   fit: DataFrame | None = None) -> DataFrame:
    """Sorted distinct values -> 0..n-1, null (and NaN) -> -1 (``astype('category').cat.codes``).

    ``fit`` is the table whose values are numbered (default ``df``); other values get -1.
    """
    name = name or column
    same = fit is None
    fit = (df if same else fit).withColumn(name, F.col(column))
    return category_codes_many(fit if same else df.withColumn(name, F.col(column)), [name], map_values, fit)


def category_codes_many(df: DataFrame, columns, map_values: int = MAP_VALUES, fit: DataFrame | None = None) -> DataFrame:
    """B4 for several columns (codes replace the values): one job counts their
    values, a second lists those of the small ones."""
    columns, fit, kinds = list(columns), df if fit is None else fit, dict(df.dtypes)
    pairs = _pairs(fit, columns).distinct().persist()
    counts = {r["k"]: r["n"] for r in pairs.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    small = [i for i in range(len(columns)) if counts.get(i, 0) <= map_values]
    texts = {i: [] for i in small}
    for k, v in pairs.where(F.col("k").isin(small)).collect():
        texts[k].append(v)
    pairs.unpersist()
    for i, c in enumerate(columns):
        if i in texts:
            df = _codes_by_map(df, c, kinds[c], _typed(kinds[c], texts[i]), c)
        else:
            df = _codes_by_join(df, fit, c, c)
    return df


def _pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column number, value as text) of every non-null value."""
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.when(_present(df, c), F.col(c).cast("string")).alias("v"))
                               for i, c in enumerate(columns)]))
    return df.select(each.alias("p")).select("p.k", "p.v").where(F.col("v").isNotNull())


def categories_many(df: DataFrame, columns) -> dict:
    """Sorted distinct non-null values of several columns in one job, in their columns' types and orders.

    For one-hot encoding: every value becomes a column, so they are listed on the driver.
    """
    columns, kinds = list(columns), dict(df.dtypes)
    out = {c: [] for c in columns}
    for k, v in _pairs(df, columns).distinct().collect():
        out[columns[k]].append(v)
    return {c: _typed(kinds[c], texts) for c, texts in out.items()}


def categories(df: DataFrame, column: str) -> list:
    return categories_many(df, [column])[column]


def one_hot_drop_first(df: DataFrame, column: str, prefix: str | None = None, drop_source: bool = True,
                       cats: list | None = None) -> tuple[DataFrame, list]:
    """One 0/1 column per category except the first; null -> all zeros.

    ``cats`` (sorted categories, e.g. from ``categories_many``) skips the scan.
    """
    prefix, kind = prefix or column, dict(df.dtypes)[column]
    values = (cats if cats is not None else categories(df, column))[1:]
    names = [f"{prefix}_{v}" for v in values]
    out = df.select("*", *[F.coalesce(F.col(column) == _literal(kind, v), F.lit(False)).cast("int").alias(n)
                           for v, n in zip(values, names)])
    if drop_source:
        out = out.drop(column)
    return out, names


def fit_scaler(df: DataFrame, columns) -> dict:
    """B6 fit: per column (mean, population std) from one aggregate over ``df``."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"{c}__m"), F.stddev_pop(c).alias(f"{c}__s")]
    row = df.agg(*aggs).first()
    return {c: (row[f"{c}__m"], row[f"{c}__s"]) for c in columns}


def apply_scaler(df: DataFrame, params: dict) -> DataFrame:
    """B6 transform: (x - mean) / std; a zero std divides by 1 (scikit-learn rule)."""
    def scaled(c):
        m, s = params[c]
        m = 0.0 if m is None else float(m)
        s = 1.0 if (s is None or s == 0.0) else float(s)
        return ((F.col(c) - F.lit(m)) / F.lit(s)).alias(c)
    return df.select(*[scaled(c) if c in params else F.col(c) for c in df.columns])
