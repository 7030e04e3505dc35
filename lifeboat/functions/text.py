"""String-derived features as native Column expressions (no Python UDFs).

Each function takes Columns (or column names) and returns a Column, so every
rule stays inside whole-stage codegen and composes in ``select``/``withColumn``.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from lifeboat.config import (
    COMMON_TITLES,
    RF_TITLE_MAP,
    TITLE_PATTERN,
    TITLE_REPLACEMENTS,
    XGB_RARE_TITLES,
    XGB_TITLE_MAP,
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_values(c: Column | str, mapping: dict, keep_unmapped: bool = True) -> Column:
    """``Series.replace(dict)``: mapped values are replaced, others kept (or nulled)."""
    c = _col(c)
    if not mapping:
        return c
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    hit = F.try_element_at(lookup, c)
    return F.coalesce(hit, c) if keep_unmapped else hit


def title_regex(name: Column | str, replacements: dict = TITLE_REPLACEMENTS,
                common: tuple = COMMON_TITLES, pattern: str = TITLE_PATTERN) -> Column:
    """First ``' <letters>.'`` token of a name, synonyms folded, rare ones -> 'Rare'.

    No match and null names both end as 'Rare'.
    """
    raw = F.nullif(F.regexp_extract(_col(name), pattern, 1), F.lit(""))
    mapped = map_values(raw, replacements)
    return F.when(mapped.isin(*common), mapped).otherwise(F.lit("Rare"))


def title_split(name: Column | str) -> Column:
    """Text between the first ', ' and the next '.'; null when there is no ', '."""
    after_comma = F.get(F.split(_col(name), ", "), 1)
    return F.get(F.split(after_comma, r"\."), 0)


def title_rf(title1: Column | str, mapping: dict = RF_TITLE_MAP) -> Column:
    """RF set: a fixed rename table, unknown titles kept as they are."""
    return map_values(title1, mapping)


def title_xgb(title1: Column | str, mapping: dict = XGB_TITLE_MAP,
              rare: tuple = XGB_RARE_TITLES) -> Column:
    """XGB set: three renames, then the rare list folded into 'Rare'."""
    renamed = map_values(title1, mapping)
    return F.when(renamed.isin(*rare), F.lit("Rare")).otherwise(renamed)


def ticket_token(ticket: Column | str) -> Column:
    """All-digit ticket -> 'X'; otherwise drop '.' and '/', trim, first ' ' token.

    Case is kept. A null ticket gives a null token.
    """
    t = _col(ticket)
    cleaned = F.regexp_replace(F.translate(t, "./", ""), r"^\s+|\s+$", "")
    first = F.get(F.split(cleaned, " "), 0)
    return F.when(t.rlike("^[0-9]+$"), F.lit("X")).otherwise(first)


def deck_letter(cabin: Column | str, missing: str) -> Column:
    """First character of the cabin, or ``missing`` for a null cabin."""
    return F.coalesce(F.substring(_col(cabin), 1, 1), F.lit(missing))
