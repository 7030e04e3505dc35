"""DuckDB SQL oracles for the registered queries.

Each entry recomputes a query from the raw parquet views with plain SQL
(window functions and joins, no shared code with the Spark side), so the
driver can compare row counts, schemas and values. Rules are spelled out
again here on purpose: the oracle is an independent statement of the same
semantics.
"""

from __future__ import annotations

from lifeboat import config as C
from lifeboat.sources.bindings import BINDING_TITLES


def _case_map(expr: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN {expr} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"(CASE {whens} ELSE {default} END)"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_titles = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(BINDING_TITLES))

SUBJECTS = f"""subjects AS (
  SELECT o_orderkey AS id,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
    o_orderkey % 10 < 7 AS is_train,
    CAST(c_nationkey % 3 + 1 AS INTEGER) AS pclass,
    CASE WHEN o_orderkey % 17 = 16 THEN c_name
         ELSE concat(c_name, ', ', CASE CAST(o_orderkey % 17 AS INTEGER) {_titles} ELSE 'Mr' END, '. J')
    END AS name,
    CASE WHEN o_orderkey % 3 = 0 THEN 'female' ELSE 'male' END AS sex,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL
         ELSE CAST((o_orderkey * 7919 + o_custkey) % 800 AS DOUBLE) / 10 END AS age,
    CAST(o_orderkey % 4 AS INTEGER) AS sibsp,
    CAST(o_custkey % 3 AS INTEGER) AS parch,
    CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR)
         ELSE concat(substring(o_orderpriority, 1, 1), '/', c_mktsegment, '. ', CAST(o_custkey AS VARCHAR))
    END AS ticket,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_totalprice / 4000 END AS fare,
    CASE WHEN o_orderkey % 4 <> 0 THEN NULL ELSE c_mktsegment END AS cabin,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE substring(c_mktsegment, 1, 1) END AS embarked
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def W(*ctes: str) -> str:
    """WITH clause: the subjects binding followed by extra CTEs."""
    return "WITH " + ",\n".join((SUBJECTS,) + ctes) + "\n"


# --- rule fragments ----------------------------------------------------------------

def title_regex(name: str = "name") -> str:
    raw = f"nullif(regexp_extract({name}, ' ([A-Za-z]+)\\.', 1), '')"
    mapped = _case_map(raw, C.TITLE_REPLACEMENTS, raw)
    return f"(CASE WHEN {mapped} IN {_in(C.COMMON_TITLES)} THEN {mapped} ELSE 'Rare' END)"


def title1(name: str = "name") -> str:
    return f"(string_split(string_split({name}, ', ')[2], '.')[1])"


def title_rf(t1: str) -> str:
    return _case_map(t1, C.RF_TITLE_MAP, t1)


def title_xgb(t1: str) -> str:
    renamed = _case_map(t1, C.XGB_TITLE_MAP, t1)
    return f"(CASE WHEN {renamed} IN {_in(C.XGB_RARE_TITLES)} THEN 'Rare' ELSE {renamed} END)"


def ticket_token(t: str = "ticket") -> str:
    cleaned = f"regexp_replace(replace(replace({t}, '.', ''), '/', ''), '^\\s+|\\s+$', '', 'g')"
    return f"(CASE WHEN regexp_matches({t}, '^[0-9]+$') THEN 'X' ELSE string_split({cleaned}, ' ')[1] END)"


def deck(c: str, missing: str) -> str:
    return f"coalesce(substring({c}, 1, 1), '{missing}')"


def bin_fixed(x: str, edges, default) -> str:
    parts = [f"WHEN {x} IS NULL THEN NULL",
             f"WHEN {x} < {edges[0]} OR {x} > {_num(edges[-1])} THEN NULL",
             f"WHEN {x} <= {edges[1]} THEN 0"]
    for i in range(1, len(edges) - 1):
        parts.append(f"WHEN {x} <= {_num(edges[i + 1])} THEN {i}")
    body = f"(CASE {' '.join(parts)} END)"
    return f"CAST(coalesce({body}, {default}) AS INTEGER)" if default is not None else body


def _num(v) -> str:
    return "'inf'::DOUBLE" if v == float("inf") else repr(float(v))


def codes(col: str, src: str) -> str:
    """Category code over ``src`` rows: dense rank of non-null values from 0, null -> -1."""
    return f"(CASE WHEN {col} IS NULL THEN -1 ELSE CAST(dense_rank() OVER (ORDER BY {col}) - 1 AS INTEGER) END)"


U = ("(CAST(CAST(('0x' || substr(md5(concat_ws(':', id, '{seed}')), 1, 13)) AS BIGINT) AS DOUBLE)"
     " / 4503599627370496.0)")


def split_cte(seed: int = 45, ratio: float = 0.2, src: str = "subjects WHERE is_train") -> str:
    return (f"sp AS (SELECT *, CAST(rn <= ceil(n * {ratio}) AS INTEGER) AS is_val FROM ("
            f"SELECT *, row_number() OVER (PARTITION BY label ORDER BY u, id) AS rn, "
            f"count(*) OVER (PARTITION BY label) AS n FROM (SELECT *, {U.format(seed=seed)} AS u FROM {src})))")
