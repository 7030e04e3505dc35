"""Secret scan with corpus-wide ownership frequency (DataFrame functions only).

Candidates are found with regular expressions in every whole text, each with
its place in code points. Every candidate value is hashed, and the corpus is
asked in how many distinct repositories and owners that hash occurs: a value
that several owners hold is a copied example, one that stays with a single
owner looks live.

Spark's regex functions give matches without places, so a text is split by
the same pattern: the lengths of the pieces and of the matches, summed in
order, are the places. The sums are a window per row and kind, over the few
rows that have a match at all; texts themselves are never shuffled.

Defined results: null text counts as empty; a null owner or repository is one
more owner or repository; repeated rows are scanned one by one; an empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lifeboat.llm.common import stage, text_or_empty

# The base kinds, in the order that ties in the start place follow.
ASSIGN = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
          r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
# A run of fewer characters fails, and nothing inside such a run can succeed.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
# Kinds that the method adds to the base ones.
PRIVATE_KEY = r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
BEARER = r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"
HOST_TOKEN = r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{20,}"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    group: int = 0          # the group that holds the secret value
    least: int = 1          # characters that group must have


BASE = (Kind("assign", ASSIGN, 2, 8), Kind("access", ACCESS), Kind("hex", HEX))
ADDED = (Kind("private_key", PRIVATE_KEY), Kind("bearer", BEARER), Kind("host_token", HOST_TOKEN))
#: From so many distinct owners on, a value counts as a copied example.
COPIED_OWNERS = 3


def candidates(docs: DataFrame, kinds: tuple[Kind, ...], text_col: str = "text", id_col: str = "doc_id",
               repository: Column | None = None, owner: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """All rows (row_id, id), and the candidates with their spans, both from one staged scan."""
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).alias("id"),
                       (F.lit(None) if repository is None else repository).cast("string").alias("repository"),
                       (F.lit(None) if owner is None else owner).cast("string").alias("owner"),
                       text_or_empty(text_col).alias("text"))
    for k in kinds:
        rows = rows.withColumn(f"gaps_{k.name}", F.transform(F.split("text", k.pattern, -1), F.length))
    for k in kinds:
        found = F.arrays_zip(F.slice(f"gaps_{k.name}", 1, F.size(f"gaps_{k.name}") - 1).alias("gap"),
                             F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0)).alias("whole"),
                             F.regexp_extract_all("text", F.lit(k.pattern), F.lit(k.group)).alias("value"))
        rows = rows.withColumn(f"found_{k.name}", F.when(F.size(f"gaps_{k.name}") > 1, found))
    found = stage(rows.drop("text", *(f"gaps_{k.name}" for k in kinds)), "candidates")
    each = reduce(DataFrame.unionByName, [
        found.select("row_id", "id", "repository", "owner", F.lit(i).alias("kind_no"), F.lit(k.name).alias("kind"),
                     F.posexplode(f"found_{k.name}").alias("no", "m"))
        for i, k in enumerate(kinds)])
    order = Window.partitionBy("row_id", "kind_no").orderBy("no")
    end = F.sum(F.col("m.gap") + F.length("m.whole")).over(order)
    least = reduce(lambda c, ik: c.when(F.col("kind_no") == ik[0], ik[1].least), enumerate(kinds), F.when(F.lit(False), 0))
    spans = (each.withColumn("end", end).withColumn("start", F.col("end") - F.length("m.whole"))
             .filter(F.length("m.value") >= least)
             .select("row_id", "id", "repository", "owner", "kind_no", "kind", "start", "end", F.col("m.value").alias("value")))
    return found.select("row_id", "id"), spans


def ownership(spans: DataFrame) -> DataFrame:
    """(value_hash, n_repositories, n_owners) of every candidate value in the corpus.

    Distinct (value, repository, owner) triples first, map-side combined, so a
    value that a third of the corpus holds is a handful of rows when counted.
    """
    key = spans.select(F.sha2("value", 256).alias("value_hash"), F.coalesce("repository", F.lit("")).alias("repository"),
                       F.coalesce("owner", F.lit("")).alias("owner")).distinct()
    return key.groupBy("value_hash").agg(F.countDistinct("repository").alias("n_repositories"),
                                         F.countDistinct("owner").alias("n_owners"))


def secret_scan(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                repository: Column | None = None, owner: Column | None = None,
                kinds: tuple[Kind, ...] = BASE + ADDED, copied_owners: int = COPIED_OWNERS) -> DataFrame:
    """One row per input row: row_id, id, found (array, by start and kind).

    Each entry has kind_no, kind, start, end, value_hash, n_repositories,
    n_owners and ``copied``: true where ``copied_owners`` or more distinct
    owners hold the value.
    """
    rows, spans = candidates(docs, kinds, text_col, id_col, repository, owner)
    spans = stage(spans, "spans")
    # Staged before it is joined, so the spans of a value that is copied all over can be split over tasks.
    owned = stage(ownership(spans), "ownership")
    told = (spans.withColumn("value_hash", F.sha2("value", 256)).join(owned, "value_hash")
            .select("row_id", F.struct("start", "kind_no", "end", "kind", "value_hash", "n_repositories", "n_owners",
                                       (F.col("n_owners") >= copied_owners).alias("copied")).alias("s")))
    per_row = told.groupBy("row_id").agg(F.array_sort(F.collect_list("s")).alias("found"))
    return rows.join(per_row, "row_id", "left").select(
        "row_id", "id", F.coalesce("found", F.filter(F.array(F.lit(None).cast(per_row.schema["found"].dataType.elementType)),
                                                     lambda x: x.isNotNull())).alias("found"))


def spans_text(found: Column) -> Column:
    """kind:start:end of each entry, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
