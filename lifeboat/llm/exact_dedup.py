"""Exact deduplication by content-defined chunk recipes (DataFrame functions only).

A text is cut into chunks at places its own content decides: the first line or
sentence end after 1,024 characters, or else the first white space after 7,168; a text without any
of them is cut every 8,192. Every chunk gets a verified
identifier, a text becomes the ordered list of its chunks' identifiers, and two
texts are equal exactly when the lists are. Only those short lists are grouped
and joined; text crosses the network once, as distinct chunks, to verify the
identifiers.

Defined results: a null text counts as empty, and all empty texts are one
group (the empty list). Of equal rows with the same doc_id one row stays. A
null doc_id is smaller than any other. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lifeboat.llm.common import free_name, numbered, stage, text_or_empty

# Chunk rule: a line or sentence end ends a chunk once it has 1,024 characters, white space once it has 7,168; 8,192 at most.
CHUNK_PATTERN = r"(?s).{1022,7166}?(?:\n|[.!?]\s)|.{7167,8191}?\s|.{1,8192}"


def chunk_array(text: Column) -> Column:
    """The chunks of a text, in order; together they are the text."""
    return F.regexp_extract_all(text, F.lit(CHUNK_PATTERN), F.lit(0))


def _chunk_hash(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def recipes(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
            chunk_hash: Callable[[Column], Column] = _chunk_hash, row: Column | None = None) -> DataFrame:
    """(row_id, id, recipe, text_sha256), staged: the identifier list of every row.

    A chunk's identifier is its hash and, where different chunks share a hash,
    its place among them; the distinct chunks are compared byte by byte to find
    those. ``chunk_hash`` can be replaced (tests use a weak one).
    """
    base = numbered(docs, row, "row_id", [F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")])
    slim = stage(base.select("row_id", "id",
                             F.transform(chunk_array(F.col("text")), chunk_hash).alias("hashes"),
                             F.sha2("text", 256).alias("text_sha256")), "recipes")
    chunks = base.select(F.explode(chunk_array(F.col("text"))).alias("chunk"))
    distinct = chunks.select(chunk_hash(F.col("chunk")).alias("h"), "chunk").distinct()
    shared = stage(distinct.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"), "shared-hash")
    if shared.isEmpty():
        return slim.select("row_id", "id", F.col("hashes").alias("recipe"), "text_sha256")
    place = stage(distinct.join(shared, "h").withColumn(
        "k", F.row_number().over(Window.partitionBy("h").orderBy("chunk")) - 1), "shared-chunks")
    pos = base.select("row_id", F.posexplode(chunk_array(F.col("text"))).alias("pos", "chunk"))
    ids = (pos.select("row_id", "pos", chunk_hash(F.col("chunk")).alias("h"), "chunk").join(place, ["h", "chunk"], "left")
           .groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("pos", "h", F.coalesce("k", F.lit(0)).alias("k")))).alias("c")))
    pairs = F.flatten(F.transform("c", lambda x: F.array(x["h"], x["k"].cast("long"))))
    return stage(slim.join(ids, "row_id", "left").select(
        "row_id", "id", F.coalesce(pairs, F.array().cast("array<long>")).alias("recipe"), "text_sha256"), "recipes")


def exact_dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                chunk_hash: Callable[[Column], Column] = _chunk_hash, row: Column | None = None) -> DataFrame:
    """One row per input row: row_id, id, keep_id, group_size, kept, text_sha256.

    ``keep_id`` is the largest id among the rows of equal text. Groups are counted with map-side partial
    aggregation, and those of more than one row are staged. The join back then has a plain shuffle on either side:
    a group with very many rows is many slim rows against one, which AQE splits.
    ``row``: see ``common.numbered``.
    """
    slim = recipes(docs, text_col, id_col, chunk_hash, row)
    groups = stage(slim.groupBy("recipe").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size")).filter("group_size > 1"), "groups")
    # Of equal largest ids (null where there is no other) the largest row number stays: few rows, or all of a group of repeated ids, summed in the task first.
    first = (slim.join(groups, "recipe").filter("id <=> keep_id").groupBy("recipe").agg(F.max("row_id").alias("keep_row"))
             .withColumnRenamed("recipe", "of"))
    copied = stage(groups.join(first, F.col("recipe") == F.col("of")).drop("of"), "copied")
    alone = F.col("group_size").isNull()
    return slim.join(copied, "recipe", "left").select(
        "row_id", "id", F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("keep_row") == F.col("row_id"))).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", row: Column | None = None) -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` does not keep; same columns."""
    name = free_name(docs, "row_id")
    own = numbered(docs, row, name)
    gone = stage(exact_dedup(own, text_col, id_col, row=F.col(name)).filter("NOT kept").select(F.col("row_id").alias(name)), "copies")
    return own.join(gone, name, "left_anti").drop(name)
