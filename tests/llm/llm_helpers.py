"""Rows with every awkward case, and plain reference computations, for the operator tests."""

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_id string, ID string, fp double"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n))


def edge_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids, clashing column names."""
    long = prose(1, 60_000)
    base = prose(2, 400)
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "two words"), (6, base), (7, base), (7, base), (8, base + " tail"),
             (9, long), (10, long + " end"), (None, "no id here at all"), (None, None), (11, "Ünïcode é " * 30), (12, "x" * 30_000),
             (13, "same same " * 200), (14, base.upper()), (15, "a\x00b \x85c\xa0d"), (5, "two words")]
    rows = [(i, t, None if i == 4 else "en", None if i == 5 else f"s{(i or 0) % 3}", None if t is None else len(t), "r", "x", 0.5) for i, t in texts]
    return spark.createDataFrame(rows, DOC_SCHEMA).coalesce(2)


def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def plain(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]
