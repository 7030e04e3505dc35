"""Driver contract: entry() runs, and every query with an oracle matches DuckDB on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tools.check_oracle import TABLES, digest


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"id", "label", "is_train", "age", "fare"} <= set(df.columns)


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


# Queries that train several models: test_models holds these families to more, on smaller settings.
TRAINERS = {"gradient_boosting", "xgboost", "svm_rbf", "knn", "mlp", "rfxgb", "ensemble_top3"}


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - TRAINERS))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    hs, cs, ls = digest(sdf.columns, srows)
    hd, cd, ld = digest(dcols, drows)
    assert cs == cd
    assert len(srows) == len(drows)
    assert hs == hd, (sorted(set(ls) - set(ld))[:3], sorted(set(ld) - set(ls))[:3])


def test_entry_without_the_libraries_of_the_subpackage(monkeypatch):
    """A library that only the training-data operators need takes none of the other queries away."""
    import importlib

    real = importlib.import_module

    def missing(name, *args):
        if name.startswith(("lifeboat.llm", "corpus_pipeline")):
            raise ModuleNotFoundError("No module named 'somelib'", name="somelib")
        return real(name, *args)

    monkeypatch.setattr(importlib, "import_module", missing)
    with pytest.warns(UserWarning, match="somelib"):
        assert E._optional("lifeboat.llm.catalog", ("lifeboat.llm",)) == {}
