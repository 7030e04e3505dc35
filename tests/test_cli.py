"""The command line runs the whole job on passenger CSV files."""

import json

from pyspark.sql import functions as F

from conftest import SF_SMALL
from lifeboat.sources import bindings as B
from lifeboat.sources.csv import PASSENGER_HEADER


def test_cli_end_to_end(spark, tmp_path, capsys):
    from lifeboat.__main__ import main
    out = {v: k for k, v in PASSENGER_HEADER.items()}
    s = B.subjects(spark, SF_SMALL)
    cols = [c for c in s.columns if c != "is_train"]
    s.where("is_train").select(*[F.col(c).alias(out[c]) for c in cols]) \
        .write.option("header", True).csv(str(tmp_path / "train"))
    s.where("not is_train").select(*[F.col(c).alias(out[c]) for c in cols if c != "label"]) \
        .write.option("header", True).csv(str(tmp_path / "test"))
    s.where("not is_train").select(F.col("id").alias("PassengerId"), F.col("label").alias("Survived")) \
        .write.option("header", True).csv(str(tmp_path / "truth"))
    main(["--train", str(tmp_path / "train"), "--test", str(tmp_path / "test"), "--model", "LogisticRegression",
          "--out", str(tmp_path / "out"), "--ground-truth", str(tmp_path / "truth"), "--seeds", "45,777"])
    rows = [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]
    assert [r["seed"] for r in rows] == [45, 777]
    assert sum(r["best"] for r in rows) == 1
    n_test = s.where("not is_train").count()
    assert all(r["total"] == n_test for r in rows)
    assert spark.read.option("header", True).csv(rows[0]["submission"]).count() == n_test
