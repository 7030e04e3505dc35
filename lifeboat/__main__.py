"""Command line: ``python -m lifeboat --train train.csv --test test.csv --model RandomForest --out DIR``.

Runs :func:`lifeboat.plans.run.run` on two passenger CSV files (the labelled
one has a ``Survived`` column) and prints one JSON line per seed.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from lifeboat import config as C
from lifeboat.plans.run import MODEL_NAMES, run
from lifeboat.sources.csv import read_passengers


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="lifeboat")
    ap.add_argument("--train", required=True)
    ap.add_argument("--test", required=True)
    ap.add_argument("--model", default="RandomForest", help=f"one of {sorted(MODEL_NAMES)}")
    ap.add_argument("--features", default="rf", choices=("mlp", "rf", "xgb"))
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--ground-truth", default=None)
    ap.add_argument("--seeds", default=",".join(str(s) for s in C.SEEDS))
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("lifeboat").config("spark.ui.enabled", "false").getOrCreate()
    res = run(spark, read_passengers(spark, a.train), read_passengers(spark, a.test), a.model, a.out,
              feature_set=a.features, ground_truth=a.ground_truth,
              seeds=[int(s) for s in a.seeds.split(",") if s])
    for row in res.rows:
        print(json.dumps(dict(zip(("seed", "val_acc", "submission_acc", "matches", "total", "best",
                                   "submission", "model"), row))))


if __name__ == "__main__":
    main()
