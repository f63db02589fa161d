"""Command line: run, train, predict and check over one warehouse folder.

    python -m indipanel run <warehouse> <observations> <entities> [--lookback N]
    python -m indipanel train <warehouse> [--trees N] [--depth N]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .operators.forest import Forest
from .plans.model_jobs import predict, train
from .plans.warehouse import Warehouse


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="indipanel")
    steps = parser.add_subparsers(dest="step", required=True)
    run = steps.add_parser("run", help="ingest landed pages, build all tables, check, predict")
    fit = steps.add_parser("train", help="evaluate on the test year, refit and save the model")
    steps_only = [steps.add_parser("predict", help="score the newer years"),
                  steps.add_parser("check", help="report the data-quality rules")]
    for step in (run, fit, *steps_only):
        step.add_argument("warehouse")
    run.add_argument("observations")
    run.add_argument("entities")
    run.add_argument("--lookback", type=int, help="compare with the hashes of this many newest rows only")
    fit.add_argument("--trees", type=int, default=Forest.trees)
    fit.add_argument("--depth", type=int, default=Forest.depth)
    fit.add_argument("--keep-production", action="store_true", help="do not reset the ledger")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _arguments(argv)
    spark = spark or SparkSession.builder.appName("indipanel").getOrCreate()
    house = Warehouse(spark, args.warehouse)
    mart, ledger, model = (house.path(t) for t in ("mart", "ledger", "model"))
    if args.step == "run":
        for name, value in house.run(args.observations, args.entities, lookback=args.lookback).items():
            print(f"{name}: {value}")
    elif args.step == "train":
        scores = train(spark, mart, ledger, model, forest=Forest(args.trees, args.depth),
                       reset=not args.keep_production)
        for table in scores.values():
            table.show(truncate=False)
    elif args.step == "predict":
        print(f"predicted: {predict(spark, mart, ledger, model)}")
    else:
        house.check().orderBy("table_name", "rule", "column_name").show(100, truncate=False)


if __name__ == "__main__":
    main()
