"""Training and scoring jobs over the stored feature mart."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules as R
from ..operators import evaluate, profile
from ..operators.forest import (
    Forest, fit_forest, labelled_between, load_model, save_model, score, to_score)
from ..operators.ledger import ledger_rows
from ..schemas import LEDGER, feature_mart
from ..session import instant, utc
from ..sources.tables import replace_partitions, replace_table, scan

_PARTITION = ["type_prediction"]


def dataset(spark: SparkSession, mart_path: str, features=R.FEATURE_NAMES) -> DataFrame:
    """The feature mart in reading order, by entity and year."""
    return scan(spark, mart_path, feature_mart(list(features))).orderBy("countryiso3code", "annee")


def describe(spark: SparkSession, mart_path: str, features=R.FEATURE_NAMES) -> dict[str, DataFrame]:
    """What a look at the mart shows: size, columns, class counts, missing values."""
    mart = scan(spark, mart_path, feature_mart(list(features)))
    return {
        "profile": profile.dataset_profile(mart, "annee"),
        "columns": profile.column_list(mart),
        "classes": profile.value_counts(mart, "income_level"),
        "missing": profile.missing_profile(mart),
    }


def train(spark: SparkSession, mart_path: str, ledger_path: str, model_path: str,
          features=R.FEATURE_NAMES, train_years=R.TRAIN_YEARS, test_year=R.TEST_YEAR,
          final_years=R.FINAL_YEARS, forest: Forest = Forest(), stamp: datetime | None = None,
          reset: bool = True, evaluation_path: str | None = None) -> dict:
    """Evaluate on the held-out year, write its predictions, refit and save.

    reset  start the ledger anew with the test rows only; otherwise the production
           rows stay until the next scoring replaces them.
    Returns the test scores as DataFrames over the stored test rows.
    """
    features = list(features)
    mart = scan(spark, mart_path, feature_mart(features))
    model = fit_forest(labelled_between(mart, *train_years), features, forest=forest)
    if evaluation_path:
        save_model(model, evaluation_path)
    tested = ledger_rows(score(model, labelled_between(mart, test_year, test_year)), R.RUN_TEST, instant(utc(stamp)))
    if reset:
        replace_table(tested, ledger_path, _PARTITION)
    else:
        replace_partitions(tested, ledger_path, _PARTITION)

    save_model(fit_forest(labelled_between(mart, *final_years), features, forest=forest), model_path)

    test = scan(spark, ledger_path, LEDGER).filter(F.col("type_prediction") == R.RUN_TEST)
    pair = ("income_level", "income_level_predit")
    classes = sorted({r[0] for r in test.select(pair[0]).distinct().collect()}
                     | {r[0] for r in test.select(pair[1]).distinct().collect()})
    return {
        "accuracy": evaluate.accuracy(test, *pair),
        "report": evaluate.classification_report(test, *pair),
        "confusion": evaluate.confusion_matrix(test, *pair, classes),
    }


def predict(spark: SparkSession, mart_path: str, ledger_path: str, model_path: str,
            features=R.FEATURE_NAMES, score_from: int = R.SCORE_FROM_YEAR,
            stamp: datetime | None = None) -> int:
    """Score the newer years and replace the production rows of the ledger.

    The ledger is partitioned by run type, so the test rows are neither read nor
    rewritten. Without rows to score the ledger is left alone.
    """
    rows = to_score(scan(spark, mart_path, feature_mart(list(features))), score_from)
    if rows.isEmpty():
        return 0
    scored = score(load_model(model_path), rows)
    replace_partitions(ledger_rows(scored, R.RUN_PRODUCTION, instant(utc(stamp))), ledger_path, _PARTITION)
    return scan(spark, ledger_path, LEDGER).filter(F.col("type_prediction") == R.RUN_PRODUCTION).count()
