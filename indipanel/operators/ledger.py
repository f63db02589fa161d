"""Prediction ledger: test rows kept, production rows replaced by every scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules as R
from ..functions import outcome
from ..schemas import LEDGER


def ledger_rows(scored: DataFrame, run: str, stamp: Column, actual: str = "income_level",
                predicted: str = "income_level_predit") -> DataFrame:
    """Scored rows in ledger form with the outcome of each prediction."""
    return scored.withColumns({
        "type_prediction": F.lit(run),
        "prediction_correcte": outcome(actual, predicted),
        "date_prediction": stamp.cast("timestamp"),
    }).select(*LEDGER.fieldNames())


def renew(ledger: DataFrame, production: DataFrame) -> DataFrame:
    """The ledger after a scoring: its test rows and the new production rows."""
    kept = ledger.filter(F.col("type_prediction") == R.RUN_TEST)
    return kept.unionByName(production)
