"""Class prediction with a random forest: split, impute, weigh, fit, score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules as R
from ..functions import dictionary
from . import bagging
from .bagging import bin_of
from .evaluate import class_weights
from .ranks import exact_median


@dataclass(frozen=True)
class Forest:
    """Model settings. Spark's trees stop at depth 30 at the latest."""

    trees: int = R.FOREST_TREES
    depth: int = 30
    seed: int = R.FOREST_SEED
    bins: int = 32
    memory_mb: int = 1024


def labelled_between(df: DataFrame, first: int, last: int, period: str = "annee",
                     label: str = "income_level") -> DataFrame:
    """Rows of a span of periods that have a class, for fitting and testing."""
    return df.filter(F.col(period).between(first, last) & F.col(label).isNotNull())


def to_score(df: DataFrame, first: int = R.SCORE_FROM_YEAR, period: str = "annee") -> DataFrame:
    """Rows to predict, with or without a class."""
    return df.filter(F.col(period) >= first)


def feature_medians(df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, median): exact medians of the non-null values, one row per feature.

    Every feature is one huge group, which exact_median spreads by value. A feature
    without any value has no row.
    """
    doubles = df.select(*[F.col(f).cast("double").alias(f) for f in features])
    return exact_median(doubles.unpivot([], [F.col(f) for f in features], "feature", "value"), ["feature"], "value")


def _imputer(medians: dict[str, float], bounds: dict[str, list[float]] = {}) -> SQLTransformer:
    """Fills gaps with the median and, for a feature with bounds, puts the number of its bin in place of the value."""
    filled = {f"_in_{f}": f"coalesce(cast(`{f}` as double), {m!r}D)" for f, m in medians.items()}
    binned = {c: bin_of(value, bounds[c]) if c in bounds else value for c, value in filled.items()}
    return SQLTransformer(statement=f"SELECT *, {', '.join(f'{v} AS `{c}`' for c, v in binned.items())} FROM __THIS__")


def fit_forest(train: DataFrame, features: list[str], label: str = "income_level",
               prediction: str = "income_level_predit", forest: Forest = Forest()) -> PipelineModel:
    """Median imputer, assembler, forest and label names as one saveable model.

    What reaches the driver is one median per feature, one count per class and the bounds of bins. The
    label is indexed here and not in the saved model, which must take unlabelled rows.
    Many rows are merged by their bins, with the bootstrap of all of them (``bagging``). In one fit
    of Spark's forest the rows keep their node of each tree from one level to the next, else every level
    walks all trees again from the root; the trees are the same.
    """
    known = {r["feature"]: r["median"] for r in feature_medians(train, features).collect()}
    medians = {f: known[f] for f in features if f in known}
    counted = class_weights(train, label).collect()
    weights = {r[label]: r["weight"] for r in counted}
    classes = sorted(weights)
    merge = sum(r["n"] for r in counted) >= bagging.MANY_ROWS

    imputer = _imputer(medians)
    if merge:
        inputs = [f"_in_{f}" for f in medians]
        imputer = _imputer(medians, bagging.bounds(imputer.transform(train), inputs, forest.bins))
    assembler = VectorAssembler(inputCols=[f"_in_{f}" for f in medians], outputCol="_features")
    index = dictionary(label, {c: str(float(i)) for i, c in enumerate(classes)}).cast("double")
    weight = dictionary(label, {c: repr(weights[c]) for c in classes}).cast("double")
    settings = RandomForestClassifier(
        featuresCol="_features", labelCol="_label", weightCol="_weight", predictionCol="_predicted",
        probabilityCol="", rawPredictionCol="_raw", numTrees=forest.trees, maxDepth=forest.depth,
        maxBins=forest.bins, maxMemoryInMB=forest.memory_mb, cacheNodeIds=True, seed=forest.seed)
    filled, target = imputer.transform(train), [index.alias("_label"), weight.alias("_weight")]
    if merge:
        model = bagging.fit_merged(filled.select(*inputs, *target), assembler, "_label", "_weight", classes, settings)
    else:
        model = settings.fit(assembler.transform(filled).select("_features", *target))
    names = IndexToString(inputCol="_predicted", outputCol=prediction, labels=classes)
    return PipelineModel(stages=[imputer, assembler, model, names])


def score(model: PipelineModel, df: DataFrame, prediction: str | None = None) -> DataFrame:
    """The rows with their predicted class, under the model's column name or another."""
    named = model.stages[-1].getOutputCol()
    return model.transform(df).select(*df.columns, F.col(named).alias(prediction or named))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
