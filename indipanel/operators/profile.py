"""Counts that describe a dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of the non-null values, most frequent first."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), F.asc(column)))


def missing_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL count per column in one pass: (column_name, missing)."""
    columns = df.columns if columns is None else columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], [F.col(c) for c in columns], "column_name", "missing")


def dataset_profile(df: DataFrame, period: str | None = None) -> DataFrame:
    """Rows and columns, with the covered periods where a period column is named."""
    aggs = [F.count("*").alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns")]
    if period:
        aggs += [F.min(period).alias("first_period"), F.max(period).alias("last_period")]
    return df.agg(*aggs)


def column_list(df: DataFrame) -> DataFrame:
    """Position, name and type of every column; reads no data."""
    import pyarrow as pa
    fields = df.schema.fields
    return df.sparkSession.createDataFrame(pa.table({
        "position": pa.array(range(1, len(fields) + 1), pa.int64()),
        "column_name": pa.array([f.name for f in fields], pa.string()),
        "column_type": pa.array([f.dataType.simpleString() for f in fields], pa.string())}))
