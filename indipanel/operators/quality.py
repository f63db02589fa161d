"""Data-quality rules: each gives the violating rows or keys, a suite gives a report."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules as R


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null keys that occur more than once."""
    return grain(df.filter(F.col(column).isNotNull()), [column])


def grain(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key combinations that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def accepted_values(df: DataFrame, column: str, accepted: list) -> DataFrame:
    """Non-null values outside the list, with their row counts."""
    return df.filter(~F.col(column).isin(accepted)).groupBy(column).agg(F.count("*").alias("n"))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str | None = None) -> DataFrame:
    """Non-null child keys without a parent, with their row counts.

    The child is reduced to its distinct keys first, so a hot key is one row per
    task before the shuffle and one row in the join.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    parents = parent.select(F.col(parent_column or column).alias(column)).distinct()
    return keys.join(parents, column, "left_anti")


@dataclass(frozen=True)
class Rules:
    """Declared expectations of one table."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: dict[str, tuple] = field(default_factory=dict)
    parents: dict[str, str] = field(default_factory=dict)   # column -> parent table, same column name
    grain: tuple[str, ...] = ()


# The expectations of the standard tables.
STANDARD_RULES = {
    "raw": Rules(not_null=("row_hash", "inserted_at")),
    "metadata": Rules(not_null=("countryiso3code", "country_name", "type_entite"), unique=("countryiso3code",)),
    "staging": Rules(
        not_null=("indicator_code", "country_name", "type_entite", "annee", "row_hash", "inserted_at"),
        accepted={"type_entite": (R.ENTITY_COUNTRY, R.ENTITY_AGGREGATE)}),
    "dim_entity": Rules(not_null=("countryiso3code", "country_name"), unique=("countryiso3code",)),
    "dim_period": Rules(not_null=("annee",), unique=("annee",)),
    "dim_indicator": Rules(not_null=("indicator_code", "indicator_label_fr"), unique=("indicator_code",)),
    "fact": Rules(
        not_null=("countryiso3code", "annee", "indicator_code", "methode_traitement", "est_imputee", "inserted_at"),
        accepted={"methode_traitement": R.METHODS},
        parents={"countryiso3code": "dim_entity", "annee": "dim_period", "indicator_code": "dim_indicator"},
        grain=("countryiso3code", "annee", "indicator_code")),
}


def run_suite(tables: dict[str, DataFrame], rules: dict[str, Rules] = STANDARD_RULES) -> DataFrame:
    """(table_name, rule, column_name, failures, status): one row per rule.

    Every table is scanned once. Its rows give one count per key of each key rule and one per broken
    row rule; parent tables give their keys to the rules of their children. All counts of all rules are
    combined before the one shuffle that answers unique, grain and relationship rules together.
    """
    names: list[tuple[str, str, str]] = []
    counts: dict[str, list] = {table: [] for table in tables}

    def rule_number(table: str, rule: str, column: str) -> int:
        names.append((table, rule, column))
        return len(names) - 1

    def counted(number: int, columns: list[str] | None, when, rows: int = 1):
        """One count: the key as text, how many rows it stands for."""
        key = F.array(*[F.col(c).cast("string") for c in columns]) if columns else F.lit(None).cast("array<string>")
        return F.when(when, F.struct(F.lit(number).alias("number"), key.alias("key"), F.lit(rows).alias("n")))

    for table, rule in rules.items():
        if table not in tables:
            continue
        found = counts[table]
        for c in rule.not_null:
            found.append(counted(rule_number(table, "not_null", c), None, F.col(c).isNull()))
        for c, ok in rule.accepted.items():
            found.append(counted(rule_number(table, "accepted_values", c), None, ~F.col(c).isin(list(ok))))
        for c in rule.unique:
            found.append(counted(rule_number(table, "unique", c), [c], F.col(c).isNotNull()))
        for c, parent in rule.parents.items():
            number = rule_number(table, "relationships", c)
            found.append(counted(number, [c], F.col(c).isNotNull()))
            counts[parent].append(counted(number, [c], F.col(c).isNotNull(), 0))
        if rule.grain:
            found.append(counted(rule_number(table, "grain", ",".join(rule.grain)), list(rule.grain), F.lit(True)))

    lines = [tables[table].select(F.explode(F.array_compact(F.array(*found))).alias("_c")).select("_c.*")
             for table, found in counts.items() if found]
    # n = 0 marks a key of the parent table
    keys = reduce(DataFrame.unionByName, lines).groupBy("number", "key").agg(
        F.sum("n").cast("bigint").alias("n"), (F.min("n") == 0).alias("known"))

    def of(*kinds: str):
        return F.col("number").isin([i for i, (_, rule, _) in enumerate(names) if rule in kinds])

    failures = (F.when(of("unique", "grain"), (F.col("n") > 1).cast("bigint"))
                .when(of("relationships") & F.col("known"), F.lit(0)).otherwise(F.col("n")))
    every = lines[0].sparkSession.createDataFrame(
        [(i, *name) for i, name in enumerate(names)], "number int, table_name string, rule string, column_name string")
    report = every.join(keys.groupBy("number").agg(F.sum(failures).alias("failures")), "number", "left").select(
        "table_name", "rule", "column_name", F.coalesce("failures", F.lit(0).cast("bigint")).alias("failures"))
    return report.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))
