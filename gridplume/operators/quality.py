"""Data tests as one aggregate per table, and the gates that act on them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridplume.schemas import FUEL_LABELS, OTHER_FUEL


@dataclass(frozen=True)
class Rule:
    column: str
    test: str
    values: tuple[str, ...] = ()

    def failure(self) -> Column:
        """True for a row that breaks the rule. NULL passes ``accepted_values``; that is ``not_null``'s business."""
        value = F.col(self.column)
        if self.test == "not_null":
            return value.isNull()
        if self.test == "accepted_values":
            return ~value.isin(*self.values)
        raise ValueError(f"unknown test: {self.test}")


def not_null(*columns: str) -> list[Rule]:
    return [Rule(c, "not_null") for c in columns]


def accepted_values(column: str, values: list[str]) -> Rule:
    return Rule(column, "accepted_values", tuple(values))


RULES = {
    "stg_cems_daily": not_null("state", "date", "facility_id", "unit_id"),
    "mart_emissions_over_time": not_null("date", "state"),
    "mart_emissions_by_fuel": [
        *not_null("date", "state", "fuel_category"),
        accepted_values("fuel_category", [*FUEL_LABELS, OTHER_FUEL]),
    ],
}


class QualityError(RuntimeError):
    def __init__(self, failed: list):
        self.failed = failed
        super().__init__("; ".join(f"{r['table']}.{r['column']} {r['test']}: {r['failures']} rows" for r in failed))


def failure_counts(rules: list[Rule]) -> list[Column]:
    """One count per rule, to be taken along in an aggregate that runs anyway."""
    return [F.count_if(rule.failure()).alias(f"failures_{i}") for i, rule in enumerate(rules)]


def as_report(counts: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """Counts named as ``failure_counts`` names them, one row, as (table, column, test, failures)."""
    lines = [
        F.struct(
            F.lit(table).alias("table"),
            F.lit(rule.column).alias("column"),
            F.lit(rule.test).alias("test"),
            F.coalesce(F.col(f"failures_{i}"), F.lit(0)).cast("bigint").alias("failures"),
        )
        for i, rule in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*lines)))


def check(df: DataFrame, table: str, rules: list[Rule] | None = None) -> DataFrame:
    """All tests of a table in one pass over the tested columns."""
    rules = RULES[table] if rules is None else rules
    return as_report(df.agg(*failure_counts(rules)), table, rules)


def report(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [check(df, name) for name, df in tables.items()])


def quality_gate(results: DataFrame) -> None:
    """Raise when any test has failing rows. ``results`` has one row per test."""
    failed = results.where(F.col("failures") > 0).orderBy("table", "column", "test").collect()
    if failed:
        raise QualityError(failed)


def upload_gate(rows: DataFrame) -> bool:
    """Whether there is anything to load."""
    return not rows.isEmpty()
