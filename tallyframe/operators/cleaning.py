"""Cleaning rules held as data: filters and recodes with an audit of each step."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.columns import named


@dataclass(frozen=True)
class Rule:
    """One step on one column.

    Make rules with ``keep``, ``drop``, ``below`` and ``recode``. A filter does not
    pass a NULL cell, as in SQL.
    """

    column: str
    action: str
    values: tuple[Any, ...]
    becomes: Any = None

    def passes(self, cell: Column) -> Column | None:
        """The filter condition on the current cell, or None for a recode."""
        if self.action == "keep":
            return cell.isin(*self.values)
        if self.action == "drop":
            return ~cell.isin(*self.values)
        if self.action == "below":
            return cell < F.lit(self.values[0])
        return None


def keep(column: str, *codes: Any) -> Rule:
    """Keep the rows whose code is listed."""
    return Rule(column, "keep", codes)


def drop(column: str, *codes: Any) -> Rule:
    """Drop the rows whose code is listed (refused, don't know, ...)."""
    return Rule(column, "drop", codes)


def below(column: str, bound: float) -> Rule:
    """Keep the rows with a value below the bound."""
    return Rule(column, "below", (bound,))


def recode(column: str, code: Any, becomes: Any) -> Rule:
    """Replace one code by another value and leave the rest."""
    return Rule(column, "recode", (code,), becomes)


def _follow(df: DataFrame, rules: Sequence[Rule]) -> tuple[list[Column | None], dict[str, Column]]:
    """Each rule's condition on the untouched input, and the recoded columns.

    Conditions come after the recodes before them, so the order of rules counts.
    """
    types = {field.name: field.dataType for field in df.schema.fields}
    cells: dict[str, Column] = {}
    conditions: list[Column | None] = []
    for rule in rules:
        if rule.column not in types:
            raise ValueError(f"no column {rule.column!r} for rule {rule}")
        cell = cells.get(rule.column, named(rule.column))
        conditions.append(rule.passes(cell))
        if rule.action == "recode":
            value = F.lit(rule.becomes).cast(types[rule.column])
            cells[rule.column] = F.when(cell == F.lit(rule.values[0]), value).otherwise(cell)
    return conditions, cells


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Apply the rules in order: one filter on the scan and one projection."""
    conditions, cells = _follow(df, rules)
    filters = [condition for condition in conditions if condition is not None]
    if filters:
        df = df.where(reduce(and_, filters))
    return df.withColumns(cells) if cells else df


def rule_audit(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows before and after every rule, all counted in one pass.

    ``rule_no, column_name, action, rows_in, rows_out``.
    """
    conditions, _ = _follow(df, rules)
    n = len(rules)
    stops = [
        F.when(~F.coalesce(condition, F.lit(False)), F.lit(step))
        for step, condition in enumerate(conditions, 1)
        if condition is not None
    ]
    # The rule that removes the row, or n + 1 for a row that stays.
    stop = F.coalesce(*stops, F.lit(n + 1)).alias("stop")
    reached = df.select(stop).agg(
        *[F.count_if(F.col("stop") >= step).alias(f"r{step}") for step in range(1, n + 2)]
    )
    rows = [
        F.struct(
            F.lit(step).alias("rule_no"),
            F.lit(rule.column).alias("column_name"),
            F.lit(rule.action).alias("action"),
            F.col(f"r{step}").alias("rows_in"),
            F.col(f"r{step + 1}").alias("rows_out"),
        )
        for step, rule in enumerate(rules, 1)
    ]
    return reached.select(F.inline(F.array(*rows)))


def make_label(
    df: DataFrame, column: str, positive: Any, negative: Any, label: str = "label"
) -> DataFrame:
    """Rename the answer column and turn its two answers to 1 and 0.

    Rows with any other answer, or none, leave. A table that has a column named as the
    label already is refused; drop or rename it first.
    """
    if label != column and label.lower() in (name.lower() for name in df.columns):
        raise ValueError(f"the table already has a column {label!r}")
    answer = named(label)
    renamed = df.withColumnRenamed(column, label)
    kind = renamed.schema[label].dataType
    return renamed.where(answer.isin(positive, negative)).withColumn(
        label, F.when(answer == F.lit(positive), 1).otherwise(0).cast(kind)
    )
