"""Filter rules: ``{"field": .., "operator": .., "value": ..}``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame

from millrace.functions.fields import TypedFields, fields_of

# The operator names of a filter rule.
OPERATORS = ("eq", "ne", "gt", "lt", "contains")


def check_rule(rule: Mapping) -> None:
    if rule.get("operator") not in OPERATORS:
        raise ValueError(f"unknown filter operator: {rule.get('operator')!r}")
    if not rule.get("field"):
        raise ValueError("a filter rule needs a field")


def _condition(fields, rule: Mapping) -> Column:
    name, op, value = rule["field"], rule["operator"], rule["value"]
    if isinstance(fields, TypedFields) and name not in fields.types:
        raise ValueError(f"unknown field: {name!r}")
    if op == "contains":
        return fields.contains(name, value)
    if op != "ne":
        return fields.compare(name, op, value)
    differs = ~fields.compare(name, "eq", value)
    if isinstance(fields, TypedFields):
        return differs
    return fields.present(name) & ~fields.is_null(name) & differs


def filter_rows(df: DataFrame, rules: Sequence[Mapping], enabled: bool = True) -> DataFrame:
    """Rows that satisfy every rule. A null field satisfies none, ``ne`` included.

    On typed tables the conditions are plain comparisons, which Spark pushes to
    the file scan.
    """
    if not enabled or not rules:
        return df
    for rule in rules:
        check_rule(rule)
    fields = fields_of(df)
    rows = fields.prepare(df, [r["field"] for r in rules])
    tests = [_condition(fields, r) for r in rules]
    return rows.filter(reduce(lambda a, b: a & b, tests)).select(*df.columns)
