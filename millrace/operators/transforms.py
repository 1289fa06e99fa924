"""Transform rules: ``{"field": .., "type": .., "value": ..}``, applied in order.

Each rule works on typed columns, or on the entries of a ``data`` map when the
frame has one. In a map a value that cannot be cast stays as it is; a typed
column cannot hold both, so there the text that did not parse moves to
``<field>__uncast``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.fields import MapFields, as_variant, edit, fields_of, variant_kind

# Rule names, cast targets and the texts accepted as numbers.
RULES = ("rename", "default", "cast", "compute")
CASTS = ("string", "int", "float")
INT_TEXT = r"^[+-]?[0-9]+$"
FLOAT_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
FLOAT_WORD = r"(?i)^([+-]?(inf|infinity)|nan)$"
VERSION = "1.0"


def _map_column(df: DataFrame) -> str | None:
    fields = fields_of(df)
    return fields.column if isinstance(fields, MapFields) else None


# Text forms accepted as numbers.

def parse_int(text: Column) -> Column:
    """Text that is wholly a base-10 64-bit integer, else NULL."""
    return F.when(text.rlike(INT_TEXT), text.try_cast("bigint"))


def parse_float(text: Column) -> Column:
    """Text that is wholly a finite number (or an infinity or nan word), else NULL."""
    number = text.try_cast("double")
    finite = text.rlike(FLOAT_TEXT) & (F.abs(number) < F.lit(float("inf")))
    return F.when(finite | text.rlike(FLOAT_WORD), number)


_PARSERS = {"int": parse_int, "float": parse_float}


class Draft:
    """Edits to a ``map<string,variant>`` column, applied in one rebuild.

    A touched entry is a VARIANT column; SQL NULL means the entry is absent.
    """

    def __init__(self, column: str = "data"):
        self.column = column
        self.touched: dict[str, Column] = {}

    def get(self, name: str) -> Column:
        return self.touched.get(name, F.col(self.column)[name])

    def put(self, values: Mapping[str, Column]) -> None:
        for name, value in values.items():
            self.touched[name] = value.cast("variant")

    def rename(self, field: str, to: str) -> None:
        if field != to:
            self.touched[to] = F.coalesce(self.get(field), self.get(to))
            self.touched[field] = F.lit(None).cast("variant")

    def default(self, field: str, value: str) -> None:
        self.touched[field] = F.coalesce(self.get(field), as_variant(value))

    def cast(self, field: str, target: str) -> None:
        value = self.get(field)
        kind = variant_kind(value)
        if target == "string":
            new = F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value))
            apply = kind != "VOID"
        else:
            new = _PARSERS[target](F.try_variant_get(value, "$", "string"))
            apply = (kind == "STRING") & new.isNotNull()
        self.touched[field] = F.when(apply, new.cast("variant")).otherwise(value)

    def apply(self, df: DataFrame) -> DataFrame:
        """``df`` with the edits made; the draft is then empty."""
        if not self.touched:
            return df
        edited = edit(F.col(self.column), self.touched)
        self.touched = {}
        return df.withColumn(self.column, edited)


def rename(df: DataFrame, field: str, to: str) -> DataFrame:
    """Move a value to a new name, replacing what was there; nothing happens
    when the field is absent or already has that name."""
    if field == to or field not in df.columns:
        return df
    return df.drop(to).withColumnRenamed(field, to)


def default(df: DataFrame, field: str, value: str, null_is_absent: bool = True) -> DataFrame:
    """Set a text where the field is absent; in a typed column
    ``null_is_absent`` decides whether NULL counts, and a text that is not of
    the column's type is refused."""
    if field not in df.columns:
        return df.withColumn(field, F.lit(value))
    if not null_is_absent:
        return df
    kind = df.schema[field].dataType
    _check_literal(field, value, kind)
    return df.withColumn(field, F.coalesce(F.col(field), F.lit(value).cast(kind)))


_READERS = (
    (T.IntegralType, int),
    ((T.FloatType, T.DoubleType), float),
    (T.DecimalType, Decimal),
    ((T.TimestampType, T.TimestampNTZType), datetime.fromisoformat),
    (T.DateType, date.fromisoformat),
)


def _check_literal(field: str, value: str, kind: T.DataType) -> None:
    for kinds, read in _READERS:
        if isinstance(kind, kinds):
            try:
                read(value)
            except (ArithmeticError, ValueError) as error:
                message = f"default of {field!r} is not a {kind.simpleString()}: {value!r}"
                raise ValueError(message) from error


def cast(df: DataFrame, field: str, target: str) -> DataFrame:
    """Cast a column to ``string``, ``int`` or ``float``; the last two only touch
    text, and keep what does not parse in ``<field>__uncast``."""
    if target not in CASTS:
        raise ValueError(f"unknown cast target: {target!r}")
    if field not in df.columns:
        return df
    column = F.col(field)
    if target == "string":
        return df.withColumn(field, column.cast("string"))
    if not isinstance(df.schema[field].dataType, T.StringType):
        return df
    parsed = _PARSERS[target](column)
    return df.withColumns({field: parsed, f"{field}__uncast": F.when(parsed.isNull(), column)})


def compute(df: DataFrame, field: str, expression: str) -> DataFrame:
    """Set a field from a SQL expression."""
    return df.withColumn(field, F.expr(expression))


def check_rule(rule: Mapping) -> None:
    if rule.get("type") not in RULES:
        raise ValueError(f"unknown transform: {rule.get('type')!r}")
    if not rule.get("field"):
        raise ValueError("a transform rule needs a field")
    if rule["type"] == "cast" and rule.get("value") not in CASTS:
        raise ValueError(f"unknown cast target: {rule.get('value')!r}")


def apply_rules(
    df: DataFrame, rules: Sequence[Mapping], enabled: bool = True, draft: Draft | None = None
) -> DataFrame:
    """All rules from first to last.

    On a ``data`` map the rules join ``draft`` and the map is rebuilt once at
    the end (and before a computed field, whose expression reads the map).
    """
    rules = list(rules) if enabled else []
    for rule in rules:
        check_rule(rule)
    data = _map_column(df)
    if data is None:
        steps = {"rename": rename, "default": default, "cast": cast, "compute": compute}
        return reduce(lambda d, r: steps[r["type"]](d, r["field"], r["value"]), rules, df)
    draft = draft or Draft(data)
    for rule in rules:
        field, value = rule["field"], rule["value"]
        if rule["type"] == "compute":
            df = draft.apply(df)
            draft.put({field: F.expr(value)})
        else:
            getattr(draft, rule["type"])(field, value)
    return draft.apply(df)


def flow_stamps(name: str) -> dict[str, Column]:
    return {"_pipeline_name": F.lit(name), "_pipeline_version": F.lit(VERSION)}


def join_stamps(name: str) -> dict[str, Column]:
    return {
        "_pipeline_name": F.lit(name),
        "_pipeline_type": F.lit("join"),
        "_processed_at": F.current_timestamp(),
    }


def _stamp(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    data = _map_column(df)
    if data is None:
        return df.withColumns(dict(values))
    draft = Draft(data)
    draft.put(values)
    return draft.apply(df)


def stamp_flow(df: DataFrame, name: str) -> DataFrame:
    return _stamp(df, flow_stamps(name))


def stamp_join(df: DataFrame, name: str) -> DataFrame:
    return _stamp(df, join_stamps(name))
