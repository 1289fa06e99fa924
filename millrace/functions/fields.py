"""Fields of three row shapes behind one small interface.

* typed tables: a field is a column;
* schema-less events: a field is an entry of a ``map<string,variant>`` column,
  which keeps "absent" and "JSON null" apart;
* documents: a field is a path inside a VARIANT column.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.NumericType,)


def as_variant(value) -> Column:
    """A literal (or column) as VARIANT."""
    if isinstance(value, Column):
        return value.cast("variant")
    if value is None or isinstance(value, (dict, list)):
        return F.parse_json(F.lit(json.dumps(value)))
    return F.lit(value).cast("variant")


def _compare(op: str, left: Column, right: Column) -> Column:
    return {
        "eq": left == right,
        "gt": left > right,
        "gte": left >= right,
        "lt": left < right,
        "lte": left <= right,
    }[op]


def variant_kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _variant_scalar(value: Column, kind: Column, op: str, literal) -> Column:
    """Comparison of a VARIANT with a literal of the same type only."""
    if literal is None:
        return (kind == "VOID") if op in ("eq", "gte", "lte") else F.lit(False)
    if isinstance(literal, bool):
        return (kind == "BOOLEAN") & _compare(
            op, F.try_variant_get(value, "$", "boolean"), F.lit(literal)
        )
    if isinstance(literal, (int, float)):
        inexact = (kind == "DOUBLE") | kind.startswith("DECIMAL")
        if isinstance(literal, int):
            whole = F.try_variant_get(value, "$", "bigint")
            exact = (kind == "BIGINT") & _compare(op, whole, F.lit(literal))
            number = F.try_variant_get(value, "$", "double")
            return exact | (inexact & _compare(op, number, F.lit(float(literal))))
        number = F.try_variant_get(value, "$", "double")
        return ((kind == "BIGINT") | inexact) & _compare(op, number, F.lit(literal))
    if isinstance(literal, str):
        return (kind == "STRING") & _compare(
            op, F.try_variant_get(value, "$", "string"), F.lit(literal)
        )
    if op == "eq":
        return F.to_json(value) == F.to_json(as_variant(literal))
    raise ValueError(f"cannot order values against {literal!r}")


def any_element(
    value: Column, kind: Column, test: Callable[[Column, Column], Column]
) -> Column:
    """``test`` on a VARIANT, or on any element when it holds an array."""
    items = F.try_variant_get(value, "$", "array<variant>")
    inside = F.exists(items, lambda v: test(v, variant_kind(v)))
    return F.when(kind.startswith("ARRAY"), test(value, kind) | inside).otherwise(
        test(value, kind)
    )


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated exactly once per row.

    Catalyst moves filters below a projection by repeating the projected
    expression; it does not move them below a generator, so costly expressions
    (parsing, path lookups) go through a one-row generator.
    """
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(made)))


class TypedFields:
    """Columns of a typed table. SQL NULL stands for both null and absent."""

    def __init__(self, schema: T.StructType):
        self.types = {f.name: f.dataType for f in schema.fields}

    def prepare(self, df: DataFrame, names) -> DataFrame:
        return df

    def present(self, name: str) -> Column:
        return F.col(name).isNotNull() if name in self.types else F.lit(False)

    def is_null(self, name: str) -> Column:
        return F.col(name).isNull() if name in self.types else F.lit(True)

    def compare(self, name: str, op: str, literal) -> Column:
        kind = self.types.get(name)
        if kind is None:
            return F.lit(literal is None and op == "eq")
        column = F.col(name)
        if literal is None:
            return column.isNull() if op in ("eq", "gte", "lte") else F.lit(False)
        if isinstance(kind, T.ArrayType):
            if isinstance(literal, list):
                return column == F.array(*[F.lit(v) for v in literal])
            return F.exists(column, lambda item: _compare(op, item, F.lit(literal)))
        if isinstance(literal, bool):
            fits = isinstance(kind, T.BooleanType)
        elif isinstance(literal, (int, float)):
            fits = isinstance(kind, _NUMERIC)
        elif isinstance(literal, str):
            fits = isinstance(kind, T.StringType)
        else:
            fits = not isinstance(kind, (T.StringType, T.BooleanType, *_NUMERIC))
        return _compare(op, column, F.lit(literal)) if fits else F.lit(False)

    def size(self, name: str) -> Column:
        """Length of an array; null for anything else."""
        if isinstance(self.types.get(name), T.ArrayType):
            return F.size(F.col(name))
        return F.lit(None).cast("int")

    def number(self, name: str) -> Column:
        """A finite number; null for anything else."""
        if isinstance(self.types.get(name), _NUMERIC):
            return _finite(F.col(name), self.types[name])
        return F.lit(None).cast("double")

    def of_type(self, name: str, wanted: str) -> Column:
        kind = self.types.get(name)
        if kind is None:
            return F.lit(wanted == "null")
        if wanted == "null":
            return F.col(name).isNull()
        inner = kind.elementType if isinstance(kind, T.ArrayType) else None
        if _type_name(kind) == wanted:
            return F.col(name).isNotNull()
        if inner is not None and _type_name(inner) == wanted:
            return F.exists(F.col(name), lambda item: item.isNotNull())
        return F.lit(False)

    def elements(self, name: str) -> Column:
        """An array's elements as VARIANT; null for anything else."""
        kind = self.types.get(name)
        if not isinstance(kind, T.ArrayType):
            return F.lit(None).cast("array<variant>")
        items = F.col(name)
        if isinstance(kind.elementType, T.FloatType):
            items = items.cast("array<double>")
        return F.try_variant_get(F.to_variant_object(items), "$", "array<variant>")

    def matches(self, name: str, pattern: str) -> Column:
        if isinstance(self.types.get(name), T.StringType):
            return F.col(name).rlike(pattern)
        return F.lit(False)

    def contains(self, name: str, literal) -> Column:
        if isinstance(self.types.get(name), T.ArrayType):
            return F.array_contains(F.col(name), F.lit(literal))
        if isinstance(self.types.get(name), T.StringType) and isinstance(literal, str):
            return F.col(name).contains(literal)
        return F.lit(False)

    def sort_keys(self, name: str, ascending: bool) -> list[Column]:
        if name not in self.types:
            return []
        column = F.col(name)
        return [column.asc_nulls_first() if ascending else column.desc_nulls_last()]


def _finite(column: Column, kind: T.DataType) -> Column:
    if not isinstance(kind, (T.FloatType, T.DoubleType)):
        return column
    # Beyond this no whole number fits a long.
    return F.when(F.abs(column) < 2.0**63, column)


# Document names of column types.
_TYPE_NAMES = {
    T.StringType: "string", T.BooleanType: "bool", T.ByteType: "int", T.ShortType: "int",
    T.IntegerType: "int", T.LongType: "long", T.FloatType: "double", T.DoubleType: "double",
    T.DecimalType: "decimal", T.DateType: "date", T.TimestampType: "date",
    T.TimestampNTZType: "date", T.BinaryType: "binData", T.ArrayType: "array",
    T.StructType: "object", T.MapType: "object",
}


def _type_name(kind: T.DataType) -> str | None:
    return _TYPE_NAMES.get(type(kind))


def _variant_is(value: Column, kind: Column, wanted: str) -> Column:
    """Whether a VARIANT has a document type. Whole numbers are ``int`` if 32 bits
    hold them, else ``long``; all others are ``double``."""
    small = F.try_variant_get(value, "$", "int").isNotNull()
    tests = {
        "int": (kind == "BIGINT") & small,
        "long": (kind == "BIGINT") & ~small,
        "double": kind.isin("DOUBLE", "FLOAT") | kind.startswith("DECIMAL"),
        "string": kind == "STRING",
        "bool": kind == "BOOLEAN",
        "null": kind == "VOID",
        "array": kind.startswith("ARRAY"),
        "object": kind.startswith("OBJECT"),
        "date": kind.isin("DATE", "TIMESTAMP", "TIMESTAMP_NTZ"),
        "binData": kind == "BINARY",
    }
    return tests.get(wanted, F.lit(False))


class _VariantFields:
    """Shared behaviour of fields whose values are VARIANT.

    ``prepare`` looks the named fields up once per row; without it each use of
    a field repeats the lookup.
    """

    def __init__(self, column: str):
        self.column = column
        self.ready: dict[str, str] = {}

    def lookup(self, name: str) -> Column:
        raise NotImplementedError

    def prepare(self, df: DataFrame, names) -> DataFrame:
        new = {}
        for name in dict.fromkeys(names):
            label = f"__f{len(self.ready)}"
            self.ready[name] = label
            new[label] = self.lookup(name)
        if not new:
            return df
        df = once(df, **new)
        return once(df, **{f"{v}k": variant_kind(F.col(v)) for v in new})

    def value(self, name: str) -> Column:
        return F.col(self.ready[name]) if name in self.ready else self.lookup(name)

    def kind(self, name: str) -> Column:
        label = self.ready.get(name)
        return F.col(f"{label}k") if label else variant_kind(self.lookup(name))

    def present(self, name: str) -> Column:
        return self.value(name).isNotNull()

    def is_null(self, name: str) -> Column:
        value = self.value(name)
        return value.isNull() | F.is_variant_null(value)

    def compare(self, name: str, op: str, literal) -> Column:
        if literal is None and op == "eq":
            return self.is_null(name)
        return any_element(
            self.value(name), self.kind(name),
            lambda v, kind: _variant_scalar(v, kind, op, literal),
        )

    def matches(self, name: str, pattern: str) -> Column:
        def test(v, kind):
            return (kind == "STRING") & F.try_variant_get(v, "$", "string").rlike(pattern)

        return any_element(self.value(name), self.kind(name), test)

    def contains(self, name: str, literal) -> Column:
        value, kind = self.value(name), self.kind(name)
        items = F.try_variant_get(value, "$", "array<variant>")
        found = F.exists(items, lambda v: _variant_scalar(v, variant_kind(v), "eq", literal))
        test = F.when(kind.startswith("ARRAY"), found)
        if isinstance(literal, str):
            text = F.try_variant_get(value, "$", "string")
            test = test.when(kind == "STRING", text.contains(literal))
        return test.otherwise(F.lit(False))

    def size(self, name: str) -> Column:
        items = F.try_variant_get(self.value(name), "$", "array<variant>")
        return F.when(self.kind(name).startswith("ARRAY"), F.size(items))

    def of_type(self, name: str, wanted: str) -> Column:
        return any_element(
            self.value(name), self.kind(name), lambda v, kind: _variant_is(v, kind, wanted)
        )

    def elements(self, name: str) -> Column:
        """An array's elements; null for anything else."""
        items = F.try_variant_get(self.value(name), "$", "array<variant>")
        return F.when(self.kind(name).startswith("ARRAY"), items)

    def number(self, name: str) -> Column:
        value, kind = self.value(name), self.kind(name)
        whole = F.try_variant_get(value, "$", "bigint")
        real = _finite(F.try_variant_get(value, "$", "double"), T.DoubleType()).cast("bigint")
        return F.when(kind == "BIGINT", whole).when((kind == "DOUBLE") | kind.startswith("DECIMAL"), real)

    def sort_keys(self, name: str, ascending: bool) -> list[Column]:
        """Null and absent first, then numbers, then text, then the rest."""
        value, kind = self.value(name), self.kind(name)
        number = F.try_variant_get(value, "$", "double")
        rank = (
            F.when(kind.isNull() | (kind == "VOID"), 0)
            .when((kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL"), 1)
            .when(kind == "STRING", 2)
            .otherwise(3)
        )
        text = F.try_variant_get(value, "$", "string")
        keys = [rank, F.when(rank == 1, number), F.when(rank == 2, text), F.when(rank != 2, F.to_json(value))]
        return [k.asc() if ascending else k.desc() for k in keys]


class MapFields(_VariantFields):
    """Entries of a ``map<string,variant>`` column."""

    def __init__(self, column: str = "data"):
        super().__init__(column)

    def lookup(self, name: str) -> Column:
        return F.col(self.column)[name]


class DocFields(_VariantFields):
    """Dotted paths inside a VARIANT column."""

    def __init__(self, column: str = "doc"):
        super().__init__(column)

    def lookup(self, name: str) -> Column:
        steps = "".join(f"['{part}']" for part in name.split("."))
        return F.try_variant_get(F.col(self.column), "$" + steps, "variant")


class ElementFields(_VariantFields):
    """Paths inside one VARIANT, such as an element of an array; the empty path
    is the value itself."""

    def __init__(self, element: Column):
        super().__init__("")
        self.element = element

    def lookup(self, name: str) -> Column:
        if not name:
            return self.element
        steps = "".join(f"['{part}']" for part in name.split("."))
        return F.try_variant_get(self.element, "$" + steps, "variant")


def fields_of(df: DataFrame, column: str | None = None):
    """Pick the shape of ``df``: a ``data`` map, a ``doc`` VARIANT, or typed."""
    types = {f.name: f.dataType for f in df.schema.fields}
    for name in [column] if column else ["data", "doc"]:
        kind = types.get(name)
        if isinstance(kind, T.MapType) and isinstance(kind.valueType, T.VariantType):
            return MapFields(name)
        if isinstance(kind, T.VariantType):
            return DocFields(name)
    return TypedFields(df.schema)


# ------------------------------------------------- editing variant maps

def put(data: Column, name: str, value: Column) -> Column:
    """The map with one entry set."""
    rest = F.map_filter(data, lambda k, _: k != name)
    return F.map_concat(rest, F.create_map(F.lit(name), value))


def edit(data: Column, values: dict[str, Column]) -> Column:
    """The map with several entries set, or removed where the value is NULL."""
    names = list(values)
    rest = F.map_filter(data, lambda k, _: ~k.isin(names))
    pairs = [c for n in names for c in (F.lit(n), values[n])]
    new = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
    return F.map_concat(rest, new)


def as_map(doc: Column) -> Column:
    """Entries of a VARIANT object; NULL when it is not an object."""
    return F.try_variant_get(doc, "$", "map<string,variant>")


def set_path(doc: Column, path: str, value: Column) -> Column:
    """The VARIANT object with one (possibly dotted) path set."""
    head, _, tail = path.partition(".")
    empty = F.from_json(F.lit("{}"), "map<string,variant>")
    entries = F.coalesce(as_map(doc), empty)
    inner = set_path(entries[head], tail, value) if tail else value
    return F.to_variant_object(put(entries, head, inner))


def unset_path(doc: Column, path: str) -> Column:
    """The VARIANT object without one (possibly dotted) path."""
    head, _, tail = path.partition(".")
    entries = as_map(doc)
    if tail:
        inner = entries[head]
        entries = F.when(as_map(inner).isNotNull(), put(entries, head, unset_path(inner, tail)))
    else:
        entries = F.map_filter(entries, lambda k, _: k != head)
    return F.coalesce(F.to_variant_object(entries), doc)


def add_to(value: Column, amount) -> Column:
    """A VARIANT number plus a literal; the literal where there is no value.
    Anything but a number fails the job."""
    kind = variant_kind(value)
    real = F.try_variant_get(value, "$", "double")
    whole = F.lit(False)
    if isinstance(amount, int):
        whole = kind == "BIGINT"
    exact = (F.try_variant_get(value, "$", "bigint") + F.lit(int(amount))).cast("variant")
    wrong = F.raise_error(F.concat(F.lit("$inc needs a number, found "), kind)).cast("variant")
    return (
        F.when(value.isNull(), as_variant(amount))
        .when(whole, exact)
        .when(real.isNotNull() & ~kind.isin("STRING", "BOOLEAN"), (real + F.lit(float(amount))).cast("variant"))
        .otherwise(wrong)
    )


def append_to(value: Column, items: list) -> Column:
    """A VARIANT array with literals added; a new array where there is none.
    Anything but an array fails the job."""
    kind = variant_kind(value)
    new = F.array(*[as_variant(item) for item in items])
    wrong = F.raise_error(F.concat(F.lit("$push needs an array, found "), kind)).cast("variant")
    held = F.try_variant_get(value, "$", "array<variant>")
    return (
        F.when(value.isNull(), F.to_variant_object(new))
        .when(kind.startswith("ARRAY"), F.to_variant_object(F.concat(held, new)))
        .otherwise(wrong)
    )
