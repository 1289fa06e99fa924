"""Text form of a key so that equal values meet across types and sides.

Strings stay as they are, numbers print without a trailing ``.0``, booleans,
arrays and objects print as JSON, and null is the text ``null`` (so nulls equal
each other). An absent field gives SQL NULL, which callers treat as an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NESTED = (T.StructType, T.ArrayType, T.MapType)
_EXACT_DOUBLE = 9.0e15
# JSON numbers that may be whole although not written as integers.
_FLOAT_JSON = r"^-?[0-9]+(\.0+$|\.?[0-9]*[eE])"


def _number_text(wide: Column, otherwise: Column) -> Column:
    whole = (wide == F.floor(wide)) & (F.abs(wide) < F.lit(_EXACT_DOUBLE))
    return F.when(whole, wide.cast("bigint").cast("string")).otherwise(otherwise)


def variant_key(value: Column) -> Column:
    """Key text of a VARIANT; SQL NULL (field absent) stays NULL."""
    text = F.to_json(value)
    number = F.try_variant_get(value, "$", "double")
    return (
        F.when(text.startswith('"'), F.try_variant_get(value, "$", "string"))
        .when(text.rlike(_FLOAT_JSON), _number_text(number, text))
        .otherwise(text)
    )


def typed_key(value: Column, dtype: T.DataType) -> Column:
    """Key text of a typed column; SQL NULL is the JSON null key."""
    if isinstance(dtype, T.VariantType):
        return variant_key(value)
    if isinstance(dtype, T.StringType) or isinstance(dtype, _INTEGRAL):
        text = value.cast("string")
    elif isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        text = _number_text(value.cast("double"), value.cast("string"))
    elif isinstance(dtype, _NESTED):
        text = F.to_json(value)
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit("null"))


def canonical_key(df: DataFrame, field: str) -> Column:
    """Key text of a (possibly dotted) column of ``df``."""
    column = F.col(field)
    return typed_key(column, df.select(column).schema[0].dataType)
