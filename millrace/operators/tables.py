"""Target tables: alignment, defaults, required columns, order and retention."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str
    nullable: bool = True
    default: str | None = None  # a SQL literal


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    order_by: tuple[str, ...] = field(default=())
    ttl_column: str | None = None
    ttl: str | None = None  # a SQL interval body such as "90 DAY"

    def schema(self) -> T.StructType:
        out = T.StructType()
        for c in self.columns:
            out = out.add(c.name, T._parse_datatype_string(c.type), c.nullable)
        return out


# The three result tables, their required columns, defaults,
# orders and retention times.
USER_SESSIONS_CLEAN = TableSpec(
    "user_sessions_clean",
    (
        ColumnSpec("session_id", "string", False),
        ColumnSpec("user_id", "string", False),
        ColumnSpec("timestamp", "timestamp", False),
        ColumnSpec("page_url", "string"),
        ColumnSpec("user_agent", "string"),
        ColumnSpec("ip_address", "string"),
        ColumnSpec("session_duration", "bigint"),
        ColumnSpec("page_views", "int", True, "1"),
    ),
    ("timestamp", "session_id"),
    "timestamp",
    "90 DAY",
)
ENRICHED_TRANSACTIONS = TableSpec(
    "enriched_transactions",
    (
        ColumnSpec("transaction_id", "string", False),
        ColumnSpec("user_id", "string", False),
        ColumnSpec("timestamp", "timestamp", False),
        ColumnSpec("amount", "decimal(10,2)", False),
        ColumnSpec("currency", "string", False, "'USD'"),
        ColumnSpec("merchant_name", "string"),
        ColumnSpec("category", "string"),
        ColumnSpec("user_name", "string"),
        ColumnSpec("user_email", "string"),
        ColumnSpec("user_tier", "string"),
        ColumnSpec("user_country", "string"),
    ),
    ("timestamp", "user_id"),
    "timestamp",
    "7 YEAR",
)
REAL_TIME_ANALYTICS = TableSpec(
    "real_time_analytics",
    (
        ColumnSpec("event_id", "string", False),
        ColumnSpec("event_type", "string", False),
        ColumnSpec("timestamp", "timestamp", False),
        ColumnSpec("user_id", "string"),
        ColumnSpec("session_id", "string"),
        ColumnSpec("properties", "string"),
        ColumnSpec("device_type", "string"),
        ColumnSpec("platform", "string"),
        ColumnSpec("country", "string"),
        ColumnSpec("value", "double"),
    ),
    ("timestamp", "event_type"),
    "timestamp",
    "30 DAY",
)


def align_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The table's columns in order and type; absent ones become NULL and
    columns the table lacks are left out (see ``extra_columns``). A value that
    does not convert is NULL; ``load_rows`` makes its row a dead letter."""
    return df.select(*_aligned(df, spec))


def _aligned(df: DataFrame, spec: TableSpec) -> list[Column]:
    out = []
    for c in spec.columns:
        if c.name not in df.columns:
            out.append(F.lit(None).cast(c.type).alias(c.name))
            continue
        column = F.col(c.name)
        if c.type == "string" and _is_nested(df.schema[c.name].dataType):
            column = F.to_json(column)
        elif c.type == "timestamp":
            column = F.date_trunc("second", column.try_cast("timestamp"))
        else:
            column = column.try_cast(c.type)
        out.append(column.alias(c.name))
    return out


def extra_columns(df: DataFrame, spec: TableSpec) -> list[str]:
    known = {c.name for c in spec.columns}
    return [c for c in df.columns if c not in known]


def _is_nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StructType, T.MapType, T.VariantType))


def convert_values(df: DataFrame) -> DataFrame:
    """Times as ``yyyy-MM-dd HH:mm:ss`` text, objects as JSON text; arrays and
    scalars unchanged."""
    out = []
    for f in df.schema.fields:
        column = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif _is_nested(f.dataType):
            column = F.to_json(column)
        out.append(column.alias(f.name))
    return df.select(*out)


def apply_defaults(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Fill NULLs of columns that declare a default."""
    return df.withColumns(
        {
            c.name: F.coalesce(F.col(c.name), F.expr(c.default).cast(c.type))
            for c in spec.columns
            if c.default is not None
        }
    )


def split_required(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """(rows with every required column, the others with ``error_reason``)."""
    reason = F.coalesce(
        *[
            F.when(F.col(c.name).isNull(), f"null_{c.name}")
            for c in spec.columns
            if not c.nullable
        ],
        F.lit(None).cast("string"),
    )
    if "__misfit" in df.columns:
        reason = F.coalesce("__misfit", reason)
    marked = df.withColumn("error_reason", reason).drop("__misfit")
    return (
        marked.filter(F.col("error_reason").isNull()).drop("error_reason"),
        marked.filter(F.col("error_reason").isNotNull()),
    )


def apply_defaults_not_null(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    return split_required(apply_defaults(df, spec), spec)


def sort_key(df: DataFrame, spec: TableSpec, partitions: int | None = None) -> DataFrame:
    """Order rows for writing. Files are sorted inside; with ``partitions`` they
    also cover disjoint ranges, so readers can skip files."""
    if not spec.order_by:
        return df
    if partitions:
        df = df.repartitionByRange(partitions, *spec.order_by)
    return df.sortWithinPartitions(*spec.order_by)


def retention(df: DataFrame, ts: str, ttl: str, as_of: datetime) -> DataFrame:
    """Rows newer than ``as_of`` minus the time to live, and those without a time.

    The caller says what time it is: a stray row from the future must not expire
    the rest. The limit is a literal, so the filter reaches the file scan.
    """
    limit = F.lit(as_of).cast(df.schema[ts].dataType) - F.expr(f"INTERVAL {ttl}")
    return df.filter(F.col(ts).isNull() | (F.col(ts) > limit))


def load_rows(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """Align, fill defaults and split off rows that break a requirement or hold
    a value that is not of its column's type."""
    rows = apply_defaults(df.select(*_aligned(df, spec), _misfit(df, spec).alias("__misfit")), spec)
    return split_required(rows, spec)


def _misfit(df: DataFrame, spec: TableSpec) -> Column:
    """The first column whose value does not convert, with the value."""
    tests = []
    for c in spec.columns:
        if c.name in df.columns and not _is_nested(df.schema[c.name].dataType):
            lost = F.col(c.name).isNotNull() & F.col(c.name).try_cast(c.type).isNull()
            shown = F.concat(F.lit(f"bad_{c.name}: "), F.col(c.name).cast("string"))
            tests.append(F.when(lost, shown))
    return F.coalesce(*tests, F.lit(None).cast("string"))


def create_table(spark: SparkSession, spec: TableSpec, database: str, location: str) -> str:
    """A catalog table at ``location``. Defaults and required columns are
    enforced by ``load_rows``; order and retention are kept as properties."""
    columns = ", ".join(f"`{c.name}` {c.type}" for c in spec.columns)
    full = f"`{database}`.`{spec.name}`"
    properties = {"order_by": ",".join(spec.order_by), "ttl": spec.ttl or ""}
    listed = ", ".join(f"'{k}'='{v}'" for k, v in properties.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {full} ({columns}) USING parquet "
        f"LOCATION '{location}' TBLPROPERTIES ({listed})"
    )
    return full


def session_rows(events: DataFrame) -> DataFrame:
    """Raw session events under the names of the session table."""
    return events.withColumnsRenamed({"page": "page_url", "duration_ms": "session_duration"})


def transaction_rows(joined: DataFrame) -> DataFrame:
    """Joined events flattened to transaction columns plus the user's profile."""
    left = joined.schema["left_data"].dataType.names
    right = joined.schema["right_data"].dataType.names
    kept = [F.col(f"left_data.{n}").alias(n) for n in left]
    user = [
        F.col(f"right_data.{n}").alias(f"user_{n}")
        for n in ("name", "email", "tier", "country")
        if n in right
    ]
    return joined.select(*kept, *user)
