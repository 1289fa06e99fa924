"""From raw topic records to decoded events, with a dead-letter side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.fields import MapFields, as_variant, edit, fields_of, once
from millrace.functions.keys import variant_key

# The columns every topic-shaped frame has (those of Spark's Kafka source).
TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
# Fixed value: the largest fetch of the original consumer, in bytes.
MAX_FETCH_BYTES = 10_000_000


def topic_stream(
    spark: SparkSession,
    topic: str,
    brokers: str,
    start: str = "latest",
    max_offsets: int | None = None,
    **options: str,
) -> DataFrame:
    """A Kafka topic as a stream (needs the Kafka connector on the classpath)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
        .option("kafka.max.partition.fetch.bytes", str(MAX_FETCH_BYTES))
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets))
    for name, value in options.items():
        reader = reader.option(name, value)
    raw = reader.load()
    return raw.withColumns({c: F.col(c).cast("string") for c in ("key", "value")})


def topic_files(
    spark: SparkSession, path: str, files_per_trigger: int | None = None, glob: str | None = None
) -> DataFrame:
    """Topic-shaped parquet files as a stream, in order of modification time."""
    return file_stream(spark, path, TOPIC_SCHEMA, files_per_trigger, glob)


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files_per_trigger: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def join_streams(
    spark: SparkSession, left_topic: str, right_topic: str, brokers: str, **options
) -> tuple[DataFrame, DataFrame]:
    """Two independent topic streams."""
    return (
        topic_stream(spark, left_topic, brokers, **options),
        topic_stream(spark, right_topic, brokers, **options),
    )


def json_decode(df: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Decode ``value`` into ``data`` and set ``error_reason`` on failure.

    Without a schema ``data`` is ``map<string,variant>``; with one it is that
    struct. Text that is not JSON, and JSON that is not an object, are errors.
    """
    text = F.col("value").cast("string")
    if schema is None:
        rows = once(df, __parsed=F.try_parse_json(text))
        entries = F.try_variant_get(F.col("__parsed"), "$", "map<string,variant>")
        rows = once(rows, __entries=entries)
        reason = F.when(F.col("__parsed").isNull(), "malformed_json").when(
            F.col("__entries").isNull(), "not_an_object"
        )
        return rows.select(
            *df.columns, F.col("__entries").alias("data"), reason.alias("error_reason")
        )
    corrupt = "__corrupt"
    wide = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    rows = once(df, __row=F.from_json(text, wide, options))
    is_object = text.rlike(r"^[ \t\r\n]*\{")
    broken = text.isNull() | F.col(f"__row.{corrupt}").isNotNull()
    reason = (
        F.when(broken & ~F.coalesce(is_object, F.lit(False)) & F.try_parse_json(text).isNotNull(),
               "not_an_object")
        .when(broken, "malformed_json")
        .when(~is_object, "not_an_object")
    )
    rows = once(rows, error_reason=reason)
    body = F.when(F.col("error_reason").isNull(), F.col("__row").dropFields(corrupt))
    return rows.select(*df.columns, body.alias("data"), "error_reason")


def require_key(df: DataFrame, field: str, out: str = "key_value") -> DataFrame:
    """Add the key text of ``data[field]``; an absent field is an error."""
    value = F.col("data")[field]
    key = variant_key(value)
    missing = F.when(F.col("error_reason").isNull() & value.isNull(), "missing_key")
    return df.withColumn(out, key).withColumn(
        "error_reason", F.coalesce(F.col("error_reason"), missing)
    )


def ensure_id(df: DataFrame, field: str = "id", out: str = "event_id") -> DataFrame:
    """Event id text; records without one get a hash of their topic position."""
    position = F.sha1(F.concat_ws("/", "topic", "partition", "offset"))
    return df.withColumn(out, F.coalesce(variant_key(F.col("data")[field]), position))


def metadata_columns() -> dict[str, Column]:
    """The record's topic position and times."""
    return {
        "_kafka_topic": F.col("topic"),
        "_kafka_partition": F.col("partition"),
        "_kafka_offset": F.col("offset"),
        "_kafka_timestamp": F.col("timestamp"),
        "_processed_at": F.current_timestamp(),
    }


def ingest_metadata(df: DataFrame) -> DataFrame:
    """Add ``metadata_columns`` as entries of a ``data`` map when there is one,
    else as columns."""
    stamps = metadata_columns()
    if not isinstance(fields_of(df), MapFields):
        return df.withColumns(stamps)
    entries = {name: as_variant(value) for name, value in stamps.items()}
    return df.withColumn("data", edit(F.col("data"), entries))


def event_time(df: DataFrame, source: str = "timestamp", out: str = "event_time") -> DataFrame:
    """Choose the column that orders events; never the wall clock, so that a
    rerun gives the same result."""
    return df.withColumn(out, F.col(source))


def split_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, dead letters)."""
    good = df.filter(F.col("error_reason").isNull()).drop("error_reason")
    return good, df.filter(F.col("error_reason").isNotNull())


def to_topic(
    df: DataFrame,
    key: str,
    topic: str,
    partition: Column | None = None,
    offset: Column | None = None,
    timestamp: Column | None = None,
    value_columns: list[str] | None = None,
) -> DataFrame:
    """Rows as topic records: key text and the row as JSON.

    A ``data`` map column is written as the object itself. The position columns
    are only for building test topics; a Kafka writer ignores them.
    """
    columns = value_columns or df.columns
    body = F.col("data") if columns == ["data"] else F.struct(*columns)
    if key in df.columns:
        name = F.col(key).cast("string")
    else:
        name = variant_key(F.col("data")[key])
    out = {
        "key": name,
        "value": F.to_json(body, {"ignoreNullFields": "false"}),
        "topic": F.lit(topic),
    }
    for label, column in (("partition", partition), ("offset", offset), ("timestamp", timestamp)):
        if column is not None:
            out[label] = column
    return df.select(*[c.alias(n) for n, c in out.items()])
