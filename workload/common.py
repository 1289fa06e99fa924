"""Registry of queries and the inputs they share.

Every query reads the whole given tables. ``sql`` is the same result in DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import shared_dir
from millrace.sources import ingest
from millrace.streaming.sinks import drain

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def is_folder(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).isDirectory()


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream, whether it is one file or a folder of files."""
    path = f"{sf_dir}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    if is_folder(spark, path):
        return ingest.file_stream(spark, path, schema)
    return ingest.file_stream(spark, sf_dir, schema, glob=f"{name}.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream with a watermarkable time."""
    return stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def drained(df: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Run a stream to its end into the shared folder and read the result."""
    spark = df.sparkSession
    root = shared_dir(spark, label)
    drain(df, f"{root}/out", f"{root}/checkpoint", mode)
    return spark.read.schema(df.schema).parquet(f"{root}/out").select(*df.columns)


def ntz(df: DataFrame, *names: str) -> DataFrame:
    """Times without a zone, as DuckDB returns them."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


# ------------------------------------------------ events as a JSON topic

def _body(fields: list[Column]) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def message(df: DataFrame) -> Column:
    """An event as JSON text, with the faults a topic carries: text that is not
    JSON, JSON that is not an object, null keys and missing keys."""
    n = F.col("event_id")
    base = [
        F.concat(F.lit("evt_"), n.cast("string")).alias("id"),
        F.col("event_type"),
        F.col("value"),
    ]
    nothing = F.lit(None).cast("bigint").alias("user_id")
    return (
        F.when(n % 97 == 0, "not json")
        .when(n % 89 == 0, "[1]")
        .when(n % 83 == 0, "null")
        .when(n % 103 == 0, _body(base))
        .when(n % 101 == 0, _body([*base, nothing]))
        .otherwise(_body([*base, F.col("user_id")]))
    )


def as_topic(df: DataFrame, topic: str = "events", *extra: str) -> DataFrame:
    return df.select(
        *extra,
        F.col("user_id").cast("string").alias("key"),
        message(df).alias("value"),
        F.lit(topic).alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def event_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_topic(events(spark, sf_dir))


# The same messages for DuckDB: why a record fails, and its key text.
MESSAGES = """messages AS (
  SELECT *,
    CASE WHEN event_id % 97 = 0 THEN 'malformed_json'
         WHEN event_id % 89 = 0 OR event_id % 83 = 0 THEN 'not_an_object' END AS decode_error,
    CASE WHEN event_id % 97 = 0 THEN 'malformed_json'
         WHEN event_id % 89 = 0 OR event_id % 83 = 0 THEN 'not_an_object'
         WHEN event_id % 103 = 0 THEN 'missing_key' END AS reason,
    CASE WHEN event_id % 101 = 0 THEN 'null' ELSE CAST(user_id AS VARCHAR) END AS key_value,
    'evt_' || event_id AS id
  FROM events)"""


# ------------------------------------------------------------ shared oracles

def anchor_cte(source: str, key: str, ts: str, tie: str, window: str, carry: str = "") -> str:
    """CTEs ``s`` (ranked rows) and ``verdicts`` (each with its anchor)."""
    return f"""s AS (
  SELECT {key} AS k, {ts} AS t, {carry + ',' if carry else ''}
         row_number() OVER (PARTITION BY {key} ORDER BY {ts}, {tie}) AS rn
  FROM {source}),
walk AS (
  SELECT k, rn, t AS anchor, true AS keep FROM s WHERE rn = 1
  UNION ALL
  SELECT s.k, s.rn,
         CASE WHEN s.t - walk.anchor > {window} THEN s.t ELSE walk.anchor END,
         s.t - walk.anchor > {window}
  FROM walk JOIN s ON s.k = walk.k AND s.rn = walk.rn + 1),
verdicts AS (
  SELECT s.*, walk.anchor, walk.keep FROM s JOIN walk ON s.k = walk.k AND s.rn = walk.rn)"""


def match_cte(source: str, window: str, replace: bool = False) -> str:
    """CTEs up to ``found(k, l, r, lt, rt)``: the one-to-one pairs of ``source``,
    which has columns k, id, ts and side (0 left, 1 right).

    Both waiting lists travel along each key's events in time order.
    """
    entry = "struct_pack(ts := ts, id := id)"
    own = "list_filter(m, lambda y: y.id <> id)" if replace else "m"
    return f"""ranked AS (
  SELECT k, id, ts, side, row_number() OVER (PARTITION BY k ORDER BY ts, id, side) AS rn
  FROM {source}),
steps AS (
  SELECT k, 0::BIGINT AS rn,
         []::STRUCT(ts TIMESTAMP, id BIGINT)[] AS lb, []::STRUCT(ts TIMESTAMP, id BIGINT)[] AS rb,
         NULL::BIGINT AS l, NULL::BIGINT AS r, NULL::TIMESTAMP AS lt, NULL::TIMESTAMP AS rt
  FROM (SELECT DISTINCT k FROM ranked)
  UNION ALL
  SELECT k, rn,
    CASE WHEN side = 1 THEN (CASE WHEN len(o) > 0 THEN o[2:] ELSE o END)
         WHEN len(o) > 0 THEN m ELSE list_append({own}, {entry}) END,
    CASE WHEN side = 0 THEN (CASE WHEN len(o) > 0 THEN o[2:] ELSE o END)
         WHEN len(o) > 0 THEN m ELSE list_append({own}, {entry}) END,
    CASE WHEN len(o) = 0 THEN NULL WHEN side = 0 THEN id ELSE o[1].id END,
    CASE WHEN len(o) = 0 THEN NULL WHEN side = 1 THEN id ELSE o[1].id END,
    CASE WHEN len(o) = 0 THEN NULL WHEN side = 0 THEN ts ELSE o[1].ts END,
    CASE WHEN len(o) = 0 THEN NULL WHEN side = 1 THEN ts ELSE o[1].ts END
  FROM (SELECT s.k, s.rn, s.id, s.ts, s.side,
          list_filter(CASE WHEN s.side = 0 THEN p.rb ELSE p.lb END,
                      lambda y: s.ts - y.ts <= {window}) AS o,
          list_filter(CASE WHEN s.side = 0 THEN p.lb ELSE p.rb END,
                      lambda y: s.ts - y.ts <= {window}) AS m
        FROM steps p JOIN ranked s ON s.k = p.k AND s.rn = p.rn + 1) q),
found AS (SELECT k, l, r, lt, rt FROM steps WHERE l IS NOT NULL)"""


PURCHASE_CLICK = """sides AS (
  SELECT CAST(user_id AS VARCHAR) AS k, event_id AS id, ts, (event_type = 'click')::INT AS side
  FROM events WHERE event_type IN ('purchase', 'click'))"""


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Purchases as the left events and clicks as the right ones."""
    rows = events(spark, sf_dir)
    return rows.filter("event_type = 'purchase'"), rows.filter("event_type = 'click'")
