"""Tables kept in the shared folder while a job runs.

A staged table is Parquet under ``spark.checkpoint.dir``, so a lost executor
costs its running tasks only and no lineage is replayed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import shared_dir


def staged(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The frame written to and read back from a fresh folder, and its path."""
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def packed(df: DataFrame) -> Column:
    """All columns of a frame as one struct, so that no name can clash."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def unpacked(row: str, columns: list[str], leave_out: list[str] = ()) -> list[Column]:
    """The columns of a packed row again, but for those named in ``leave_out``."""
    gone = {c.lower() for c in leave_out}
    return [F.col(f"{row}.`{c}`").alias(c) for c in columns if c.lower() not in gone]


def numbered(df: DataFrame, label: str, block_rows: int, **extra: Column) -> DataFrame:
    """A staged copy (block long, pos long, row struct, extras).

    A block is a run of at most ``block_rows`` rows of one input partition. The
    numbers are written with the rows, so later reads and retries agree on them.
    """
    at = F.monotonically_increasing_id()
    rows = df.select(packed(df).alias("row"), at.alias("at"), *[c.alias(n) for n, c in extra.items()])
    part, index = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    rows = rows.select(
        F.shiftleft(part, 33).bitwiseOR((index / block_rows).cast("long")).alias("block"),
        index.alias("pos"), *extra, "row",
    )
    return staged(rows, label)[0]


def ascii_lower(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())
