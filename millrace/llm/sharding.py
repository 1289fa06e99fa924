"""A uniform shuffle into shards of exact sizes.

Rows lie in blocks, runs of one input partition. A communication matrix says how
many rows each block sends to each shard: its rows are multivariate
hypergeometric draws from the places still free in the shards, so that every
shard gets exactly its size and every assignment is equally likely. Each block is
permuted and cut by its row of the matrix; each shard is permuted again.

The matrix is drawn on the driver, one line of ``shards`` numbers for ``BLOCK``
rows. The permutation of a shard is by cells of a random key, about ``CELL`` rows
each, so no task holds a shard. Only row numbers are sorted; the rows themselves
move once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.draws import multivariate_hypergeometric
from millrace.llm.staging import numbered, staged, unpacked

BLOCK, CELL = 1 << 16, 1 << 15


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Counts at most one apart."""
    return [rows // shards + (k < rows % shards) for k in range(shards)]


def communication_matrix(counts: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """For each block, the number of its rows that go to each shard."""
    rng = np.random.default_rng(seed)
    free, matrix = list(sizes), []
    for count in counts:
        drawn = multivariate_hypergeometric(free, count, rng)
        free = [f - d for f, d in zip(free, drawn)]
        matrix.append(drawn)
    return matrix


def scaled(key: Column, parts: int | Column) -> Column:
    """The upper half of a 64-bit key, scaled to 0 .. parts - 1."""
    return F.shiftright(F.shiftrightunsigned(key, 32) * parts, 32)


def assigned(rows: DataFrame, shards: int, seed: int) -> DataFrame:
    """(block, pos, shard int, slot long) of each numbered row."""
    spark = rows.sparkSession
    counts = sorted(rows.groupBy("block").count().collect())
    sizes = shard_sizes(sum(r["count"] for r in counts), shards)
    matrix = communication_matrix([r["count"] for r in counts], sizes, seed)
    bounds = pa.table({
        "block": pa.array([r.block for r in counts], pa.int64()),
        "bounds": pa.array([np.cumsum(m)[:-1].tolist() for m in matrix], pa.list_(pa.int64())),
    })
    key = F.xxhash64(F.lit(seed), "block", "pos")
    local = Window.partitionBy("block").orderBy(key, "pos")
    sent = rows.select("block", "pos", F.row_number().over(local).alias("rank"))
    sent = sent.join(spark.createDataFrame(bounds), "block")
    shard = F.size(F.filter("bounds", lambda b: b < F.col("rank"))).alias("shard")
    again = F.xxhash64(F.lit(seed + 1), "block", "pos")
    cell = scaled(again, -(-max(sizes) // CELL) or 1)
    sent, _ = staged(sent.select("block", "pos", shard, again.alias("key"), cell.alias("cell")), "shard-rows")
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = sent.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    cells = cells.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("key", "block", "pos"))
    slots = sent.withColumn("place", place).join(cells, ["shard", "cell"])
    return slots.select("block", "pos", "shard", (F.col("first") + F.col("place") - 1).alias("slot"))


def shuffled(df: DataFrame, shards: int, seed: int = 2) -> DataFrame:
    """The rows with ``shard`` (0 to shards - 1) and ``slot``, the place in it.

    Repeated rows, null and empty values are rows like any other. A column of
    the input named shard or slot is replaced. The same input files and read
    settings give the same shuffle.
    """
    rows = numbered(df, "shard-input", BLOCK)
    places = assigned(rows.drop("row"), shards, seed)
    moved = rows.join(places, ["block", "pos"])
    return moved.select(*unpacked("row", df.columns, ["shard", "slot"]), "shard", "slot")


def sharded_documents(docs: DataFrame, shards: int = 8, seed: int = 2) -> DataFrame:
    """Where each row of ``docs(doc_id, text)`` goes, with its size and checksum."""
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    grown = F.lit(None).cast("int").alias("grown_shard")
    return shuffled(rows, shards, seed).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", grown)
