"""Mixing sources to target weights by a splitting tree.

A source's target in words is filled with whole passes over it and one part of a
pass. Each source is dealt into blocks by a hash; a block of one pass is one
quota unit. The quotas of all sources are split among the output shards by a
binary tree: at each node a multivariate hypergeometric draw says how many blocks
of each source the left half of the shards gets. A shard then takes the next
blocks of each source's permuted list, so all draws are disjoint, and orders its
rows by a random key.

The driver holds one line for each source. Sums along a source go by block, so
a source with a third of all rows is no task's work.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.draws import multivariate_hypergeometric
from millrace.llm.sharding import scaled, shard_sizes
from millrace.llm.staging import numbered, staged, unpacked

WEIGHTS = (1, 2, 3)
MOST = 3
BLOCK = 1 << 12
# Up to so many sources, the table of sources is broadcast (a few MB).
SMALL = 20_000


def words(text: Column) -> Column:
    """Number of runs without blanks; none in a null text. The work grows with
    the text's length, however many blanks stand together."""
    blank = r"[\x20\x09-\x0D]"
    text = text.cast("string")
    # An empty part stands before a leading and after a trailing run of blanks.
    edges = F.substring(text, 1, 1).rlike(blank).cast("int") + F.substring(text, -1, 1).rlike(blank).cast("int")
    parts = F.size(F.split(text, f"{blank}+")) - edges
    return F.when(text.isNull() | (text == ""), 0).otherwise(parts).cast("long")


def targets(sizes: list[int], weights: list[float], most: int = MOST) -> list[float]:
    """Words for each source: shares of the total by weight, none above ``most``
    times its size; what a source cannot take is shared among the others."""
    left, open_, out = float(sum(sizes)), list(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = unit * weights[i]
            break
        for i in full:
            out[i] = float(most * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in set(full)]
    return out


def splitting_tree(quotas: list[int], shards: int, seed: int) -> list[list[int]]:
    """For each shard, its number of blocks of each source."""
    rng = np.random.default_rng(seed)
    sizes = shard_sizes(sum(quotas), shards)

    def split(low, high, here):
        if high - low == 1:
            return [here]
        middle = (low + high) // 2
        left = multivariate_hypergeometric(here, sum(sizes[low:middle]), rng)
        return split(low, middle, left) + split(middle, high, [h - x for h, x in zip(here, left)])

    return split(0, shards, list(quotas))


def _sources(spark, table: dict[str, pa.Array]) -> DataFrame:
    frame = spark.createDataFrame(pa.table(table))
    return F.broadcast(frame) if len(table["number"]) <= SMALL else frame


def planned(rows: DataFrame, shards: int, seed: int) -> DataFrame:
    """(block, pos, size, source_size, target, copies, shards array<int>) of
    numbered rows (block, pos, source, size, tag): how often each is taken and
    which shard each copy goes to."""
    spark = rows.sparkSession
    found = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    found = sorted(found, key=lambda r: (r.source is None, r.source))
    weights = [WEIGHTS[k % len(WEIGHTS)] for k in range(len(found))]
    target = targets([r["size"] for r in found], weights)
    passes = [min(MOST, int(t // r["size"])) if r["size"] else 0 for r, t in zip(found, target)]
    table = {
        "source": pa.array([r.source for r in found], pa.string()),
        "number": pa.array(range(len(found)), pa.int32()),
        "source_size": pa.array([r["size"] for r in found], pa.int64()),
        "target": pa.array(target, pa.float64()),
        "passes": pa.array(passes, pa.int32()),
        "part": pa.array([t - p * r["size"] for r, t, p in zip(found, target, passes)], pa.float64()),
        "blocks": pa.array([-(-r["n"] // BLOCK) for r in found], pa.int64()),
    }
    sources = _sources(spark, table).withColumnRenamed("source", "of")
    dealt = rows.join(sources, F.col("source").eqNullSafe(F.col("of")))
    unit = scaled(F.col("tag"), F.col("blocks")).alias("unit")
    dealt = dealt.select("block", "pos", "size", "tag", "number", "source_size", "target", "passes", "part", unit)

    # Where each block begins in its source's part pass.
    mixed = F.xxhash64(F.lit(seed), "number", "unit")
    before = Window.partitionBy("number").orderBy(mixed, "unit").rowsBetween(Window.unboundedPreceding, -1)
    units = dealt.groupBy("number", "unit").agg(F.sum("size").alias("size"), F.first("passes").alias("passes"), F.first("part").alias("part"))
    units = units.withColumn("first", F.coalesce(F.sum("size").over(before), F.lit(0)))
    taken = F.col("passes") + (F.col("first") < F.col("part")).cast("int")
    units, _ = staged(units.select("number", "unit", "first", taken.alias("times")), "mix-blocks")

    # The shard of each block of each pass.
    quota = {r.number: r.q for r in units.groupBy("number").agg(F.sum("times").alias("q")).collect()}
    leaves = splitting_tree([quota.get(k, 0) for k in range(len(found))], shards, seed)
    bounds = np.cumsum(np.array(leaves, dtype=np.int64).reshape(shards, len(found)), axis=0).T[:, :-1]
    bounds = _sources(spark, {"number": table["number"], "bounds": pa.array(bounds.tolist(), pa.list_(pa.int64()))})
    each = units.filter("times > 0").select("number", "unit", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("turn"))
    drawn = Window.partitionBy("number").orderBy(F.xxhash64(F.lit(seed + 1), "number", "unit", "turn"), "unit", "turn")
    each = each.withColumn("rank", F.row_number().over(drawn)).join(bounds, "number")
    shard = F.size(F.filter("bounds", lambda b: b < F.col("rank")))
    each = each.groupBy("number", "unit").agg(F.sort_array(F.collect_list(F.struct("turn", shard.alias("shard")))).alias("turns"))
    units = units.join(each, ["number", "unit"], "left").select("number", "unit", "first", F.col("turns.shard").alias("to"))

    inside = Window.partitionBy("number", "unit").orderBy("tag", "block", "pos").rowsBetween(Window.unboundedPreceding, -1)
    dealt = dealt.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(units, ["number", "unit"])
    fits = (F.col("part") > 0) & (F.col("first") + F.col("within") + F.col("size") / 2 <= F.col("part"))
    copies = (F.col("passes") + fits.cast("int")).alias("copies")
    dealt = dealt.select("block", "pos", "size", "source_size", "target", copies, "to")
    return dealt.withColumn("shards", F.when(F.col("copies") > 0, F.slice("to", 1, F.col("copies")))).drop("to")


def _numbered(docs: DataFrame, seed: int) -> DataFrame:
    text = F.col("text").cast("string")
    # Rows without an id are told apart by place, or all of one text would be one block.
    place = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    return numbered(
        docs, "mix-input", 1 << 20, source=F.col("source").cast("string"), size=words(text),
        tag=F.xxhash64(F.lit(seed), "doc_id", text, place),
    )


def mixed_documents(docs: DataFrame, shards: int = 8, seed: int = 3) -> DataFrame:
    """For each row of ``docs(doc_id, text, source)`` what the mix takes of it.

    Null texts have size 0; rows with a null source are one source, the last. A
    source without words has target 0. A row's copies are 0 to 3; which rows get
    the odd copy depends on a hash of id and text, so reruns agree; rows alike in
    both are told apart by position, rows with a null id by their place in the
    input. An empty table gives an empty result.
    """
    slim = docs.select("doc_id", "text", "source")
    rows = _numbered(slim, seed)
    plan = planned(rows.drop("row"), shards, seed)
    out = rows.select("block", "pos", F.col("row.doc_id").alias("doc_id")).join(plan, ["block", "pos"])
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return out.select("doc_id", "size", "source_size", "target", taken, "copies", "shards")


def mixed_rows(docs: DataFrame, shards: int = 8, seed: int = 3) -> DataFrame:
    """The mix itself: one row for each copy taken, with all columns, and
    ``mix_shard`` and ``mix_order``, its shard and its place there by value; input
    columns of these names give way. Null texts, sources and ids and repeated rows
    are as in ``mixed_documents``; an empty table gives an empty mix."""
    rows = _numbered(docs, seed)
    plan = planned(rows.drop("row"), shards, seed).filter("copies > 0").select("block", "pos", "shards")
    out = rows.select("block", "pos", "tag", "row").join(plan, ["block", "pos"])
    out = out.select("row", "tag", F.posexplode("shards").alias("turn", "mix_shard"))
    order = F.xxhash64(F.lit(seed + 2), "tag", "turn").alias("mix_order")
    return out.select(*unpacked("row", docs.columns, ["mix_shard", "mix_order"]), "mix_shard", order)
