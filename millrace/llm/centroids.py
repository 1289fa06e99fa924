"""Centroid clustering of embeddings with JVM expressions and exact integers.

Each round is one pass over a staged table of integer vectors. The centroids of
the round are one literal array of arrays; ``zip_with`` and ``aggregate`` compute
the squared distances, ``array_min`` of (distance, number) structs chooses the
cluster, and the next centroids come from one grouped sum a component. Only
these sums, one row a cluster, are shuffled and reach the driver, so a pass has
no hot key however the vectors fall, and no round's plan holds an earlier one.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.staging import staged

WIDTH, CLUSTERS, ROUNDS, SCALE, SEED = 64, 40, 5, 256, 2


@dataclass
class Clustering:
    """Centroids in order of their number, and the table they were fitted on:
    (vec_id, spot array<bigint>), one row for each kept vector."""

    centroids: list[tuple[int, ...]]
    spots: DataFrame


# ------------------------------------------------------------------ vectors

def spots(vectors: DataFrame, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """(vec_id, spot): the integers floor(scale * x) of the kept vectors.

    Kept are vectors of exactly ``width`` components, none of them null, NaN or
    infinite; null vectors and all others are left out. ``width`` 0 keeps none.
    """
    parts = F.col("embedding").cast("array<double>")
    fine = F.forall("part", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), parts.alias("part"))
    kept = rows.filter((F.size("part") == width) & (F.size("part") > 0) & F.coalesce(fine, F.lit(False)))
    return kept.select("vec_id", F.transform("part", lambda x: F.floor(x * scale).cast("long")).alias("spot"))


def _starts(table: DataFrame, clusters: int, seed: int) -> list[tuple[int, ...]]:
    """The spots of the smallest hashes of ``seed:vec_id``; null ids come last,
    rows of one id in the order of their components."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = table.select(name.alias("hash"), "spot").orderBy(F.asc_nulls_last("hash"), "spot").limit(clusters)
    return [tuple(r.spot) for r in first.collect()]


# ------------------------------------------------------------------- rounds

def _literal(centroids: list[tuple[int, ...]]) -> Column:
    """One constant; as text it is parsed once instead of a literal a component."""
    rows = ",".join("array(" + ",".join(f"{x}L" if x > -(1 << 63) else f"cast({x} as bigint)" for x in c) + ")"
                    for c in centroids)
    return F.expr(f"array({rows})")


def nearest(spot: Column, centroids: list[tuple[int, ...]]) -> Column:
    """A struct (distance, cluster): the squared distance to the nearest
    centroid and its number, the smaller one of equals. Distances are exact; one
    that no long can hold is an arithmetic overflow error."""

    def distance(centroid: Column, number: Column) -> Column:
        squares = F.zip_with(spot, centroid, lambda a, b: (a - b) * (a - b))
        total = F.aggregate(squares, F.lit(0).cast("long"), lambda s, x: s + x)
        return F.struct(total.alias("distance"), number.alias("cluster"))

    return F.array_min(F.transform(_literal(centroids), distance))


def _moved(table: DataFrame, centroids: list[tuple[int, ...]]) -> list[tuple[int, ...]]:
    """The centroids after one round; empty clusters stay where they are."""
    held = table.select(nearest(F.col("spot"), centroids)["cluster"].alias("cluster"), "spot")
    # Sums of more than 9 quintillion would not fit a long.
    sums = [F.sum(F.col("spot")[k]).alias(f"s{k}") for k in range(len(centroids[0]))]
    found = held.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect()
    out = list(centroids)
    for row in found:
        out[row.cluster] = tuple(total // row.n for total in row[2:])
    return out


def fit(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH,
        scale: int = SCALE, seed: int = SEED) -> Clustering:
    """Starts from the ``clusters`` vectors of smallest hash (fewer vectors:
    fewer clusters) and moves the centroids ``rounds`` times to the floor of
    their vectors' mean."""
    table, _ = staged(spots(vectors, width, scale), "spots")
    centroids = _starts(table, clusters, seed)
    for _ in range(rounds if centroids else 0):
        centroids = _moved(table, centroids)
    return Clustering(centroids, table)


# ------------------------------------------------------------------ results

def digest(centroid: tuple[int, ...]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def clustered(vectors: DataFrame, **how: int) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of
    each kept vector of ``vectors(vec_id, embedding)``; see ``fit``.

    Vectors that ``spots`` does not keep have no row. Repeated rows are repeated
    and weigh as often; vectors with a null id are clustered like others. An
    empty table gives an empty result. Other columns are ignored.
    """
    model = fit(vectors, **how)
    if not model.centroids:
        return model.spots.select(
            "vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"),
            F.lit(0).cast("long").alias("cluster_inertia"), F.lit(0).cast("long").alias("inertia"),
            F.lit("").alias("centroid_sha256"))
    near = model.spots.select("vec_id", nearest(F.col("spot"), model.centroids).alias("near"))
    held, _ = staged(near.select("vec_id", "near.cluster", "near.distance"), "clusters")
    # One row a cluster comes back to the driver.
    totals = {r.cluster: r.total for r in held.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    size = len(model.centroids)
    inertia = F.array(*[F.lit(totals.get(k, 0)).cast("long") for k in range(size)])
    sha = F.array(*[F.lit(digest(c)) for c in model.centroids])
    return held.select(
        "vec_id", "cluster", "distance", inertia[F.col("cluster")].alias("cluster_inertia"),
        F.lit(sum(totals.values())).cast("long").alias("inertia"), sha[F.col("cluster")].alias("centroid_sha256"))


# --------------------------------------------------------------- DuckDB SQL

def _sql() -> str:
    start = f"""
WITH raw AS (
  SELECT vec_id, row_number() OVER () AS row, embedding::DOUBLE[] AS part FROM embeddings
  WHERE len(embedding) = {WIDTH}
), kept AS MATERIALIZED (
  SELECT vec_id, row, list_transform(part, lambda x: CAST(floor({SCALE} * x) AS BIGINT)) AS spot FROM raw
  WHERE len(list_filter(part, lambda x: x IS NOT NULL AND isfinite(x))) = {WIDTH}
), cells AS MATERIALIZED (
  SELECT row, unnest(spot) AS x, unnest(range({WIDTH})) AS j FROM kept
), first AS (
  SELECT spot, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), spot) - 1 AS cluster FROM kept
), c0 AS MATERIALIZED (
  SELECT cluster, unnest(spot) AS x, unnest(range({WIDTH})) AS j FROM first WHERE cluster < {CLUSTERS}
)"""
    near = """, a{r} AS MATERIALIZED (
  SELECT row, min(struct_pack(d := d, c := cluster)) AS near FROM (
    SELECT v.row, c.cluster, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS d
    FROM cells v JOIN c{r} c USING (j) GROUP BY v.row, c.cluster) GROUP BY row
)"""
    move = """, m{n} AS (
  SELECT near.c AS cluster, j, floor_mean(sum(x), count(*)) AS x FROM a{r} JOIN cells USING (row) GROUP BY ALL
), c{n} AS MATERIALIZED (
  SELECT c.cluster, c.j, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{n} m ON m.cluster = c.cluster AND m.j = c.j
)""".replace("floor_mean(sum(x), count(*))", "((sum(x) - (((sum(x) % count(*)) + count(*)) % count(*))) // count(*))::BIGINT")
    rounds = "".join(near.format(r=r) + move.format(r=r, n=r + 1) for r in range(ROUNDS)) + near.format(r=ROUNDS)
    return start + rounds + f"""
SELECT k.vec_id, a.near.c::INTEGER AS cluster, a.near.d AS distance,
  sum(a.near.d) OVER (PARTITION BY a.near.c)::BIGINT AS cluster_inertia, sum(a.near.d) OVER ()::BIGINT AS inertia,
  s.sha AS centroid_sha256
FROM kept k JOIN a{ROUNDS} a USING (row)
JOIN (SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY j)) AS sha FROM c{ROUNDS} GROUP BY cluster) s
  ON s.cluster = a.near.c"""


SQL = _sql()
