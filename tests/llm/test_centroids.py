"""Centroid clustering against plain Python integers."""

import hashlib
import math

from pyspark.sql import types as T

from millrace.llm import centroids

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
    T.StructField("label", T.IntegerType()), T.StructField("spot", T.StringType()),
])


def brute(rows, clusters, rounds, width, scale, seed):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    hashed = [(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None]
    middle = [v for _, v in sorted(hashed)] + sorted(v for i, v in kept if i is None)
    middle = middle[:clusters]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(middle))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for k, vs in groups.items():
            middle[k] = [sum(x) // len(vs) for x in zip(*vs)]
    found = [(i, *near(v)) for i, v in kept]
    total = sum(f[1] for f in found)
    return sorted(((i, k, d, sum(f[1] for f in found if f[2] == k), total,
                    hashlib.sha256(",".join(map(str, middle[k])).encode()).hexdigest()) for i, d, k in found), key=str)


def run(spark, rows, **how):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    return sorted((tuple(r) for r in centroids.clustered(df, **how).collect()), key=str)


def test_against_plain_integers(spark, rng=None):
    import random

    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(120)]
    rows += [(i, [-0.5, -1e-9, 0.0, 2.0]) for i in range(200, 240)]  # a third are equal
    rows += [(7, rows[3][1]), (7, [0.1, 0.2, 0.3, 0.4]), (None, [1.0, 1.0, 1.0, 1.0]), (None, [9.0, 9.0, 9.0, 9.0])]
    rows += [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0]), (303, [1.0, math.nan, 0.0, 0.0]),
             (304, [math.inf, 0.0, 0.0, 0.0]), (305, [1.0] * 3), (306, [1.0] * 5)]
    how = dict(clusters=7, rounds=3, width=4, scale=16, seed=2)
    assert run(spark, rows, **how) == brute(rows, **how)


def test_ties_go_to_the_smaller_number_and_empty_clusters_stay(spark):
    rows = [(i, [float(i % 2), 0.0]) for i in range(20)]
    how = dict(clusters=12, rounds=2, width=2, scale=2, seed=5)
    found = run(spark, rows, **how)
    assert found == brute(rows, **how)
    assert len({r[1] for r in found}) == 2


def test_fewer_vectors_than_clusters_and_none(spark):
    how = dict(clusters=40, rounds=2, width=2, scale=4, seed=2)
    rows = [(1, [0.5, 0.5]), (2, [-3.0, 1.0])]
    assert run(spark, rows, **how) == brute(rows, **how)
    assert run(spark, [], **how) == []
    assert run(spark, [(None, [0.0, 1.0])], **how) == brute([(None, [0.0, 1.0])], **how)


def test_extreme_integers(spark):
    big = float(2**27)
    rows = [(1, [big, -big]), (2, [-big, big]), (3, [-big, -big])]
    how = dict(clusters=2, rounds=1, width=2, scale=1, seed=2)
    assert run(spark, rows, **how) == brute(rows, **how)
