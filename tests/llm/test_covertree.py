import math
import random

import numpy as np
import pytest

from millrace.llm import covertree, queries


def brute(rows):
    """(vec_id, n_links, component, kept) by comparing all."""
    good = [v is not None and i is not None and l is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
            for i, v, l in rows]
    n, links = len(rows), [set() for _ in rows]
    for a in range(n):
        for b in range(a):
            if good[a] and good[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[k][1], dtype=np.float64) for k in (a, b))
                if (x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum())) >= 0.98:
                    links[a].add(b), links[b].add(a)
    out, seen = [], {}
    for a in range(n):
        if a not in seen:
            group, todo = {a}, [a]
            while todo:
                for b in links[todo.pop()] - group:
                    group.add(b), todo.append(b)
            seen |= dict.fromkeys(group, min((rows[k][0] for k in group if rows[k][0] is not None), default=None))
        out.append((rows[a][0], len(links[a]), seen[a], seen[a] == rows[a][0]))
    return sorted(map(str, out))


def found(frame):
    return sorted(str(tuple(r)) for r in covertree.near_duplicates(frame).collect())


def clustered(rng, n, centres, d, noise):
    base = rng.normal(size=(centres, d))
    return base[rng.integers(0, centres, n)] + noise * rng.normal(size=(n, d))


@pytest.mark.parametrize("n, centres, d, noise", [(300, 20, 8, 0.05), (400, 400, 64, 0), (500, 3, 3, 0.2), (1, 1, 4, 0), (200, 1, 2, 2.0)])
def test_traversal_misses_no_pair(n, centres, d, noise):
    rng = np.random.default_rng(n)
    a = covertree._unit(clustered(rng, n, centres, d, noise))
    b = covertree._unit(clustered(rng, n // 2 + 1, centres, d, noise))
    for x, y in ((a, b), (a, a)):
        near = np.argwhere(x @ y.T >= 0.98 + 1e-9)
        got = {(i, j) for ii, jj in covertree.close_pairs(x, y, 0.98) for i, j in zip(ii, jj)}
        assert set(map(tuple, near)) <= got


@pytest.mark.parametrize("chunk, sample", [(2048, 4096), (16, 60)])
def test_against_brute_force(spark, monkeypatch, chunk, sample):
    monkeypatch.setattr(covertree, "CHUNK", chunk)
    monkeypatch.setattr(covertree, "SAMPLE", sample)
    rng = np.random.default_rng(9)
    rows = [(int(i), v.tolist(), int(i) % 3) for i, v in enumerate(clustered(rng, 200, 12, 8, 0.04))]
    rows += [(1000 + i, rows[0][1], 0) for i in range(60)] + [(2000, [2 * x for x in rows[1][1]], 1)]
    rows += [(3000, None, 0), (None, rows[0][1], 0), (3001, [0.0] * 8, 0), (3002, [None] * 8, 1), (3003, [math.nan] * 8, 1),
             (3004, [math.inf] * 8, 1), (3005, [], 2), (3006, rows[2][1][:7], 2), (3007, rows[0][1], None), (3008, rows[2][1][:7], 2)]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, vector string, size int")
    wanted = [r for r in brute(rows)]
    assert [w if "None" not in w else "(None, 0, None, True)" for w in wanted] == [
        g if "None" not in g else "(None, 0, None, True)" for g in found(frame)]
    pairs = {tuple(r) for r in covertree.near_pairs(frame).collect()}
    assert all(a < b for a, b in pairs) and (1, 2000) in pairs
    assert covertree.near_duplicates(frame.limit(0)).count() == 0


def test_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding, r.label) for r in queries.table(spark, sf_dir, "embeddings").collect()]
    assert found(queries.table(spark, sf_dir, "embeddings")) == brute(rows)
