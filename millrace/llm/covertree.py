"""All pairs of vectors above a cosine, by dual traversal of cover trees.

On unit vectors the cosine bound is a distance bound, so nodes whose centres are
further apart than both covering radii and that distance hold no pair. The tree's
top levels are nets with halving radii over a bounded sample of each label; every
vector goes to its nearest centre, and the cells' measured radii decide which pairs
of cells can meet. Cells are cut into chunks of at most about ``CHUNK`` vectors.
Each pair of chunks that can meet is one group: there both get the lower levels of
their trees, again nets with halving radii, and are traversed level by level.

Groups report, for each vector, how many vectors it links to, and edges of a
spanning forest, so a dense cluster makes as many rows as it has vectors. Equal
vectors of a label are one vector with a count.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.graph import components
from millrace.llm.staging import staged

COSINE = 0.98
SAMPLE, CHUNK = 4096, 2048
ROWS = 256
LEVELS = tuple(2.0 ** -k for k in range(0, 5))
SLACK = 1e-6  # of rounding, given to bounds and taken back by the exact test


def reach(cosine: float) -> float:
    return float(np.sqrt(max(0.0, 2 - 2 * cosine)))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * (a @ b.T)))


# ----------------------------------------------------------------- one tree

def net(points: np.ndarray, centres: list[int], radius: float) -> list[int]:
    """``centres`` and as many more points as make every point lie within
    ``radius`` of one."""
    centres = list(centres)
    for low in range(0, len(points), ROWS):
        block = points[low:low + ROWS]
        far = np.ones(len(block), dtype=bool)
        if centres:
            far = distances(block, points[centres]).min(1) > radius
        left = np.flatnonzero(far)
        if len(left):
            among = distances(block[left], block[left])
            open_ = np.ones(len(left), dtype=bool)
            for i in range(len(left)):
                if open_[i]:
                    centres.append(low + int(left[i]))
                    open_ &= among[i] > radius
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each point's nearest centre and its distance."""
    which, how = np.zeros(len(points), dtype=np.int64), np.zeros(len(points))
    for low in range(0, len(points), ROWS):
        d = distances(points[low:low + ROWS], centres)
        which[low:low + ROWS] = d.argmin(1)
        how[low:low + ROWS] = d.min(1)
    return which, how


def tree(points: np.ndarray) -> list[tuple]:
    """Levels (centres, radius of each, parent of each), from the root's
    children down to the points themselves."""
    levels, centres, parent_of = [], [], np.zeros(len(points), dtype=np.int64)
    for radius in LEVELS:
        centres = net(points, centres, radius)
        if len(centres) > len(points) // 2:
            break
        at = np.array(centres)
        which, how = nearest(points, points[at])
        radii = np.zeros(len(at))
        np.maximum.at(radii, which, how)
        # Points are moved below the parent of their centre; its radius covers them.
        up = parent_of[at]
        if levels:
            above = points[levels[-1][0]]
            wide = np.sqrt(np.maximum(0, 2 - 2 * (points * above[up[which]]).sum(1)))
            np.maximum.at(levels[-1][1], up[which], wide)
        levels.append([at, radii, up])
        parent_of = which
    levels.append([np.arange(len(points)), np.zeros(len(points)), parent_of])
    # Radii that grew below must be covered above.
    for upper, lower in zip(levels[-2::-1], levels[:0:-1]):
        gap = np.sqrt(np.maximum(0, 2 - 2 * (points[lower[0]] * points[upper[0]][lower[2]]).sum(1)))
        np.maximum.at(upper[1], lower[2], gap + lower[1])
    return [tuple(level) for level in levels]


def close_pairs(a: np.ndarray, b: np.ndarray, cosine: float):
    """Yields (i, j) index arrays of the pairs a[i], b[j] that may reach the
    cosine, by dual traversal."""
    far = reach(cosine) + SLACK
    left, right = tree(a), tree(b)
    while len(left) < len(right):
        left.append((left[-1][0], left[-1][1], np.arange(len(a))))
    while len(right) < len(left):
        right.append((right[-1][0], right[-1][1], np.arange(len(b))))
    alive = np.ones((1, 1), dtype=bool)
    for depth, ((ca, ra, pa_), (cb, rb, pb_)) in enumerate(zip(left, right)):
        last = depth == len(left) - 1
        now = np.zeros((len(ca), len(cb)), dtype=bool) if not last else None
        for low in range(0, len(ca), ROWS):
            some = slice(low, low + ROWS)
            open_ = alive[pa_[some]][:, pb_]
            columns = np.flatnonzero(open_.any(0))
            if not len(columns):
                continue
            d = distances(a[ca[some]], b[cb[columns]])
            near = open_[:, columns] & (d <= ra[some, None] + rb[columns] + far)
            if last:
                i, j = np.nonzero(near)
                yield ca[low + i], cb[columns[j]]
            else:
                now[some, columns] = near
        alive = now


# ------------------------------------------------------------ one chunk pair

def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    dot, nx, ny = (x * y).sum(1), (x * x).sum(1), (y * y).sum(1)
    return dot / (np.sqrt(nx) * np.sqrt(ny))


def linked(raw: np.ndarray, side: np.ndarray, cosine: float, same: bool):
    """(i, j) arrays of the linked pairs of a group, each pair once."""
    unit = _unit(raw)
    one = np.arange(len(raw)) if same else np.flatnonzero(side == 0)
    two = one if same else np.flatnonzero(side == 1)
    if not len(one) or not len(two):
        return
    for i, j in close_pairs(unit[one], unit[two], cosine):
        i, j = one[i], two[j]
        if same:
            i, j = i[i < j], j[i < j]
        good = _exact(raw[i], raw[j]) >= cosine
        if good.any():
            yield i[good], j[good]


def _root(parent: np.ndarray, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _group(cosine: float, pairs: bool):
    def work(frame: pd.DataFrame) -> pd.DataFrame:
        ids, copies = frame["id"].to_numpy(), frame["copies"].to_numpy()
        raw = np.array(frame["vector"].tolist(), dtype=np.float64)
        same = bool(frame["same"].iloc[0])
        found = linked(raw, frame["side"].to_numpy(), cosine, same)
        if pairs:
            got = [(ids[i], ids[j]) for i, j in found]
            a, b = (np.concatenate([g[k] for g in got]) if got else np.zeros(0, np.int64) for k in (0, 1))
            return pd.DataFrame({"id": np.minimum(a, b), "links": np.zeros(len(a), np.int64), "root": np.maximum(a, b)})
        links, parent = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
        for i, j in found:
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            _, first = np.unique(i, return_index=True)
            spare = np.ones(len(i), dtype=bool)
            for x, y in zip(i[first], j[first]):
                parent[_root(parent, y)] = _root(parent, x)
            spare[first] = False
            for x, y in zip(i[spare], j[spare]):
                p, q = _root(parent, x), _root(parent, y)
                if p != q:
                    parent[q] = p
        on = np.flatnonzero(links)
        roots = np.array([ids[_root(parent, k)] for k in on], dtype=np.int64)
        return pd.DataFrame({"id": ids[on], "links": links[on], "root": roots})
    return work


# -------------------------------------------------------------------- Spark

def _vectors(df: DataFrame) -> DataFrame:
    """(row, vec_id, label, vector, usable) of each row."""
    vector = F.col("embedding").cast("array<double>")
    size = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x)
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & sound & (size > 0) & (size < float("inf"))
    return df.select(F.col("vec_id").cast("long"), "label", vector.alias("vector"), F.coalesce(usable, F.lit(False)).alias("usable"))


def _pivots(classes: DataFrame) -> dict:
    """Centres of each label's cells, nets with halving radii over a sample of
    about ``SAMPLE`` vectors in all; at most one centre for ``CHUNK`` vectors."""
    count = classes.count()
    draw = F.pmod(F.xxhash64(F.lit(8), "id"), F.lit(1 << 30)) / (1 << 30)
    got = classes.filter(draw < SAMPLE / max(count, 1)).select("id", "label", "size", "vector").collect()
    by_label: dict = {}
    for r in sorted(got, key=lambda r: r.id):
        by_label.setdefault((r.label, r["size"]), []).append(r.vector)
    out = {}
    for label, vectors in by_label.items():
        unit = _unit(np.array(vectors, dtype=np.float64))
        most = max(1, round(len(unit) * count / min(count, SAMPLE) / CHUNK))
        centres: list[int] = []
        for radius in LEVELS:
            centres = net(unit, centres, radius)
            if len(centres) >= most:
                break
        out[label] = unit[centres[:most]]
    return out


def _cells(pivots: dict):
    def batches(source):
        for batch in source:
            label, size = batch.column(1).to_pylist(), batch.column(3).to_numpy()
            vectors = batch.column(2).to_pylist()
            cell, far = np.zeros(len(label), dtype=np.int64), np.full(len(label), 2.0)
            groups: dict = {}
            for k, key in enumerate(zip(label, size.tolist())):
                groups.setdefault(key, []).append(k)
            for key, at in groups.items():
                if key in pivots:
                    cell[at], far[at] = nearest(_unit(np.array([vectors[k] for k in at], dtype=np.float64)), pivots[key])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cell), pa.array(far)], ["id", "cell", "far"])
    return batches


def _meetings(cells: list, pivots: dict, far: float) -> list[tuple]:
    """Pairs of cells that can hold a link: (label, size, cell and number of
    chunks of either). ``cells`` has a row for each cell with its radius; there
    are no more cells than centres and labels without one."""
    by_label: dict = {}
    for r in cells:
        by_label.setdefault((r.label, r["size"]), []).append(r)
    out = []
    for label, rows in by_label.items():
        rows.sort(key=lambda r: r.cell)
        radii = np.array([r.radius for r in rows])
        near = np.ones((len(rows), len(rows)), dtype=bool)
        if label in pivots:
            centres = pivots[label][[r.cell for r in rows]]
            near = distances(centres, centres) <= radii[:, None] + radii + far + SLACK
        for x, y in zip(*np.nonzero(np.triu(near))):
            out.append((*label, rows[x].cell, rows[x].chunks, rows[y].cell, rows[y].chunks))
    return out


def _grouped(classes: DataFrame, cosine: float, pairs: bool) -> DataFrame:
    """(id, links, root) from every pair of chunks, or (id, 0, id) of each pair."""
    spark = classes.sparkSession
    pivots = _pivots(classes)
    placed = classes.select("id", "label", "vector", F.col("size")).mapInArrow(_cells(pivots), "id long, cell long, far double")
    placed, _ = staged(classes.join(placed, "id"), "vector-cells")
    chunks = F.ceil(F.count("*") / CHUNK).cast("int")
    cells = placed.groupBy("label", "size", "cell").agg(F.max("far").alias("radius"), chunks.alias("chunks")).collect()
    kind = classes.schema["label"].dataType.simpleString()
    meet = _meetings(cells, pivots, reach(cosine))
    meet = spark.createDataFrame(meet, f"label {kind}, size int, x long, nx int, y long, ny int")
    same = F.col("x") == F.col("y")
    meet = meet.withColumn("c", F.explode(F.sequence(F.lit(0), F.col("nx") - 1)))
    meet = meet.withColumn("d", F.explode(F.sequence(F.when(same, F.col("c")).otherwise(0), F.col("ny") - 1)))
    pair = ["label", "size", "x", "c", "y", "d"]
    same = (same & (F.col("c") == F.col("d"))).alias("same")
    seats = meet.select(*pair, same, F.lit(0).alias("side"), F.col("x").alias("cell"), F.col("c").alias("chunk"))
    others = meet.select(*pair, same, F.lit(1).alias("side"), F.col("y").alias("cell"), F.col("d").alias("chunk"))
    seats = seats.union(others.filter("NOT same"))
    sizes = spark.createDataFrame([(r.label, r["size"], r.cell, r.chunks) for r in cells], f"label {kind}, size int, cell long, chunks int")
    where = ["label", "size", "cell"]
    chunk = F.pmod(F.xxhash64(F.lit(9), "id"), F.col("chunks")).cast("int").alias("chunk")
    rows = placed.join(sizes, where).select("id", "copies", "vector", *where, chunk)
    rows = rows.join(seats, [*where, "chunk"]).select("id", "copies", "vector", "side", "same", *pair)
    return rows.groupBy(*pair).applyInPandas(_group(cosine, pairs), "id long, links long, root long")


def _classes(vectors: DataFrame) -> DataFrame:
    """Distinct usable vectors of each label; id is the smallest vec_id."""
    whole = vectors.filter("usable").groupBy("label", "vector")
    classes = whole.agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    return classes.withColumn("size", F.size("vector"))


def near_pairs(df: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(a, b), a < b: linked pairs of distinct vectors of a label, each named by
    its smallest vec_id, of ``df(vec_id, embedding, label)``."""
    classes, _ = staged(_classes(_vectors(df)), "vector-classes")
    return _grouped(classes, cosine, True).select(F.col("id").alias("a"), F.col("root").alias("b")).distinct()


def near_duplicates(df: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of
    ``df(vec_id, embedding, label)``.

    Vectors link if their labels are equal and their cosine, in double
    precision, is at least ``cosine``. Rows with a null id, label or vector, a
    zero vector, or a component that is null or not finite link with nothing,
    nor do vectors of different lengths; they are kept, and their component is
    their own id. ``vec_id`` is taken as a key: vectors under one id are one
    vertex and share its links.
    """
    vectors, _ = staged(_vectors(df), "vectors")
    classes, _ = staged(_classes(vectors), "vector-classes")
    parts, _ = staged(_grouped(classes, cosine, False), "vector-links")
    found = components(parts.select(F.col("id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "id")
    links = parts.groupBy("id").agg(F.sum("links").alias("links"))
    known = classes.join(links, "id", "left").join(found, "id", "left")
    known = known.select(
        F.col("label").alias("l"), F.col("vector").alias("v"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "id").alias("c"))
    same = F.col("usable") & (F.col("label") == F.col("l")) & (F.col("vector") == F.col("v"))
    out = vectors.join(known, same, "left")
    component = F.coalesce("c", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
