"""Find keys that hold too many rows for one task and cut them by time.

Finding them is approximate (a frequent-items sketch), which is safe: operators
give the same rows whether a key is cut or not, so a miss costs time only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key above this many rows is cut into time slices of about a quarter of it.
HOT_ROWS = 20_000_000
SLICES_PER_HOT_ROWS = 4
# Most slices of one key; of a key above a quarter of that many times HOT_ROWS rows
# the slices are longer.
MAX_SLICES_PER_KEY = 1 << 16


@dataclass(frozen=True)
class HotKeys:
    """Hot keys with the times (micros) at which they are cut, about equal
    numbers of rows apart: one number for each slice."""

    grid: dict[str, tuple[int, ...]]
    hot_rows: int = HOT_ROWS

    def __bool__(self) -> bool:
        return bool(self.grid)

    def slices(self) -> int:
        return sum(len(cuts) + 1 for cuts in self.grid.values())

    def coarser(self, apart: int) -> HotKeys:
        """The same keys with cuts at least ``apart`` microseconds from each other,
        where that leaves no slice above about a quarter of ``HOT_ROWS``."""
        most = max(1, HOT_ROWS // self.hot_rows)
        grid = {}
        for key, cuts in self.grid.items():
            kept = [0]
            for i, cut in enumerate(cuts):
                if cut - cuts[kept[-1]] >= apart or i - kept[-1] >= most:
                    kept.append(i)
            grid[key] = tuple(cuts[i] for i in kept)
        return HotKeys(grid, self.hot_rows)

    def frame(self, spark) -> DataFrame:
        return spark.createDataFrame(
            [(k, list(cuts)) for k, cuts in self.grid.items()], "__hk string, __cuts array<bigint>"
        )

    def slice_column(self, df: DataFrame, key: str, at: Column, out: str) -> DataFrame:
        """Add the slice number: 0 for ordinary keys, 1.. by time for hot ones.

        The grid is broadcast: eight bytes for each ``HOT_ROWS`` / 4 rows of a hot
        key, 1.6 MB for 10^12 rows. The cuts are searched by halving steps.
        """
        if not self.grid:
            return df.withColumn(out, F.lit(0))
        longest = max(len(cuts) for cuts in self.grid.values())
        steps = F.array(*[F.lit(1 << k) for k in reversed(range(longest.bit_length()))])
        passed = F.aggregate(
            steps, F.lit(0),
            lambda n, step: F.when(F.get("__cuts", n + step - 1) <= at, n + step).otherwise(n),
        )
        return (
            df.join(F.broadcast(self.frame(df.sparkSession)), F.col(key) == F.col("__hk"), "left")
            .withColumn(out, F.when(F.col("__hk").isNull(), 0).otherwise(passed + 1))
            .drop("__hk", "__cuts")
        )


NONE = HotKeys({})


def find_hot_keys(
    df: DataFrame,
    key: str,
    at: str,
    hot_rows: int | None = None,
    tracked: int = 65_536,
) -> HotKeys:
    """Keys of ``df`` above ``hot_rows`` rows, each with its cuts.

    ``key`` is a text column and ``at`` a bigint column of microseconds. With
    ``hot_rows`` unset it is ``HOT_ROWS``. Inputs with no more rows than that
    cannot hold such a key and are only counted. The sketch finds every key above
    about 1/20,000 of the rows; if all it can name are hot, keys are counted.
    """
    if hot_rows is None:
        hot_rows = HOT_ROWS
        if df.count() <= hot_rows:
            return NONE
    width = min(tracked, 4096)
    sketch = df.agg(F.expr(f"approx_top_k({key}, {width}, {tracked})").alias("top")).first()
    hot = [t["item"] for t in sketch["top"] or [] if t["count"] > hot_rows]
    if len(hot) == width:
        hot = [r[key] for r in df.groupBy(key).count().filter(F.col("count") > hot_rows).collect()]
    if not hot:
        return NONE
    rows = df.filter(F.col(key).isin(hot))
    sizes = {r[key]: r["count"] for r in rows.groupBy(key).count().collect()}
    slices = {
        k: min(MAX_SLICES_PER_KEY, -(-n * SLICES_PER_HOT_ROWS // hot_rows))
        for k, n in sizes.items()
        if n > hot_rows
    }
    if not slices:
        return NONE
    most = max(slices.values())
    shares = ",".join(str(i / most) for i in range(1, most))
    times = F.expr(
        f"percentile_approx({at}, cast(split('{shares}', ',') as array<double>), {max(10_000, 4 * most)})"
    )
    grid = {}
    for row in rows.groupBy(key).agg(times.alias("cuts")).collect():
        wanted = slices.get(row[key], 1)
        picked = [row["cuts"][i * most // wanted - 1] for i in range(1, wanted)]
        if cuts := sorted(set(picked)):
            grid[row[key]] = tuple(cuts)
    return HotKeys(grid, hot_rows)
