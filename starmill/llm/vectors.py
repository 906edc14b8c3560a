"""What the two vector operators share: valid vectors, bounded fits, lists met in blocks."""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import ship

MOST_SAMPLED = 20_000  # expected bound of the sample an index is fitted on
BLOCK = 2048  # rows of a list, on either side, that one task compares at a time


def is_valid(vector: str) -> Column:
    """A vector that is neither null, empty nor zero and has finite components only."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def valid_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector of doubles) of rows that can be compared.

    Vectors of another length than most have are left out, as are rows without an id.
    """
    rows = df.where(is_valid(vector_col) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    usual = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("vector") == (usual["d"] if usual else 0))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of vectors of one length as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))


def fit(
    rows: DataFrame, n: int, task: Callable[[np.ndarray], dict[str, np.ndarray]], most: int = MOST_SAMPLED
) -> dict[str, np.ndarray]:
    """Run ``task`` in one Spark task over a sample of about ``most`` vectors at most.

    The sample is chosen by a hash of the id. The arrays returned, whose size
    the caller's parameters bound, come back to the driver.
    """
    steps = 1 << 20
    chosen = F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(steps)) < steps * min(1.0, most / max(n, 1))

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(np.array(table["id"].to_pylist()), kind="stable")
        found = task(matrix(table["vector"])[order])
        return pa.table({
            "name": list(found), "shape": [list(a.shape) for a in found.values()],
            "data": [a.astype("<f8").tobytes() for a in found.values()],
        })

    ship(rows.sparkSession)
    back = rows.where(chosen).groupBy().applyInArrow(run, "name string, shape array<long>, data binary")
    return {
        r["name"]: np.frombuffer(bytes(r["data"]), "<f8").reshape(r["shape"]).copy() for r in back.collect()
    }


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0)


def kmeans(points: np.ndarray, k: int, rounds: int = 8, balance: float = 0.0) -> np.ndarray:
    """Centroids of ``points``; ``balance`` makes crowded clusters seem farther away."""
    rng = np.random.default_rng(17)
    k = max(1, min(k, len(points)))
    centroids = points[rng.choice(len(points), k, replace=False)].copy()
    push = np.zeros(k)
    scale = points.var(0).sum() or 1.0
    for _ in range(rounds):
        own = np.argmin(squared_distances(points, centroids) + push, axis=1)
        sizes = np.bincount(own, minlength=k)
        total = np.zeros_like(centroids)
        np.add.at(total, own, points)
        filled = sizes > 0
        centroids[filled] = total[filled] / sizes[filled, None]
        push += balance * scale * (sizes / (len(points) / k) - 1)
    return centroids


def meet(
    index: DataFrame, queries: DataFrame, compare: Callable[[int, pa.Table, pa.Table], pa.Table],
    schema: str, block: int = BLOCK,
) -> DataFrame:
    """Compare the queries of every list with its rows, in blocks of bounded size.

    Both frames have the column ``list`` and ``id`` and are otherwise alike. A
    list with more than ``block`` rows or queries becomes a grid of blocks, so
    that a list which holds a third of all rows is many tasks' work.
    ``compare(list, queries, rows)`` sees one cell of the grid.
    """
    sides = index.withColumn("is_query", F.lit(False)).unionByName(
        queries.withColumn("is_query", F.lit(True))
    )
    counts = sides.groupBy("list").agg(
        F.ceil(F.count_if(~F.col("is_query")) / block).alias("row_blocks"),
        F.ceil(F.count_if("is_query") / block).alias("query_blocks"),
    ).where("row_blocks > 0 AND query_blocks > 0")
    own = lambda blocks: F.array(F.pmod(F.xxhash64("id"), F.col(blocks)))
    every = lambda blocks: F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1)
    cells = (
        sides.join(counts, "list")
        .withColumn("row_block", F.explode(F.when(F.col("is_query"), every("row_blocks")).otherwise(own("row_blocks"))))
        .withColumn("query_block", F.explode(F.when(F.col("is_query"), own("query_blocks")).otherwise(every("query_blocks"))))
        .drop("row_blocks", "query_blocks")
    )

    def cell(table: pa.Table) -> pa.Table:
        mask = table["is_query"]
        return compare(table["list"][0].as_py(), table.filter(mask), table.filter(pa.compute.invert(mask)))

    ship(index.sparkSession)
    return cells.groupBy("list", "row_block", "query_block").applyInArrow(cell, schema)
