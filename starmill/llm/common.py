"""What several operators share: tables, row keys, vectorised tasks, connected components."""

import contextlib
import ctypes
import gc
import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import starmill
from starmill.workspace import materialize

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(starmill.__file__)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(
    df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` whose Python workers find this package where the driver found it."""
    ship(df.sparkSession)
    return df.mapInArrow(task, schema)


def ship(spark: SparkSession) -> None:
    """Let Python workers that start from now on import this package, and get texts in
    batches of few rows: Spark's own default of 10,000 is for short ones."""
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "1000")
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, known)])


_in_use: list[dict] = [{}]


def sole(kept: dict) -> dict:
    """Make a look-up table the only one its worker holds; the one before it is emptied.

    Workers live on from stage to stage, and would gather the tables of all operators.
    """
    if _in_use[0] is not kept:
        _in_use[0].clear()
        _in_use[0] = kept
        pa.default_memory_pool().release_unused()
    return kept


def forget() -> None:
    """Give back what earlier operators left in this worker: their look-up tables, and memory they freed."""
    sole({})
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it keeps its memory
        ctypes.CDLL(None).malloc_trim(0)


def groups(texts: list[str], most: int = 1 << 20) -> Iterator[list[str]]:
    """Texts in order, in groups of about ``most`` characters; a longer text is a group."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema
    )


def row_key(*columns: str) -> Column:
    """A row's own key from its contents: the same on every attempt of a lost task.

    Rows that agree in all these columns share a key.
    """
    return F.xxhash64(*(F.coalesce(F.col(c).cast("string"), F.lit("\0null")) for c in columns))


def unused(name: str, columns: list[str]) -> str:
    """The name, with as many underscores before it as no column has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of an undirected graph, as (id, component).

    ``edges`` has longs ``a`` and ``b``; every id on an edge gets the smallest id
    it can reach. Large-star and small-star steps alternate until nothing
    changes; each step aggregates before it shuffles, joins by key and is
    written to the shared folder, so hubs are split and lost executors cost one
    step. The driver sees a count and a checksum a round.
    """
    edges = materialize(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        label,
    )
    seen = _state(edges)
    while seen[0]:
        edges = materialize(_small_star(_large_star(edges)), label)
        now = _state(edges)
        if now == seen:
            break
        seen = now
    # Stars whose hubs are the smallest ids: every edge names a component.
    found = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    hubs = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return found.union(hubs)


def _state(edges: DataFrame) -> tuple:
    checksum = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), checksum).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return (
        both.where("b > a").join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.union(least.select("a", F.col("m").alias("b"))).distinct()
