"""Nearest neighbours by balanced posting lists, a graph of centroids and distance-ratio pruning."""

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmill.llm.common import batch, map_arrow, table
from starmill.llm.vectors import fit, kmeans, matrix, meet, squared_distances, valid_vectors
from starmill.workspace import materialize

NEAREST = 10
MOST_LISTS = 4096  # bound of the centroids every task holds
COPIES = 3  # lists a boundary vector is filed in at most; the first is always its nearest
BOUNDARY = 1.04  # a list is near enough for a copy within this ratio of the nearest distance
PRUNE = 1.15  # a list is searched within this ratio of the query's nearest centroid
NEIGHBOURS = 24  # of a centroid in the graph


def fit_lists(lists: int):
    """What fits centroids of even crowd and the graph that searches them."""

    def task(points: np.ndarray) -> dict[str, np.ndarray]:
        centroids = kmeans(points, lists, rounds=12, balance=0.02)
        far = squared_distances(centroids, centroids)
        np.fill_diagonal(far, np.inf)
        near = np.argsort(far, axis=1, kind="stable")[:, :min(NEIGHBOURS, len(centroids) - 1)]
        middle = np.argmin(squared_distances(points.mean(0, keepdims=True), centroids))
        return {"centroids": centroids, "graph": near.astype(float), "entry": np.array([float(middle)])}

    return task


class CentroidGraph:
    """Centroids linked to their nearest ones in either direction, searched best first."""

    def __init__(self, fitted: dict[str, np.ndarray]):
        self.centroids = fitted["centroids"]
        self.entry = int(fitted["entry"][0])
        links: list[set[int]] = [set() for _ in self.centroids]
        for i, near in enumerate(fitted["graph"].astype(int)):
            for j in near.tolist():
                links[i].add(j)
                links[j].add(i)
        self.links = [np.array(sorted(x), int) for x in links]

    def search(self, query: np.ndarray, ratio: float) -> list[int]:
        """Centroids within ``ratio`` times the nearest one's distance, nearest first.

        Walks the graph from its entry, always on from the nearest centroid seen.
        A walk ends where nothing within the ratio is left to walk on from; while
        the nearest still moves, it goes on from the best ``NEIGHBOURS`` at least.
        """
        far = {self.entry: float(np.linalg.norm(query - self.centroids[self.entry]))}
        open_, best = [(far[self.entry], self.entry)], far[self.entry]
        walked = 0
        while open_:
            distance, at = heapq.heappop(open_)
            if distance > best * ratio and walked >= NEIGHBOURS:
                break
            walked += 1
            new = [j for j in self.links[at].tolist() if j not in far]
            if not new:
                continue
            for j, d in zip(new, np.linalg.norm(self.centroids[new] - query, axis=1).tolist()):
                far[j] = d
                best = min(best, d)
                heapq.heappush(open_, (d, j))
        return [j for d, j in sorted((d, j) for j, d in far.items()) if d <= best * ratio]


    def enough(self, query: np.ndarray, ratio: float, sizes: np.ndarray, least: int) -> np.ndarray:
        """Lists to search: as ``search`` finds, or, if these hold fewer than ``least`` entries,
        those within ``ratio`` times the distance at which the nearest lists hold as many."""
        found = np.array(self.search(query, ratio))
        if sizes[found].sum() >= least:
            return found
        far = np.linalg.norm(self.centroids - query, axis=1)
        order = np.argsort(far, kind="stable")
        held = np.cumsum(sizes[order])
        line = far[order[min(np.searchsorted(held, least), len(order) - 1)]]
        return np.union1d(found, order[far[order] <= line * ratio])


def copies(vectors: np.ndarray, centroids: np.ndarray) -> list[np.ndarray]:
    """The lists of each vector: its nearest, and a copy in those near whose boundary it lies."""
    far = np.sqrt(squared_distances(vectors, centroids))
    order = np.argsort(far, axis=1, kind="stable")[:, :COPIES]
    near = np.take_along_axis(far, order, axis=1)
    return [o[d <= BOUNDARY * d[0]] for o, d in zip(order, near)]


def nearest(
    df: DataFrame, is_query: str, id_col: str = "vec_id", vector_col: str = "embedding",
    k: int = NEAREST, prune: float = PRUNE,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest rows found for each query.

    ``is_query`` is a condition on ``id``. Equal vectors are one entry of the
    index with the ``k + 1`` smallest ids, of which a result can show no more.
    Long lists are blocks of many tasks; each gives back a query's ``k`` best,
    so what is shuffled at the end grows with the queries and their lists only.
    Distances are Euclidean, in double precision, on the original vectors. Rows
    that cannot be compared take no part.
    """
    rows = valid_vectors(df, id_col, vector_col)
    first = Window.partitionBy("vector").orderBy("id")
    entries = materialize(
        rows.withColumn("at", F.row_number().over(first)).where(F.col("at") <= k + 1)
        .groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.min("id").alias("id")),
        "posting-entries",
    )
    n = entries.count()
    result = "query_id long, rank int, vec_id long, score double"
    if not n:
        return df.sparkSession.createDataFrame([], result)
    lists = max(1, min(MOST_LISTS, int(n**0.5 / 2)))
    fitted = fit(entries, n, fit_lists(lists))
    sent = df.sparkSession.sparkContext.broadcast(fitted)
    schema = pa.schema([
        ("list", pa.int64()), ("id", pa.int64()), ("ids", pa.list_(pa.int64())),
        ("vector", pa.list_(pa.float64())),
    ])
    names = "list long, id long, ids array<long>, vector array<double>"

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = sent.value["centroids"]
        for x in batches:
            for start in range(0, len(x), 2000):
                part = x.slice(start, 2000)
                yield _spread(part, copies(matrix(part.column("vector")), centroids), schema)

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for start in range(0, len(x), 2000):
                filed = copies(matrix(x.slice(start, 2000).column("vector")), sent.value["centroids"])
                yield pa.RecordBatch.from_pydict({"list": pa.array([o[0] for o in filed], pa.int64())})

    # Entries of each list but for copies: a number for each of a bounded number of lists.
    sizes = np.zeros(len(fitted["centroids"]), np.int64)
    for r in map_arrow(entries.select("vector"), homes, "list long").groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = CentroidGraph(sent.value)
        for x in batches:
            for start in range(0, len(x), 200):
                part = x.slice(start, 200)
                found = [graph.enough(v, prune, sizes, k + 1) for v in matrix(part.column("vector"))]
                yield _spread(part, found, schema)

    index = map_arrow(entries.select("id", "ids", "vector"), file, names)
    queries = rows.where(is_query).select(
        "id", F.lit(None).cast("array<long>").alias("ids"), "vector"
    )
    found = meet(index, map_arrow(queries, ask, names), _best(k), "query_id long, vec_id long, score double")
    by_query = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.distinct().withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _spread(part: pa.RecordBatch, lists: list[np.ndarray], schema: pa.Schema) -> pa.RecordBatch:
    """Each row once for each of its lists."""
    at = pa.array(np.repeat(np.arange(len(part)), [len(x) for x in lists]))
    rows = part.take(at)
    return batch(
        schema, list=np.concatenate(lists), id=rows.column("id"), ids=rows.column("ids"),
        vector=rows.column("vector"),
    )


def _best(k: int):
    def compare(_: int, queries: pa.Table, rows: pa.Table) -> pa.Table:
        q, v = matrix(queries["vector"]), matrix(rows["vector"])
        q_ids, ids = queries["id"].to_pylist(), rows["ids"].to_pylist()
        # Distances are small beside vectors far from the origin; taken from a point among them, little is lost.
        near_q, near_v = q - v[0], v - v[0]
        rough = squared_distances(near_q, near_v)
        # What rounding may add to a rough distance, by the vectors' lengths.
        slack = 16 * (v.shape[1] + 2) * np.finfo(float).eps * ((near_q**2).sum(1) + (near_v**2).sum(1).max())
        kept = min(k + 1, len(v))  # one may be the query's own entry
        out: list[tuple[int, int, float]] = []
        for i, query in enumerate(q_ids):
            # Rounding may disturb ties; take all within it of the last one kept.
            line = np.partition(rough[i], kept - 1)[kept - 1]
            at = np.flatnonzero(rough[i] <= line + slack[i])
            exact = np.sqrt(((v[at] - q[i]) ** 2).sum(1))
            near = sorted((s, vec) for s, a in zip(exact.tolist(), at) for vec in ids[a] if vec != query)
            out += [(query, vec, s) for s, vec in near[:k]]
        query, vec, score = zip(*out) if out else ((), (), ())
        return pa.table({
            "query_id": pa.array(query, pa.int64()), "vec_id": pa.array(vec, pa.int64()),
            "score": pa.array(score, pa.float64()),
        })

    return compare


def op4_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of every embedding whose id is divisible by 100."""
    return nearest(table(spark, sf_dir, "embeddings"), "id % 100 = 0")


QUERIES = {"op4_posting_lists": (op4_posting_lists, None)}
