"""Ranked lexical search: items and documents lie in two trees of coordinate maxima that are searched together.

A node of the document tree holds, for each term, the largest impact of its documents; a node of the item tree the
largest weight of its items. The product of two nodes bounds every score between them, so a pair whose bound is below
the weakest k-th score of the items goes without a look at its documents. A bound equal to that score stays, since a
smaller id could win the tie: the result is exact.
"""

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmill.llm.common import batch, map_arrow, table
from starmill.workspace import materialize

#: Entries (item, term) that one block of items has about; workers hold one block.
BLOCK = 1 << 14
#: Documents of a tree and of a leaf, items of a leaf, children of a node.
TREE, LEAF, ITEM_LEAF, FAN = 4096, 4, 4, 4
#: Sums of products below this are exact in doubles.
EXACT = 1 << 53

# Bytes that belong to no term become blanks, A-Z become a-z, all others stay.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text in order, as UTF-8; null has none."""
    return text.encode().translate(FOLD).split() if text else []


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct (id, term) of the items; rows that share an id form one item."""
    schema = pa.schema([("id", pa.int64()), ("terms", pa.list_(pa.string()))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            own = [[t.decode() for t in set(terms_of(v))] for v in x.column("text").to_pylist()]
            yield batch(schema, id=x.column("id"), terms=own)

    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = map_arrow(rows, task, "id long, terms array<string>")
    return found.select("id", F.explode("terms").alias("term")).distinct()


class Items:
    """A block of items: their terms by number, and the tree over them once weights are known."""

    def __init__(self, pairs: pa.Table):
        ids = pairs["id"].to_pylist()
        words = pairs["term"].to_pylist()
        self.ids = sorted(set(ids), key=lambda i: (i is not None, i or 0))
        self.vocabulary = sorted(set(words))
        number = {t: k for k, t in enumerate(self.vocabulary)}
        place = {i: k for k, i in enumerate(self.ids)}
        self.item = np.array([place[i] for i in ids], np.int64)
        self.term = np.array([number[t] for t in words], np.int64)

    def weigh(self, counts: dict[int, int], n_docs: int) -> None:
        """Set the weights from the documents that hold each term; terms in no document weigh nothing."""
        weight = np.zeros(len(self.vocabulary), np.int64)
        for term, df in counts.items():
            weight[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        self.weight = weight
        # Products stay whole in doubles; only items of hundreds of thousands of terms need the slower integers.
        self.kind = np.float64 if int(weight.sum()) * 1_000_000 < EXACT else np.int64
        whole = np.zeros((len(self.ids), len(weight)), self.kind)
        whole[self.item, self.term] = weight[self.term]
        self.order = np.lexsort((whole.sum(axis=1), whole.argmax(axis=1)))
        # Levels from the items up to one root, each with the coordinate maxima of the level below.
        self.levels = tower(whole[self.order], ITEM_LEAF)

    def weakest(self, least: np.ndarray) -> list[np.ndarray]:
        """The weakest k-th score below each node, level by level."""
        out, fan = [least[self.order]], ITEM_LEAF
        for rows in self.levels[1:]:
            out.append(np.minimum.reduceat(out[-1], np.arange(0, len(out[-1]), fan)))
            fan = FAN
        return out


def tower(rows: np.ndarray, fan: int) -> list[np.ndarray]:
    """Rows, then the coordinate maxima of groups of them, up to a single one."""
    levels = [rows]
    while len(levels[-1]) > 1:
        levels.append(np.maximum.reduceat(levels[-1], np.arange(0, len(levels[-1]), fan), axis=0))
        fan = FAN
    return levels


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, all_terms: int) -> np.ndarray:
    """Impact of each posting: its frequency against its document's length, in whole numbers."""
    if len(n) and 90 * int(n.max()) * n_docs >= 1 << 63:
        m = np.array([10 + 90 * int(x) * n_docs // all_terms for x in n], np.int64)
    else:
        m = 10 + 90 * n * n_docs // max(all_terms, 1)
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class Documents:
    """A tree over some documents, each a sparse row of impacts."""

    def __init__(self, items: Items, ids, known, starts, terms, impact):
        value = items.weight[terms] * impact
        rows = np.repeat(np.arange(len(ids)), np.diff(starts))
        # Documents whose heaviest term is the same lie together, so maxima are tight.
        best = np.lexsort((-value, rows))
        best = best[np.searchsorted(rows[best], np.arange(len(ids)))]
        order = np.lexsort((impact[best], terms[best]))
        self.ids, self.known = ids[order], known[order]
        self.columns, column = np.unique(terms, return_inverse=True)
        self.place = np.empty(len(ids), np.int64)
        self.place[order] = np.arange(len(ids))
        at = self.place[rows]
        by = np.argsort(at, kind="stable")
        self.at, self.column, self.impact = at[by], column[by], impact[by].astype(items.kind)
        self.starts = np.searchsorted(self.at, np.arange(len(ids) + 1))
        leaf = np.zeros((-(-len(ids) // LEAF), len(self.columns)), items.kind)
        np.maximum.at(leaf, (self.at // LEAF, self.column), self.impact)
        self.levels = tower(leaf, FAN)

    def dense(self, leaf: int) -> np.ndarray:
        first, last = leaf * LEAF, min(len(self.ids), (leaf + 1) * LEAF)
        s, e = self.starts[first], self.starts[last]
        out = np.zeros((last - first, len(self.columns)), self.impact.dtype)
        out[self.at[s:e] - first, self.column[s:e]] = self.impact[s:e]
        return out


class Best:
    """The k best documents of each item so far."""

    def __init__(self, items: Items, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()
        self.rows = [([], [], []) for _ in items.ids]  # scores, ids, whether there is an id

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        good = np.flatnonzero((scores > 0) & (scores >= self.least[item]))
        if not len(good):
            return
        s, i, n = (np.concatenate([np.asarray(a), b[good]]) for a, b in zip(self.rows[item], (scores, ids, known)))
        top = np.lexsort((i, ~n.astype(bool), -s))[:self.k]
        self.rows[item] = (s[top], i[top], n[top])
        if len(top) == self.k:
            self.least[item] = max(self.least[item], s[top[-1]])


def search(items: Items, docs: Documents, best: Best) -> int:
    """Go down both trees together and score what no bound excludes; returns the scores computed."""
    narrow = [level[:, docs.columns] for level in items.levels]
    i, d = len(items.levels) - 1, len(docs.levels) - 1
    nodes, parts = np.arange(len(narrow[i])), np.arange(len(docs.levels[d]))
    alive = np.ones((len(nodes), len(parts)), bool)
    while True:
        least = items.weakest(best.least)[i]
        alive &= narrow[i][nodes] @ docs.levels[d][parts].T >= least[nodes][:, None]
        keep_i, keep_d = alive.any(axis=1), alive.any(axis=0)
        nodes, parts, alive = nodes[keep_i], parts[keep_d], alive[keep_i][:, keep_d]
        if not len(nodes) or d == 0 and i == 0:
            break
        if d:
            d -= 1
            parent = np.repeat(np.arange(len(parts)), FAN)
            parts = (parts[:, None] * FAN + np.arange(FAN)).ravel()
            real = parts < len(docs.levels[d])
            parts, alive = parts[real], alive[:, parent[real]]
        if i:
            i -= 1
            fan = FAN if i else ITEM_LEAF
            parent = np.repeat(np.arange(len(nodes)), fan)
            nodes = (nodes[:, None] * fan + np.arange(fan)).ravel()
            real = nodes < len(narrow[i])
            nodes, alive = nodes[real], alive[parent[real]]
    scored = 0
    if len(nodes):
        # Leaves with the greatest promise first: they raise the k-th scores for the others.
        bound = narrow[0][nodes] @ docs.levels[0][parts].T
        for p in np.argsort(-np.where(alive, bound, 0).max(axis=0), kind="stable"):
            asking = np.flatnonzero(alive[:, p] & (bound[:, p] >= best.least[items.order[nodes]]))
            if not len(asking):
                continue
            first = parts[p] * LEAF
            scores = (narrow[0][nodes[asking]] @ docs.dense(parts[p]).T).astype(np.int64)
            ids, known = docs.ids[first:first + LEAF], docs.known[first:first + LEAF]
            scored += scores.size
            for row, item in zip(scores, items.order[nodes[asking]]):
                best.add(item, row, ids, known)
    return scored


def sow(items: Items, docs: Documents, best: Best) -> None:
    """Score each item's most promising leaf, so that all tasks can start from good k-th scores."""
    bound = items.levels[0][:, docs.columns] @ docs.levels[0].T
    for row, leaf in enumerate(bound.argmax(axis=1)):
        scores = (docs.dense(leaf) @ items.levels[0][row, docs.columns]).astype(np.int64)
        at = slice(leaf * LEAF, leaf * LEAF + LEAF)
        best.add(items.order[row], scores, docs.ids[at], docs.known[at])


def forward(docs: DataFrame, sent) -> DataFrame:
    """Postings of each document within a block's vocabulary, and how many documents of a task hold each term."""
    schema = pa.schema([
        ("id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tf", pa.list_(pa.int64())),
        ("held", pa.list_(pa.int64())),
    ])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t.encode(): k for k, t in enumerate(sent.value.vocabulary)}
        held = np.zeros(len(number), np.int64)
        for x in batches:
            n, terms, tf = [], [], []
            for text in x.column("text"):
                words = terms_of(text.as_py())
                n.append(len(words))
                counts = [(number[w], c) for w, c in Counter(words).items() if w in number]
                terms.append([t for t, _ in counts])
                tf.append([c for _, c in counts])
                held[terms[-1]] += 1
            yield batch(schema, id=x.column("id"), n=n, terms=terms, tf=tf, held=[None] * len(n))
        some = np.flatnonzero(held)
        yield batch(schema, id=[None], n=[0], terms=[some], tf=[[]], held=[held[some]])

    names = "id long, n long, terms array<int>, tf array<long>, held array<long>"
    return materialize(map_arrow(docs, task, names), "postings")


def trees(items: Items, batches: Iterator[pa.RecordBatch], n_docs: int, all_terms: int) -> Iterator[Documents]:
    """Documents of a task as trees of bounded size."""
    most = max(LEAF, min(TREE, (1 << 25) // max(1, len(items.vocabulary))))
    for x in batches:
        for s in range(0, x.num_rows, most):
            part = x.slice(s, most)
            lists = part.column("terms")
            size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            n = np.repeat(part.column("n").to_numpy(), size)
            tf = part.column("tf").flatten().to_numpy()
            yield Documents(
                items, part.column("id").fill_null(0).to_numpy(), part.column("id").is_valid().to_numpy(False),
                np.concatenate([[0], np.cumsum(size)]), lists.flatten().to_numpy().astype(np.int64),
                impacts(tf, n, n_docs, all_terms),
            )


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", block: int = BLOCK,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest score for each item.

    Items come in blocks of about ``block`` entries (item, term), an item of more is a block of its own; workers hold one
    block, and documents are read once for each. Documents are never shuffled: a task turns its own into postings, trees and at most ``k`` candidates an
    item. Items without terms or with no document above 0 have no rows. A null item id is an id; documents of null id
    count and can be found, and stand last among equals; repeated document rows are documents of their own.
    """
    spark = docs.sparkSession
    asked = materialize(item_terms(items, item_id, item_text), "item-terms")
    sizes = asked.groupBy("id").count()
    vast = [i for i, _ in sizes.where(F.col("count") > block).collect()]  # at most one in ``block`` entries
    named = F.coalesce(F.col("id").isin([i for i in vast if i is not None]), F.lit(None in vast))
    rest = asked.where(~named)
    blocks = -(-rest.count() // block)
    number = F.pmod(F.xxhash64(F.coalesce("id", F.lit(-1))), F.lit(max(1, blocks)))
    chosen = [asked.where(F.col("id").eqNullSafe(i)) for i in vast] + [rest.where(number == b) for b in range(blocks)]
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = [_rank_block(spark, texts, part, k) for part in (Items(x.toArrow()) for x in chosen) if part.ids]
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def _rank_block(spark: SparkSession, texts: DataFrame, items: Items, k: int) -> DataFrame:
    sent = spark.sparkContext.broadcast(items)
    index = forward(texts, sent)
    rows = index.where("held IS NULL")
    n_docs, all_terms = rows.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    pairs = index.where("held IS NOT NULL").select(F.explode(F.arrays_zip("terms", "held")).alias("x"))
    counts = dict(pairs.groupBy("x.terms").agg(F.sum("x.held")).collect())
    items.weigh(counts, n_docs)
    sent = spark.sparkContext.broadcast(items)
    schema = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
    full = rows.where(F.size("terms") > 0).select("id", "n", "terms", "tf")

    def candidates(visit, least: np.ndarray) -> DataFrame:
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = sent.value
            best = Best(items, k, least)
            for tree in trees(items, batches, n_docs, all_terms):
                visit(items, tree, best)
            for item, (scores, ids, known) in enumerate(best.rows):
                if len(scores):
                    doc_ids = [int(i) if n else None for i, n in zip(ids, known)]
                    yield batch(schema, item=[item] * len(scores), doc_id=doc_ids, score=scores)

        return map_arrow(full, task, "item long, doc_id long, score long")

    by = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    seeds = candidates(sow, np.zeros(len(items.ids), np.int64)).withColumn("rank", F.row_number().over(by))
    least = np.zeros(len(items.ids), np.int64)
    for item, score in seeds.where(F.col("rank") == k).select("item", "score").collect():
        least[item] = score
    ranked = candidates(search, least).withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    names = spark.createDataFrame(list(enumerate(items.ids)), "item long, item_id long")
    return ranked.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op13_dual_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), s AS (
    SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS all_terms FROM d WHERE len(terms) > 0
), q AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), p AS (
    SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d
), tf AS (
    SELECT r, doc_id, n, term, count(*) AS tf FROM p WHERE term IN (SELECT term FROM q) GROUP BY ALL
), w AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM tf, s GROUP BY term
), scores AS (
    SELECT item_id, r, doc_id,
        CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // all_terms)))) AS BIGINT) AS score
    FROM q JOIN tf USING (term) JOIN w USING (term), s
    GROUP BY item_id, r, doc_id
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
    FROM scores WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

QUERIES = {"op13_dual_tree": (op13_dual_tree, OP13_SQL)}
