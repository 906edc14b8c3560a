"""Conversation prefix trie, rolled up by centroid decomposition.

A node is a distinct sequence of first turns; its key is a sum of hashed turns, each times a power that stands for its
place (two lanes of 64 bits), so keys of long conversations come from pieces worked out in several tasks. Subtrees are
summed by splitting the trie at weighted centroids: each split adds the total of what hangs from the centroid to the
nodes between it and the top of its component, and halves the weight, so a chain is no deeper than its logarithm.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.common import batch, map_arrow, table
from starmill.workspace import materialize

#: Nodes of a component that one task splits on its own; larger ones are split by joins.
COMPONENT = 50_000
#: Conversations that share their first turns come in runs of so many ids; at most so many turns are shared.
SERIES, SHARED = 20, 3
#: Bytes of the ids that travel as one row to be hashed.
CHUNK = 1 << 16

# An odd multiplier for each lane, and the key of the root.
BASES = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)
ROOT = bytes(16)
WORD = r"[^\x20\x09-\x0D]+"


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of both bases, modulo 2^64."""
    out = np.tile(BASES, (max(n, 1), 1))
    out[0] = 1
    return np.multiply.accumulate(out, axis=0)


def power(n: int) -> np.ndarray:
    return np.array([pow(int(b), n, 1 << 64) for b in BASES], np.uint64)


def lanes(column: pa.Array) -> np.ndarray:
    """Keys of 16 bytes as two numbers each."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, 2)


def keys(values: np.ndarray) -> list[bytes]:
    raw = np.ascontiguousarray(values, "<u8").tobytes()
    return [raw[i:i + 16] for i in range(0, len(raw), 16)]


def shared_turns(conv_id: Column) -> Column:
    """How many first turns a conversation takes from the first of its series."""
    return F.crc32(conv_id.cast("string").cast("binary")) % (SHARED + 1)


# Places of turns -------------------------------------------------------------------------------------------------

PLACED = "part int, conv_id long, pos long, h binary, before binary, words long"


def placed_turns(conversations: DataFrame) -> DataFrame:
    """Each turn's place in its conversation, and the sums up to it and before it.

    One range partitioning over all turns; a conversation of many turns, or a turn repeated many times, is spread over
    tasks, whose sums are joined by the few totals of conversations that cross a border.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), role.alias("role"),
        F.substring(text, 1, 64).alias("head"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("t"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        (F.monotonically_increasing_id() % 1009).alias("salt"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), *map(F.col, ("role", "head", "t", "salt"))]
    ranges = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = pa.schema([
        ("part", pa.int32()), ("conv_id", pa.int64()), ("pos", pa.int64()), ("h", pa.binary()),
        ("before", pa.binary()), ("words", pa.int64()),
    ])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, at, total = None, 0, np.zeros(2, np.uint64)
        for x in batches:
            if not x.num_rows:
                continue
            conv, turn = x.column("conv_id").to_numpy(), lanes(x.column("t"))
            index = np.arange(len(conv))
            new = np.r_[True, conv[1:] != conv[:-1]]
            start = np.maximum.accumulate(np.where(new, index, 0))
            pos = index - start + 1
            step = powers(len(conv) + 1)[pos]
            carried = (start == 0) & (last is not None and conv[0] == last)
            step[carried] *= power(at)
            value = turn * step
            sums = np.cumsum(value, axis=0, dtype=np.uint64)
            h = sums - (sums - value)[start]
            h[carried] += total
            pos = pos + np.where(carried, at, 0)
            last, at, total = conv[-1], int(pos[-1]), h[-1].copy()
            yield batch(
                schema, part=x.column("part"), conv_id=conv, pos=pos, h=keys(h), before=keys(h - value),
                words=x.column("words"),
            )

    staged = ranges.select("conv_id", "t", "words", F.spark_partition_id().alias("part"))
    return across_borders(materialize(map_arrow(staged, task, PLACED), "turns"))


def across_borders(placed: DataFrame) -> DataFrame:
    """Continue places and sums of conversations that lie in several ranges.

    The driver sees the first and last conversation of each range and the totals of those on a border: at most two
    rows a range.
    """
    ends = placed.groupBy("part").agg(F.min("conv_id").alias("a"), F.max("conv_id").alias("z")).orderBy("part").collect()
    crossing = {x.z for x, y in zip(ends, ends[1:]) if x.z == y.a}
    if not crossing:
        return placed
    wanted = F.broadcast(placed.sparkSession.createDataFrame([(c,) for c in crossing], "conv_id long"))
    totals = (
        placed.join(wanted, "conv_id").groupBy("conv_id", "part")
        .agg(F.max(F.struct("pos", "h")).alias("x")).orderBy("conv_id", "part").collect()
    )
    before: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
    conv, at, total = None, 0, np.zeros(2, np.uint64)
    for row in totals:
        if row.conv_id != conv:
            conv, at, total = row.conv_id, 0, np.zeros(2, np.uint64)
        before[row.part, conv] = at, total
        total = total + power(at) * np.frombuffer(bytes(row.x.h), "<u8")
        at += row.x.pos

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            part, conv, pos = (x.column(c).to_numpy().copy() for c in ("part", "conv_id", "pos"))
            h, prior = lanes(x.column("h")).copy(), lanes(x.column("before")).copy()
            for one in np.unique(part):
                for c in np.unique(conv[part == one]):
                    if (int(one), int(c)) in before:
                        at, total = before[int(one), int(c)]
                        rows = (part == one) & (conv == c)
                        pos[rows] += at
                        h[rows] = h[rows] * power(at) + total
                        prior[rows] = prior[rows] * power(at) + total
            yield batch(
                x.schema, part=part, conv_id=conv, pos=pos, h=keys(h), before=keys(prior), words=x.column("words"),
            )

    return map_arrow(placed, task, PLACED)


# Rebuilt conversations ---------------------------------------------------------------------------------------------


def frames(placed: DataFrame) -> DataFrame:
    """One row a conversation: what it takes from its series, and how its own turns continue that."""
    firsts = range(1, SHARED + 2)
    heads = materialize(
        placed.groupBy("conv_id").agg(
            F.max("pos").alias("n"),
            *(F.max(F.when(F.col("pos") == i, F.hex("h"))).alias(f"h{i}") for i in firsts),
            *(F.max(F.when(F.col("pos") == i, F.col("words"))).alias(f"w{i}") for i in firsts),
        ),
        "heads",
    )
    heads = heads.select(
        "conv_id", "n", F.array(*(F.unhex(f"h{i}") for i in firsts)).alias("h"),
        F.array(*(f"w{i}" for i in firsts)).alias("words"),
    )
    first = heads.where(F.col("conv_id") % SERIES == 0).select(
        F.col("conv_id").alias("first"), F.col("n").alias("first_n"), F.col("h").alias("first_h"),
        F.col("words").alias("first_words"),
    )
    own = heads.select(
        "conv_id", "n", "h", (F.col("conv_id") - F.col("conv_id") % SERIES).alias("first"),
        shared_turns(F.col("conv_id")).alias("taken"),
    )
    turn = pa.struct([("depth", pa.int64()), ("key", pa.binary()), ("parent", pa.binary()), ("words", pa.int64())])
    schema = pa.schema([
        ("conv_id", pa.int64()), ("shift", pa.int64()), ("size", pa.int64()), ("top", pa.binary()),
        ("base", pa.binary()), ("own", pa.binary()), ("turns", pa.list_(turn)),
    ])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            out = []
            for r in x.to_pylist():
                k, h = min(r["taken"], r["first_n"] or 0), [ROOT, *r["h"]]
                theirs = [ROOT, *(r["first_h"] or [])]
                more = max(0, r["n"] - r["taken"])
                own = h[r["taken"]] if more else ROOT
                if k:
                    top = theirs[1]
                elif more:  # its first own turn, moved to the first place
                    a, b = (np.frombuffer(v, "<u8") for v in (own, h[r["taken"] + 1]))
                    top = ((b - a) * power(-r["taken"])).tobytes()
                else:
                    top = ROOT
                turns = [
                    {"depth": i, "key": theirs[i], "parent": theirs[i - 1], "words": r["first_words"][i - 1]}
                    for i in range(1, k + 1)
                ]
                out.append((r["conv_id"], k - r["taken"], k + more, top, theirs[k], own, turns))
            yield batch(schema, **{f.name: [o[i] for o in out] for i, f in enumerate(schema)})

    names = (
        "conv_id long, shift long, size long, top binary, base binary, own binary, "
        "turns array<struct<depth: long, key: binary, parent: binary, words: long>>"
    )
    return materialize(map_arrow(own.join(first, "first", "left"), task, names), "frames")


ROWS = "conv_id long, depth long, key binary, parent binary, words long, size long, top binary"


def rebuilt_turns(placed: DataFrame, frame: DataFrame) -> DataFrame:
    """The turns of all rebuilt conversations: place, key, and key of the turn before."""
    schema = pa.schema([
        ("conv_id", pa.int64()), ("depth", pa.int64()), ("key", pa.binary()), ("parent", pa.binary()),
        ("words", pa.int64()), ("size", pa.int64()), ("top", pa.binary()),
    ])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = np.array([power(-i) for i in range(SHARED + 1)])
        for x in batches:
            base, own = lanes(x.column("base")), lanes(x.column("own"))
            shift = x.column("shift").to_numpy()
            moved = [(lanes(x.column(c)) - own) * back[-shift] + base for c in ("h", "before")]
            yield batch(
                schema, conv_id=x.column("conv_id"), depth=x.column("pos").to_numpy() + shift, key=keys(moved[0]),
                parent=keys(moved[1]), words=x.column("words"), size=x.column("size"), top=x.column("top"),
            )

    own = placed.where(F.col("pos") > shared_turns(F.col("conv_id"))).join(frame.drop("turns"), "conv_id")
    taken = frame.select("conv_id", "size", "top", F.explode("turns").alias("t"))
    taken = taken.select("conv_id", "t.depth", "t.key", "t.parent", "t.words", "size", "top")
    return materialize(map_arrow(own, task, ROWS).union(taken), "trie-turns")


# Rollup --------------------------------------------------------------------------------------------------------------

STATE = ["key", "parent", "part", "conv_id", "depth", "weight", "leaves", "saved", "sum_leaves", "sum_saved"]


def rollup(nodes: DataFrame, turns: DataFrame, component: int = COMPONENT) -> DataFrame:
    """(key, n_leaves, saved_tokens): sums over each node's subtree.

    ``weight`` is the number of turns below a node's top that pass through it, known before any rollup. In a component
    the nodes of at least half its weight are a chain from its top, and the last of them is its centroid. Whether
    another node lies below the centroid is a look at one turn of the node's own conversation. Each round halves the
    weight of all large components at once; those of at most ``component`` nodes are split in one task each.
    """
    state = nodes.select(*STATE[:8], F.lit(0).cast("long").alias("sum_leaves"), F.lit(0).cast("long").alias("sum_saved"))
    steps = turns.select("conv_id", F.col("depth").alias("look"), F.col("key").alias("piece"), F.col("parent").alias("over"))
    finished: list[DataFrame] = []
    small: list[DataFrame] = []
    while True:
        sizes = materialize(
            state.groupBy("part").agg(F.count(F.lit(1)).alias("nodes"), F.max("weight").alias("whole")), "components"
        )
        large = sizes.where(F.col("nodes") > component).select("part", "whole")
        if large.isEmpty():
            small.append(state)
            break
        small.append(state.join(large, "part", "left_anti").select(*STATE))
        state = state.join(large, "part").withColumn("chain", 2 * F.col("weight") >= F.col("whole"))
        centre = state.where("chain").groupBy("part").agg(F.max(F.struct("depth", "key", "weight")).alias("c"))
        placed = materialize(
            state.join(materialize(centre, "centroids"), "part").withColumn("look", F.col("c.depth") + 1)
            .join(steps, ["conv_id", "look"], "left")
            .withColumn("centre", F.col("key") == F.col("c.key"))
            .withColumn("below", F.coalesce((F.col("depth") >= F.col("look")) & (F.col("over") == F.col("c.key")), F.lit(False))),
            "split",
        )
        totals = placed.where("below OR centre").groupBy("part").agg(
            F.sum("leaves").alias("add_leaves"), F.sum("saved").alias("add_saved")
        )
        added = placed.join(totals, "part").select(
            "key", "parent", F.when(F.col("below"), F.col("piece")).otherwise(F.col("part")).alias("part"), "conv_id", "depth",
            (F.col("weight") - F.when(F.col("chain"), F.col("c.weight")).otherwise(F.lit(0))).alias("weight"),
            "leaves", "saved",
            *((F.col(f"sum_{x}") + F.when(F.col("chain"), F.col(f"add_{x}")).otherwise(F.lit(0))).alias(f"sum_{x}") for x in ("leaves", "saved")),
            "centre",
        )
        added = materialize(added, "split")
        finished.append(added.where("centre").select("key", "sum_leaves", "sum_saved"))
        state = added.where("NOT centre").select(*STATE)
    rest = small[0]
    for more in small[1:]:
        rest = rest.union(more)
    out = split_locally(rest)
    for more in finished:
        out = out.union(more)
    return out.toDF("key", "n_leaves", "saved_tokens")


def split_locally(state: DataFrame) -> DataFrame:
    """Split components of bounded size, many of them at once in each task."""
    schema = pa.schema([("key", pa.binary()), ("sum_leaves", pa.int64()), ("sum_saved", pa.int64())])

    def whole_components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, rows = [], 0
        for x in batches:
            if not x.num_rows:
                continue
            held.append(x)
            rows += x.num_rows
            if rows < COMPONENT:
                continue
            found = pa.Table.from_batches(held)
            parts = found["part"].to_pylist()
            last = len(parts)
            while last and parts[last - 1] == parts[-1]:
                last -= 1
            if last:
                yield found.slice(0, last)
            held, rows = found.slice(last).to_batches(), len(parts) - last
        if held:
            yield pa.Table.from_batches(held)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in whole_components(batches):
            key = x["key"].to_pylist()
            place = {k: i for i, k in enumerate(key)}
            at = np.arange(len(key))
            top = np.array([k == p for k, p in zip(key, x["part"].to_pylist())])
            parent = np.where(top, at, [place.get(p, -1) for p in x["parent"].to_pylist()])
            values = np.array([x["leaves"].to_numpy(), x["saved"].to_numpy()]).T
            sums = centroid_sums(parent, x["weight"].to_numpy(), values)
            sums += np.array([x["sum_leaves"].to_numpy(), x["sum_saved"].to_numpy()]).T
            yield batch(schema, key=key, sum_leaves=sums[:, 0], sum_saved=sums[:, 1])

    ordered = state.repartition("part").sortWithinPartitions("part", "depth")
    return map_arrow(ordered, task, "key binary, sum_leaves long, sum_saved long")


def centroid_sums(parent: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of values over subtrees of a forest; a top is its own parent, weights include all below.

    All components are split at once: each round takes one centroid out of each.
    """
    weight, sums = weight.astype(np.int64), np.zeros_like(values)
    alive = np.arange(len(parent))
    up = parent.copy()  # within a component; its top points to itself
    while len(alive):
        part = tops(up, alive)
        chain = alive[2 * weight[alive] >= weight[part[alive]]]
        inner = np.zeros(len(parent), bool)
        inner[up[chain[up[chain] != chain]]] = True
        centre = chain[~inner[chain]]
        of = np.empty(len(parent), np.int64)
        of[part[centre]] = centre
        # What hung from a centroid becomes components of their own.
        out = np.zeros(len(parent), bool)
        out[centre] = True
        cut = alive[out[up[alive]] & ~out[alive]]
        over = up[cut]
        up[cut] = cut
        rest = alive[~out[alive]]
        pieces = tops(up, rest)
        total = np.zeros_like(values)
        np.add.at(total, pieces[rest], values[rest])
        below = values[centre].copy()
        held = np.zeros_like(values)
        np.add.at(held, over, total[cut])
        below += held[centre]
        add = np.zeros_like(values)
        add[centre] = below
        own = of[part[chain]]
        sums[chain] += add[own]
        light = weight[own]
        weight[chain] -= light
        alive = rest
    return sums


def tops(up: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """The top of each living node's component, by doubling steps."""
    found = np.arange(len(up))
    found[alive] = up[alive]
    while True:
        further = found[found[alive]]
        if np.array_equal(further, found[alive]):
            return found
        found[alive] = further


# Members that end at a node -------------------------------------------------------------------------------------------


def end_digests(turns: DataFrame, frame: DataFrame) -> DataFrame:
    """(key, ends_sha256) of every node at which conversations end.

    Ids are range-partitioned by node and id; each task writes those of a node as chunks of text, and only these chunks
    meet in the task that hashes them one after another. It never holds a node's ids.
    """
    ends = turns.where("depth = size").select("key", "conv_id")
    ends = ends.union(frame.where("size = 0").select(F.lit(ROOT).alias("key"), "conv_id"))
    pieces = pa.schema([("key", pa.binary()), ("first", pa.int64()), ("ids", pa.binary())])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            key, ids = x.column("key").to_pylist(), x.column("conv_id").to_pylist()
            out, start = [], 0
            for i in range(1, len(key) + 1):
                if i == len(key) or key[i] != key[start] or 21 * (i - start) >= CHUNK:
                    out.append((key[start], ids[start], ",".join(map(str, ids[start:i])).encode()))
                    start = i
            if out:
                yield batch(pieces, **{f.name: [o[i] for o in out] for i, f in enumerate(pieces)})

    digests = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for x in batches:
            out = []
            for k, ids in zip(x.column("key").to_pylist(), x.column("ids").to_pylist()):
                if k == key:
                    state.update(b",")
                elif state:
                    out.append((key, state.hexdigest()))
                    state = None
                key, state = k, state or hashlib.sha256()
                state.update(ids)
            if out:
                yield batch(digests, key=[o[0] for o in out], ends_sha256=[o[1] for o in out])
        if state:
            yield batch(digests, key=[key], ends_sha256=[state.hexdigest()])

    ranges = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    parts = map_arrow(ranges, chunks, "key binary, first long, ids binary")
    return map_arrow(
        parts.repartition("key").sortWithinPartitions("key", "first"), digest, "key binary, ends_sha256 string"
    )


def prefix_trie(conversations: DataFrame, component: int = COMPONENT) -> DataFrame:
    """All nodes of the trie of rebuilt conversations, with sums over their subtrees.

    Takes conv_id, turn, role, text; other columns are left alone. Turns are ordered by turn (null first), equal ones
    by role, by the first 64 characters of the text, then by a hash; a turn given twice counts twice. Null role or text
    is empty, rows without a conv_id belong to no conversation, and without conversations there is no node.
    """
    spark = conversations.sparkSession
    placed = placed_turns(conversations)
    frame = frames(placed)
    turns = rebuilt_turns(placed, frame)
    # A node's parent, depth, words and top follow from its key; they group with it.
    nodes = turns.groupBy("key", "parent", "depth", "words", "top").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.col("size") - F.col("depth") + 1).alias("weight"),
    )
    nodes = materialize(nodes, "trie-nodes")
    n_all, least = frame.agg(F.count(F.lit(1)), F.min("conv_id")).first()
    children = nodes.where("depth > 1").groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"))
    known = nodes.join(children.withColumnRenamed("parent", "key"), "key", "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("long"))
    )
    known = materialize(known, "trie-nodes")
    sums = rollup(
        known.withColumns({
            "part": F.col("top"), "leaves": (F.col("n_children") == 0).cast("long"),
            "saved": (F.col("n_convs") - 1) * F.col("words"),
        }),
        turns, component,
    )
    over = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    named = known.where("depth > 1").join(over, "parent").select(*known.columns, "parent_conv_id").union(
        known.where("depth = 1").withColumn("parent_conv_id", F.lit(least).cast("long"))
    )
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    body = named.join(sums, "key").select("key", *columns)
    # The root is the sum of all there is.
    root = known.agg(
        F.sum((F.col("depth") == 1).cast("long")), F.sum((F.col("n_children") == 0).cast("long")),
        F.sum((F.col("n_convs") - 1) * F.col("words")),
    ).first()
    first = [(ROOT, least, 0, None, n_all, root[0] or 0, root[1] or 1, root[2] or 0)] if n_all else []
    kinds = "key binary, " + ", ".join(f"{c} long" for c in columns)
    ends = end_digests(turns, frame)
    empty = F.lit(hashlib.sha256().hexdigest())
    return (
        body.union(spark.createDataFrame(first, kinds)).join(ends, "key", "left")
        .select(*columns, F.coalesce("ends_sha256", empty).alias("ends_sha256"))
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


OP11_SQL = r"""
WITH numbered AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), left(coalesce(text, ''), 64)) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), crc AS (
    SELECT c, list_reduce(flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
            lambda ch: list_transform(range(8), lambda i: CAST((ascii(ch) >> i) & 1 AS BIGINT)))),
        lambda s, b: CASE WHEN xor(s, b) & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END,
        CAST(4294967295 AS BIGINT)) AS s
    FROM (SELECT DISTINCT conv_id AS c FROM numbered)
), h AS (
    SELECT c, xor(s, 4294967295) % 4 AS h FROM crc
), taken AS (
    SELECT c, pos AS depth, role, text FROM h JOIN numbered ON conv_id = c - c % 20 AND pos <= h
), k AS (
    SELECT c, count(*) AS k FROM taken GROUP BY c
), turns AS (
    SELECT c, 0 AS depth, NULL AS role, NULL AS text FROM h
    UNION ALL SELECT * FROM taken
    UNION ALL SELECT c, coalesce(k, 0) + pos - h, role, text
    FROM h JOIN numbered ON conv_id = c AND pos > h LEFT JOIN k USING (c)
), paths AS (
    SELECT c, depth, text, max(depth) OVER (PARTITION BY c) AS size,
        list(coalesce(md5(length(role) || ':' || role || text), '')) OVER (PARTITION BY c ORDER BY depth) AS path
    FROM turns
), nodes AS (
    SELECT path, depth, min(c) AS conv_id, count(*) AS n_convs,
        (count(*) - 1) * coalesce(len(regexp_extract_all(any_value(text), '[^\x20\x09-\x0D]+')), 0) AS saved,
        string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (depth = size) AS ends
    FROM paths GROUP BY path, depth
), children AS (
    SELECT path[:len(path) - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), below AS (
    SELECT p.path, n.saved, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf
    FROM nodes n JOIN paths p ON p.c = n.conv_id AND p.depth <= n.depth LEFT JOIN children ON children.path = n.path
), sums AS (
    SELECT path, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM below GROUP BY path
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, o.conv_id AS parent_conv_id, n.n_convs,
    coalesce(n_children, 0) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
    CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN sums ON sums.path = n.path LEFT JOIN children ON children.path = n.path
    LEFT JOIN nodes o ON o.path = n.path[:len(n.path) - 1] AND n.depth > 0
"""

QUERIES = {"op11_prefix_trie": (op11_prefix_trie, OP11_SQL)}
