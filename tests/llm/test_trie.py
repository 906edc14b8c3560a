"""The conversation prefix trie, against a plain walk over all prefixes."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from starmill.llm.centroid_trie import centroid_sums, op11_prefix_trie, placed_turns, prefix_trie

CONV = "conv_id long, turn long, role string, text string"
COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


def rest(n, k):
    """Remainder that keeps the sign of the number, as SQL has it."""
    return n - k * int(n / k)


def brute(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(t)] for c, t in turns.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = (*turns.get(c - rest(c, 20), [])[:h], *own[h:])
    members, kids = {}, {}
    for c, t in built.items():
        for d in range(len(t) + 1):
            members.setdefault(t[:d], []).append(c)
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for path, own in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in kids
            saved[path[:d]] += (len(own) - 1) * words
    out = set()
    for path, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(built[c]) == len(path))
        out.add((
            min(own), len(path), min(members[path[:-1]]) if path else None, len(own), len(kids.get(path, [])),
            leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def found(df):
    rows = [tuple(r) for r in df.select(*COLUMNS).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def odd_rows():
    rows = [(0, t, "user", f"t{t} a b") for t in range(9)]
    rows += [(c, t, "user", f"t{t} a b") for c in range(1, 60) for t in range(c % 6)]  # series with and without a first
    rows += [(100, t, "assistant", "a long one") for t in range(300)]
    rows += [(100 + c, t, "assistant", "a long one") for c in (3, 7, 13) for t in range(280 + c)]
    rows += [(c, t, "user", "same") for c in range(200, 290) for t in range(4)]  # a hot conversation
    rows += [(300, None, None, None), (300, None, None, None), (300, 1, "", ""), (301, 2, None, "x \x0b y"), (301, 2, "a", "z")]
    rows += [(None, 1, "user", "lost"), (-3, 0, "user", "t0 a b"), (-21, 5, "user", "minus"), (-20, 5, "user", "twenty")]
    rows += [(400, 1, "user", "again " * 20_000)] * 40 + [(401, 7, "u", "ab"), (402, 7, "ua", "b")]
    return rows


@pytest.mark.parametrize("component", [50_000, 3])
def test_odd_conversations(spark, many_ranges, component):
    rows = odd_rows()
    df = spark.createDataFrame(rows, CONV).repartition(5)
    assert found(prefix_trie(df, component)) == brute(rows)


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(op11_prefix_trie(spark, sf_dir)) == brute(rows)


def test_places_across_ranges(spark, many_ranges):
    rows = [(5, t, "u", f"x{t}") for t in range(4000)] + [(6, 0, "u", "x0")]
    placed = placed_turns(spark.createDataFrame(rows, CONV)).collect()
    assert len({r.part for r in placed}) > 2
    assert sorted((r.conv_id, r.pos) for r in placed) == [(5, p) for p in range(1, 4001)] + [(6, 1)]
    by_place = {(r.conv_id, r.pos): r for r in placed}
    assert all(bytes(by_place[5, p].before) == bytes(by_place[5, p - 1].h) for p in range(2, 4001))
    assert bytes(by_place[5, 1].h) == bytes(by_place[6, 1].h)


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([(20, 0, "u", "a", 1, 2, 3)], CONV + ", key int, depth int, n_convs int")
    assert found(prefix_trie(df)) == brute([(20, 0, "u", "a")])
    assert found(prefix_trie(df.limit(0))) == set()


def test_turnless_conversations_only(spark):
    # 1 has three turns fewer than it would share, and no first conversation to share with.
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(c, 0, "u", "gone"), (c, 1, "u", "gone too")]
    assert found(prefix_trie(spark.createDataFrame(rows, CONV))) == brute(rows) == {
        (c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())
    }


@pytest.mark.parametrize("shape", ["random", "chain", "star"])
def test_centroid_sums(shape):
    rng = np.random.default_rng(5)
    n = 700
    parent = {
        "random": [int(rng.integers(0, i)) if i > 3 else i for i in range(n)],
        "chain": [max(0, i - 1) for i in range(n)],
        "star": [0] * n,
    }[shape]
    values = rng.integers(0, 50, (n, 2))
    weight, want = rng.integers(1, 9, n), values.copy()
    for i in range(n - 1, 0, -1):
        if parent[i] != i:
            weight[parent[i]] += weight[i]
            want[parent[i]] += want[i]
    assert np.array_equal(centroid_sums(np.array(parent), weight, values), want)
