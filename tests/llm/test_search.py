"""Ranked lexical search, against a plain ranking of all documents."""

import math
import re
import string
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from conftest_llm import DOC, ODD_TEXTS, document
from starmill.llm import dual_tree
from starmill.llm.dual_tree import Best, Items, op13_dual_tree, rank_documents, search, terms_of, trees

ITEM = "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    held = [(i, words(t)) for i, t in docs]
    held = [(i, w, Counter(w)) for i, w in held if w]
    n_docs, total = len(held), sum(len(w) for _, w, _ in held)
    df = Counter(t for _, _, c in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(words(t))
    out = set()
    for item, terms in asked.items():
        scores = []
        for i, w, c in held:
            m = 10 + 90 * len(w) * n_docs // total
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms if t in c
            )
            if s > 0:
                scores.append((-s, i is None, i or 0))
        for rank, (s, none, i) in enumerate(sorted(scores)[:k], 1):
            out.add((item, rank, None if none else i, -s))
    return out


def rows(df):
    return [tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()]


def test_terms():
    assert terms_of("Ab-C_d É9 x\x7fy") == [b"ab", b"c", b"d", "É9 x".encode(), b"y"]
    assert terms_of(None) == terms_of("") == terms_of(" \n") == []


@pytest.mark.parametrize("block", [1 << 14, 300])
def test_whole_table(spark, sf_dir, block):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = rows(rank_documents(docs, items, block=block))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert len(found) == len(want) and set(found) == want


def test_odd_rows(spark, tables):
    docs = [document(i, t) for i, t in enumerate(ODD_TEXTS)] + [document(None, "one a b"), document(4, "one")]
    docs += [document(900 + i, "tie of words") for i in range(15)] + [document(3, "d " * 40_000)]
    items = [(0, "one"), (0, "a"), (1, None), (2, ""), (3, "tie"), (None, "nbsp b D"), (5, "absent"), (6, "naïve CAFÉ café")]
    folder = tables(documents=(docs, DOC), benchmark=([i for i in items], ITEM))
    found = rows(op13_dual_tree(spark, folder))
    want = brute([(d[0], d[1]) for d in docs], items)
    assert len(found) == len(want) and set(found) == want
    assert [r[2] for r in sorted(r for r in found if r[0] == 3)] == list(range(900, 910))


def test_an_item_beyond_a_block(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a x"), (3, None)], "doc_id long, text string")
    items = [(7, "a b c d e f g h i j k l"), (8, "x"), (None, "f a e q r s t u v w z")]
    found = rows(rank_documents(docs, spark.createDataFrame(items, ITEM), block=5))
    assert set(found) == brute([(1, "a b c d e f"), (2, "a x"), (3, None)], items)


def test_whole_numbers_beyond_doubles(monkeypatch, spark, sf_dir):
    monkeypatch.setattr(dual_tree, "EXACT", 0)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 60")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert set(rows(rank_documents(docs, items))) == want


def test_empty_tables_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b", 9, 9, 9)], "doc_id long, text string, item_id long, rank int, score long")
    items = spark.createDataFrame([(1, "a", 5, 5)], "item_id long, text string, doc_id long, term int")
    # One document: its only term is in all documents, so its weight is 1000 * ln(4 / 3).
    assert rows(rank_documents(docs, items)) == [(1, 1, 1, math.floor(1000 * math.log(4 / 3)) * (10**9 // 1800))]
    assert rows(rank_documents(docs.limit(0), items)) == []
    assert rows(rank_documents(docs, items.limit(0))) == []


def test_bounds_prune_and_stay_exact():
    rng = np.random.default_rng(3)
    pairs = [(i, f"t{t}") for i in range(30) for t in rng.choice(400, 12, replace=False)]
    items = Items(pa.table({"id": [i for i, _ in pairs], "term": [t for _, t in pairs]}))
    n = 6000
    lists = [np.sort(rng.choice(len(items.vocabulary), 8, replace=False)) for _ in range(n)]
    tfs = [rng.integers(1, 4, 8) for _ in range(n)]
    items.weigh(dict(Counter(int(t) for x in lists for t in x)), n)
    part = pa.RecordBatch.from_pydict({
        "id": pa.array(rng.permutation(n), pa.int64()), "n": pa.array([20] * n, pa.int64()),
        "terms": pa.array(lists, pa.list_(pa.int32())), "tf": pa.array(tfs, pa.list_(pa.int64())),
    })
    best = Best(items, 10, np.zeros(30, np.int64))
    first = sum(search(items, tree, best) for tree in trees(items, iter([part]), n, 20 * n))
    again = Best(items, 10, best.least)
    scored = sum(search(items, tree, again) for tree in trees(items, iter([part]), n, 20 * n))
    assert scored <= first and scored < 0.1 * 30 * n
    dense = np.zeros((n, len(items.vocabulary)), np.int64)
    for row, (t, f) in enumerate(zip(lists, tfs)):
        dense[row, t] = dual_tree.impacts(f, np.full(8, 20), n, 20 * n)
    ids = part.column("id").to_numpy()
    for k in range(30):
        own = items.term[items.item == k]
        score = dense[:, own] @ items.weight[own]
        order = np.lexsort((ids, -score))[:10]
        for got in (best.rows[k], again.rows[k]):
            assert list(got[0]) == list(score[order]) and list(got[1]) == list(ids[order])


def test_lengths_beyond_64_bits():
    n = np.array([10**16], np.int64)
    m = 10 + 90 * 10**16 * 10**11 // 10**18
    assert list(dual_tree.impacts(np.array([7]), n, 10**11, 10**18)) == [7 * 10**9 // (7000 + 8 * m)]
