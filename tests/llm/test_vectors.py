"""Nearest neighbours and near-duplicate vectors, against all pairs."""

import numpy as np

from starmill.llm.posting_lists import CentroidGraph, fit_lists, nearest, op4_posting_lists
from starmill.llm.pq_neardup import near_duplicates, op9_pq_neardup
from starmill.llm.vectors import squared_distances

VECTOR = "vec_id long, embedding array<float>, label int"


def brute_nearest(ids, vectors, query, k=10):
    near = sorted(
        (float(np.sqrt(((v - vectors[query]) ** 2).sum())), i) for i, v in zip(ids, vectors) if i != ids[query]
    )
    return near[:k]


def test_recall_over_the_whole_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    ids, vectors = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    found = {}
    for r in op4_posting_lists(spark, sf_dir).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    queries = [k for k, i in enumerate(ids) if i % 100 == 0]
    assert set(found) == {ids[k] for k in queries}
    hits = 0
    for k in queries:
        near = brute_nearest(ids, vectors, k)
        own = sorted(found[ids[k]])
        assert [r for r, _, _ in own] == list(range(1, 11))
        assert [(s, v) for _, v, s in own] == sorted((s, v) for _, v, s in own)
        place = {i: n for n, i in enumerate(ids)}
        for _, v, s in own:
            assert s == float(np.sqrt(((vectors[place[v]] - vectors[k]) ** 2).sum()))
        hits += len({v for _, v, _ in own} & {v for _, v in near})
    assert hits >= 0.9 * 10 * len(queries)


def odd_vectors():
    return [
        (0, [1.0, 0.0], 1), (100, [1.0, 0.0], 1), (7, [1.0, 0.0], 1), (7, [1.0, 0.0], 1), (3, [0.0, 2.0], 1),
        (200, None, 1), (300, [0.0, 0.0], 1), (4, [float("nan"), 1.0], 1), (5, [None, 1.0], 1), (6, [], 1),
        (8, [float("inf"), 1.0], 1), (None, [1.0, 0.0], 1), (9, [1.0, 0.0, 0.0], 1), (11, [3.0, 0.1], None),
    ]


def test_neighbours_of_odd_vectors(spark, tables):
    found = op4_posting_lists(spark, tables(embeddings=(odd_vectors(), VECTOR))).collect()
    by_query = {q: [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r.rank) if r.query_id == q] for q in (0, 100)}
    far = float(np.sqrt((np.float32(3.0).astype(float) - 1) ** 2 + np.float32(0.1).astype(float) ** 2))
    assert by_query[0] == [(7, 0.0), (100, 0.0), (11, far), (3, float(np.sqrt(5)))]
    assert by_query[100] == [(0, 0.0), (7, 0.0), (11, far), (3, float(np.sqrt(5)))]
    assert {r.query_id for r in found} == {0, 100}


def test_many_copies_show_their_smallest_ids(spark):
    rows = [(i, [1.0, 1.0], "clash") for i in range(300)] + [(1000, [5.0, 5.0], "clash")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    found = nearest(df, "id % 100 = 0").collect()
    by_query = {q: [r.vec_id for r in sorted(found, key=lambda r: r.rank) if r.query_id == q] for q in (0, 100, 1000)}
    assert by_query == {0: list(range(1, 11)), 100: list(range(10)), 1000: list(range(10))}


def test_graph_finds_the_nearest_centroid():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(4000, 16))
    graph = CentroidGraph(fit_lists(60)(points))
    far = squared_distances(points[:200], graph.centroids)
    assert np.mean([graph.search(p, 1.0)[0] == best for p, best in zip(points[:200], far.argmin(1))]) > 0.95


def test_outliers_have_ten_neighbours(spark):
    rng = np.random.default_rng(6)
    v = rng.normal(size=(2000, 8))
    v[::100] *= 1000
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    counts = {r.query_id: r["count"] for r in nearest(df, "id % 100 = 0").groupBy("query_id").count().collect()}
    assert counts == {i: 10 for i in range(0, 2000, 100)}


def all_links(rows, threshold=0.9):
    """(n_links, component) by comparing all pairs of rows."""
    usable = [
        k for k, (i, v, *_) in enumerate(rows)
        if i is not None and v and len(v) == 2 and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    unit = {k: np.array(rows[k][1], np.float32).astype(float) for k in usable}
    unit = {k: v / np.linalg.norm(v) for k, v in unit.items()}
    links = {k: [j for j in usable if j != k and unit[k] @ unit[j] >= threshold] for k in usable}
    out = []
    for k, row in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in links.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out.append((row[0], len(links.get(k, [])), min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)))
    return sorted(out, key=repr)


def test_near_duplicates_of_odd_vectors(spark, tables):
    rows = odd_vectors()
    found = op9_pq_neardup(spark, tables(embeddings=(rows, VECTOR))).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=repr) == all_links(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_links_over_the_whole_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    vectors = np.array([r.embedding for r in rows], float)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    close = vectors @ vectors.T >= 0.9
    found = {r.vec_id: r.n_links for r in op9_pq_neardup(spark, sf_dir).collect()}
    assert [found[r.vec_id] for r in rows] == (close.sum(1) - 1).tolist()


def planted_pairs(n=10_000, pairs=500):
    """Unit vectors, of which the last ``pairs`` have a cosine of 0.9 to 0.95 with the first ones."""
    rng = np.random.default_rng(5)
    v = rng.normal(size=(n, 64))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    aside = v[-pairs:] - (v[-pairs:] * v[:pairs]).sum(1)[:, None] * v[:pairs]
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    cos = rng.uniform(0.9005, 0.95, pairs)[:, None]
    v[-pairs:] = cos * v[:pairs] + np.sqrt(1 - cos**2) * aside
    return v


def test_planted_pairs_among_many_lists(spark, monkeypatch):
    from starmill.llm import pq_neardup

    # 100 lists, fitted on a quarter of the rows, as larger tables are on a part of theirs.
    whole = pq_neardup.fit
    monkeypatch.setattr(pq_neardup, "fit", lambda *a: whole(*a, most=2500))
    monkeypatch.setattr(pq_neardup, "LIST_ROWS", 100)
    v = planted_pairs()
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in near_duplicates(df).collect()}
    close = v @ v.T >= 0.9
    expected = (close.sum(1) - 1).tolist()
    assert sum(expected) >= 1000
    # Either end of a pair counts it, and both are in one component.
    assert [found[i].n_links for i in range(len(v))] == expected
    a, b = np.nonzero(close)
    assert all(found[i].component_id == found[j].component_id for i, j in zip(a.tolist(), b.tolist()))


def test_a_crowded_list_is_many_cells(spark, monkeypatch):
    from starmill.llm import pq_neardup

    rng = np.random.default_rng(4)
    rows = [(i, (np.array([1.0, 0.3]) + rng.normal(size=2) * 0.02).tolist(), 0) for i in range(120)]
    rows += [(200 + i, rng.normal(size=2).tolist(), 0) for i in range(60)]
    whole = pq_neardup.meet
    monkeypatch.setattr(pq_neardup, "meet", lambda *a, **k: whole(*a, **k, block=16))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links int")
    found = near_duplicates(df).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=repr) == all_links(rows)


def test_no_vectors(spark, tables):
    sf_dir = tables(embeddings=([], VECTOR))
    assert op4_posting_lists(spark, sf_dir).collect() == []
    assert op9_pq_neardup(spark, sf_dir).collect() == []


def test_recall_of_planted_pairs_over_many_lists(spark):
    """10,000 vectors in 39 lists: pairs from 0.90 to 0.95, links of both ends equal, against all pairs."""
    rng = np.random.default_rng(23)
    n, d = 9000, 64
    base = rng.normal(size=(n, d)) * np.linspace(1.5, 0.5, d)
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    near = rng.normal(size=(1000, d))
    near -= (near * base[:1000]).sum(1)[:, None] * base[:1000]
    near /= np.linalg.norm(near, axis=1, keepdims=True)
    cos = np.linspace(0.901, 0.95, 1000)[:, None]
    vectors = np.concatenate([base, cos * base[:1000] + np.sqrt(1 - cos ** 2) * near])
    order = rng.permutation(len(vectors))
    rows = [(int(i), vectors[k].tolist()) for i, k in enumerate(order)]
    found = near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    unit = vectors[order] / np.linalg.norm(vectors[order], axis=1, keepdims=True)
    close = unit @ unit.T >= 0.9
    np.fill_diagonal(close, False)
    want = close.sum(1)
    got = np.zeros(len(order), int)
    for r in found:
        got[r.vec_id] = r.n_links
    assert want.sum() >= 2000 and (got <= want).all()
    assert got.sum() >= 0.99 * want.sum()
    # Pairs of two vectors that have no other neighbour: both ends see them, or none does.
    a, b = np.nonzero(close)
    alone = (want[a] == 1) & (want[b] == 1)
    assert (got[a[alone]] == got[b[alone]]).all()
    linked = {r.vec_id: r.component_id for r in found}
    assert all((linked[i] == linked[j]) == (got[i] == 1) for i, j in zip(a[alone], b[alone]))


def test_neighbours_far_from_the_origin(spark):
    rng = np.random.default_rng(4)
    vectors = 1e8 + rng.normal(size=(400, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = nearest(df, "id % 100 = 0", prune=1e9)
    by_query = {}
    for r in found.orderBy("query_id", "rank").collect():
        by_query.setdefault(r.query_id, []).append(r.vec_id)
    for q in range(0, 400, 100):
        far = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        want = sorted((d, i) for i, d in enumerate(far.tolist()) if i != q)[:10]
        assert by_query[q] == [i for _, i in want]
