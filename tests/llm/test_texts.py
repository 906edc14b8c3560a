"""Secrets, toxicity, the Jaccard join and repeated passages, against brute force."""

import hashlib
import math
import random
import re
import time
import tracemalloc
import zlib

import numpy as np
import pytest
from conftest_llm import DOC, ODD_TEXTS, document

from starmill.llm import jaccard_join, secret_scan, sentence_spans, toxicity
from starmill.llm.shingles import longest_first, shingle_set
from starmill.workspace import Files, shared_dir

ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def test_base_spans_of_random_texts():
    rng = random.Random(3)
    parts = [
        "password", "PassWord", "passwd", "secret", "token", "apikey", "API_KEY", "=", ":", " ", '"', "'", "AKIA",
        "ABCDEFGHIJKLMN", "0123456789abcdef", "deadbeef", "é", "日", "K", "ſ", "x", "AKI", "akia", "abc", "=:",
        "tokentoken", "aaaaaaaaaaaaaaaa", "F", "f", "\n", "İ",
    ]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.choice([4, 10, 30])))
        assert [s for s in secret_scan.scan(text) if s[1] < 3] == base_spans(text)


def test_tokens_that_carry_their_checksum():
    body = "ghp_" + "a" * 30
    good = body + secret_scan.base62(zlib.crc32(b"a" * 30), 6).decode()
    assert (2, 3, 42) in secret_scan.scan(f"é {good} x")
    assert not any(s[1] == 3 for s in secret_scan.scan(f"{body}000000"))
    assert secret_scan.redact(f"é {good} x", secret_scan.scan(f"é {good} x")) == "é [secret] x"


def test_secrets_query(spark, tables):
    texts = [*ODD_TEXTS, 'é "token": "abcdefghijkl" 0123456789abcdef', "AKIA" + "A" * 14, "token = short"]
    rows = [document(i, t) for i, t in enumerate(texts)]
    sf_dir = tables(documents=([*rows, rows[-2]], DOC))
    found = secret_scan.op10_secret_scan(spark, sf_dir).collect()
    assert len(found) == len(rows) + 1
    for r in found:
        spans = base_spans(texts[r.doc_id] or "")
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[1] == k for s in spans) for k in range(3)]
        shown = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest()


def test_redaction_keeps_rows_and_columns(spark):
    docs = spark.createDataFrame(
        [(1, None, "k"), (2, "a token=abcdefghijklmn b", "k"), (2, "", "k")], "doc_id long, text string, spans string"
    )
    found = secret_scan.redact_secrets(docs)
    assert found.columns == docs.columns
    assert sorted(repr(r.text) for r in found.collect()) == ["''", "'a [secret] b'", "None"]


WORDS = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORDS.findall((text or "").translate(FOLD))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


def components_of(sets, percent=75):
    """By comparing all pairs."""
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(a & b)
            if both and 100 * both >= percent * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


def family_of_texts(rng, n):
    texts = []
    for _ in range(n):
        words = rng.choice(texts).split() if texts and rng.random() < 0.8 else [
            f"w{rng.randrange(300)}" for _ in range(rng.choice([3, 6, 40, 120]))
        ]
        words = [w if rng.random() > 0.01 else f"w{rng.randrange(300)}" for w in words]
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("zone_rows", [2000, 8])
def test_join_equals_all_pairs(spark, zone_rows):
    texts = [*ODD_TEXTS, *family_of_texts(random.Random(4), 150)]
    rows = [(i, t, 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    sets = [shingles(t) for t in texts]
    expected = components_of(sets)
    found = {r.doc_id: r for r in jaccard_join.jaccard_components(docs, zone_rows=zone_rows).collect()}
    assert [found[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert [found[i].component_id for i in range(len(texts))] == expected


def test_zones_of_any_size_are_joined_exactly(spark):
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(240):
        base = sets[rng.integers(len(sets))] if sets and rng.random() < 0.85 else rng.choice(10**6, rng.integers(5, 30), replace=False)
        kept = base[rng.random(len(base)) > rng.choice([0, 0.05, 0.1, 0.2, 0.3])]
        sets.append(np.unique(np.r_[kept, rng.choice(10**6, rng.integers(1, 4))]))
    expected = components_of([set(s.tolist()) for s in sets])
    rows = spark.createDataFrame(
        [(0, i, [int(v) for v in s]) for i, s in enumerate(sets)], "zone long, id long, shingles array<long>"
    )
    for zone_rows in (1000, 20):
        links = jaccard_join.join_zones(rows, 75, zone_rows).collect()
        root = list(range(len(sets)))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for r in links:
            x, y = find(r.a), find(r.b)
            root[max(x, y)] = min(x, y)
        assert [find(i) for i in range(len(sets))] == expected


def test_documents_of_one_template_take_few_rounds(spark, monkeypatch):
    rounds = []
    spread = jaccard_join._spread
    monkeypatch.setattr(jaccard_join, "_spread", lambda *args: rounds.append(1) or spread(*args))
    # 66 of 100 shingles are everyone's, so all lie just beyond twice the reach of each other; every
    # tenth document is a near copy of the one before, and forty are far from all.
    sets = [set(range(66)) | set(range(1000 * i + 1000, 1000 * i + 1034)) for i in range(200)]
    for i in range(9, 200, 10):
        sets[i] = sets[i - 1] - {0} | {-i}
    sets += [set(range(10**6 + 20 * i, 10**6 + 20 * i + 20)) for i in range(40)]
    rows = spark.createDataFrame([(0, i, sorted(s)) for i, s in enumerate(sets)], "zone long, id long, shingles array<long>")
    links = {tuple(sorted((r.a, r.b))) for r in jaccard_join.join_zones(rows, 75, 16).collect()}
    assert links == {(i - 1, i) for i in range(9, 200, 10)}
    assert len(rounds) <= 4


def test_large_groups_of_near_copies_beside_others(spark, monkeypatch):
    rng = np.random.default_rng(6)
    common = rng.choice(10**6, 60, replace=False)
    sets = [set(common[rng.random(60) > 0.06].tolist()) for _ in range(150)]  # close to each other
    sets += [set(common[rng.random(60) > 0.4].tolist()) | {10**7 + i} for i in range(150)]  # some way off
    rows = spark.createDataFrame([(0, i, sorted(s)) for i, s in enumerate(sets)], "zone long, id long, shingles array<long>")
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for r in jaccard_join.join_zones(rows, 75, 20).collect():
        both = len(sets[r.a] & sets[r.b])
        assert both * 100 >= 75 * len(sets[r.a] | sets[r.b])
        x, y = find(r.a), find(r.b)
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(sets))] == components_of(sets)


def test_join_of_copies_nulls_and_no_rows(spark, tables):
    rows = [document(5, "a b c d e f"), document(3, "A b c d e  f"), document(3, "a b c d e f"), document(None, "a b c d e f")]
    sf_dir = tables(documents=(rows, DOC))
    found = jaccard_join.op5_jaccard_join(spark, sf_dir).collect()
    assert sorted((repr(r.doc_id), r.n_shingles, r.component_id) for r in found) == [
        ("3", 2, 3), ("3", 2, 3), ("5", 2, 3), ("None", 2, 3),
    ]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.jaccard_components(empty).collect() == []
    docs = spark.createDataFrame(rows, DOC)
    assert [r.doc_id for r in jaccard_join.one_of_each(docs).collect()] == [3]


def test_copies_read_by_several_tasks_are_one_document_in_a_region(spark, monkeypatch):
    # Two texts of 36 shingles share one: by itself not enough to be candidates, whatever copies there are.
    mine = [
        " ".join([*(f"{k}word{i}" for i in range(20)), *(f"shared{'x' * 20}{i}" for i in range(5)), *(f"{k}text{i}" for i in range(15))])
        for k in "ab"
    ]
    docs = spark.createDataFrame([(i, mine[i % 2]) for i in range(16)], "doc_id long, text string").repartition(8, "doc_id")
    edges = []

    def counted(*args, found=jaccard_join._zone_edges):
        edges.append(found(*args).count())
        return found(*args)

    monkeypatch.setattr(jaccard_join, "_zone_edges", counted)
    found = jaccard_join.jaccard_components(docs).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(i, i % 2) for i in range(16)]
    assert edges == [0]


def test_shingles_of_short_words_come_last():
    filler = "of the and in to a on it is"
    text = f"{filler} {' '.join(f'uncommon{i}' for i in range(30))} {filler}"
    found, order = longest_first(text)
    assert found.tolist() == shingle_set(text).tolist() and sorted(order) == list(range(len(found)))
    short = {int(v) for v in shingle_set(filler)}
    assert {int(v) for v in found[order][-len(short):]} == short
    # An order of all shingles, whatever text they are in.
    other, other_order = longest_first(f"{filler} {' '.join(f'uncommon{i}' for i in range(10, 40))}")
    both = set(found.tolist()) & set(other.tolist())
    assert [v for v in found[order].tolist() if v in both] == [v for v in other[other_order].tolist() if v in both]


def test_what_the_join_writes_on_the_way_is_removed(spark):
    docs = spark.createDataFrame([(i, f"{'a b c d e f g h ' * 4}{i % 3}") for i in range(12)], "doc_id long, text string")
    files = Files(spark)
    before = set(files.names(f"{shared_dir(spark)}/starmill"))
    found = jaccard_join.jaccard_components(docs)
    left = set(files.names(f"{shared_dir(spark)}/starmill")) - before
    assert [name.rsplit("-", 1)[0] for name in left] == ["jaccard-components"]
    assert found.count() == 12


def test_whole_texts_are_not_shuffled_to_drop_copies(spark):
    docs = spark.createDataFrame([(i, f"text {i // 4} of some words", i) for i in range(-40, 400)], "doc_id long, text string, more int")
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    held = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        stay = jaccard_join.one_of_each(docs)
        plan = stay._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in held.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin" not in plan
    assert sorted(r.doc_id for r in stay.collect()) == list(range(-40, 400, 4))


@pytest.mark.parametrize("most", [1 << 19, 0])
def test_rows_without_those_that_go(spark, monkeypatch, most):
    monkeypatch.setattr(jaccard_join, "MOST_WORDS", most)
    ids = [-(1 << 63), -65, -64, -1, 0, 63, 64, 1 << 40, (1 << 63) - 1]
    rows = spark.createDataFrame([(i, "_word") for i in ids for _ in range(2)], "i long, _word string")
    gone = spark.createDataFrame([(i,) for i in ids[::2] for _ in range(3)], "i long")
    assert sorted(r.i for r in jaccard_join._without(rows, gone, "i").collect()) == sorted(ids[1::2] * 2)


def test_one_row_of_each_component_stays(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [
        (1, "a b c d e f", 0, 0), (1, "a b c d e f", 0, 0), (None, "a b c d e f", 0, 0),  # copies with and without an id
        (None, long, 0, 0), (None, long, 0, 0), (None, long + " more", 0, 0),  # no id at all
        (2, None, 0, 0), (2, None, 0, 0), (None, "", 0, 0), (None, "", 0, 0), (3, " ", 0, 0),  # nothing to be a copy of
        (4, "one two three four five six", 0, 0), (4, "quite another text with that id", 0, 0),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, _rank int, component_id int")
    found = jaccard_join.one_of_each(df)
    assert found.columns == df.columns
    kept = sorted(map(repr, ((r.doc_id, r.text) for r in found.collect())))
    longs = [k for k in kept if "w39" in k]
    assert len(longs) == 1
    rest = [(1, "a b c d e f"), (2, None), (2, None), (None, ""), (None, ""), (3, " "),
            (4, "one two three four five six"), (4, "quite another text with that id")]
    assert sorted(set(kept) - set(longs)) == sorted(set(map(repr, rest))) and len(kept) == len(rest) + 1


def test_passages_go_whatever_other_columns_are_called(spark):
    passage = " ".join(f"w{i}" for i in range(60)) + "."
    rows = [(1, passage, "a", "b", "c"), (2, "before this. " + passage, "d", "e", "f"), (3, None, "g", "h", "i")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _key string, _later string, hash string")
    found = {r.doc_id: r for r in sentence_spans.drop_repeats(df).collect()}
    assert found[1].text == passage and len(found[2].text) < 0.5 * len(passage) and found[3].text is None
    assert [tuple(found[i])[2:] for i in (1, 2, 3)] == [("a", "b", "c"), ("d", "e", "f"), ("g", "h", "i")]


def without_repeats(texts_by_id):
    """By brute force, in the order of ids."""
    seen, out = set(), {}
    for i in sorted(texts_by_id):
        text = texts_by_id[i]
        marks = sentence_spans.sentences(text)
        assert "".join(text[a:b] for a, b in marks) == text
        words = [tuple(text[a:b].split()) for a, b in marks]
        gone = set()
        for k in range(len(words) - sentence_spans.RUN + 1):
            run = tuple(words[k:k + sentence_spans.RUN])
            if sum(map(len, run)) >= sentence_spans.LEAST_WORDS:
                if run in seen:
                    gone.update(range(k, k + sentence_spans.RUN))
                seen.add(run)
        out[i] = "".join(text[a:b] for k, (a, b) in enumerate(marks) if k not in gone)
    return out


def passages(rng, n):
    def sentence():
        return " ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(1, 30))) + rng.choice([". ", ", ", "\n", "! "])

    shared = [sentence() for _ in range(40)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(1, 12)):
            start = rng.randrange(40)
            parts += shared[start:start + 5] if rng.random() < 0.3 else [sentence()]
        texts.append("".join(parts))
    return texts


def test_repeated_passages_equal_brute_force(spark, tables):
    texts = [*(t or "" for t in ODD_TEXTS), *passages(random.Random(6), 80)]
    texts += texts[-3:]
    sf_dir = tables(documents=([document(i, t) for i, t in enumerate(texts)], DOC))
    found = {r.doc_id: r for r in sentence_spans.op8_sentence_spans(spark, sf_dir).collect()}
    expected = without_repeats(dict(enumerate(texts)))
    assert {i: r.text for i, r in found.items()} == expected
    assert all(found[i].removed_chars == len(t) - len(expected[i]) for i, t in enumerate(texts))
    assert any(r.n_spans for r in found.values()) and any(not r.n_spans for r in found.values())


def test_passages_set_into_other_text_are_found(spark):
    passage = " ".join(f"p{k}" + ("," if k % 9 == 0 else "") for k in range(60))
    docs = spark.createDataFrame(
        [(1, f"begins so {passage} and ends.", 1), (2, f"other words here {passage} with another end.", 2),
         (3, "a clean text of its own, with nothing that repeats anywhere, at all.", 3), (4, None, 4)],
        "doc_id long, text string, spans int",
    ).drop("spans")
    found = {r.doc_id: r.text for r in sentence_spans.drop_repeats(docs).collect()}
    assert found[1] == f"begins so {passage} and ends." and found[4] is None
    assert found[3].startswith("a clean text") and len(found[2].split()) < 40


def set_into_others(rng, passage):
    """A passage between other words, twice."""
    around = [[f"o{rng.randrange(10**6)}" for _ in range(30)] for _ in range(4)]
    return [" ".join([*a, *passage, *b]) for a, b in (around[:2], around[2:])]


@pytest.mark.parametrize("between", [", ", "\n", ": ", "; "])
def test_lists_of_short_items_are_found(spark, between):
    rng, rows = random.Random(8), []
    for k in range(20):
        items = [" ".join(f"i{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 4))) for _ in range(60)]
        passage = between.join(items).split(" ")[:60]
        rows += [(2 * k + n, text) for n, text in enumerate(set_into_others(rng, passage))]
    found = {r.doc_id: r.text for r in sentence_spans.drop_repeats(
        spark.createDataFrame(rows, "doc_id long, text string")
    ).collect()}
    for i, text in rows:
        assert found[i] == text if i % 2 == 0 else len(text.split()) - len(found[i].split()) >= 30


@pytest.mark.parametrize("least, most", [(4, 7), (8, 12), (12, 16), (17, 30), (99, 99)])
def test_passages_of_51_to_60_words_are_found(least, most):
    rng, found = random.Random(9), []
    for _ in range(200):
        passage, left = [], 0
        for _ in range(rng.randrange(51, 61)):
            left = left or rng.randrange(least, most + 1)
            left -= 1
            passage.append(f"p{rng.randrange(10**6)}" + ("" if left else "."))
        one, two = set_into_others(rng, passage)
        found.append(bool(set(sentence_spans.runs(one)[0]) & set(sentence_spans.runs(two)[0])))
    assert all(found)


def test_repeats_of_shared_ids_and_no_rows(spark):
    text = ", ".join(" ".join(f"w{5 * k + i}" for i in range(5)) for k in range(6)) + ". "
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text + "own.")], "doc_id long, text string")
    found = sorted((repr(r.doc_id), r.text) for r in sentence_spans.drop_repeats(docs).collect())
    assert found == [("1", text), ("1", text), ("2", "own."), ("None", "")]
    assert sentence_spans.drop_repeats(docs.limit(0)).collect() == []


def toxic_corpus(rng, n):
    plain = [f"w{k}" for k in range(400)]
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.15
        words = rng.choices(plain, k=rng.randrange(20, 200))
        if bad:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["vile", "rotten", "stinkard", "stinkhead", "stinker"]))
        rows.append(document(i, " ".join(words)))
        if rng.random() < 0.8:
            labels.append((i, 1, int(bad)))
    return rows, labels


def test_held_out_accuracy(spark, tables):
    rows, labels = toxic_corpus(random.Random(8), 1500)
    odd = [document(5000 + i, t) for i, t in enumerate(ODD_TEXTS)]
    sf_dir = tables(
        documents=([*rows, *odd, odd[4], document(None, "vile")], DOC),
        labels=([*labels, (None, 1, 1), (9999, None, None)], "doc_id long, quality int, toxic int"),
    )
    found = toxicity.op7_toxicity(spark, sf_dir).collect()
    assert len(found) == len(rows) + len(odd) + 2
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    truth = {i: toxic for i, _, toxic in labels}
    held = [(r.predicted, truth[r.doc_id]) for r in found if r.held_out and r.doc_id in truth]
    assert sum(p == t for p, t in held) >= 0.97 * len(held)


def test_scores_depend_on_no_held_out_label(spark):
    rows, labels = toxic_corpus(random.Random(9), 300)
    docs = spark.createDataFrame(rows, DOC)
    schema = "doc_id long, quality int, toxic int"
    changed = [(i, q, 1 - t) if zlib.crc32(str(i).encode()) % 4 == 2 else (i, q, t) for i, q, t in labels]
    weights = [toxicity.learn(docs, spark.createDataFrame(x, schema)) for x in (labels, changed)]
    assert np.array_equal(*weights)


@pytest.mark.parametrize("prior, toxic, unlabelled, negative", [
    (0.1, [0.5, -1.0, 2.0], [-1.5, 0.3, 0.8, -2.0], False),
    (0.8, [3.0, 4.0], [-3.0, -4.0, -2.5], True),  # toxic texts told apart so well that the estimate turns negative
])
def test_slope_of_the_risk_by_a_plain_loop(prior, toxic, unlabelled, negative):
    def losses(z):
        return [(math.log1p(math.exp(-v)), math.log1p(math.exp(v))) for v in z]  # called clean, called toxic

    def clean_risk(z):
        pairs = losses(z)
        return sum(c for _, c in pairs[n:]) / (len(z) - n) - prior * sum(c for _, c in pairs[:n]) / n

    def aim(z):
        if negative:
            return -clean_risk(z)
        return prior * sum(t for t, _ in losses(z)[:n]) / n + clean_risk(z)

    z, n, h = [*toxic, *unlabelled], len(toxic), 1e-5
    assert (clean_risk(z) < 0) == negative
    found = toxicity.risk_slope(toxicity.sigmoid(np.array(z)), n, prior)
    for i in range(len(z)):
        up, down = ([*z[:i], z[i] + d, *z[i + 1:]] for d in (h, -h))
        assert found[i] == pytest.approx((aim(up) - aim(down)) / (2 * h), abs=1e-8)


def test_without_labels_nothing_is_toxic(spark):
    docs = spark.createDataFrame([document(1, "a"), document(2, None)], DOC)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    weights = toxicity.learn(docs, none)
    assert [r.predicted for r in toxicity.score_documents(docs, weights).collect()] == [0, 0]
    assert toxicity.drop_toxic(docs, weights).count() == 2
    assert toxicity.score_documents(docs.limit(0), weights).collect() == []


def test_a_short_text_does_not_cost_a_pass_over_all_keywords():
    secret_scan.automaton()
    begun = time.process_time()
    for _ in range(2_000):
        secret_scan.scan("nothing here")
    assert time.process_time() - begun < 1


def test_a_text_of_nothing_but_hits_is_held_in_bounded_memory():
    text = "0123456789abcdef" * 60_000 + " " + "password=" * 3_000 + " secret: abcdefghijklmno api_key=0123456789abcdef"
    secret_scan.automaton()  # not part of what a text takes
    tracemalloc.start()
    try:
        found = secret_scan.scan(text)
        assert tracemalloc.get_traced_memory()[1] < 20_000_000
    finally:
        tracemalloc.stop()
    assert [s for s in found if s[1] < 3] == base_spans(text)
