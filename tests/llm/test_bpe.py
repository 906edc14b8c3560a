"""BPE by trees, counts by ranks and packing, against the library."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from conftest_llm import DOC, ODD_TEXTS, document
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starmill.llm import harmonic_packing, tree_bpe
from starmill.llm.bpe import vocabulary
from starmill.llm.rank_counts import count_tokens, counter, op6_rank_counts
from starmill.llm.tree_bpe import decode_documents, encode_documents, encode_text, op3_tree_bpe

PARTS = [
    "a", "b", "the", " ", "  ", "\n", "\n\n", "'", "'s", "'ll", "l", "s", "1", "23", "!", "!!", "é", "日",
    "\U0001f600", "\x85", "\x1c", "ing", "tion", "A", "_", "-", "\xa0", "<|endoftext|>", "<|", "aaaa", "\t", ",",
]


@pytest.fixture(scope="module")
def library(vocabulary_path):
    return Tokenizer.from_file(vocabulary_path)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    return [
        "".join(rng.choice(rng.sample(PARTS, rng.choice([2, 4, len(PARTS)]))) for _ in range(rng.choice([5, 40, 200])))
        for _ in range(400)
    ]


def test_trees_and_counts_equal_the_library(vocabulary_path, library, texts):
    bpe, ranks = vocabulary(vocabulary_path), counter(vocabulary_path)
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert bpe.encode(text).tolist() == ids
        for leaf in (1, 3, 16):
            assert encode_text(bpe, text, leaf).tolist() == ids
        assert ranks.count_all([text]) == [len(ids)]
        assert bpe.decode(np.array(ids)) == library.decode(ids, skip_special_tokens=False)


def test_text_without_a_place_to_split(vocabulary_path, library):
    rng = random.Random(1)
    bpe = vocabulary(vocabulary_path)
    for text in ("a" * 20_000, "".join(rng.choice("abcdef01") for _ in range(20_000))):
        ids = library.encode(text, add_special_tokens=False).ids
        assert encode_text(bpe, text, 64).tolist() == ids
        assert counter(vocabulary_path).count_all([text]) == [len(ids)]


def odd_documents(tables):
    rows = [document(i, t) for i, t in enumerate(ODD_TEXTS)]
    return rows, tables(documents=([*rows, rows[3], document(None, "no id")], DOC))


def test_queries_on_odd_texts(spark, tables, library):
    rows, sf_dir = odd_documents(tables)
    texts = [*(t or "" for t in ODD_TEXTS), ODD_TEXTS[3], "no id"]
    ids = [library.encode(t, add_special_tokens=False).ids for t in texts]
    expected = sorted(
        (repr(len(i)), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(),
         hashlib.sha256(t.encode()).hexdigest()) for i, t in zip(ids, texts)
    )
    found = op3_tree_bpe(spark, sf_dir).collect()
    assert sorted((repr(r.n_tokens), r.ids_sha256, r.decoded_sha256) for r in found) == expected
    counted = op6_rank_counts(spark, sf_dir).collect()
    assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in counted) == sorted(
        (len(t.encode()), len(i), len(i) > 512) for t, i in zip(texts, ids)
    )


def test_blocks_of_long_documents(spark, vocabulary_path, library):
    rng = random.Random(2)
    text = "".join(rng.choice(PARTS) for _ in range(3000))
    rows = [(1, text, "clash"), (1, text, "clash"), (2, "short", None), (None, text + "end", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    coded = encode_documents(docs, vocabulary_path, leaf=50, block=200)
    found = sorted(
        (r.id is None, r.id or 0, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in coded.collect()
    )
    assert found == sorted(
        (i is None, i or 0, library.encode(t, add_special_tokens=False).ids) for i, t, _ in rows
    )
    decoded = sorted(r.text for r in decode_documents(coded, vocabulary_path).collect())
    assert decoded == sorted(t for _, t, _ in rows)


def check_packing(packed, docs, library, capacity):
    by_row = {}
    for i, text in docs:
        by_row.setdefault(i, []).append([*library.encode(text or "", add_special_tokens=False).ids, 1])
    taken, sequences = {}, {}
    for r in packed:
        assert any(
            len(ids) == r.doc_tokens
            and zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32
            for ids in by_row[r.doc_id]
        )
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.padded_length))
    assert taken == {i: sum(map(len, v)) for i, v in by_row.items()}
    padded = 0
    for pieces in sequences.values():
        end = 0
        for offset, length, _ in sorted(pieces):
            assert offset == end
            end += length
        assert end <= pieces[0][2] <= capacity
        assert pieces[0][2] == (end if end & (end - 1) == 0 else capacity)
        padded += pieces[0][2]
    return sum(taken.values()), padded


def test_packing(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    packed = harmonic_packing.op2_harmonic_packing(spark, sf_dir).collect()
    filled, padded = check_packing(packed, [tuple(r) for r in docs.collect()], library, 2048)
    assert padded < 1.01 * filled


def test_packing_of_odd_texts(spark, tables, library):
    rows, sf_dir = odd_documents(tables)
    packed = harmonic_packing.op2_harmonic_packing(spark, sf_dir).collect()
    check_packing(packed, [(r[0], r[1]) for r in [*rows, rows[3], (None, "no id")]], library, 2048)


def test_pieces_are_fractions_of_the_capacity():
    for capacity in (2048, 100):
        fractions = {capacity // k for k in range(1, capacity + 1)}
        for tokens in (0, 1, 2, 67, 99, 100, 101, 1500, 2047, 2048, 2049, 10_000):
            lengths = harmonic_packing.cut(tokens, capacity)
            assert sum(lengths) == tokens and set(lengths) <= fractions


def test_empty_tables(spark, tables, vocabulary_path):
    sf_dir = tables(documents=([], DOC))
    for query in (op3_tree_bpe, op6_rank_counts, harmonic_packing.op2_harmonic_packing):
        assert query(spark, sf_dir).collect() == []
    docs = spark.createDataFrame([], "key long, body string")
    assert count_tokens(docs, vocabulary_path, "key", "body").collect() == []


def test_whole_table(spark, sf_dir, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in op6_rank_counts(spark, sf_dir).collect():
        assert r.n_tokens == len(library.encode(docs[r.doc_id], add_special_tokens=False).ids)
    assert tree_bpe.op3_tree_bpe(spark, sf_dir).where(
        F.col("decoded_sha256").isNull()
    ).count() == 0


def test_long_words_are_merged_in_time_that_follows_their_merges(vocabulary_path, library):
    rng = random.Random(8)
    letters = "".join(rng.choice("etaoinshrdlucmf") for _ in range(80_000))
    found = [letters, "a" * 50_001, "ab" * 20_000, "the" * 9_000 + " " + "é" * 3_000, "-" * 1_000 + "x" * 255 + "9" * 256, "日本" * 700]
    ranks = counter(vocabulary_path)
    begun = time.monotonic()
    counts = ranks.count_all(found)
    assert time.monotonic() - begun < 6
    assert counts == [len(library.encode(t, add_special_tokens=False).ids) for t in found]
    assert (ranks._long_sizes([t.encode() for t in found[1:3]]) == ranks._short_sizes([t.encode() for t in found[1:3]])).all()


def test_ids_of_the_whole_table_equal_the_library(spark, sf_dir, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op3_tree_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
