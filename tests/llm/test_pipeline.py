"""The pipeline's stages, each against what it was given."""

import os

import corpus_pipeline
import pytest
from conftest_llm import DOC, ODD_TEXTS, document
from test_bpe import check_packing
from test_texts import components_of, shingles, without_repeats
from tokenizers import Tokenizer

from starmill.llm import secret_scan

LABEL = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """What each stage of a run over the smallest tables was given and returned."""
    folder = tmp_path_factory.mktemp("stages")
    docs, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = f"file:{os.path.join(folder, name)}"
        stage(spark, docs, sf_dir).write.parquet(path)
        found = spark.read.parquet(path)
        seen.append((name, docs, found))
        docs = found
    return {name: (before, after) for name, before, after in seen}


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_stay_but_for_the_last(stages):
    for name, (before, after) in stages.items():
        assert name == "packing" or after.schema.simpleString() == before.schema.simpleString()


def test_toxicity_drops_what_it_predicts(stages, spark, sf_dir):
    before, after = (texts(df) for df in stages["toxicity"])
    assert after.items() <= before.items()
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    gone = before.keys() - after.keys()
    assert sum(toxic.get(i) == 0 for i in gone) <= 0.05 * len(before)


def test_one_of_each_group_stays(stages):
    before, after = (texts(df) for df in stages["near_duplicates"])
    ids = sorted(before)
    roots = components_of([shingles(before[i]) for i in ids])
    assert after == {ids[r]: before[ids[r]] for r in set(roots)}


def test_passages_go(stages):
    before, after = (texts(df) for df in stages["substring_dedup"])
    assert after == without_repeats(before)


def test_secrets_go(stages):
    before, after = (texts(df) for df in stages["secrets"])
    assert before.keys() == after.keys()
    for i, text in before.items():
        assert after[i] == secret_scan.redact(text, secret_scan.scan(text))


def test_all_that_is_left_is_packed(stages, vocabulary_path):
    docs, packed = stages["packing"]
    check_packing(packed.collect(), list(texts(docs).items()), Tokenizer.from_file(vocabulary_path), 2048)


def test_run_equals_its_stages(stages, spark, sf_dir):
    packed = stages["packing"][1]
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    run = corpus_pipeline.run(spark, sf_dir).select(*columns).collect()
    assert sorted(map(tuple, run)) == sorted(map(tuple, packed.select(*columns).collect()))


def test_odd_and_no_documents(spark, tables):
    rows = [document(i, t) for i, t in enumerate(ODD_TEXTS)]
    sf_dir = tables(documents=([*rows, rows[4], document(None, None)], DOC), labels=([(1, None, 1)], LABEL))
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf_dir).select("doc_id").collect()} >= {0, 1, 4, None}


def test_no_documents(spark, tables):
    assert corpus_pipeline.run(spark, tables(documents=([], DOC), labels=([], LABEL))).collect() == []
