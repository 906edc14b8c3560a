import os

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def vocabulary_path():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


@pytest.fixture
def tables(spark, tmp_path):
    """A folder of tables as the queries find them, from rows and a schema each."""

    def write(**named):
        for name, (rows, schema) in named.items():
            spark.createDataFrame(rows, schema).write.parquet(os.path.join(tmp_path, f"{name}.parquet"))
        return str(tmp_path)

    return write


def document(i, text):
    return (i, text, "en", "src0", len(text or ""))


# Nulls, empty and blank texts, ties, repeated rows, special strings, one long text.
ODD_TEXTS = [
    None, "", " ", "\n\n", "one", "a b c d", "a b c d e", "a b c d e", "A B C D E F",
    "special <|endoftext|> inside<|endoftext|>", "<|endoftext|>", "naïve café — 日本語 \U0001f600",
    "it's we'll  two  blanks\t tab nbsp  em", "x" * 5000, "no stop " * 3000,
]
