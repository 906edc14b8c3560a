"""BPE of whole texts by tree concatenation: halves first, then windows around the joins."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.bpe import ByteBpe, vocabulary
from starmill.llm.common import batch, map_arrow, row_key, ship, table

LEAF = 2048  # characters encoded at one go
BLOCK = 1 << 16  # characters of a text that one task encodes; longer texts are spread
AGREE = 2  # tokens that must be the same on both encodings, on either side
FIRST_WINDOW = 8  # tokens taken from either side of a join at first

RESULT = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def join_ids(bpe: ByteBpe, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Ids of two adjacent texts together, from the ids of each.

    A window of tokens around the join is encoded anew and grows until it begins
    with the left side's own tokens and ends with the right side's. Every pair of
    neighbouring tokens then comes from one encoding, which makes the whole the
    encoding of the joined text. A window that has grown over a whole side needs
    no agreement there.
    """
    size = FIRST_WINDOW
    while len(left) and len(right):
        a, b = max(0, len(left) - size), min(len(right), size)
        while a > 0 and _inside_character(bpe, left[a]):
            a -= 1
        while b < len(right) and _inside_character(bpe, right[b]):
            b += 1
        middle = bpe.encode_plain(bpe.bytes_for(np.concatenate([left[a:], right[:b]])).decode())
        n = min(AGREE, len(middle) // 2)
        left_agrees = a == 0 or (n == AGREE <= len(left) - a and np.array_equal(middle[:n], left[a:a + n]))
        right_agrees = b == len(right) or (n == AGREE <= b and np.array_equal(middle[-n:], right[b - n:b]))
        if left_agrees and right_agrees:
            return np.concatenate([left[:a], middle, right[b:]])
        size *= 2
    return np.concatenate([left, right])


def _inside_character(bpe: ByteBpe, token: int) -> bool:
    return bpe.bytes_of[token][0] & 0xC0 == 0x80


def join_all(bpe: ByteBpe, parts: list[np.ndarray]) -> np.ndarray:
    """Ids of adjacent texts, joined two by two, level by level."""
    while len(parts) > 1:
        joined = [join_ids(bpe, *parts[i:i + 2]) for i in range(0, len(parts) - 1, 2)]
        parts = joined + parts[2 * len(joined):]
    return parts[0] if parts else np.zeros(0, "<u4")


def encode_tree(bpe: ByteBpe, text: str, leaf: int = LEAF) -> np.ndarray:
    """Ids of a text without special strings, cut into leaves wherever they end."""
    if len(text) <= leaf:
        return bpe.encode_plain(text)
    half = (len(text) + 1) // 2
    return join_ids(bpe, encode_tree(bpe, text[:half], leaf), encode_tree(bpe, text[half:], leaf))


def encode_text(bpe: ByteBpe, text: str, leaf: int = LEAF) -> np.ndarray:
    return bpe.encode(text, lambda part: encode_tree(bpe, part, leaf))


def digests(bpe: ByteBpe, ids: np.ndarray) -> tuple[int, str, str]:
    decoded = bpe.decode(ids).encode()
    return (
        len(ids), hashlib.sha256(bpe.decimal(ids)).hexdigest(), hashlib.sha256(decoded).hexdigest(),
    )


def encode_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
    leaf: int = LEAF, block: int = BLOCK,
) -> DataFrame:
    """Ids of every document, as (id, row_key, ids binary of little-endian 32-bit ids).

    Texts up to ``block`` characters are encoded where they are read, as a tree
    of leaves. Longer ones are cut into blocks that tasks encode in parallel;
    one task then joins the blocks of a document, which is no more than its row.
    A null text is empty; rows that repeat wholly come out as often as they went in.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    schema = pa.schema([("id", pa.int64()), ("row_key", pa.int64()), ("ids", pa.binary())])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for x in batches:
            ids = [encode_text(bpe, t, leaf).tobytes() for t in x.column("text").to_pylist()]
            yield batch(schema, id=x.column("id"), row_key=x.column("row_key"), ids=ids)

    names = "id long, row_key long, ids binary"
    keyed = rows.withColumn("row_key", row_key("id", "text"))
    short = map_arrow(keyed.where(F.length("text") <= block), whole, names)
    return short.unionByName(_long_documents(keyed.where(F.length("text") > block), path, leaf, block))


def _long_documents(rows: DataFrame, path: str, leaf: int, block: int) -> DataFrame:
    cut = pa.schema([
        ("id", pa.int64()), ("row_key", pa.int64()), ("segment", pa.int32()), ("block", pa.int32()),
        ("part", pa.string()),
    ])
    coded = pa.schema([*list(cut)[:-1], ("ids", pa.binary())])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Segments between special strings, cut into blocks; special strings are blocks."""
        bpe = vocabulary(path)
        for x in batches:
            for i, key, text in zip(*(x.column(c).to_pylist() for c in ("id", "row_key", "text"))):
                for segment, part in enumerate(bpe.plain_parts(text)):
                    starts = range(0, len(part), block)
                    yield batch(
                        cut, id=[i] * len(starts), row_key=[key] * len(starts),
                        segment=[segment] * len(starts), block=list(range(len(starts))),
                        part=[part[s:s + block] for s in starts],
                    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for x in batches:
            ids = [
                bpe.encode(part) if segment % 2 else encode_tree(bpe, part, leaf)
                for segment, part in zip(*(x.column(c).to_pylist() for c in ("segment", "part")))
            ]
            kept = {c: x.column(c) for c in ("id", "row_key", "segment", "block")}
            yield batch(coded, **kept, ids=[v.tobytes() for v in ids])

    def join(rows: pa.Table) -> pa.Table:
        bpe = vocabulary(path)
        found: dict[tuple[int, int], np.ndarray] = {}
        copies: dict[tuple[int, int], int] = {}
        for at, ids in zip(
            zip(rows["segment"].to_pylist(), rows["block"].to_pylist()), rows["ids"].to_pylist()
        ):
            found[at] = np.frombuffer(ids, "<u4")
            copies[at] = copies.get(at, 0) + 1
        segments: dict[int, list[np.ndarray]] = {}
        for segment, block_no in sorted(found):
            segments.setdefault(segment, []).append(found[segment, block_no])
        whole = np.concatenate([join_all(bpe, parts) for parts in segments.values()])
        times = min(copies.values())
        return pa.table({
            "id": pa.array(rows["id"].to_pylist()[:1] * times, pa.int64()),
            "row_key": pa.array(rows["row_key"].to_pylist()[:1] * times, pa.int64()),
            "ids": pa.array([whole.astype("<u4").tobytes()] * times, pa.binary()),
        })

    names = "id long, row_key long, segment int, block int"
    ship(rows.sparkSession)
    parts = map_arrow(rows, blocks, f"{names}, part string").repartition("row_key", "segment", "block")
    ids = map_arrow(parts, encode, f"{names}, ids binary")
    return ids.groupBy("row_key").applyInArrow(join, "id long, row_key long, ids binary")


def decode_documents(coded: DataFrame, path: str) -> DataFrame:
    """(id, text) of what ``encode_documents`` returned."""
    schema = pa.schema([("id", pa.int64()), ("text", pa.string())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for x in batches:
            texts = [bpe.decode(np.frombuffer(v, "<u4")) for v in x.column("ids").to_pylist()]
            yield batch(schema, id=x.column("id"), text=texts)

    return map_arrow(coded, task, "id long, text string")


def op3_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again, with digests of ids and text."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = encode_documents(table(spark, sf_dir, "documents"), path)
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
        ("decoded_sha256", pa.string()),
    ])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for x in batches:
            found = [digests(bpe, np.frombuffer(v, "<u4")) for v in x.column("ids").to_pylist()]
            n, ids, decoded = zip(*found) if found else ((), (), ())
            yield batch(schema, doc_id=x.column("id"), n_tokens=n, ids_sha256=ids, decoded_sha256=decoded)

    return map_arrow(coded.select("id", "ids"), task, f"doc_id long, {RESULT}")


QUERIES = {"op3_tree_bpe": (op3_tree_bpe, None)}
