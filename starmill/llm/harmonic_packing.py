"""Packing documents into sequences of one capacity, by reciprocal-capacity classes."""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmill.llm.bpe import vocabulary
from starmill.llm.common import batch, groups, map_arrow, ship, table
from starmill.workspace import materialize

CAPACITY = 2048
END_ID = 1

PIECE = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
    ("block", pa.int32()), ("rank", pa.int64()),
])
PIECE_NAMES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, block int, rank long"
)


def cut(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of a document's pieces, each a whole fraction of the capacity.

    A piece is as long as ``capacity // k`` for some k, so that k of them fill a
    bin but for less than k tokens. What is left after the longest such piece is
    at most a part of it, so a handful of pieces takes any document.
    """
    lengths = [capacity] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        piece = capacity // (capacity // rest)
        if piece != rest:
            piece = capacity // -(-capacity // rest)
        lengths.append(piece)
        rest -= piece
    return lengths


def pieces(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID,
) -> DataFrame:
    """Every document's ids with ``end_id`` after them, cut into pieces.

    ``rank`` numbers the pieces of one length within one task's ``block``.
    A null text is empty and still has its end id.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        block = TaskContext.get().partitionId()
        ranks = [0] * (capacity + 1)
        end = np.array([end_id], "<u4").tobytes()
        for x in batches:
            out: list[tuple] = []
            coded = (ids for group in groups(x.column("text").to_pylist(), 1 << 13) for ids in bpe.encode_all(group))
            for doc, ids in zip(x.column("id").to_pylist(), coded):
                ids += end
                tokens, start = len(ids) // 4, 0
                for length in cut(tokens, capacity):
                    crc = zlib.crc32(ids[4 * start:4 * (start + length)])
                    out.append((doc, start, length, crc, tokens, block, ranks[length]))
                    ranks[length] += 1
                    start += length
            if out:
                yield batch(PIECE, **dict(zip(PIECE.names, zip(*out))))

    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    return map_arrow(rows, task, PIECE_NAMES)


def fill(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every piece its sequence and its offset there.

    Pieces of one length are one class; a bin takes ``capacity // length`` of
    them. A piece's number in its class is its rank within its block plus the
    pieces in earlier blocks, so workers fill bins without hearing of each other:
    only counts by class and block are exchanged. The last bin of each class may
    stay short. These leftovers, at most a bin's pieces of each class however
    large the corpus, are mixed first-fit, longest first.
    """
    by_class = Window.partitionBy("length")
    counts = cut_pieces.groupBy("length", "block").agg((F.max("rank") + 1).alias("n")).select(
        "length", "block",
        (F.sum("n").over(by_class.orderBy("block")) - F.col("n")).alias("before"),
        F.sum("n").over(by_class).alias("in_class"),
    )
    per_bin = F.expr(f"{capacity} div length")
    numbered = cut_pieces.join(counts, ["length", "block"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("before") + F.col("rank")).alias("number"), per_bin.alias("per_bin"),
        F.expr(f"in_class - in_class % ({capacity} div length)").alias("in_full_bins"),
    )
    full = numbered.where("number < in_full_bins").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.expr(f"(number div per_bin) * {capacity + 1} + length").alias("sequence_id"),
        F.expr("(number % per_bin) * length").alias("offset"),
        (F.col("per_bin") * F.col("length")).alias("filled"),
    )
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def mix(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([
            ("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"),
            ("ids_crc32", "ascending"),
        ])
        room = np.full(len(rows), capacity)
        bins = np.zeros(len(rows), "int64")
        offsets = np.zeros(len(rows), "int64")
        for i, length in enumerate(rows["length"].to_pylist()):
            bins[i] = fits = int(np.argmax(room >= length))
            offsets[i] = capacity - room[fits]
            room[fits] -= length
        rows = rows.append_column("sequence_id", pa.array(bins * (capacity + 1)))
        rows = rows.append_column("offset", pa.array(offsets))
        return rows.append_column("filled", pa.array(capacity - room[bins]))

    ship(cut_pieces.sparkSession)
    mixed = numbered.where("number >= in_full_bins").select(*names).groupBy().applyInArrow(
        mix, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long, filled long",
    )
    power = F.expr("filled & (filled - 1)") == 0
    return full.unionByName(mixed).select(
        *names, "sequence_id", "offset",
        F.when(power, F.col("filled")).otherwise(F.lit(capacity).cast("long")).alias("padded_length"),
    )


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, **columns: str) -> DataFrame:
    """Documents as pieces of sequences of ``capacity`` tokens; see ``pieces`` and ``fill``.

    The pieces are written once to the shared folder: texts are tokenized once,
    and numbers stay the same when an executor is lost.
    """
    return fill(materialize(pieces(docs, path, capacity=capacity, **columns), "pieces"), capacity)


def op2_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return pack_documents(table(spark, sf_dir, "documents"), path)


QUERIES = {"op2_harmonic_packing": (op2_harmonic_packing, None)}
