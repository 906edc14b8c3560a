"""Elements of large JSON documents, read in splits.

A document is read up to its commas, so its bytes are split between tasks wherever a comma stands. Whether a block begins
inside a string, and how deep, follows from the blocks before it: quotes flip the one, brackets add up to the other, for
either state before a block. Every task then cuts its own block at the commas of the root array, and elements that cross
blocks are put together from their parts.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starmill.sources.records import runs
from starmill.workspace import importable, materialize

BLANK = " \t\r\n\ufeff"
ESCAPED = re.compile(rb"\\.", re.DOTALL)
# What a byte outside strings does to the depth; the second table says which bytes matter at all.
STEP = np.zeros(256, np.int64)
STEP[list(b"[{")], STEP[list(b"]}")] = 1, -1
MARKS = STEP != 0
MARKS[ord(",")] = True


def structure(text: bytes, inside: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Where brackets and commas stand outside strings, their steps, and whether a string is open at the end."""
    # An escaped character is neither a quote nor a backslash.
    plain = np.frombuffer(ESCAPED.sub(b"__", text) if b"\\" in text else text, np.uint8)
    quotes = np.cumsum(plain == ord('"'))
    found = np.flatnonzero(MARKS[plain])
    at = found[(quotes[found] % 2 == 1) == inside]
    return at, STEP[plain[at]], bool(quotes[-1] % 2) != inside if len(quotes) else inside


def pieces(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    parts = spark.read.option("lineSep", ",").text(paths)
    return parts.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, int, bool, bytes]]:
    """(file, name, block, whether the block begins here, bytes); each comma belongs to what follows it."""
    current = None
    for file, name, block, values in runs(batches):
        first, current = current != (file, block), (file, block)
        text = ",".join(values.to_pylist())
        yield file, name, block, first, (text if first and block == 0 else "," + text).encode()


SUMMARY = "file string, block long, root string, flips boolean, from_out long, from_in long"
START = "file string, block long, inside boolean, depth long"


def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a block: whether it flips the state, and its change of depth for either state before it."""
    schema = pa.schema([
        ("file", pa.string()), ("block", pa.int64()), ("root", pa.string()), ("flips", pa.bool_()),
        ("from_out", pa.int64()), ("from_in", pa.int64()),
    ])
    found: list[list] = []
    for file, _, block, first, text in stretches(batches):
        if first:
            found.append([file, block, text.decode().strip(BLANK)[:1], False, 0, 0])
        row = found[-1]
        _, out, after = structure(text, row[3])
        _, within, _ = structure(text, not row[3])
        row[3:] = after, row[4] + int(out.sum()), row[5] + int(within.sum())
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)


def compose(rows: pa.Table) -> pa.Table:
    """(inside a string, depth) before each block of a file.

    A root that is no array counts as an element, so it begins at depth 1.
    """
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("inside", pa.bool_()), ("depth", pa.int64())])
    rows = rows.sort_by("block").to_pylist()
    base = int(rows[0]["root"] != "[")
    inside, depth, out = False, base, []
    for r in rows:
        out.append({"file": r["file"], "block": r["block"], "inside": inside, "depth": depth})
        depth += r["from_in" if inside else "from_out"]
        inside = inside != r["flips"]
    if inside or depth != base:
        raise ValueError(f"{rows[0]['file']} ends inside a JSON value")
    return pa.Table.from_pylist(out, schema)


ELEMENTS = "file string, name string, block long, row long, whole boolean, begins boolean, record string"
ELEMENT = pa.schema([
    ("file", pa.string()), ("name", pa.string()), ("block", pa.int64()), ("row", pa.int64()), ("whole", pa.bool_()),
    ("begins", pa.bool_()), ("record", pa.string()),
])


class Block:
    """The elements of one block, as its bytes arrive."""

    def __init__(self, file: str, name: str, block: int, start: tuple[bool, int]):
        self.file, self.name, self.block = file, name, block
        self.inside, self.depth = start
        # Whether the open element began in this block; None outside the root array.
        self.begun = None if self.depth == 0 else block == 0
        self.held: list[bytes] = []
        self.row = 0
        self.opened = False  # the root array was opened by the last mark
        self.found: list[tuple[int, bool, bool, str]] = []

    def add(self, text: bytes) -> None:
        at, steps, self.inside = structure(text, self.inside)
        depths = self.depth + np.cumsum(steps)
        if len(depths):
            self.depth = int(depths[-1])
        ends = at[((steps >= 0) & (depths == 1)) | ((steps < 0) & (depths == 0))].tolist()
        start = 0
        for end in ends:
            self.held.append(text[start:end])
            self.close(text[end:end + 1])
            start = end + 1
        self.held.append(text[start:])

    def close(self, mark: bytes) -> None:
        """An element, or what lies around the root array, ends at a mark."""
        record, self.held = b"".join(self.held).decode(), []
        blank = not record.strip(BLANK)
        if self.begun is None:
            wrong = not blank
        else:
            empty = self.opened and mark == b"]"
            wrong = self.begun and blank and not empty
            if not (self.begun and blank):
                self.found.append((self.row, self.begun, self.begun, record))
                self.row += 1
        if wrong:
            raise ValueError(f"{self.file} is no JSON document, in the block at byte {self.block}")
        self.begun = None if mark == b"]" else True
        self.opened = mark == b"["

    def finish(self) -> None:
        """The block ends; an open element goes on in the next one."""
        record, self.held = b"".join(self.held).decode(), []
        if self.begun is not None:
            self.found.append((self.row, False, self.begun, record))
        elif record.strip(BLANK):
            raise ValueError(f"{self.file} goes on after its JSON value")

    def taken(self) -> pa.RecordBatch:
        rows, self.found = self.found, []
        n = len(rows)
        columns = [[self.file] * n, [self.name] * n, [self.block] * n, *(zip(*rows) if rows else [[]] * 4)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ELEMENT)], schema=ELEMENT)


def elements(
    batches: Iterator[pa.RecordBatch], starts: dict[tuple[str, int], tuple[bool, int]]
) -> Iterator[pa.RecordBatch]:
    """Elements of the root arrays; those that cross blocks in parts, a tail (``begins`` false) or a head each."""
    current = None
    for file, name, block, first, text in stretches(batches):
        if first:
            if current:
                current.finish()
                yield current.taken()
            current = Block(file, name, block, starts[file, block])
        current.add(text)
        yield current.taken()
    if current:
        current.finish()
        yield current.taken()


def split_elements(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, name, block, row, record): a row an element of a root array, or a whole document with another root.

    The documents are read twice, for one row a block and for the elements, which are written to the shared folder. What
    crosses blocks is one element a block at most; who owns a part is found on rows without texts.
    """
    importable(spark)
    parts = pieces(spark, paths)
    summary = parts.mapInArrow(summaries, SUMMARY)
    # A task composes the blocks of one file, a few bytes each; the driver gets a row for every split it schedules.
    starts = {
        (r["file"], r["block"]): (r["inside"], r["depth"])
        for r in summary.groupBy("file").applyInArrow(compose, START).collect()
    }
    found = materialize(parts.mapInArrow(lambda batches: elements(batches, starts), ELEMENTS), "elements")
    columns = ["file", "name", "block", "row", "record"]
    crossing = found.where("NOT whole")
    order = Window.partitionBy("file").orderBy("block", "begins").rowsBetween(Window.unboundedPreceding, 0)
    owners = crossing.select(
        "file", "block", "begins",
        F.last(F.when(F.col("begins"), F.col("block")), ignorenulls=True).over(order).alias("owner"),
    )
    joined = (
        crossing.join(owners, ["file", "block", "begins"]).groupBy("file", "name", F.col("owner").alias("block"))
        .agg(
            F.max(F.when(F.col("begins"), F.col("row"))).alias("row"),
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct("block", "record"))), lambda p: p["record"]), ""
            ).alias("record"),
        )
    )
    nothing = F.trim(F.translate("record", "\t\r\n", "   ")) == ""
    missing = F.raise_error(F.concat("file", F.lit(" has a comma without a JSON value")))
    checked = joined.withColumn("record", F.when(nothing, missing).otherwise(F.col("record")))
    return found.where("whole").select(*columns).union(checked.select(*columns))
