"""Positions in a global order, computed partition by partition."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.functions.columns import flat_columns
from starmill.workspace import materialize, temporary_tables

POSITION_BITS = 33
# Rows of a block that are numbered together: 2 to this power.
STRETCH_BITS = 13
# Stretches whose bitmaps, some 1.5 KB each, are broadcast.
MOST_STRETCHES = 1 << 15


def sort_columns(df: DataFrame, order_by: list[str | Column]) -> list[Column]:
    """The order as plain columns: a struct becomes its fields, which sort faster."""
    out = []
    for c in order_by:
        if isinstance(c, str):
            leaves = flat_columns(df.select(c).schema)
            out += list(leaves.values())
        else:
            out.append(c)
    return out


def ranged(df: DataFrame, order_by: list[str | Column], label: str) -> DataFrame:
    """Range-partition and sort by a total order, then write the table.

    Adds ``_part`` (the range, ascending) and ``_pos`` (the place inside it).
    The ranges come from sampling, so they are written down before any second
    reader sees them.
    """
    low_bits = F.lit((1 << POSITION_BITS) - 1)
    order = sort_columns(df, order_by)
    return materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(low_bits)),
        label,
    )


def part_offsets(staged: DataFrame) -> DataFrame:
    """Rows in all earlier ranges, one row per range.

    The driver sees one count per partition, never the data.
    """
    totals = staged.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect()
    offsets, before = [], 0
    for total in totals:
        offsets.append((total["_part"], before))
        before += total["n"]
    return staged.sparkSession.createDataFrame(offsets, "_part int, _before long")


def number_rows(df: DataFrame, order_by: list[str | Column], into: str, start: int = 1) -> DataFrame:
    """Dense numbers from ``start`` in the given total order."""
    staged = ranged(df, order_by, "numbered")
    return (
        staged.join(F.broadcast(part_offsets(staged)), "_part")
        .withColumn(into, F.col("_before") + F.col("_pos") + F.lit(start))
        .drop("_part", "_pos", "_before")
    )


def is_placed(df: DataFrame) -> bool:
    """Whether ``_ord`` is a place in a source: source, file, block and row."""
    kind = df.schema["_ord"].dataType
    return getattr(kind, "names", None) == ["source", "file", "block", "row"]


def with_places(df: DataFrame, into: str) -> DataFrame:
    """Adds the place ``_ord`` as one long that sorts alike and is cheap to compare.

    Rows of a block go by stretches; a stretch is named by its rank among all,
    which joins by broadcast: there is one for some thousands of rows.
    """
    keys = {
        "_source": F.col("_ord.source"), "_file": F.coalesce("_ord.file", F.lit("")),
        "_block": F.coalesce("_ord.block", F.lit(0)), "_stretch": F.shiftright("_ord.row", STRETCH_BITS),
    }
    row = F.col("_ord.row").bitwiseAND((1 << STRETCH_BITS) - 1)
    stretches = materialize(df.select(*[c.alias(n) for n, c in keys.items()]).distinct(), "stretches")
    in_file = Window.partitionBy("_source", "_file").orderBy("_block", "_stretch")
    in_order = Window.orderBy("_source", "_file").rowsBetween(Window.unboundedPreceding, -1)
    files = stretches.groupBy("_source", "_file").agg(F.count(F.lit(1)).alias("n"))  # one row a file
    files = files.select("_source", "_file", F.coalesce(F.sum("n").over(in_order), F.lit(0)).alias("_earlier"))
    rank = F.col("_earlier") + F.row_number().over(in_file) - 1
    ranks = materialize(
        stretches.join(files, ["_source", "_file"]).select(*keys, rank.alias("_rank")), "stretch-ranks"
    )
    placed = df.withColumns(keys | {"_row": row}).join(F.broadcast(ranks), list(keys))
    return placed.withColumn(
        into, F.expr(f"shiftleft(_rank, {STRETCH_BITS})").bitwiseOR(F.col("_row"))
    ).drop(*keys, "_row", "_rank")


def is_numeric_place(df: DataFrame) -> bool:
    """Whether ``_ord`` is a place that ``with_places`` gave."""
    return df.schema["_ord"].dataType.typeName() == "long"


def number_placed(df: DataFrame, into: str, start: int, wanted: Column) -> DataFrame:
    """Dense numbers from ``start`` for the wanted rows, in the order of their places; others get null.

    A stretch of places is a row of bitmaps that tell which are wanted, with the
    wanted rows before each. So no row is shuffled or sorted to be numbered: it
    meets the bitmaps of its stretch, by broadcast while they are no more than
    ``MOST_STRETCHES``, and counts the bits before its own. Rows that share a
    place cannot be told apart by bits; if there are any, rows are numbered by sorting their
    stretches. ``df`` is read twice, once for the bitmaps, and the result is not written.
    """
    word_bits = min(6, STRETCH_BITS)
    words_of = STRETCH_BITS - word_bits
    placed = df.withColumn("_at", F.col("_ord")) if is_numeric_place(df) else with_places(df, "_at")
    placed = placed.withColumn("_wanted", F.coalesce(wanted, F.lit(False)))
    bit = F.expr(f"shiftleft(1L, cast(_at & {(1 << word_bits) - 1} AS int))")
    words = materialize(
        placed.where("_wanted").groupBy(F.shiftright("_at", word_bits).alias("_word"))
        .agg(F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("n")), "place-words",
    )
    stretches = materialize(
        words.groupBy(F.shiftright("_word", words_of).alias("_stretch"))
        .agg(F.sum("n").alias("n"), F.sum(F.bit_count("bits")).alias("places")), "place-stretches",
    )
    # Wanted rows of all stretches before: by groups of stretches, and then within a group.
    grouped = stretches.withColumn("_group", F.shiftright("_stretch", 12))
    earlier = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    in_group = Window.partitionBy("_group").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    groups = grouped.groupBy("_group").agg(F.sum("n").alias("n"))
    groups = groups.select("_group", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_earlier"))
    before = F.coalesce(F.sum("n").over(in_group), F.lit(0)) + F.col("_earlier")
    offsets = grouped.join(groups, "_group").select("_stretch", before.alias("_before"))
    placed = placed.withColumn("_stretch", F.shiftright("_at", STRETCH_BITS))
    size = stretches.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("n") != F.col("places")).alias("shared")).first()
    if size["shared"]:
        within = Window.partitionBy("_stretch", "_wanted").orderBy("_at")
        numbered = placed.withColumn("_pos", F.row_number().over(within) - 1).join(offsets, "_stretch", "left")
    else:
        every = stretches.select(
            F.expr(f"explode(sequence(shiftleft(_stretch, {words_of}), shiftleft(_stretch + 1, {words_of}) - 1))").alias("_word"),
            F.lit(0).cast("long").alias("bits"), F.lit(0).cast("long").alias("n"),
        )
        cells = words.unionByName(every).groupBy("_word").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
        cells = cells.withColumn("_stretch", F.shiftright("_word", words_of))
        in_stretch = Window.partitionBy("_stretch").orderBy("_word").rowsBetween(Window.unboundedPreceding, -1)
        cells = cells.withColumn("first", F.coalesce(F.sum("n").over(in_stretch), F.lit(0)).cast("int"))
        cells = cells.groupBy("_stretch").agg(F.sort_array(F.collect_list(F.struct("_word", "first", "bits"))).alias("cells"))
        bitmaps = materialize(
            cells.join(offsets, "_stretch").select(
                "_stretch", "_before", F.col("cells.first").alias("_firsts"), F.col("cells.bits").alias("_bits")
            ), "place-bitmaps",
        )
        word = f"cast((_at >> {word_bits}) & {(1 << words_of) - 1} AS int)"
        lower = f"~shiftleft(-1L, cast(_at & {(1 << word_bits) - 1} AS int))"
        numbered = placed.join(
            F.broadcast(bitmaps) if size["n"] <= MOST_STRETCHES else bitmaps, "_stretch", "left"
        ).withColumn("_pos", F.expr(f"_firsts[{word}] + bit_count(_bits[{word}] & {lower})"))
    return numbered.withColumn(
        into, F.when(F.col("_wanted"), F.col("_before") + F.col("_pos") + F.lit(start))
    ).drop("_at", "_wanted", "_stretch", "_before", "_firsts", "_bits", "_pos")


def exact_medians(df: DataFrame, values: dict[str, Column]) -> dict[str, float]:
    """Median of each named double expression, exact at any size.

    Values are counted first, so a value that fills a third of the table is one
    row from there on; the middle is then found from per-range counts and only
    the ranges that hold it are read again.
    """
    with temporary_tables(df.sparkSession):
        return _medians(df, values)


def _medians(df: DataFrame, values: dict[str, Column]) -> dict[str, float]:
    pairs = F.explode(
        F.array(*[
            F.struct(F.lit(name).alias("name"), value.cast("double").alias("value"))
            for name, value in values.items()
        ])
    ).alias("pair")
    histogram = (
        df.select(pairs).select("pair.*").where("value IS NOT NULL")
        .groupBy("name", "value").agg(F.count("*").alias("n"))
    )
    staged = ranged(histogram, ["name", "value"], "median")
    totals = staged.groupBy("name", "_part").agg(F.sum("n").alias("n")).collect()

    wanted = []  # (name, range, rows of the column before the range, rank)
    for name in values:
        parts = sorted((t["_part"], t["n"]) for t in totals if t["name"] == name)
        size = sum(n for _, n in parts)
        for rank in {(size - 1) // 2, size // 2} if size else set():
            before = 0
            for part, n in parts:
                if before <= rank < before + n:
                    wanted.append((name, part, before, rank))
                before += n
    if not wanted:
        return {}
    targets = df.sparkSession.createDataFrame(
        wanted, "name string, _part int, _before long, rank long"
    )
    upto = F.sum("n").over(Window.partitionBy("name", "_part").orderBy("value"))
    parts = sorted({part for _, part, _, _ in wanted})
    middles = (
        staged.where(F.col("_part").isin(parts))
        .withColumn("upto", upto)
        .join(F.broadcast(targets), ["name", "_part"])
        .where(F.col("_before") + F.col("upto") > F.col("rank"))
        .groupBy("name", "rank").agg(F.min("value").alias("value"))
        .groupBy("name").agg(F.avg("value").alias("median"))
        .collect()
    )
    return {row["name"]: row["median"] for row in middles}
