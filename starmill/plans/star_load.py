"""Loading transactions into the star: dimensions, keys, facts, checks."""

import logging
from collections import Counter
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.calendar import date_key
from starmill.functions.fixed import B2B_COUNTRIES, REGIONS
from starmill.functions.text import day, number
from starmill.operators.clean import known_pattern
from starmill.operators.dimensions import (
    customer_dimension,
    date_dimension_for,
    product_dimension,
)
from starmill.operators.numbering import is_numeric_place, is_placed, number_placed, number_rows, with_places
from starmill.operators.profile import referential_orphans
from starmill.plans.warehouse import (
    BUSINESS_KEYS,
    DELETED,
    FACT,
    KEYS,
    Snapshot,
    Warehouse,
    bucket,
    checked_counts,
    deepest,
    holding,
)
from starmill.workspace import materialize, shuffles_dropped, temporary_tables

log = logging.getLogger(__name__)

# Folders a part of a year of facts, or the list of deleted orders, may consist of before a
# load merges them, the share of dead facts at which it drops them, and the most orders that
# are looked for by name.
MOST_LOADS = 32
MOST_DEAD = 0.25
NAMED = 1000

MEASURES = ["quantity", "unit_price", "discount", "total_amount"]


def stamped(now: datetime) -> Column:
    """A moment as a zoneless literal, whatever the session's zone."""
    return F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")


def new_dates(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Days of the batch the date dimension does not have yet."""
    return batch.join(current.select("date_key"), "date_key", "left_anti")


def upsert(
    current: DataFrame, batch: DataFrame, business_key: str, surrogate: str,
    now: datetime, next_key: int = 1,
) -> DataFrame:
    """The dimension after a batch: known keys overwritten, new ones numbered, others kept.

    ``batch`` has one row per business key and ``_ord``, the place that decides
    the order of new surrogate keys. Adds ``_change``: new, updated or kept.
    """
    attributes = [
        c for c in current.columns
        if c not in (business_key, surrogate, "loaded_at", "updated_at")
    ]
    stamp = stamped(now)
    old = current.select(F.lit(True).alias("_old"), *[
        F.col(c) if c == business_key else F.col(c).alias(f"old_{c}") for c in current.columns
    ])
    joined = old.join(
        batch.withColumn("_new", F.lit(True)), business_key, "full_outer"
    )
    is_old, is_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    merged = joined.select(
        F.col(f"old_{surrogate}").alias(surrogate),
        business_key,
        *[
            F.when(is_new, F.col(c)).otherwise(F.col(f"old_{c}")).alias(c)
            if c in batch.columns else F.col(f"old_{c}").alias(c)
            for c in attributes
        ],
        F.when(is_old, F.col("old_loaded_at")).otherwise(stamp).alias("loaded_at"),
        F.when(is_new, stamp).otherwise(F.col("old_updated_at")).alias("updated_at"),
        F.when(~is_old, "new").when(is_new, "updated").otherwise("kept").alias("_change"),
        "_ord",
    )
    staged = materialize(merged, "upsert")
    known = staged.where("_change <> 'new'").drop("_ord")
    added = number_rows(
        staged.where("_change = 'new'").drop(surrogate), ["_ord"], surrogate, next_key
    )
    return known.unionByName(added.drop("_ord"))


def first_load(
    batch: DataFrame, columns: list[str], surrogate: str, now: datetime, next_key: int = 1
) -> DataFrame:
    """What ``upsert`` gives on an empty dimension, without the join."""
    stamp = stamped(now)
    numbered = number_rows(batch, ["_ord"], surrogate, next_key)
    numbered = numbered.withColumns({
        "loaded_at": stamp, "updated_at": stamp, "_change": F.lit("new")
    })
    return numbered.select(*[
        F.col(c) if c in numbered.columns else F.lit(None).alias(c) for c in columns
    ], "_change")


def key_map(dimension: DataFrame, table: str) -> DataFrame:
    """Business key to surrogate key."""
    return dimension.select(BUSINESS_KEYS[table], KEYS[table])


def dated(sales: DataFrame, pattern: str | None = None) -> tuple[DataFrame, str | None]:
    """The batch with its dates as dates, and the pattern they were read by.

    Text follows ``pattern``, or else the format of the first one, as in cleaning.
    """
    dtype = sales.schema["order_date"].dataType
    if not isinstance(dtype, T.StringType):
        return sales, None
    if pattern is None:
        place = F.when(F.col("order_date").isNotNull(), F.col("_ord"))
        first = sales.agg(F.min_by("order_date", place)).first()[0]
        pattern = known_pattern("order_date", first)
    return sales.withColumn("order_date", day(F.col("order_date"), dtype, pattern)), pattern


def resolve_facts(sales: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Fact columns with surrogate keys; ``_dropped`` says why a row cannot be loaded.

    The key maps join without hints: the optimizer broadcasts a map that is
    small enough and otherwise sorts both sides, splitting keys that are hot.
    """
    bought = day(F.col("order_date"), sales.schema["order_date"].dataType)
    joined = sales.join(customers, "customer_id", "left").join(products, "product_id", "left")
    return joined.select(
        date_key(bought).alias("date_key"),
        "customer_key",
        "product_key",
        F.col("order_id").cast("string").alias("order_id"),
        *[number(F.col(c), sales.schema[c].dataType).alias(c) for c in MEASURES],
        F.when(F.col("customer_key").isNull(), "customer")
        .when(F.col("product_key").isNull(), "product")
        .when(bought.isNull(), "date").alias("_dropped"),
        "_ord",
    )


def keyed_facts(sales: DataFrame, customers: DataFrame, products: DataFrame, next_key: int = 1) -> DataFrame:
    """Written, numbered facts of a batch whose every key the maps hold; ``_dropped`` as in ``resolve_facts``.

    Lines are numbered before their keys are looked up, since an id that is there
    will be found: each look-up then runs once, and no places are shuffled for it.
    """
    bought = day(F.col("order_date"), sales.schema["order_date"].dataType)
    lines = sales.select(
        date_key(bought).alias("date_key"),
        "customer_id",
        "product_id",
        F.col("order_id").cast("string").alias("order_id"),
        *[number(F.col(c), sales.schema[c].dataType).alias(c) for c in MEASURES],
        F.when(F.col("customer_id").isNull(), "customer")
        .when(F.col("product_id").isNull(), "product")
        .when(bought.isNull(), "date").alias("_dropped"),
        "_ord",
    )
    numbered = number_facts(lines, next_key).drop("_ord")
    found = numbered.join(customers, "customer_id", "left").join(products, "product_id", "left")
    return materialize(found.drop("customer_id", "product_id"), "facts")


def number_facts(resolved: DataFrame, next_key: int = 1) -> DataFrame:
    """Give every loadable row its sale_id in batch order; dropped rows get none or a later one."""
    if is_placed(resolved) or is_numeric_place(resolved):
        return number_placed(resolved, "sale_id", next_key, F.col("_dropped").isNull())
    return number_rows(
        resolved, [F.col("_dropped").isNotNull(), "_ord"], "sale_id", next_key
    )


def load_measures() -> dict[str, Column]:
    """Aggregates over resolved facts: rows offered, dropped by reason, loaded, and revenue."""
    loaded = F.col("_dropped").isNull()
    revenue = F.sum(F.when(loaded, F.col("total_amount")))
    return {
        "rows_in": F.count("*"),
        "unmapped_customers": F.count_if(F.col("_dropped") == "customer"),
        "unmapped_products": F.count_if(F.col("_dropped") == "product"),
        "invalid_dates": F.count_if(F.col("_dropped") == "date"),
        "rows_loaded": F.count_if(loaded),
        "total_revenue": revenue,
        "avg_order": F.try_divide(revenue.cast("double"), F.count_if(loaded)),
    }


def part_path(folder: str) -> str:
    """Year and part of a folder of facts, whatever load wrote it."""
    return folder.split("/", 2)[2]


def parts_of(batch: DataFrame, key: str, folders: list[str]) -> set[int]:
    """The parts a batch has keys in, as deep as the deepest folder; the driver sees one row a part."""
    parts = batch.select(bucket(key, deepest(folders))).where("bucket IS NOT NULL").distinct()
    return {r[0] for r in parts.collect()}


def stored_orders(warehouse: Warehouse, base: Snapshot, batch: DataFrame) -> DataFrame:
    """(order_id, lines) of the batch's orders that have live lines in the warehouse.

    Only folders of parts the batch has orders in are scanned, and of those one
    column; a few orders are looked for by name, so that files sorted by order
    are skipped but for the pages that may have them.
    """
    orders = batch.select("order_id").distinct()
    folders = holding(base.tables[FACT], parts_of(batch, "order_id", base.tables[FACT]))
    stored = warehouse.live_facts(folders, base.tables.get(DELETED, [])).select("order_id")
    named = [r[0] for r in orders.limit(NAMED + 1).collect()]
    if len(named) <= NAMED:
        stored = stored.where(F.col("order_id").isin(named))
    found = stored.join(orders, "order_id", "left_semi")
    return materialize(found.groupBy("order_id").agg(F.count(F.lit(1)).alias("lines")), "stored-orders")


def folders_with_dead(warehouse: Warehouse, folders: list[str], deleted: list[str]) -> list[str]:
    """The fact's folders that hold lines of deleted orders; the driver sees one row a folder."""
    folder = F.regexp_extract("_place", f"/({FACT}/load=[^/]*/[^/]*/[^/]*)/[^/]*$", 1).alias("folder")
    every = warehouse.read(FACT, folders, place=True).groupBy(folder).agg(F.count(F.lit(1)).alias("stored"))
    live = warehouse.live_facts(folders, deleted, place=True).groupBy(folder).agg(F.count(F.lit(1)).alias("live"))
    both = every.join(live, "folder", "left").where("live IS NULL OR live < stored")
    return [r["folder"] for r in both.collect()]


@dataclass
class Loaded:
    """What a star load did."""

    version: int
    dates_inserted: int
    customers: dict[str, int]
    products: dict[str, int]
    facts: dict[str, Any]
    facts_replaced: int
    orphans: dict[str, int]


@dataclass
class LoadedDimension:
    """A dimension's rows, the folders that will hold it, and what changed."""

    rows: DataFrame
    folders: list[str]
    counts: dict[str, int]


def load_dimension(
    warehouse: Warehouse, base: Snapshot, name: str, batch: DataFrame, now: datetime
) -> LoadedDimension:
    """Merge a batch into a dimension and write the parts that have its keys to new folders.

    ``rows`` are those parts as written, which hold every key of the batch. The
    optimizer knows their size, and broadcasts their keys while they are few.
    """
    start = base.next_key.get(name, 1)
    business, surrogate = BUSINESS_KEYS[name], KEYS[name]
    folders = base.tables.get(name, [])
    if folders:
        merged = holding(folders, parts_of(batch, business, folders))
        folders = [f for f in folders if f not in set(merged)]
        rows = upsert(warehouse.read(name, merged), batch, business, surrogate, now, start)
    else:
        rows = first_load(batch, warehouse.schemas[name].names, surrogate, now, start)
    counts = checked_counts(rows, name, {
        kind: F.count_if(F.col("_change") == kind) for kind in ("new", "updated")
    })
    written = warehouse.write(rows, name, base.version + 1, start - 1 + counts["new"])
    return LoadedDimension(warehouse.read(name, written), folders + written, counts)


def load_dates(warehouse: Warehouse, base: Snapshot, sales: DataFrame) -> LoadedDimension:
    """Write the days the date dimension lacks; ``rows`` holds those only."""
    rows = materialize(
        new_dates(warehouse.table("dim_date", base), date_dimension_for(sales)), "dates"
    )
    counts = checked_counts(rows, "dim_date", {"new": F.count("*")})
    folders = list(base.tables.get("dim_date", []))
    if counts["new"]:
        folders += warehouse.write(rows.coalesce(1), "dim_date", base.version + 1)
    return LoadedDimension(rows, folders, counts)


def side_by_side(tasks: list[Callable[[], Any]]) -> list[Any]:
    """Run independent loads together, so that one fills the cluster where another ends."""
    with ThreadPoolExecutor(len(tasks)) as pool:
        return [f.result() for f in [pool.submit(copy_context().run, t) for t in tasks]]


def load_star(
    warehouse: Warehouse,
    sales: DataFrame,
    regions: dict[str, str] = REGIONS,
    b2b: list[str] = B2B_COUNTRIES,
    now: datetime | None = None,
    most_loads: int = MOST_LOADS,
    stream: tuple[str, int] | None = None,
) -> Loaded | None:
    """Load a batch of transactions: all tables become visible together, or none.

    ``sales`` must be a written table (it is read once per output) and carry
    ``_ord``. A batch replaces the stored lines of its orders: those orders are
    written down as deleted, and readers leave their older lines out. Once a
    quarter of the stored lines is dead, or the deletions fill ``most_loads``
    folders, the folders with dead lines are rewritten without them; so are the
    parts of the fact in that many folders.

    A batch of a ``stream``, given as the stream's name and the batch's number,
    adds its lines instead, for the other lines of an order may have come in an
    earlier one; a number the warehouse has seen is loaded already, and nothing
    is done. A stream's dates are read by the pattern of its first one, whatever
    batch they come in, and a batch without a readable date is set aside.
    """
    with temporary_tables(warehouse.spark), shuffles_dropped(warehouse.spark), shuffles_dropped(sales.sparkSession):
        return _load_star(warehouse, sales, regions, b2b, now, most_loads, stream)


def _load_star(
    warehouse: Warehouse, sales: DataFrame, regions: dict[str, str], b2b: list[str],
    now: datetime | None, most_loads: int, stream: tuple[str, int] | None,
) -> Loaded | None:
    now = now or datetime.now(timezone.utc).replace(tzinfo=None)
    base = warehouse.current()
    if stream and base.streams.get(stream[0], -1) >= stream[1]:
        return None
    offered = sales
    sales, pattern = dated(sales, base.patterns.get(stream[0]) if stream else None)
    version = base.version + 1
    if is_placed(sales):
        sales = with_places(sales, "_ord")
    customers, products, dates = side_by_side([
        lambda: load_dimension(
            warehouse, base, "dim_customer", customer_dimension(sales, regions, b2b), now
        ),
        lambda: load_dimension(warehouse, base, "dim_product", product_dimension(sales), now),
        lambda: load_dates(warehouse, base, sales),
    ])
    dimensions = {"dim_customer": customers, "dim_product": products, "dim_date": dates}
    tables = {name: d.folders for name, d in dimensions.items()}
    next_key = {
        name: base.next_key.get(name, 1) + dimensions[name].counts["new"] for name in BUSINESS_KEYS
    }

    start = base.next_key.get(FACT, 1)
    facts = keyed_facts(
        sales, key_map(customers.rows, "dim_customer"), key_map(products.rows, "dim_product"), start
    )
    counts = checked_counts(facts, FACT, load_measures(), F.col("_dropped").isNull())
    if counts["rows_in"] and counts["invalid_dates"] == counts["rows_in"]:
        if not stream:
            raise ValueError("no order_date of the batch can be read; see the log for its format")
        aside = warehouse.set_aside(offered, *stream)
        log.error("batch %d of stream %s has no readable order_date; kept in %s", stream[1], stream[0], aside)
        warehouse.publish(base, {}, {}, dict([stream]))
        return None
    loadable = facts.where("_dropped IS NULL").drop("_dropped")
    next_key[FACT] = start + counts["rows_loaded"]
    batch = loadable.withColumns({
        "loaded_at": stamped(now),
        "sale_year": F.floor(F.col("date_key") / 10000).cast("int"),
    })

    folders, deleted = list(base.tables.get(FACT, [])), list(base.tables.get(DELETED, []))
    replaced, dead = 0, base.dead
    if folders and not stream:
        again = stored_orders(warehouse, base, batch)
        replaced = again.agg(F.coalesce(F.sum("lines"), F.lit(0))).first()[0]
        if replaced:
            deleted.append(warehouse.write_deleted(again, version))
            dead += replaced
    # Dead lines go once they are many, and so do parts of many small folders.
    parts = Counter(part_path(f) for f in folders)
    rewritten = {f for f in folders if parts[part_path(f)] >= most_loads}
    drop_dead = dead > MOST_DEAD * (start - 1) or len(deleted) >= most_loads > 1
    if deleted and drop_dead:
        rewritten |= set(folders_with_dead(warehouse, folders, deleted))
    if rewritten:
        kept = warehouse.live_facts(sorted(rewritten), deleted)
        batch = kept.unionByName(batch, allowMissingColumns=True)
        folders = [f for f in folders if f not in rewritten]
    if drop_dead:
        deleted, dead = [], 0
    tables[FACT] = folders + warehouse.write(batch, FACT, version, next_key[FACT] - 1)
    tables[DELETED] = deleted

    orphans = {
        r["foreign_key"]: r["orphans"]
        for r in referential_orphans(loadable, {
            "customer_key": customers.rows,
            "product_key": products.rows,
            "date_key": dates.rows.select("date_key").unionByName(
                warehouse.table("dim_date", base).select("date_key")
            ),
        }).collect()
    }
    if any(orphans.values()):
        raise ValueError(f"referential integrity violated: {orphans}")
    warehouse.publish(
        base, tables, next_key, dict([stream]) if stream else {},
        {stream[0]: pattern} if stream and pattern else {}, dead,
    )
    return Loaded(
        version, dates.counts["new"], customers.counts, products.counts, counts, replaced, orphans,
    )
