"""The star-schema warehouse: Parquet tables behind atomic snapshots.

Each load writes its files to new folders and then publishes one small snapshot
file that lists, for every table, the folders that make it up. Readers see the
whole load or nothing; files a load does not touch are carried over by name.
"""

import json
import uuid
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.operators.profile import uniqueness
from starmill.workspace import Files

FACT = "fact_sales"
# Orders whose lines of earlier loads are gone; facts are read without them.
DELETED = "fact_deleted"
# A year of facts lies in parts by a hash of the order, a dimension in parts by a hash of its
# business key. There are twice as many whenever a table has outgrown so many rows a part.
PART_ROWS = 2_000_000
KEYS = {
    "dim_date": "date_key",
    "dim_customer": "customer_key",
    "dim_product": "product_key",
    FACT: "sale_id",
}
BUSINESS_KEYS = {"dim_customer": "customer_id", "dim_product": "product_id"}

# Conditions every row must meet; a null result passes, as in SQL CHECK.
NOT_NULL = {
    FACT: [
        "sale_id", "date_key", "customer_key", "product_key", "order_id", "quantity",
        "unit_price", "total_amount",
    ],
    "dim_date": [
        "date_key", "full_date", "day", "month", "year", "quarter", "day_of_week",
        "day_of_week_num", "month_name", "is_weekend",
    ],
    "dim_customer": ["customer_key", "customer_id", "customer_name"],
    "dim_product": ["product_key", "product_id", "product_name", "category"],
}
CHECKS = {
    FACT: {
        "quantity > 0": "quantity > 0",
        "unit_price >= 0": "unit_price >= 0",
        "discount between 0 and 100": "discount BETWEEN 0 AND 100",
        "total_amount >= 0": "total_amount >= 0",
    },
    "dim_date": {
        "day between 1 and 31": "day BETWEEN 1 AND 31",
        "month between 1 and 12": "month BETWEEN 1 AND 12",
        "quarter between 1 and 4": "quarter BETWEEN 1 AND 4",
        "day_of_week_num between 1 and 7": "day_of_week_num BETWEEN 1 AND 7",
    },
    "dim_customer": {},
    "dim_product": {},
}


def bucket(key: str, depth: int) -> Column:
    """The part of a key: the low ``depth`` bits of its hash, after a leading one that tells the depth."""
    return (F.lit(1 << depth) + F.pmod(F.xxhash64(key), F.lit(1 << depth))).cast("int").alias("bucket")


def depth_of(part: int) -> int:
    return part.bit_length() - 1


def part_of(folder: str) -> int:
    return int(folder.rsplit("bucket=", 1)[1])


def deepest(folders: list[str]) -> int:
    return max((depth_of(part_of(f)) for f in folders), default=0)


def holding(folders: list[str], parts: set[int]) -> list[str]:
    """The folders that may hold keys of the parts, which are as deep as the deepest folder."""
    low = {(d, p & ((1 << d) - 1)) for d in {depth_of(part_of(f)) for f in folders} for p in parts}
    return [f for f in folders if (d := depth_of(p := part_of(f)), p & ((1 << d) - 1)) in low]


class ConstraintError(ValueError):
    """Rows that break a table's constraints; nothing was written."""


class ContractError(ValueError):
    """A stored table that no longer has the shape or keys it must have."""


def schemas(money: str = "double") -> dict[str, T.StructType]:
    """Table schemas; ``money`` is the type of prices and amounts."""
    return {
        "dim_date": T.StructType.fromDDL(
            "date_key int, full_date date, day int, month int, year int, quarter int, "
            "day_of_week string, day_of_week_num int, month_name string, is_weekend int, "
            "is_holiday int, fiscal_year int, fiscal_quarter int"
        ),
        "dim_customer": T.StructType.fromDDL(
            "customer_key long, customer_id string, customer_name string, email string, "
            "country string, city string, region string, customer_segment string, "
            "first_purchase_date date, loaded_at timestamp_ntz, updated_at timestamp_ntz"
        ),
        "dim_product": T.StructType.fromDDL(
            "product_key long, product_id string, product_name string, category string, "
            f"subcategory string, brand string, cost_price {money}, is_active int, "
            "loaded_at timestamp_ntz, updated_at timestamp_ntz"
        ),
        FACT: T.StructType.fromDDL(
            "sale_id long, date_key int, customer_key long, product_key long, "
            f"order_id string, quantity long, unit_price {money}, discount {money}, "
            f"total_amount {money}, loaded_at timestamp_ntz, sale_year int"
        ),
    }


@dataclass
class Snapshot:
    """Folders of each table, the next surrogate key of each sequence, the last batch of
    each stream that is loaded and the date pattern it goes by, and how many stored facts
    are dead."""

    version: int = 0
    tables: dict[str, list[str]] = field(default_factory=dict)
    next_key: dict[str, int] = field(default_factory=dict)
    streams: dict[str, int] = field(default_factory=dict)
    patterns: dict[str, str] = field(default_factory=dict)
    dead: int = 0


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, money: str = "double", part_rows: int = PART_ROWS):
        self.spark = spark
        self.part_rows = part_rows
        self.root = root.rstrip("/")
        self.schemas = schemas(money)
        self._files = Files(spark)

    # Snapshots

    def current(self) -> Snapshot:
        """The newest published snapshot; version 0 is the empty warehouse."""
        names = [n for n in self._files.names(f"{self.root}/_snapshots") if n.endswith(".json")]
        if not names:
            return Snapshot()
        return Snapshot(**json.loads(self._files.read_text(f"{self.root}/_snapshots/{names[-1]}")))

    def publish(
        self, base: Snapshot, tables: dict[str, list[str]], next_key: dict[str, int],
        streams: dict[str, int] | None = None, patterns: dict[str, str] | None = None,
        dead: int | None = None,
    ) -> Snapshot:
        """Make a load visible. Fails if another load was published since ``base``."""
        new = Snapshot(
            base.version + 1, {**base.tables, **tables}, {**base.next_key, **next_key},
            {**base.streams, **(streams or {})}, {**base.patterns, **(patterns or {})},
            base.dead if dead is None else dead,
        )
        self._files.create_once(
            f"{self.root}/_snapshots/{new.version:012d}.json", json.dumps(vars(new))
        )
        return new

    # Tables

    def table(self, name: str, at: Snapshot | None = None) -> DataFrame:
        """A table as of a snapshot; a table never loaded has no rows."""
        at = at or self.current()
        if name == FACT and at.tables.get(DELETED):
            return self.live_facts(at.tables.get(FACT, []), at.tables[DELETED])
        return self.read(name, at.tables.get(name, []))

    def live_facts(self, folders: list[str], deleted: list[str], place: bool = False) -> DataFrame:
        """Facts without the lines of orders a later load has replaced.

        Only folders older than the newest deletion are joined with the deleted
        orders, which the optimizer broadcasts while they are few.
        """
        newest = max((version_of(f) for f in deleted), default=0)
        old = [f for f in folders if version_of(f) < newest]
        new = [f for f in folders if version_of(f) >= newest]
        if not old:
            return self.read(FACT, new, place)
        rows = self.read(FACT, old, True).withColumn("_version", _version(F.col("_place")))
        gone = self.spark.read.schema("order_id string").parquet(*[f"{self.root}/{f}" for f in deleted])
        gone = gone.select(
            F.col("order_id").alias("_gone"), _version(F.col("_metadata.file_path")).alias("_since")
        ).groupBy("_gone").agg(F.max("_since").alias("_since"))
        met = (F.col("order_id") == F.col("_gone")) & (F.col("_version") < F.col("_since"))
        live = rows.join(gone, met, "left_anti").drop("_version", *([] if place else ["_place"]))
        return live.unionByName(self.read(FACT, new, place)) if new else live

    def write_deleted(self, orders: DataFrame, version: int) -> str:
        folder = f"{DELETED}/load=v{version}_{uuid.uuid4().hex}"
        orders.select("order_id").write.parquet(f"{self.root}/{folder}")
        return folder

    def set_aside(self, batch: DataFrame, stream: str, number: int) -> str:
        """Keep a batch that cannot be loaded where somebody can look at it."""
        path = f"{self.root}/_set_aside/{stream}/batch={number}"
        batch.write.mode("overwrite").parquet(path)
        return path

    def depth(self, rows: int) -> int:
        """Bits of the hash that part a table of so many rows."""
        return max(0, -(-rows // self.part_rows) - 1).bit_length()

    def read(self, name: str, folders: list[str], place: bool = False) -> DataFrame:
        """The rows in some folders of a table; ``place`` adds the file of each as ``_place``."""
        schema = self.schemas[name]
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}")
        files = [F.col("_metadata.file_path").alias("_place")] if place else []
        return reader.parquet(*[f"{self.root}/{f}" for f in folders]).select(*schema.names, *files)

    def clean_up(self, keep: int = 10) -> list[str]:
        """Remove folders that none of the newest ``keep`` snapshots names, and older snapshots.

        Folders of loads that failed go as well, so no load may be running.
        """
        folder = f"{self.root}/_snapshots"
        names = [n for n in self._files.names(folder) if n.endswith(".json")]
        kept = [Snapshot(**json.loads(self._files.read_text(f"{folder}/{n}"))) for n in names[-keep:]]
        used = {f for s in kept for folders in s.tables.values() for f in folders}
        used_loads = {"/".join(f.split("/")[:2]) for f in used}
        removed = [
            f"{name}/{load}" for name in [*self.schemas, DELETED] for load in self._files.names(f"{self.root}/{name}")
            if f"{name}/{load}" not in used_loads
        ]
        for path in [*removed, *(f"_snapshots/{n}" for n in names[:-keep])]:
            self._files.remove(f"{self.root}/{path}")
        return removed

    def write(self, df: DataFrame, name: str, version: int, rows: int = 0) -> list[str]:
        """Write new files of a table and return their folders; readers do not see them yet.

        ``rows`` is about how many the whole table has, and says how finely it is parted.

        The folder is the writer's own, so two loads of one version cannot mix.
        """
        folder = f"{name}/load=v{version}_{uuid.uuid4().hex}"
        out = df.select(*[
            F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schemas[name].fields
        ])
        if name == "dim_date":
            out.write.parquet(f"{self.root}/{folder}")
            return [folder]
        # One writer per part and advisory size: large parts are split, small ones merged.
        parts = ["sale_year", "bucket"] if name == FACT else ["bucket"]
        key = "order_id" if name == FACT else BUSINESS_KEYS[name]
        balanced = out.withColumn("bucket", bucket(key, self.depth(rows))).hint("rebalance", *parts)
        # In the order of the key, so that a look for few keys skips most of a file.
        balanced = balanced.sortWithinPartitions(*parts, key)
        balanced.write.partitionBy(*parts).parquet(f"{self.root}/{folder}")
        folders = [folder]
        for part in parts:
            folders = [
                f"{f}/{n}" for f in folders for n in self._files.names(f"{self.root}/{f}")
                if n.startswith(f"{part}=")
            ]
        return folders

    # Contract

    def contract(self, name: str) -> DataFrame:
        """One row per promise of a stored table: its columns and its unique keys."""
        stored = self.spark.createDataFrame([], self.schemas[name])
        folders = self.current().tables.get(name, [])
        if folders:
            stored = self.spark.read.option("basePath", f"{self.root}/{name}").parquet(
                *[f"{self.root}/{f}" for f in folders]
            )
        have = {f.name: f.dataType.simpleString() for f in stored.schema.fields}
        wrong = [
            f.name for f in self.schemas[name].fields
            if have.get(f.name) != f.dataType.simpleString()
        ]
        rows = self.spark.createDataFrame(
            [(name, "columns", not wrong, ",".join(wrong))],
            "table_name string, promise string, holds boolean, detail string",
        )
        for key in (KEYS[name], BUSINESS_KEYS.get(name)):
            if key in have:
                unique = uniqueness(self.table(name) if name == FACT else stored, key, name)
                rows = rows.unionByName(unique.select(
                    F.lit(name).alias("table_name"),
                    F.lit(f"unique {key}").alias("promise"),
                    F.col("is_valid").alias("holds"),
                    F.col("message").alias("detail"),
                ))
        return rows

    def require_contract(self, name: str) -> None:
        broken = [r for r in self.contract(name).collect() if not r["holds"]]
        if broken:
            raise ContractError(
                "; ".join(f"{name} {r['promise']}: {r['detail']}" for r in broken)
                + "; call rebuild() to start the warehouse anew"
            )

    def rebuild(self) -> Snapshot:
        """Start over with empty tables. Older files stay where they are."""
        base = self.current()
        return self.publish(base, {name: [] for name in self.schemas}, {k: 1 for k in base.next_key})


def version_of(folder: str) -> int:
    """The version of the load that wrote a folder."""
    return int(folder.split("/load=v", 1)[1].split("_", 1)[0])


def _version(path: Column) -> Column:
    return F.regexp_extract(path, "/load=v([0-9]+)_", 1).cast("int")


def constraint_rules(columns: list[str], table: str) -> dict[str, Column]:
    """Constraint name to the condition of a row that breaks it."""
    rules = {f"{c} is not null": F.col(c).isNull() for c in NOT_NULL[table] if c in columns}
    return rules | {name: ~F.expr(rule) for name, rule in CHECKS[table].items()}


def constraint_counts(df: DataFrame, table: str) -> DataFrame:
    """One row per constraint of the table: how many rows break it, in one pass."""
    rules = constraint_rules(df.columns, table)
    counted = df.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("constraint_name"), F.col(f"`{name}`").alias("violations"))
        for name in rules
    ])))


def checked_counts(
    df: DataFrame, table: str, measures: dict[str, Column], rows: Column | None = None
) -> dict[str, Any]:
    """Measures of a batch, and its constraints, in one pass; raises if any is broken.

    ``rows`` limits the constraints to the rows that will be stored.
    """
    rules = constraint_rules(df.columns, table)
    counted = df.agg(
        *[c.alias(name) for name, c in measures.items()],
        *[
            F.count_if(broken if rows is None else broken & rows).alias(name)
            for name, broken in rules.items()
        ],
    ).first().asDict()
    broken = {name: counted.pop(name) for name in rules}
    if any(broken.values()):
        found = ", ".join(f"{name} ({n})" for name, n in broken.items() if n)
        raise ConstraintError(f"{table}: {found}")
    return counted
