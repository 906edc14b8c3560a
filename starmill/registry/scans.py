"""Queries of the sources: the given tables written as files and read back."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions.samples import (
    COUNTRIES,
    CUSTOMER_NAMES,
    DAYS,
    DISCOUNTS,
    FIRST_DAY,
    PRODUCTS,
)
from starmill.operators.clean import drop_metadata, standardize_names
from starmill.registry.tables import MONEY, NAMES, padded_sql, table
from starmill.sources.csv import read_csv, read_csv_directory
from starmill.sources.extract import extract
from starmill.sources.generate import sample_sales
from starmill.sources.json import read_json
from starmill.sources.sql import list_tables, read_query, read_table
from starmill.workspace import materialize, scratch_path


def csv_of(df: DataFrame, path: str, rows_a_file: int = 0) -> str:
    """Write CSV files, of so many rows at most if that is given."""
    df.write.mode("append").option("maxRecordsPerFile", rows_a_file).csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return path


def json_of(spark: SparkSession, df: DataFrame, record: Column) -> str:
    path = scratch_path(spark, "json")
    df.select(F.to_json(record, {"ignoreNullFields": "false"})).write.text(path)
    return path


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lang = F.col("lang")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text",
        F.when(lang == "es", "N/A").when(lang == "de", "NULL").when(lang == "fr", "-")
        .otherwise(lang).alias("lang"),
    )
    rows = read_csv(spark, csv_of(docs, scratch_path(spark, "csv")))
    return rows.select("doc_id", "text", "lang", "_source_type")


CSV_SCAN = """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, text,
       CASE lang WHEN 'es' THEN NULL WHEN 'de' THEN NULL WHEN 'fr' THEN '-' ELSE lang END AS lang,
       'CSV' AS _source_type
FROM documents"""


SPLIT_ROWS = 1_000_000  # of a table whose files and tasks are small


def csv_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in files of 20,000 rows, each with a cell of two lines, read by tasks of 64 KB.

    Files and tasks of a large table are larger in one proportion, so that there are no more of them:
    the driver hears from every task.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat_ws("\n", "l_returnflag", "l_linestatus").alias("flags"), "l_returnflag"
    )
    path = scratch_path(spark, "csv")
    times = max(1, -(-lines.count() // SPLIT_ROWS))
    lines.write.option("maxRecordsPerFile", 20_000 * times).csv(path, header=True, escape='"')
    files = spark.read.text(path).inputFiles()
    limit = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(limit)
    spark.conf.set(limit, 65536 * times)
    try:
        rows = materialize(read_csv(spark, files), "split")
    finally:
        spark.conf.set(limit, before)
    return rows.select("l_orderkey", "l_linenumber", "flags", "l_returnflag")


CSV_SPLIT = """
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
       l_returnflag || chr(10) || l_linestatus AS flags, l_returnflag FROM lineitem"""


def csv_spec_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder as one source of a spec; its files have their columns in different orders."""
    folder = scratch_path(spark, "folder")
    parts = table(spark, sf_dir, "part")
    csv_of(parts.where("p_size <= 25").select("p_partkey", "p_brand"), folder)
    csv_of(parts.where("p_size > 25").select("p_brand", "p_partkey"), folder)
    rows = extract(spark, {"sources": [{"type": "CSV", "path": folder}]}).rows
    return rows.select("p_partkey", "p_brand", "_source_type")


CSV_SPEC_FOLDER = """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_brand, 'CSV' AS _source_type FROM part"""


def json_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose root is an array, of up to 500 customers each."""
    records = F.collect_list(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")))
    path = scratch_path(spark, "json")
    customers = table(spark, sf_dir, "customer").groupBy(F.floor(F.col("c_custkey") / 500)).agg(F.to_json(records).alias("value"))
    customers.select("value").repartition(8).write.option("maxRecordsPerFile", 1).text(path)
    files = [f for f in customers.sparkSession.read.text(path).inputFiles()]
    return read_json(spark, files).select("id", "name", "_source_type")


JSON_DOCUMENT = "SELECT c_custkey AS id, c_name AS name, 'JSON' AS _source_type FROM customer"


def csv_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "folder")
    csv_of(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), folder)
    csv_of(table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("c_name")), folder)
    rows = read_csv_directory(spark, folder)
    return rows.select("c_custkey", "c_name", "c_mktsegment", "s_suppkey", "_source_type")


CSV_DIRECTORY = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment,
       CAST(NULL AS VARCHAR) AS s_suppkey, 'CSV' AS _source_type FROM customer
UNION ALL
SELECT NULL, s_name, NULL, CAST(s_suppkey AS VARCHAR), 'CSV' FROM supplier"""


def json_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line is an array of two records."""
    def record(field: str, value: str) -> Column:
        return F.struct(
            F.col("c_custkey").alias("id"), F.lit(field).alias("field"), F.col(value).alias("value")
        )

    pairs = F.array(record("name", "c_name"), record("segment", "c_mktsegment"))
    path = json_of(spark, table(spark, sf_dir, "customer"), pairs)
    return read_json(spark, path, lines=True).select("id", "field", "value", "_source_type")


JSON_ARRAYS = """
SELECT c_custkey AS id, 'name' AS field, c_name AS value, 'JSON' AS _source_type FROM customer
UNION ALL
SELECT c_custkey, 'segment', c_mktsegment, 'JSON' FROM customer"""


def json_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested objects, flattened to dotted names and then standard ones."""
    record = F.struct(
        F.col("p_partkey").alias("id"),
        F.struct(
            F.col("p_name").alias("Name"),
            F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")).alias("made"),
        ).alias("item"),
        F.col("p_type").alias("kind"),
    )
    path = json_of(spark, table(spark, sf_dir, "part"), record)
    return drop_metadata(standardize_names(read_json(spark, path, lines=True)))


JSON_NESTED = """
SELECT p_partkey AS id, p_type AS kind, p_name AS item_name, p_brand AS item_made_brand,
       CAST(p_size AS BIGINT) AS item_made_size
FROM part"""


def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per element of the array at a path, parent fields repeated."""
    offers = F.array(
        F.struct(F.lit("list").alias("tier"), F.col("p_retailprice").alias("price")),
        F.struct(F.lit("half").alias("tier"), (F.col("p_retailprice") / 2).alias("price")),
    )
    none = F.array().cast(offers_type := "array<struct<tier:string,price:double>>")
    record = F.struct(
        F.col("p_partkey").alias("part"),
        F.struct(F.col("p_brand").alias("brand")).alias("info"),
        F.when(F.col("p_size") > 25, none).otherwise(offers.cast(offers_type)).alias("offers"),
    )
    path = json_of(spark, table(spark, sf_dir, "part"), record)
    rows = read_json(
        spark, path, record_path="offers", meta=["part", ["info", "brand"], "absent"], lines=True
    )
    return drop_metadata(standardize_names(rows))


JSON_RECORDS = """
SELECT tier, price, p_partkey AS part, p_brand AS info_brand, CAST(NULL AS VARCHAR) AS absent
FROM part
CROSS JOIN LATERAL (SELECT 'list' AS tier, p_retailprice AS price
                    UNION ALL SELECT 'half', p_retailprice / 2)
WHERE p_size <= 25"""


def json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    buyers = json_of(spark, table(spark, sf_dir, "customer"), F.struct("c_custkey", "c_name"))
    sellers = json_of(spark, table(spark, sf_dir, "supplier"), F.struct("s_suppkey", "s_name"))
    return drop_metadata(read_json(spark, [buyers, sellers], lines=True))


JSON_FILES = """
SELECT c_custkey, c_name, CAST(NULL AS BIGINT) AS s_suppkey, CAST(NULL AS VARCHAR) AS s_name
FROM customer
UNION ALL SELECT NULL, NULL, s_suppkey, s_name FROM supplier"""


def views(spark: SparkSession, sf_dir: str) -> None:
    for name in NAMES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def sql_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir)
    rows = read_query(
        spark,
        "SELECT o_orderkey, o_orderstatus FROM orders "
        "WHERE o_totalprice >= :least AND o_orderpriority = :priority",
        {"least": 100000.0, "priority": "1-URGENT"},
    )
    return rows.drop("_ord", "_source_db")


SQL_QUERY = """
SELECT o_orderkey, o_orderstatus, 'SQL' AS _source_type FROM orders
WHERE o_totalprice >= 100000.0 AND o_orderpriority = '1-URGENT'"""


def sql_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir)
    return read_table(spark, "customer", "c_acctbal < 0").drop("_ord", "_source_db")


SQL_TABLE = "SELECT *, 'SQL' AS _source_type FROM customer WHERE c_acctbal < 0"


def sql_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listed tables with their row counts."""
    views(spark, sf_dir)
    counts = None
    for name in NAMES:
        one = spark.table(name).agg(F.count("*").alias("row_count"))
        one = one.select(F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return list_tables(spark).select("table_name").join(counts, "table_name")


SQL_TABLES = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in NAMES
)


def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    as_csv = read_csv(spark, csv_of(events, scratch_path(spark, "csv")))
    as_json = read_json(spark, json_of(spark, events, F.struct("*")), lines=True)
    both = as_csv.select("_source_type", "_source_file").unionByName(
        as_json.select("_source_type", "_source_file")
    )
    return both.groupBy("_source_type").agg(
        F.count("*").alias("row_count"), F.count_if(F.col("_source_file").like("part-%")).alias("named")
    )


LINEAGE = """
SELECT 'CSV' AS _source_type, count(*) AS row_count, count(*) AS named FROM events
UNION ALL SELECT 'JSON', count(*), count(*) FROM events"""


def many_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV, JSON and SQL united by name; a missing file is left out; text wins a type dispute."""
    views(spark, sf_dir)
    buyers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").cast(MONEY).alias("balance"),
    )
    parts = table(spark, sf_dir, "part")
    record = F.struct(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"))
    found = extract(spark, {"sources": [
        {"type": "CSV", "path": csv_of(buyers, scratch_path(spark, "csv"))},
        {"type": "CSV", "path": scratch_path(spark, "absent")},
        {"type": "XML", "path": "ignored"},
        {"type": "JSON", "path": json_of(spark, parts, record), "lines": True},
        {"type": "SQL", "query": "SELECT s_suppkey AS id, s_name AS name FROM supplier"},
    ]})
    return found.rows.select(
        "id", "name", "balance", "brand", "_source_type",
        F.lit(len(found.failed)).alias("failed_sources"),
    )


MANY_SOURCES = """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS balance, CAST(NULL AS VARCHAR) AS brand,
       'CSV' AS _source_type, 1 AS failed_sources FROM customer
UNION ALL SELECT CAST(p_partkey AS VARCHAR), NULL, NULL, p_brand, 'JSON', 1 FROM part
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL, NULL, 'SQL', 1 FROM supplier"""


def sampled_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One made-up sale per order of the table."""
    return sample_sales(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")))


def _draw(what: str, n: int) -> str:
    return f"(CAST('0x' || substr(md5(concat(o_orderkey, ':{what}')), 1, 8) AS BIGINT) % {n})"


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


def _shares(shares: dict) -> str:
    return _list([v for v, share in shares.items() for _ in range(share)])


def _cities() -> str:
    cases = " ".join(
        f"WHEN '{country}' THEN {_list(cities)}[{_draw('city', len(cities))} + 1]"
        for country, (_, cities) in COUNTRIES.items()
    )
    return f"CASE country {cases} END"


SAMPLED_SALES = f"""
WITH drawn AS (
  SELECT o_orderkey, {_draw('customer', 200)} AS customer, {_draw('product', 100)} AS product,
         {_shares({c: s for c, (s, _) in COUNTRIES.items()})}[{_draw('country', 100)} + 1] AS country,
         CAST({_draw('quantity', 5)} + 1 AS INTEGER) AS quantity,
         CAST(({_draw('price', 199001)} + 1000) * 0.01 AS DECIMAL(18,2)) AS unit_price,
         CAST({_shares(DISCOUNTS)}[{_draw('discount', 100)} + 1] AS INTEGER) AS discount
  FROM orders),
named AS (
  SELECT *, {_list(CUSTOMER_NAMES)}[customer % {len(CUSTOMER_NAMES)} + 1] AS customer_name,
         product % {len(PRODUCTS)} + 1 AS kind
  FROM drawn)
SELECT {padded_sql('o_orderkey + 1', 'ORD', 6)} AS order_id,
       CAST(CAST(DATE '{FIRST_DAY}' + CAST({_draw('day', DAYS)} AS INTEGER) AS DATE) AS VARCHAR)
         AS order_date,
       {padded_sql('customer + 1', 'C', 4)} AS customer_id, customer_name,
       concat(lower(replace(customer_name, ' ', '.')), '@email.com') AS email,
       country, {_cities()} AS city,
       {padded_sql('product + 1', 'P', 4)} AS product_id,
       {_list(p[0] for p in PRODUCTS)}[kind] AS product_name,
       {_list(p[1] for p in PRODUCTS)}[kind] AS category,
       {_list(p[2] for p in PRODUCTS)}[kind] AS subcategory,
       {_list(p[3] for p in PRODUCTS)}[kind] AS brand,
       quantity, unit_price, discount,
       CAST(unit_price * (quantity * (100 - discount)) * 0.01 AS DECIMAL(18,2)) AS total_amount
FROM named"""


QUERIES = {
    "src_1": (csv_scan, CSV_SCAN),
    "src_1_split": (csv_split, CSV_SPLIT),
    "src_2_spec": (csv_spec_folder, CSV_SPEC_FOLDER),
    "src_3_document": (json_document, JSON_DOCUMENT),
    "src_2": (csv_directory, CSV_DIRECTORY),
    "src_3": (json_arrays, JSON_ARRAYS),
    "src_4": (json_nested, JSON_NESTED),
    "src_5": (json_records, JSON_RECORDS),
    "src_6": (json_files, JSON_FILES),
    "src_7": (sql_query, SQL_QUERY),
    "src_8": (sql_table, SQL_TABLE),
    "src_9": (sql_tables, SQL_TABLES),
    "src_10": (lineage, LINEAGE),
    "src_11": (many_sources, MANY_SOURCES),
    "src_12": (sampled_sales, SAMPLED_SALES),
}
