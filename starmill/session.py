"""Sessions for local runs, and the settings the engine expects on a cluster."""

from pyspark.sql import SparkSession

# Settings that matter for plans; a cluster session should carry the same ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 << 20),
    # Recording a Python call site for every column expression slows wide tables down.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


PARTITIONS = "spark.sql.shuffle.partitions"
# Bytes of stored input for which a shuffle gets one more partition: some 200,000 lines of sales.
INPUT_A_PARTITION = 4 << 20


def spread(spark: SparkSession, size: int) -> None:
    """Shuffle in as many partitions as an input of ``size`` bytes asks for, never in fewer than are set.

    A sort or join then holds a bounded share of the input in each task, whatever
    its size; adaptive execution merges partitions that turn out small.
    """
    least = -(-size // INPUT_A_PARTITION)
    if int(spark.conf.get(PARTITIONS)) < least:
        spark.conf.set(PARTITIONS, str(least))


def local_session(cpus: str = "*", partitions: int = 8, **extra: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("starmill")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        # Reading a shuffle by mapper saves network, of which one machine has none.
        .config("spark.sql.adaptive.localShuffleReader.enabled", "false")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
