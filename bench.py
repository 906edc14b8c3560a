"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores. Every query runs to the
end over its whole tables; results go to Spark's noop sink.
"""

import json
import os
import time

from starmill.registry import QUERIES
from starmill.session import local_session

# The star load comes first: the analytics read the warehouse it leaves.
HEADLINE = [
    "lod_12", "lod_10", "lod_12_facts", "qlt_9",
    "src_1", "src_3", "src_11",
    "cln_3", "cln_6", "cln_7", "cln_15",
    "val_9", "qlt_8",
    "dup_1", "dup_2", "dup_4", "dup_6", "dup_7",
    "qlt_1", "qlt_5", "qlt_6",
    "dim_4", "dim_6", "dim_8",
    "lod_6", "lod_7", "lod_8",
    "jon_1", "agg_1", "agg_2", "agg_3", "agg_4", "agg_5", "agg_6", "agg_7_median",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in HEADLINE:
        begun = time.monotonic()
        QUERIES[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - begun, 3)
    print(json.dumps({
        "metric": "headline queries, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
