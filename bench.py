"""Time the headline queries and print one JSON line.

Every query runs once to warm up on the smallest tables and once for the record. ``compile``
is the part of its time that goes before the first row: compiling the dictionary and
planning. ``rules_x_rows_per_second`` leaves that part out.
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from query_suite import QUERIES  # noqa: E402
from query_suite.jobs import PART_RULES  # noqa: E402
from query_suite.matching import CONTAINS, FULL  # noqa: E402
from query_suite.words import PHRASES  # noqa: E402

HEADLINE = [
    "latest_per_key_text_date",
    "match_full",
    "match_contains",
    "match_generated_keys",
    "match_many_rules",
    "fts_phrase",
    "fts_near",
    "fts_passages",
    "action_resolve",
    "label_table",
    "label_unmapped",
    "label_folder",
]
#: Rules of a query and the table they are matched to.
RATED = {
    "match_full": (FULL, "part"),
    "match_contains": (CONTAINS, "part"),
    "fts_phrase": (PHRASES, "documents"),
    "label_table": (PART_RULES, "lineitem"),
}


def run(spark, name, sf):
    """Seconds until the query is compiled, and until its rows are made."""
    start = time.time()
    result = QUERIES[name](spark, sf)
    compiled = time.time() - start
    result.write.format("noop").mode("overwrite").save()
    return compiled, time.time() - start


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rulemark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    small = os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001")
    for name in HEADLINE:
        run(spark, name, small if os.path.isdir(small) else sf)
    times = {name: run(spark, name, sf) for name in HEADLINE}
    rates = {}
    for name, (rules, source) in RATED.items():
        rows = spark.read.parquet(os.path.join(sf, f"{source}.parquet")).count()
        rates[name] = round(len(rules) * rows / (times[name][1] - times[name][0]))
    record = {
        "metric": "total_query_time",
        "value": round(sum(t for _, t in times.values()), 3),
        "unit": "sec",
        "queries": {name: round(t, 3) for name, (_, t) in times.items()},
        "compile": {name: round(c, 3) for name, (c, _) in times.items()},
        "rules_x_rows_per_second": rates,
        "sf": os.path.basename(sf.rstrip("/")),
    }
    print(json.dumps(record))
    spark.stop()


if __name__ == "__main__":
    main()
