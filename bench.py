"""Times the library's headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line. Making the tables that a
build publishes (counted pairs, partners, closure, postings) is timed first, as `publish`, and counts in the total; queries that
read them are timed against them."""

import json
import os
import time

from pyspark.sql import SparkSession

from evidra.plans import catalogue

HEADLINE = ["pair_counters_vh", "pair_counters_hh", "top_partners", "source_precedence", "first_of_group", "annotation_codes", "ancestor_closure", "nearest_family",
    "interval_best_match", "asof_release", "two_hop", "virus_drilldown", "family_rollup", "publication_backs", "audit_report", "near_names", "text_search", "text_clean", "under_term", "title_search"]


def main() -> None:
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalogue.QUERIES["graph_summary"](spark, d).collect()
    start = time.perf_counter()
    catalogue.publish(spark, d)
    took = {"publish": round(time.perf_counter() - start, 3)}
    for name in HEADLINE:
        start = time.perf_counter()
        catalogue.QUERIES[name](spark, d).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(d)}))
    spark.stop()


if __name__ == "__main__":
    main()
