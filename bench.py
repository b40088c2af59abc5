"""Time the headline queries: one warm-up, then the median of three runs into the noop sink.

Prints one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from starsift import queries  # noqa: E402

HEADLINE = [
    "preprocessed", "preprocessed_documents", "product_summary", "monthly_sentiment", "aspect_summary",
    "complaint_summary", "complaint_taxonomy", "complaint_matrix", "aspect_keyword_sentiment", "kpis",
    "basic_text_features", "readability", "tfidf_keywords", "rake_phrases", "suspicious_reviews",
    "summary_sentences", "brand_pairs", "semantic_search", "threshold_curve", "corr_matrix", "near_neighbours",
    "entity_columns", "topic_keywords", "conversation_points",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry = queries.load()
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    times = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            registry[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:] or taken), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
