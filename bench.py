"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Per query: one warm-up, then the median of $BENCH_RUNS (3) runs into the noop sink. Stream
queries are one run each, reading what is there until the end.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from newsloom.plans.catalog import all_queries  # noqa: E402
from newsloom.session import build_session  # noqa: E402

BATCH = (
    "clean_articles",
    "sentiment_score",
    "tfidf_terms",
    "page_text",
    "monthly_sentiment_distribution",
    "location_sentiment_heatmap",
    "search_all_keywords",
    "low_content_quality",
    "top_title_words",
    "word_sentiment_by_date",
    "section_month_sentiment",
    "location_sentiment_words",
    "time_period_matrix",
    "same_place_same_day",
    "article_profile",
    "related_title_words",
)
STREAM = ("stream_keyword_count", "stream_sentiment_windows")
TRAINING = ("train_naive_bayes",)


def timed(query, spark, sf_dir):
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "newsloom-bench", f"local[{cpus}]", cpus, spark__ui__enabled="false", spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    seconds = {}
    for name in BATCH:
        timed(registered[name], spark, sf_dir)
        seconds[name] = statistics.median(timed(registered[name], spark, sf_dir) for _ in range(runs))
    for name in STREAM + TRAINING:
        seconds[name] = timed(registered[name], spark, sf_dir)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in seconds.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
