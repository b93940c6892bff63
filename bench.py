"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR picks the data folder, BENCH_CPUS the local cores, BENCH_QUERIES (optional,
comma separated) other queries. Each query is run whole and its full result is produced.
"""

from __future__ import annotations

import json
import os
import time

from millrace import catalog
from millrace.session import local_session, prepare

HEADLINE = [
    "order_features", "halfhour_counts", "bucketize_count", "latest_per_key", "running_sum", "join_left_composite", "describe",
    "tfidf", "chi2_rank", "kmeans", "knn", "naive_bayes", "dbscan", "pagerank", "resolve_redirects", "radius_join", "roc_curve",
    "cluster_scores", "stream_halfhour", "text_classify",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = prepare(local_session(cores, "millrace-bench"))
    spark.sparkContext.setLogLevel("ERROR")
    catalog.load_all()
    spark.read.parquet(os.path.join(folder, "orders.parquet")).groupBy("o_orderpriority").count().collect()  # start the engine
    times = {}
    for name in chosen:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
