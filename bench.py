"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS choose data and cores; BENCH_QUERIES a comma-separated subset.
Each query runs once to warm up and then BENCH_RUNS times; the fastest run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "value_counts", "distinct_counts", "frequent_values", "numeric_stats", "text_longest", "mixed_type_counts",
    "date_range_text", "profile_table", "minmax_scale", "sem_regex", "sem_color", "sem_list", "sem_city_person",
    "sem_cascade", "sem_report", "mine_keywords", "word_ngrams", "jaccard_pairs", "cosine_pairs", "name_clusters",
    "minhash_signatures", "frequent_itemsets", "precision_recall",
)


def main() -> None:
    from colsight.plans.staging import release
    from colsight.session import local_session
    from suite import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("OFF")
    seconds: dict[str, float] = {}
    for name in names:
        best = None
        for i in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            release()
            if i:
                best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
