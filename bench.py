"""Time every registered query and print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local cores. Names given as
arguments limit the run to those queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quern.plans.catalog import QUERIES  # noqa: E402
from quern.session import local_session  # noqa: E402

HEADLINE = [
    "first_occurrence", "token_budget", "pack_sequences", "epoch_plan", "resume_offsets",
    "random_split", "byte_tokenize", "score_histogram", "spec_counts", "split_impact",
    "udf_registry", "hamming_nn_join", "cosine_nn_join", "fts_search", "vector_search",
    "hybrid_search", "attribution", "detection_metrics", "pr_curve", "episode_window_join",
    "action_pad_mask", "take_by_position", "append_refresh_cycle",
]


def seconds(spark, build, sf_dir: str) -> float:
    start = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or [n for n in HEADLINE if n in QUERIES]
    if names == ["all"]:
        names = list(QUERIES)
    spark = local_session(cpus, shuffle_partitions=int(cpus))
    # One untimed query starts the JVM's code paths and the Python workers.
    seconds(spark, QUERIES["byte_tokenize"], sf_dir)
    times = {}
    for name in names:
        times[name] = round(seconds(spark, QUERIES[name], sf_dir), 3)
        print(f"{name:32s} {times[name]:8.2f}s", file=sys.stderr, flush=True)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
