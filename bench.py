"""Time the headline queries and print one JSON line.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
Each query runs once to warm up, then BENCH_RUNS times (default 3) into the noop
sink; the median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quillwork.session import local_session  # noqa: E402
from quillwork.workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "gather_short_texts", "split_counts", "sample_by_split", "balanced_prompt_draw", "templates_join",
    "downloaded_triples", "generation_inputs", "select_for_rewriting", "topic_label", "language_score",
    "batch_generate", "pollution_repair", "versions_union", "cosine_scores", "score_summary", "preference_pairs",
    "nearest_centre", "prompt_clusters", "chat_format", "message_stack", "dpo_examples", "evaluate_similarity",
    "evaluate_answers", "score_job", "rewrite_job", "row_ids", "run_positions", "sft_examples", "gathered_pairs",
]


def run(spark, name: str, sf_dir: str) -> float:
    begin = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, 8)
    times = {}
    for name in HEADLINE:
        run(spark, name, sf_dir)
        times[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "runs": runs,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
