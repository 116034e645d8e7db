"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores.
"""

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from feedback_loom import build_session, catalog  # noqa: E402

HEADLINE = (
    "read_texts_csv", "score_texts", "negative_texts", "negative_shares", "induced_lexicon", "clean_tokens",
    "term_counts", "vocabulary_cap", "tfidf_weights", "single_cluster_error", "nearest_centroid",
    "cluster_error_sweep", "clustered_texts", "group_summary", "group_keywords", "batch_numbers",
    "joined_batch_texts", "write_back_items", "answer_status", "first_texts_per_group", "sampled_texts_per_group",
    "class_summary", "scored_by_function", "classified_by_function", "classified_by_cosine", "group_issues",
    "merged_groups", "typical_causes", "conclusion_text", "resumed_scores", "analyze_feedback",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="feedback_loom-bench-"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    catalog.class_counts(spark, folder).collect()  # start the JVM's workers
    times = {}
    for name in HEADLINE:
        start = time.time()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": folder.rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
