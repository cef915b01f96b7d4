"""Time the headline queries on one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (every row is
computed, nothing is collected to the driver).  One untimed warm-up run of
the first query on the smallest tables comes first.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.plans import catalog  # noqa: E402
from quarry.session import get_spark  # noqa: E402

HEADLINE = [
    "describe_lineitem",
    "describe_by_returnflag",
    "crosstab_flag_status",
    "corr_matrix_lineitem",
    "histogram_extendedprice",
    "bayesian_average_events",
    "chunk_mean_events",
    "gram_lineitem_folds",
    "classification_report_lineitem",
    "roc_curve_lineitem",
    "auroc_lineitem",
    "diff_daily_total",
    "sliding_sequences_daily",
    "kfold_orders",
    "sample_balanced_documents",
    "tfidf_test_documents",
    "vocabulary_documents",
    "char_ngrams_by_language",
    "classify_language_top3",
    "unigram_perplexity_documents",
    "text_multinomial_nb_report",
    "oof_report_orders",
    "glm_profile_confint_orders",
    "attention_pool_embeddings",
    "shapiro_francia_events",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or [n for n in HEADLINE if n in catalog.REGISTRY]
    spark = get_spark(f"local[{cpus}]", max(8, 2 * cpus), app="quarry-bench")
    # JVM / codegen warm-up on the smallest tables, reported but not counted:
    # otherwise about 20 s of start-up cost lands on whichever query runs first
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    t0 = time.perf_counter()
    if os.path.isdir(warm_dir):
        catalog.REGISTRY[names[0]].run(spark, warm_dir).write.format("noop").mode("overwrite").save()
    warmup = round(time.perf_counter() - t0, 3)
    times: dict[str, float] = {}
    for name in names:
        q = catalog.REGISTRY[name]
        t0 = time.perf_counter()
        q.run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "warmup_sec": warmup}))
    spark.stop()


if __name__ == "__main__":
    main()
