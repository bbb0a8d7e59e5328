"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs to the end into a sink that drops the rows.  The Java machine is
warmed up on a smaller folder first; nothing of the measured folder is kept from it.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks.queries import QUERIES
from topicloom.session import build_session

HEADLINE = [
    "normalize",
    "garbage_reason_counts",
    "char_wb_ngrams",
    "unicode_noise",
    "lang_profile",
    "route_languages",
    "idf_corpus",
    "tfidf_weights",
    "feature_union",
    "overlap_mask",
    "route_official",
    "route_top_k",
    "daily_counts",
    "class_purity",
    "golden_set",
    "translate_terms",
    "rebuild_keywords_v2",
    "taxonomy_self_similarity",
]


def run(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=16)
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    if os.path.isdir(small) and small != folder.rstrip("/"):
        for name in names:
            run(spark, small, name)
    seconds = {name: run(spark, folder, name) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
