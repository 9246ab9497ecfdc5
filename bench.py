"""Times the headline queries: one warm-up run, then one measured run each.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores, BENCH_QUERIES an
optional comma-separated choice.
"""
from __future__ import annotations

import json
import os
import sys
import time

from lociframe.session import session

HEADLINE = (
    "region_enrichment", "region_enrichment_details", "interval_merge", "binned_coverage", "methylation_summary", "select_hits_topk", "score_candidates",
    "condition_matrices", "term_enrichment", "pathway_counts", "merge_annotations", "family_summary", "event_summary", "expression_summary",
    "synteny_heatmap", "assembly_stats", "introns",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = session("bench", f"local[{cores}]", **{
        "spark.sql.shuffle.partitions": str(max(int(cores), 8)), "spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    from lociframe.plans import QUERIES

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(run(name), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
