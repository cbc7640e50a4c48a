"""Seconds per headline query: each result is computed in full and thrown away."""

from __future__ import annotations

import json
import os
import time

from gaugeworks.plans import load_all
from gaugeworks.session import build_session

HEADLINE = (
    "a13_merge_upsert", "a16_prune_stale", "b02_resolve_names", "c01_unwrap_envelope", "c12_composite_score", "c18_definition_rows",
    "c30_apply_templates", "c32_latest_metrics", "d08_explode_domains", "e02_union_keep_last", "e04_monthly_snapshot", "f08_match_titles",
    "f14_suggest_titles", "f17_row_history", "f18_adaptive_candidates", "f19_pattern_candidates", "f20_duplicate_candidates",
    "g03_route_units", "g05_plan_ticket_actions", "h06_persistence", "h11_invalidation_list", "h15_high_score_alerts",
    "i03_search_evidence", "i05_relevance", "i08_rank_evidence", "j07_render_messages", "k01_candidate_keys",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = os.environ.get("BENCH_ONLY", "")
    spark = build_session(
        "bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8,
        {
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g",
            # One machine and small files: smaller partitions keep every core busy.
            "spark.sql.files.maxPartitionBytes": "2m", "spark.sql.files.openCostInBytes": "64k",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load_all()
    queries["b02_resolve_names"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start-up is not measured
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        if only and not name.startswith(tuple(only.split(","))):
            continue
        started = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": float(sf)}))
    spark.stop()


if __name__ == "__main__":
    main()
