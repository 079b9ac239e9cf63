"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from clausewise.plans.queries import QUERIES
from clausewise.session import local_session

HEADLINE = [
    "issue_dedupe_first", "issue_assign_id", "model_input_build", "category_dataset",
    "kg_points_from_graph", "join_equipment_contains", "token_sets", "text_similarity",
    "match_topk", "issue_enrich_kg", "decision_enrich", "revision_need", "standard_report",
    "clause_aggregate", "clause_rank", "review_summary", "review_queue", "feedback_retrain",
    "graph_node_table", "graph_edge_table", "split_stratified", "eval_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = local_session(cpus, app="clausewise-bench", memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
