"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "document_findings", "restricted_sources", "full_redaction", "sanitized_receipts", "merged_advisories", "all_mods",
    "document_terms", "observe_github_pr", "observe_transcript", "verified_github", "replay_dedup", "duplicate_marks",
    "ttl_dedup", "gated_page_items", "run_caps", "page_token_chain", "trace_audit", "ledger_chain", "latest_states",
    "span_matches", "document_metrics", "cursor_verdicts",
]


def main() -> None:
    from sievelight.plans import registry
    from sievelight.session import local_session

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    table = registry.queries()
    # One small job first, so that starting the engine is not charged to the first query.
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.time()
        table[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": sf.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
