"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

The native input tables (statements, reports, histories) are derived from the given tables and written
once before the clock starts. Every query runs three times, results go to the no-op sink, and the best
run counts: the first one pays for class loading and code generation of a fresh JVM. First runs, medians and the spread
between the slowest and the best run, as a share of the best, are printed beside it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerloom.registry.queries import REGISTRY  # noqa: E402
from ledgerloom.registry.views import write_views  # noqa: E402
from ledgerloom.session import build_session, scratch_path  # noqa: E402

HEADLINE = [
    "recon_period_measures", "recon_bank_summary", "escrow_summary", "store_subtotals", "instalment_plain", "instalment_sheets",
    "instalment_cards", "ffill_keys", "trust_matrix", "margin_pivot_events", "receipt_long", "tie_out_billing", "fee_ratio",
    "net_card_revenue", "payment_report", "running_total_events", "running_balance", "journal_long", "journal_pivot", "ledger_check",
    "orders_journal", "safe_cast_num", "silver_pass", "null_ratio", "dup_keys", "upsert_tuple", "upsert_columnwise", "parquet_partitions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "8"), "16g")
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    started = time.perf_counter()
    write_views(spark, sf_dir, scratch_path(spark, "native"))
    prepared = round(time.perf_counter() - started, 3)
    took: dict[str, float] = {}
    cold: dict[str, float] = {}
    median: dict[str, float] = {}
    spread: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(3):
            started = time.perf_counter()
            REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        took[name] = round(min(runs), 3)
        cold[name] = round(runs[0], 3)
        median[name] = round(statistics.median(runs), 3)
        spread[name] = round(max(runs) / min(runs) - 1, 2)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took,
        "prepare_sec": prepared, "median": median, "median_total": round(sum(median.values()), 3), "cold": cold, "spread": spread,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
