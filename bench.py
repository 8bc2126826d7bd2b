"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from restock.queries import CATALOGUE  # noqa: E402
from restock.session import local_session  # noqa: E402

WARM_UP = "/root/testdata/sf0.001"
HEADLINE = [
    "kpi_star_join",
    "pivot_tags",
    "kpi_wide",
    "affected_docs",
    "store_c_anti",
    "doc_header",
    "gs_doc_qty",
    "doc_qty_json",
    "gs_region_skc",
    "sales_rollups_long",
    "stock_metrics",
    "stock_metrics_json",
    "running_moves",
    "stock_before_after_json",
    "net_stock_after",
    "priority_scores",
    "fill_rate",
    "doc_enrich",
    "doc_detail",
    "dedupe_orders",
    "publish_incremental",
    "sync_batches",
    "cdc_apply",
    "cdc_stream",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    for name in ("kpi_wide", "stock_metrics_json", "cdc_apply"):  # start-up, on the smallest data there is
        CATALOGUE[name](spark, WARM_UP if os.path.isdir(WARM_UP) else folder).write.format("noop").mode("overwrite").save()
    only = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in only:
        start = time.perf_counter()
        CATALOGUE[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, total seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
