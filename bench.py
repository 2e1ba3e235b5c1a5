"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8).
``python bench.py name ...`` times other registered queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from comarca.plans.catalog import QUERIES
from comarca.session import local_session

HEADLINE = [
    "stage_population", "stage_unemployment", "stage_contracts", "code_completion", "one_to_one_lookup",
    "fuzzy_match", "fuzzy_best", "yearly_rollup", "yearly_trend", "population_trends",
    "population_ranks_by_range", "rates_mart", "socioeconomic_mart", "incremental_upsert",
    "grid_data_start", "grid_to_tidy", "population_from_grid", "page_links", "html_table_rows",
    "lenient_numeric", "last_wins", "dq_suite", "group_completeness", "quality_summary",
    "dash_recent_top", "dash_kpis", "dash_top10", "stream_new_files",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus), memory="16g")
    names = sys.argv[1:] or HEADLINE
    QUERIES["yearly_trend"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm up
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
