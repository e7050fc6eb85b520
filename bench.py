"""Time the headline queries.

``BENCH_SF_DIR`` is the data (default sf0.1), ``BENCH_CPUS`` the number of local threads,
``BENCH_QUERIES`` an optional comma-separated choice. Each query runs once to warm up and
once for the clock, every column written to a sink that discards it. One JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from canvass.catalog import QUERIES  # noqa: E402
from canvass.session import local_session  # noqa: E402

HEADLINE = """
final_status_per_unit latest_visit latest_visit_only attempt_number reopen_after_close
partial_history repeated_history status_categories
blacklist keyed_override id_correction status_correction day_filter coalesce_fill
comment_rules discrepancy_review garbage_text garbage_lines label_dictionary
duration_flags numeric_outliers lineitem_outliers question_outlier_summary nsnr_flags nsnr_summary
missing_flags skip_flags findings_long identity_duplicates document_duplicates
utm_project geofence distance_summary
audit_verdicts alert_table cases_table appointments_overdue case_refresh
block_scorecard block_progress agent_consolidated agent_productivity agent_report
daily_progress_wide intervention_by_agent contingency distinct_null_aware
wide_to_long across_columns json_flatten survey_audit
""".split()


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else [n for n in HEADLINE if n in QUERIES]
    spark = local_session(cpus)
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = round(run(spark, name, sf_dir), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
