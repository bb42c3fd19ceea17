"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores.  Each query is run
to the end without collecting its rows.
"""

from __future__ import annotations

import json
import os
import time

from logweir import build_session
from logweir.catalog import QUERIES

HEADLINE = (
    "a4_freshness b1_preset_window c3_contains c4_not_contains c14_ips_filter c15_cidr e1_page e3_drift e5_top_k e6_topn "
    "f1_group_exact f5_breakdowns f6_residuals f7_bounded_sample f8_policy_traffic f9_top_sources f12_top_threats f16_policy_line "
    "f21_time_buckets f22_incident_stats h3_linkage_fallback h5_alert_logs h6_endpoint_vulns h7_user_endpoints h8_indicator_sweep "
    "h9_lateral i1_percentile j1_risk j2_endpoint_anomaly k1_timeline k2_root_cause l1_mask_table l4_scrub_text l11_unmask "
    "l12_redact l14_leak_check m1_stream_counts "
    "e3_snapshot_page l1_mask_values m1_rollup m2_late_rows n13_incident_summary n14_investigate n16_investigate_deep"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The first query pays for starting the engine; it is run once beforehand.
    QUERIES["f9_top_sources"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        started = time.monotonic()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - started, 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
