"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskframe.session import local_session  # noqa: E402
from riskframe.workload import load_all  # noqa: E402

HEADLINE = (
    "sca16_parse_clock",
    "prj12_presence_flags",
    "win1_exact_dedupe",
    "win2_feature_dedupe",
    "e1_severity_by_daypart",
    "agg3_duplicate_report",
    "agg4_rollup",
    "agg9_null_report",
    "agg10_summary",
    "agg11_profile",
    "agg14_freq_many",
    "bin1_quantile_cut",
    "bin3_optimal_bin",
    "iv1_woe_table",
    "iv1_quantile_iv",
    "smp1_exact_split",
    "glm1_fit_logit",
    "glm3_score",
    "vif1_collinearity",
    "tree1_fit_chaid",
    "evl1_ks",
    "evl2_auc",
    "cut4_youden",
    "evl6_compare",
    "jn1_new_rows",
    "str1_stream_increment",
    "mon2_monitor",
    "e2_crash_study",
)


def run(query, spark, sf_dir) -> float:
    started = time.perf_counter()
    query.run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "riskframe-bench")
    registry = load_all()
    # One unmeasured query brings up the JVM, the catalogue and code generation.
    run(registry["agg19_rate"], spark, sf_dir)
    seconds = {name: round(run(registry[name], spark, sf_dir), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
