"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.queries import REGISTRY  # noqa: E402
from millrace.session import build_session  # noqa: E402

HEADLINE = (
    "value_counts_event_type missing_stats_orders ranges_lineitem iqr_outliers_events conform_report_customer "
    "canonical_columns normalise_cells cast_record redact_ssn nine_digits ledger_parse composite_join "
    "safe_merge_report fk_catalog fk_by_position word_pattern_candidates snapshot_diff_customer "
    "composite_key_report nested_region_json duplicate_documents order_totals count_over_group latest_per_key "
    "previous_row numbered_keys batch_ids top_orders upsert_orders update_orders validate_rejects widen_lengths "
    "align_schema_report stage_bulk upsert_person merge_phone nightly_sync bucket_rows json_value json_query "
    "json_exists json_table_lines json_mergepatch json_edit json_enrich_orders purchase_order_documents "
    "search_lines grep_context extract_between split_blocks markdown_toc extract_links html_to_markdown "
    "human_bytes date_arithmetic hash_text url_slug loan_schedule csv_read_good union_csv_dir gen_phone "
    "throttle_events ttl_lookup debounce_events change_feed sweep_stream"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "1"))

    def once(name: str) -> float:
        began = time.perf_counter()
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    once("value_counts_event_type")  # start the JVM's machinery before timing
    timings = {}
    for name in names:
        once(name)  # warm-up
        timings[name] = round(sorted(once(name) for _ in range(runs))[runs // 2], 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
