"""Times the headline queries on one machine and prints one JSON line.

Reads ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[BENCH_CPUS]``. Each query writes all its
rows to the no-op sink once, after one warm-up query. Times include planning and the tables that a query
writes in between.
"""

from __future__ import annotations

import json
import os
import sys
import time

import pyspark

from quarrysql import registry
from quarrysql.session import local_session

# The whole jobs, the corpus operators that shuffle or parse most, and every query pattern.
CORPUS = [
    "a01_read_jsonl", "a03_merge_sources", "a04_cap_source", "a11_assistant_sql", "a16_extract_statements",
    "a24_rebuild_text", "a25_encode_fixed", "a26_mysql_to_postgres", "a29_statement_gate", "a34_dedup_first",
    "a35_anti_existing", "a36_dedup_greedy", "a39_rebalance", "a41_shuffle", "a42_train_val_split", "a45_complexity7",
    "a47_sql_features", "a49_type_distribution", "a53_feature_rates", "a56_overlap", "a59_row_checks",
    "a65_keyword_coverage", "a68_leaderboard", "a71_side_by_side", "a76_route_prompt", "a77_function_allowlist",
    "e1_curated_corpus", "e2_code_transcripts", "e2_merged_corpus",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session("quarrysql-bench", cores=cores, shuffle=int(cores))
    spark.sparkContext.setLogLevel("ERROR")
    available = registry.queries()
    names = sys.argv[1:] or CORPUS + [n for n in available if n.startswith("b")]

    def run(name: str) -> float:
        start = time.perf_counter()
        available[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("b22_aggregates")
    seconds = {name: round(run(name), 3) for name in names}
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    report = {
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("sf", 1)[-1],
        "cores": cores,
        "spark": pyspark.__version__,
        "python": sys.version.split()[0],
    }
    if "e1_curated_corpus" in seconds:
        report["curation_rows_per_sec"] = round(orders / seconds["e1_curated_corpus"])
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
