"""Times the headline queries and prints one line of JSON.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the
local cores. Each query is run whole into Spark's noop sink, so nothing is
pruned away and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from folia.plans.queries import QUERIES  # noqa: E402
from folia.session import build_session  # noqa: E402

HEADLINE = [
    "catalog_listing",
    "catalog_entry",
    "catalog_as_json",
    "order_documents",
    "order_documents_in_parts",
    "customer_documents",
    "order_links",
    "order_part_types",
    "order_all_regions",
    "order_visit_documents",
    "customer_histories",
    "customer_history_sample",
    "sanitized_orders",
    "change_outcomes",
    "changed_books",
    "changed_inventory",
    "single_modes",
    "tied_modes",
    "exact_medians",
    "filled_quantities",
    "describe_price",
    "narrowed_quantiles",
    "null_counts",
    "length_outliers",
    "price_density",
    "binned_discounts",
    "hash_split_orders",
    "string_indexes",
    "assembled_features",
    "model_scores",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.log.level": "ERROR",
        },
    )
    # Starts executors and loads classes, so the first query is not charged for them.
    spark.read.parquet(f"{sf_dir}/region.parquet").groupBy("r_name").count().collect()
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
