"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the number of local cores. Stage tables the
queries share (cleaned catalog, features, published catalog) are timed where they are built.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vitrine.session import local_session  # noqa: E402
from vitrine.sources.listings import listings  # noqa: E402
from vitrine.stages import release_stages  # noqa: E402
from vitrine.suite import data, registry  # noqa: E402

HEADLINE = [
    "parse_price", "normalize_storefront_bulk", "extract_page_observations", "validate_catalog", "dedup_first", "clean_strict",
    "features_ops", "generate_rules", "zscore", "top_products", "search_products", "shop_ranking_composite_score", "catalog_stats_category",
    "cluster_summary", "price_boxes", "anomaly_table", "competitor_context", "merge_enrichment", "stream_append", "optimal_f1_threshold",
    "roc_auc", "stratified_split", "isolation_forest", "pca_projection", "dbscan", "elbow_radius",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    budget = float(os.environ.get("BENCH_BUDGET_SEC", "900"))
    spark = local_session(cpus, "vitrine-bench")
    listings(spark, sf_dir).limit(1).collect()  # start the JVM's workers outside the clock
    times: dict[str, float] = {}
    begin = time.perf_counter()

    def clock(name: str, action) -> None:
        start = time.perf_counter()
        action()
        times[name] = round(time.perf_counter() - start, 3)

    clock("clean_standard", lambda: data.silver(spark, sf_dir))
    clock("features_max", lambda: data.features(spark, sf_dir))
    clock("publish_catalog", lambda: data.published(spark, sf_dir))
    skipped = []
    for name in HEADLINE:
        if time.perf_counter() - begin > budget:
            skipped.append(name)
            continue
        clock(name, lambda n=name: run(registry.QUERIES[n](spark, sf_dir)))
    release_stages(spark)
    spark.stop()
    line = {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1]}
    if skipped:
        line["skipped"] = skipped
    print(json.dumps(line))


if __name__ == "__main__":
    main()
