"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list to override the headline set).
Each query is executed in full into Spark's ``noop`` sink (no collect).
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "degree_distribution", "power_law_gamma", "components", "articulation_points", "shortest_paths",
    "word_count", "build_vocab", "select_features", "bernoulli_nb", "gaussian_nb",
    "most_similar", "mean_vector", "kernel_regress", "ridge_closed_form",
    "canonical_plays", "user_totals", "top_x_per_user", "overlap_at_x", "als_overlap",
    "candidate_bids", "rank_bids_greedy", "sentiment_windows", "polarity_counts",
    "modularity", "attribute_affinity", "gaussian_nb_dense", "rank_bids_balance", "trade_loops",
    "components_part_supplier", "shortest_paths_part_supplier", "closeness_landmarks", "articulation_cyclic",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from lodestar.plans import registry
    from lodestar.session import checkpoint_dir, get_spark
    registry.load_all()
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else [n for n in HEADLINE if n in registry.QUERIES]
    spark = get_spark(f"local[{cpus}]", "lodestar-bench", shuffle_partitions=int(cpus) * 2,
                      conf={"spark.driver.memory": "16g"})
    checkpoint_dir(spark)
    # untimed warm-up: JVM class loading and the first parquet footer read
    # belong to session start, not to the first query
    spark.read.parquet(f"{sf_dir}/region.parquet").count()
    times = {}
    for n in names:
        t0 = time.time()
        try:
            registry.QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[n] = round(time.time() - t0, 3)
            print(f"{n}: {times[n]}s", file=sys.stderr, flush=True)
        except Exception as e:  # keep the line valid; report the failure
            times[n] = None
            print(f"{n} failed: {e}", file=sys.stderr)
    total = round(sum(v for v in times.values() if v is not None), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
