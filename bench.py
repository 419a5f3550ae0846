"""Time the headline queries: one warm-up, then the median of three runs, to a noop sink."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from motorpool.dictionaries import STARTER_BRANDS, alias_table  # noqa: E402
from motorpool.operators.upsert import upsert  # noqa: E402
from motorpool.operators.vehicles import fleet_cells, vehicle_dim  # noqa: E402
from motorpool.plans.job import run  # noqa: E402
from motorpool.plans.registry import QUERIES  # noqa: E402
from motorpool.plans.scenario import scenario, stored_raw, write_inputs  # noqa: E402
from motorpool.operators.normalize import normalize  # noqa: E402
from motorpool.schemas import DIM_ATTRIBUTES  # noqa: E402
from motorpool.session import build_session, scratch_path, settle  # noqa: E402

HEADLINE = (
    "numeric_coercion", "brand_prefix_match", "brand_prefix_join", "valid_brands_by_period", "normalize_rows",
    "vehicle_dim_all", "fleet_fact_cells", "surrogate_keys", "file_order_ordinal", "rollup_to_state",
    "fleet_star_join", "fleet_by_brand_model", "dq_raw", "dq_norm", "change_log", "text_normalize", "catalogue_rows",
)
REPEATS = 3


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    action()
    seconds = []
    for _ in range(REPEATS):
        started = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - started)
    return round(statistics.median(seconds), 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "motorpool-bench",
        master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    stored_raw(spark, sf_dir)
    published = scenario(spark, sf_dir).publication
    seconds = {name: timed(lambda n=name: noop(QUERIES[n](spark, sf_dir))) for name in HEADLINE}

    norm = settle(normalize(stored_raw(spark, sf_dir), STARTER_BRANDS, alias_table(spark)), "norm")
    stored_dim = settle(vehicle_dim(norm.where("report_period < 202601")), "dim")
    incoming = settle(vehicle_dim(norm.where("report_period = 202601")), "incoming")
    seconds["dim_upsert"] = timed(lambda: noop(upsert(stored_dim, incoming, ["hash_veiculo"], DIM_ATTRIBUTES)))
    seconds["fleet_fact_stored_norm"] = timed(lambda: noop(fleet_cells(norm)))

    def swap() -> None:
        published.publish()
        published.rollback()

    seconds["publish_and_roll_back"] = timed(swap)

    root = scratch_path(spark, "bench")
    period = write_inputs(stored_raw(spark, sf_dir), f"{root}/input")[-1]
    seconds["phase_job_one_period"] = timed(
        lambda: run(spark, root, f"{root}/input", period=period, multi_file=True, prefix="bench_", brands=STARTER_BRANDS)
    )
    total = round(sum(seconds.values()), 4)
    name = os.path.basename(sf_dir).removeprefix("sf")
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": float(name),
        "conf": {"cpus": int(cpus), "driver_memory": "12g", "shuffle_partitions": int(cpus), "repeats": REPEATS},
    }))


if __name__ == "__main__":
    main()
