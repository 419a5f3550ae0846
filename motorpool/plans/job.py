"""The phase job: raw -> normalize -> core -> analytics for one report period.

Each phase reads the stored layer before it, so a run may start and stop at any phase and may be
repeated. `fleet_job.py` at the root of the repository is its command line.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorpool.dictionaries import alias_table
from motorpool.functions.numbers import check_period
from motorpool.operators.brands import load_dictionary
from motorpool.operators.normalize import normalize, stored_form
from motorpool.operators.upsert import change_payload, changes, upsert_with_ids
from motorpool.operators.vehicles import fleet_fact, vehicle_dim
from motorpool.schemas import AUDIT, DIM, DIM_ATTRIBUTES, FACT, NORM, RAW
from motorpool.session import build_session, scratch_scope, settle_counted
from motorpool.sources.delimited import Reading, load_period, resolve_period
from motorpool.sources.publish import Publication
from motorpool.sources.warehouse import Warehouse, now_literal

PHASES = ("raw", "normalize", "core", "analytics")
#: Seconds a load waits for its turn to merge and to publish.
WAIT = 3600.0
#: Stands for a dictionary that was not given.
NOT_GIVEN = object()


@dataclass
class Outcome:
    period: int
    counts: dict[str, int] = field(default_factory=dict)


def phase_range(start: str = "raw", stop: str = "analytics") -> tuple[str, ...]:
    for name in (start, stop):
        if name not in PHASES:
            raise ValueError(f"unknown phase {name!r}; one of {', '.join(PHASES)}")
    first, last = PHASES.index(start), PHASES.index(stop)
    if first > last:
        raise ValueError(f"phase {start} cannot come after {stop}")
    return PHASES[first : last + 1]


def load_raw(warehouse: Warehouse, records: DataFrame, total: int, period: int) -> int:
    """Replace the period in the raw layer; ids continue after the highest one, in file order."""
    # Numbers count as given out before they are stored: a failed write may leave a gap, never a repeat.
    base = warehouse.reserve_ids(RAW, "id_raw", total)
    rows = records.withColumns({
        "report_period": F.lit(period),
        "id_raw": F.col("record") + F.lit(base + 1),
        "load_timestamp": now_literal(),
    })
    stored = warehouse.replace_periods(rows, RAW, [period])
    # Only now are the norm rows stale; a failed write above leaves them as they were.
    warehouse.clear_periods([NORM], [period])
    return stored


def load_norm(
    warehouse: Warehouse, period: int, brands: Sequence[str] | DataFrame | None, aliases: DataFrame | None, **rules
) -> int:
    """Replace the period in the norm layer. A raw row gives at most one norm row, so it lends its id."""
    rows = stored_form(normalize(warehouse.raw_period(period), brands, aliases, **rules))
    stamped = rows.withColumns({"id_norm": F.col("id_raw"), "data_carga": now_literal()})
    return warehouse.replace_periods(stamped, NORM, [period])


def load_core(warehouse: Warehouse, period: int, touch_updated_at: bool = False) -> dict[str, int]:
    """Merge the period's vehicles into the dimension and replace its fact, both visible from one commit on.

    Everything is written beside what readers see: a failure before the commit leaves the old state, and the next
    load writes the same version and its change log again.
    """
    norm = warehouse.read(NORM, period)
    now = now_literal()
    before = warehouse.commit_record()
    dim = warehouse.read(DIM, record=before)
    version, inserted = before["dim"], 0
    # Settled once: the merge reads it twice, and the written ids must match what was merged.
    vehicles, incoming = settle_counted(vehicle_dim(norm), "vehicles")
    if incoming:
        merged, inserted = upsert_with_ids(
            dim, vehicles, "hash_veiculo", DIM_ATTRIBUTES, "id_veiculo", lambda n: warehouse.reserve_ids(DIM, "id_veiculo", n),
            touch={"updated_at": now} if touch_updated_at else None,
            on_insert={"created_at": now, "updated_at": now},
        )
        version += 1
        warehouse.write_dim(merged, version)
        # Compared with the incoming vehicles only: no other row of the dimension can have changed.
        log = change_payload(changes(dim, vehicles, "hash_veiculo", DIM_ATTRIBUTES))
        warehouse.replace_periods(
            log.withColumns({"changed_at": now, "report_period": F.lit(period), "dim_version": F.lit(version)}),
            AUDIT, [version],
        )
    # The highest id of a cell belongs to no other cell, so it serves as the fact's own key too.
    fact = fleet_fact(norm, warehouse.read(DIM, record={**before, "dim": version})).withColumns(
        {"id_fato": F.col("id_raw"), "created_at": now, "updated_at": now}
    )
    folder, facts = warehouse.write_fact(fact, period)
    kept = {p: f for p, f in before["fact"].items() if int(p) != period}
    warehouse.commit(before, version, kept | ({str(period): folder} if folder else {}))
    return {"vehicles_inserted": inserted, "vehicles_updated": incoming - inserted, "facts": facts}


def run(
    spark: SparkSession,
    root: str,
    input_base: str,
    *,
    start: str = "raw",
    stop: str = "analytics",
    period: int | str | None = None,
    brands: Sequence[str] | DataFrame | None | object = NOT_GIVEN,
    aliases: DataFrame | None = None,
    multi_file: bool = False,
    reading: Reading | None = None,
    prefix: str = "",
    wait: float = WAIT,
) -> Outcome:
    """Run the phases from `start` to `stop` for one period, the latest one if none is named.

    `brands` is the dictionary for imported vehicles: names, or a table with a column `brand`. Normalising
    without one would drop every imported vehicle, so it has to be given; None asks for just that. Other loads that
    merge or publish are waited for up to `wait` seconds each time.
    """
    phases = phase_range(start, stop)
    if "normalize" in phases and brands is NOT_GIVEN:
        raise ValueError("the normalize phase needs a brand dictionary: brands=..., or --brands FILE")
    wanted = None if period is None else check_period(str(period))
    report_period, folder = resolve_period(spark, input_base, wanted)
    warehouse = Warehouse(spark, root, prefix)
    warehouse.ensure()
    outcome = Outcome(report_period)
    # Periods load side by side. The dimension is merged by one load after the other, and so is the publication.
    with warehouse.loading(report_period), scratch_scope(spark):
        if "raw" in phases:
            records, total = load_period(spark, folder, multi_file=multi_file, reading=reading)
            outcome.counts["raw"] = load_raw(warehouse, records, total, report_period)
        if "normalize" in phases:
            names = alias_table(spark) if aliases is None else aliases
            outcome.counts["norm"] = load_norm(warehouse, report_period, brands, names)
        if "core" in phases:
            with warehouse.exclusive("_core", wait):
                outcome.counts.update(load_core(warehouse, report_period))
        if "analytics" in phases:
            outcome.counts["version"] = Publication(warehouse).publish(wait)
        warehouse.log_counts(report_period, {k: n for k, n in outcome.counts.items() if k != "version"})
    return outcome


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Load one report period into the fleet warehouse.")
    parser.add_argument("--root", required=True, help="warehouse folder")
    parser.add_argument("--input", required=True, help="folder with one YYYYMM sub-folder per period")
    parser.add_argument("--start-from", choices=PHASES, default="raw")
    parser.add_argument("--stop-at", choices=PHASES, default="analytics")
    parser.add_argument("--period", help="YYYYMM; the latest folder if left out")
    parser.add_argument("--brands", help="text file with one brand per line; needed to normalize")
    parser.add_argument("--multi-file", action="store_true", help="load all files of the period folder")
    options = parser.parse_args(argv)
    spark = build_session()
    outcome = run(
        spark, options.root, options.input, start=options.start_from, stop=options.stop_at,
        period=options.period, multi_file=options.multi_file,
        brands=load_dictionary(spark, options.brands) if options.brands else NOT_GIVEN,
    )
    print(outcome)
