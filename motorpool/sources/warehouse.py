"""Stored layers: Parquet tables under one root folder, visible to SQL as schema.table."""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from motorpool.dictionaries import inline_table
from motorpool.schemas import AUDIT, DIM, FACT, LOAD_LOG, NORM, RAW, Contract, conform
from motorpool.session import settle
from motorpool.sources import files
from motorpool.sources.leases import SECONDS, Lease, record_numbers

COMMITS = "_commits"
#: Commit records that stay; their folders are those of the last two.
KEEP_COMMITS = 2


def now_text(moment: dt.datetime | None = None) -> str:
    moment = moment or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return moment.isoformat(sep=" ")


def now_literal(moment: dt.datetime | None = None):
    """One instant per job, as a column."""
    return F.lit(now_text(moment)).cast("timestamp_ntz")


def listed_periods(spark: SparkSession, contract: Contract, location: str) -> dict[int, str]:
    mark = f"{contract.partition}="
    return {int(e.name[len(mark):]): e.path for e in files.listing(spark, location) if e.name.startswith(mark)}


def show_periods(spark: SparkSession, name: str, contract: Contract, folders: dict[int, str]) -> None:
    """Let the catalog's table `name` have just these period folders, one statement each for what differs."""
    part = contract.partition
    known = {int(r.partition.removeprefix(f"{part}=")) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    fresh = sorted(folders.keys() - known)
    if fresh:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(f"PARTITION ({part}={p}) LOCATION '{folders[p]}'" for p in fresh))
    if contract is FACT:
        for p in sorted(folders.keys() & known):
            spark.sql(f"ALTER TABLE {name} PARTITION ({part}={p}) SET LOCATION '{folders[p]}'")
    for p in sorted(known - folders.keys()):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({part}={p})")


def read_periods(spark: SparkSession, contract: Contract, folders: dict[int, str]) -> DataFrame:
    """Rows of period folders that may lie anywhere; the period comes from the folder, as in a partitioned table."""
    if not folders:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in contract.struct])
    base = folders[min(folders)].rsplit(f"/{contract.partition}=", 1)[0]
    rows = spark.read.schema(contract.struct).option("basePath", base).parquet(*[folders[p] for p in sorted(folders)])
    return rows.select(*contract.struct.names)


class Warehouse:
    """Reads and replaces the raw, norm, dimension and fact tables.

    `prefix` goes in front of the SQL schema names, so several warehouses can share a session.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = "", lease_seconds: float = SECONDS) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix
        self.lease_seconds = lease_seconds
        self._held: list[Lease] = []

    # Locations and SQL names

    def sql_name(self, contract: Contract) -> str:
        return f"{self.prefix}{contract.schema}.{contract.name}"

    def folder(self, contract: Contract) -> str:
        return f"{self.root}/{contract.schema}/{contract.name}"

    def _commits(self) -> list[int]:
        return record_numbers(self.spark, f"{self.root}/core/{COMMITS}")

    def commit_record(self, number: int | None = None) -> dict:
        """What the core layer is as of a commit, the last one by default.

        `dim` is the version of the dimension, which also bounds the change log; `fact` names the folder of each
        period. Folders never change once a commit names them, so a reader of one record sees one state.
        """
        if number is None:
            number = max(self._commits(), default=0)
        stored = files.read_json(self.spark, self._commit_path(number)) if number else None
        return {"number": number, **(stored or {"dim": 0, "fact": {}})}

    def _commit_path(self, number: int) -> str:
        return f"{self.root}/core/{COMMITS}/{number:08d}.json"

    def commit(self, before: dict, dim: int, fact: dict[str, str]) -> dict:
        """Make a new state of dimension, change log and fact current by one file that must not exist yet.

        It fails if another load has committed since `before` was read. Folders that neither the new nor the
        previous record names are removed afterwards; a failure there leaves files that nobody reads.
        """
        self.check_leases()
        number = before["number"] + 1
        # A higher number means that records up to ours may have been made and swept since; readers take the highest.
        if (
            not files.create_whole(self.spark, self._commit_path(number), {"dim": dim, "fact": fact})
            or max(self._commits()) > number
        ):
            raise RuntimeError(f"another load committed {number} in {self.root}")
        after = self.commit_record(number)
        for contract in (DIM, FACT):
            self._refresh(contract)
        self._sweep(before, after)
        return after

    def _sweep(self, *records: dict) -> None:
        for old in self._commits()[:-KEEP_COMMITS]:
            files.drop(self.spark, self._commit_path(old))
        oldest = min(r["dim"] for r in records)
        for entry in files.listing(self.spark, self.folder(DIM)):
            if entry.name.startswith("v=") and int(entry.name[2:]) < oldest:
                files.drop(self.spark, entry.path)
        kept = {folder for r in records for folder in r["fact"].values()}
        for period in files.listing(self.spark, self.folder(FACT)):
            for entry in files.listing(self.spark, period.path) if period.is_dir else ():
                if f"{period.name}/{entry.name}" not in kept:
                    files.drop(self.spark, entry.path)

    def dim_version(self) -> int:
        return self.commit_record()["dim"]

    def location(self, contract: Contract) -> str:
        if contract is DIM:
            return f"{self.folder(DIM)}/v={self.dim_version()}"
        return self.folder(contract)

    def period_folders(self, contract: Contract, record: dict | None = None) -> dict[int, str]:
        """Folder of each stored period."""
        location = self.folder(contract)
        if contract is FACT:
            return {int(p): f"{location}/{f}" for p, f in (record or self.commit_record())["fact"].items()}
        return listed_periods(self.spark, contract, location)

    # Set-up

    def ensure(self) -> None:
        """Create schemas and tables that do not exist yet and attach stored partitions."""
        for contract in (RAW, NORM, DIM, FACT, AUDIT, LOAD_LOG):
            location = self.location(contract)
            files.make_dirs(self.spark, location)
            schema = f"{self.prefix}{contract.schema}"
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{self.root}/{contract.schema}'")
            name = self.sql_name(contract)
            if self.spark.catalog.tableExists(name):
                continue
            columns = ", ".join(f.ddl for f in contract.fields)
            parts = f" PARTITIONED BY ({contract.partition})" if contract.partition else ""
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{parts} LOCATION '{location}'")
            if contract.partition:
                show_periods(self.spark, name, contract, self.period_folders(contract))

    def _refresh(self, contract: Contract) -> None:
        """Let SQL see what was just written, if the table is in the catalog."""
        name = self.sql_name(contract)
        if not self.spark.catalog.tableExists(name):
            return
        location = self.location(contract)
        if contract.partition:
            show_periods(self.spark, name, contract, self.period_folders(contract))
        else:
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
        self.spark.catalog.refreshTable(name)

    def _lease(self, work: str) -> Lease:
        return Lease(self.spark, self.root, work, self.lease_seconds)

    @contextlib.contextmanager
    def exclusive(self, work: str = "_loading", wait: float = 0.0) -> Iterator[None]:
        """Keep other jobs out of `work` until it is done, by default out of loading any period.

        Another job that holds it is waited for up to `wait` seconds. A job that dies holds it no longer than a lease.
        """
        with self._lease(work).hold(wait) as lease:
            if work == "_loading":
                for other in files.listing(self.spark, f"{self.root}/_leases"):
                    if other.name.startswith("_loading_") and self._lease(other.name).held():
                        raise RuntimeError(f"another job loads a period of this warehouse: {other.name}")
            self._held.append(lease)
            try:
                yield
            finally:
                self._held.remove(lease)

    @contextlib.contextmanager
    def loading(self, period: int) -> Iterator[None]:
        """Keep other jobs from loading the same period, and all periods from being held as a whole."""
        with self.exclusive(f"_loading_{period}"):
            # each side takes its own lease before it looks at the other's, so they cannot miss each other
            if self._lease("_loading").held():
                raise RuntimeError("another job holds this warehouse")
            yield

    def check_leases(self) -> None:
        """Raise if a lease that this job works under went to another job."""
        for lease in self._held:
            lease.check()

    # Reads

    def read(self, contract: Contract, period: int | None = None, record: dict | None = None) -> DataFrame:
        """The table, or one period of it: a partition filter that reaches the file listing.

        Readers of both dimension and fact pass one commit `record` to see them as of one moment.
        """
        if contract is FACT:
            if not files.exists(self.spark, self.folder(FACT)):
                raise FileNotFoundError(f"no table {contract.name} in {self.root}")
            folders = self.period_folders(FACT, record)
            return read_periods(self.spark, FACT, {p: f for p, f in folders.items() if period in (None, p)})
        location = f"{self.folder(DIM)}/v={record['dim']}" if record and contract is DIM else self.location(contract)
        if not files.exists(self.spark, location):
            raise FileNotFoundError(f"no table {contract.name} in {self.root}")
        rows = self.spark.read.schema(contract.struct).parquet(location)
        if period is None or contract.partition is None:
            return rows
        return rows.where(F.col(contract.partition) == period)

    def raw_period(self, period: int | None = None) -> DataFrame:
        columns = ("report_period", "id_raw", "uf", "marca_modelo", "ano_fabricacao_veiculo_crv", "qtd_veiculos")
        return self.read(RAW, period).select(*columns)

    def highest_id(self, contract: Contract, column: str) -> int:
        """The last number given out. Kept beside the table, so no load scans the periods before it,
        and never lowered: numbers of replaced rows are not used again."""
        return self._last_range(contract, column)[1]

    def _ranges(self, contract: Contract, column: str) -> str:
        return f"{self.folder(contract)}/_ids_{column}"

    def _last_range(self, contract: Contract, column: str) -> tuple[int, int]:
        """Number of the last record of ids, and the last id it gave out."""
        folder = self._ranges(contract, column)
        number = max(record_numbers(self.spark, folder), default=0)
        if number:
            return number, files.read_json(self.spark, f"{folder}/{number:08d}.json")["last"]
        # warehouses of before kept one number instead of ranges
        kept = files.read_json(self.spark, f"{self.folder(contract)}/_last_{column}.json")
        return 0, kept["value"] if kept else 0

    def reserve_ids(self, contract: Contract, column: str, n: int) -> int:
        """Give out `n` ids: those after the number returned.

        Each range is a record that only one job can make, so jobs that load at once get ranges of their own. A job
        that fails leaves a gap, never a repeat. Records stay (one a load): a number that came free could be made twice.
        """
        while True:
            number, last = self._last_range(contract, column)
            if n == 0:
                return last
            record = {"last": last + n, "made": now_text()}
            if files.create_whole(self.spark, f"{self._ranges(contract, column)}/{number + 1:08d}.json", record):
                return last

    # Writes

    def replace_periods(self, rows: DataFrame, contract: Contract, periods: Sequence[int]) -> int:
        """Replace exactly `periods`; returns the rows written.

        Dynamic overwrite swaps partitions at commit, so a failed job leaves the old rows. It does not
        touch a period without new rows, so those are cleared afterwards.
        """
        self.check_leases()
        checked, seen = self._checked(rows, contract, periods)
        writer = checked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(contract.partition).parquet(self.folder(contract))
        result = seen.get
        filled = set(result["periods"] or ())
        for period in set(periods) - filled:
            self._clear(contract, period)
        self._refresh(contract)
        return result["rows"] or 0

    def _checked(self, rows: DataFrame, contract: Contract, periods: Sequence[int]) -> tuple[DataFrame, Observation]:
        """Rows under the contract; a row of another period stops the write before anything is swapped."""
        seen = Observation(f"{contract.name}_write")
        own = F.col(contract.partition)
        foreign = F.raise_error(F.concat(F.lit(f"{contract.name}: row of another period than {sorted(periods)}: "), own))
        kept = F.when(own.isin(*periods), own).otherwise(foreign.cast("int"))
        checked = conform(rows, contract).withColumn(contract.partition, kept).observe(
            seen, F.count(F.lit(1)).alias("rows"), F.collect_set(contract.partition).alias("periods")
        )
        return checked, seen

    def write_fact(self, rows: DataFrame, period: int) -> tuple[str | None, int]:
        """Write a period of the fact into a folder of its own, which no reader sees before a commit names it.

        Returns its name, None if there are no rows, and the rows written.
        """
        checked, seen = self._checked(rows, FACT, [period])
        name = f"{FACT.partition}={period}/load={uuid.uuid4().hex}"
        checked.drop(FACT.partition).write.parquet(f"{self.folder(FACT)}/{name}")
        written = seen.get["rows"] or 0
        return (name if written else None), written

    def _clear(self, contract: Contract, period: int) -> None:
        """Empty one partition, keeping its folder."""
        folder = f"{self.folder(contract)}/{contract.partition}={period}"
        files.drop(self.spark, folder)
        files.make_dirs(self.spark, folder)

    def clear_periods(self, contracts: Sequence[Contract], periods: Sequence[int]) -> None:
        for contract in contracts:
            for period in periods:
                self._clear(contract, period)
            self._refresh(contract)

    def write_dim(self, rows: DataFrame, version: int) -> None:
        """Write the dimension as a version that no reader sees before a commit names it."""
        conform(rows, DIM).write.mode("overwrite").parquet(f"{self.folder(DIM)}/v={version}")

    def log_counts(self, period: int, counts: dict[str, int]) -> None:
        """Keep what the phases of a run counted; phases that did not run keep their last count."""
        if not counts:
            return
        rows = inline_table(self.spark, counts.items(), ("stage", "n"))
        fresh = rows.withColumns({"n": F.col("n").cast("bigint"), "logged_at": now_literal(), "report_period": F.lit(period)})
        older = self.read(LOAD_LOG, period).join(rows.select("stage"), "stage", "left_anti")
        # Read and replaced in one go, so what stays is settled first.
        self.replace_periods(settle(older.select(*LOAD_LOG.columns).union(fresh.select(*LOAD_LOG.columns)), "log"), LOAD_LOG, [period])

    def history(self) -> DataFrame:
        """Every recorded attribute change with the vehicle it belongs to as it is now."""
        record = self.commit_record()
        now = self.read(DIM, record=record).select("hash_veiculo", "id_veiculo", "marca", "modelo", "ano_fabricacao")
        # A version above the current one is a load that did not finish.
        log = self.read(AUDIT).where(F.col("dim_version") <= record["dim"])
        return log.join(now, "hash_veiculo")

    def previous_dim(self) -> DataFrame:
        """The dimension as of the version before the current one."""
        location = f"{self.folder(DIM)}/v={self.dim_version() - 1}"
        if not files.exists(self.spark, location):
            return self.read(DIM).limit(0)
        return self.spark.read.schema(DIM.struct).parquet(location)
