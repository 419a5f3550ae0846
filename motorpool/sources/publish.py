"""The published replica: both tables switch together, and the last switch can be undone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from motorpool.schemas import AUDIT, DIM, FACT, PUBLISHED_DIM, PUBLISHED_FACT, Contract, conform
from motorpool.sources import files
from motorpool.sources.warehouse import Warehouse, read_periods, show_periods

#: Names of versions and the ending of their SQL names.
NAMES = {"current": "", "previous": "_prev", "failed": "_failed"}


class Publication:
    """Versions of both tables and one manifest naming the current, previous and failed one.

    A version is a list of folders that never change: one of the dimension and one for each period of the fact,
    each with the core folder it was copied from. Versions share the folders of what did not change between them,
    and a folder goes when the last version that names it goes.
    """

    def __init__(self, warehouse: Warehouse) -> None:
        self.warehouse = warehouse
        self.spark: SparkSession = warehouse.spark
        self.root = f"{warehouse.root}/analytics"

    def manifest(self) -> dict:
        stored = files.read_json(self.spark, f"{self.root}/manifest.json")
        return stored or {"current": None, "previous": None, "failed": None, "last": 0, "versions": {}}

    def _switch(self, manifest: dict) -> None:
        named = {str(manifest[which]) for which in NAMES}
        manifest["versions"] = {n: v for n, v in manifest["versions"].items() if n in named}
        self.warehouse.check_leases()
        files.replace_json(self.spark, f"{self.root}/manifest.json", manifest)
        self._show(manifest)
        self._retain(manifest)

    def _known(self, manifest: dict) -> dict[str, str]:
        """Core folder to its copy, over all versions that are kept."""
        out = {}
        for version in manifest["versions"].values():
            out |= {source: copy for source, copy in (version["dim"], *version["fact"].values())}
        return out

    def publish(self, wait: float = 0.0) -> int:
        """Copy what changed in the core tables, ids and timestamps included, and make the new version current.

        A month's load adds one period, so one period and the dimension are copied, whatever the history holds. The
        version becomes visible by one manifest replacement once both tables are complete; copies need no shuffle.
        """
        with self.warehouse.exclusive("_publishing", wait):
            before = self.manifest()
            version = before["last"] + 1
            core, record = self.warehouse, self.warehouse.commit_record()
            known = self._known(before)
            dim = f"v={record['dim']}"
            if dim not in known:
                known[dim] = f"{PUBLISHED_DIM.name}/v={version}"
                self._copy(core.read(DIM, record=record), PUBLISHED_DIM, known[dim])
            facts = {}
            for period, source in record["fact"].items():
                if source not in known:
                    known[source] = f"{PUBLISHED_FACT.name}/{FACT.partition}={period}/v={version}"
                    self._copy(core.read(FACT, int(period), record), PUBLISHED_FACT, known[source])
                facts[period] = [source, known[source]]
            content = {"dim": [dim, known[dim]], "fact": facts, "dim_version": record["dim"]}
            after = {**before, "current": version, "previous": before["current"], "last": version}
            self._switch({**after, "versions": {**before["versions"], str(version): content}})
            return version

    def _copy(self, rows: DataFrame, contract: Contract, folder: str) -> None:
        own = conform(rows, contract)
        if contract.partition:
            own = own.drop(contract.partition)
        own.write.mode("overwrite").parquet(f"{self.root}/{folder}")

    def rollback(self) -> bool:
        """Make the previous version current and mark the current one failed; False without one."""
        with self.warehouse.exclusive("_publishing"):
            before = self.manifest()
            if before["previous"] is None:
                return False
            self._switch({**before, "current": before["previous"], "previous": None, "failed": before["current"]})
            return True

    def _retain(self, manifest: dict) -> None:
        """Remove the folders that no version of the manifest names."""
        kept = set(self._known(manifest).values())
        for folder in self._folders():
            if folder not in kept:
                files.drop(self.spark, f"{self.root}/{folder}")

    def _folders(self) -> list[str]:
        own = [f"{PUBLISHED_DIM.name}/{e.name}" for e in files.listing(self.spark, f"{self.root}/{PUBLISHED_DIM.name}")]
        for period in files.listing(self.spark, f"{self.root}/{PUBLISHED_FACT.name}"):
            own += [f"{PUBLISHED_FACT.name}/{period.name}/{e.name}" for e in files.listing(self.spark, period.path)]
        return [f for f in own if f.rsplit("/", 1)[-1].startswith("v=")]

    def _version(self, which: str) -> dict:
        manifest = self.manifest()
        if manifest[which] is None:
            raise ValueError(f"no {which} version has been published")
        return manifest["versions"][str(manifest[which])]

    def _read(self, contract: Contract, version: dict) -> DataFrame:
        if contract is PUBLISHED_DIM:
            return self.spark.read.schema(contract.struct).parquet(f"{self.root}/{version['dim'][1]}")
        return read_periods(self.spark, contract, self._periods(version))

    def _periods(self, version: dict) -> dict[int, str]:
        return {int(p): f"{self.root}/{copy}" for p, (_, copy) in version["fact"].items()}

    def read(self, contract: Contract, which: str = "current") -> DataFrame:
        return self._read(contract, self._version(which))

    def tables(self, which: str = "current") -> tuple[DataFrame, DataFrame]:
        """(dimension, fact) of one version, from one reading of the manifest."""
        version = self._version(which)
        return self._read(PUBLISHED_DIM, version), self._read(PUBLISHED_FACT, version)

    def _show(self, manifest: dict) -> None:
        """SQL names for the current version, and for the previous one with `_prev`."""
        schema = f"{self.warehouse.prefix}analytics"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{self.root}'")
        named = tuple(NAMES.items())
        contracts = (PUBLISHED_DIM, PUBLISHED_FACT)
        for version in {manifest[which] for which, _ in named} - {None}:
            for contract in contracts:
                self._show_version(schema, contract, version, manifest["versions"][str(version)])
        # Names move by one statement each and never vanish in between. The manifest is what switches both tables
        # at once; a SQL reader between two statements may see the dimension a version ahead of the fact.
        for which, suffix in named:
            for contract in contracts:
                name = f"{schema}.{contract.name}{suffix}"
                if manifest[which] is None:
                    self.spark.sql(f"DROP VIEW IF EXISTS {name}")
                else:
                    self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {schema}.{contract.name}_v{manifest[which]}")
        self._forget({manifest[which] for which, _ in named}, schema)
        self._show_views(schema, manifest)

    def _show_version(self, schema: str, contract: Contract, version: int, content: dict) -> None:
        """A table of its own for each version; it never changes."""
        name = f"{schema}.{contract.name}_v{version}"
        location = f"{self.root}/{contract.name if contract.partition else content['dim'][1]}"
        if self.spark.catalog.tableExists(name):
            return
        columns = ", ".join(f.ddl for f in contract.fields)
        parts = f" PARTITIONED BY ({contract.partition})" if contract.partition else ""
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{parts} LOCATION '{location}'")
        if contract.partition:
            show_periods(self.spark, name, contract, self._periods(content))

    def _forget(self, versions: set[int | None], schema: str) -> None:
        """Drop the tables of versions that no name shows any more; their files go by `_retain`."""
        for contract in (PUBLISHED_DIM, PUBLISHED_FACT):
            mark = f"{contract.name}_v"
            for row in self.spark.sql(f"SHOW TABLES IN {schema} LIKE '{mark}*'").collect():
                number = row.tableName.removeprefix(mark)
                if number.isdigit() and int(number) not in versions:
                    self.spark.sql(f"DROP TABLE IF EXISTS {schema}.{row.tableName}")

    def _show_views(self, schema: str, manifest: dict) -> None:
        """Readable views: the current vehicles, and what changed on them up to the published dimension."""
        if manifest["current"] is None:
            return
        audit = self.warehouse.sql_name(AUDIT)
        self.spark.sql(f"CREATE OR REPLACE VIEW {schema}.vw_dim_veiculo AS SELECT * FROM {schema}.{PUBLISHED_DIM.name}")
        if self.spark.catalog.tableExists(audit):
            # later versions are loads that are not published, or never finished
            bound = manifest["versions"][str(manifest["current"])]["dim_version"]
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {schema}.vw_historico_alteracoes AS "
                "SELECT d.id_veiculo, d.marca, d.modelo, d.ano_fabricacao, a.action, a.column_name, a.old_value, "
                "a.new_value, a.payload, a.changed_at, a.report_period "
                f"FROM {audit} a JOIN {schema}.{PUBLISHED_DIM.name} d ON a.hash_veiculo = d.hash_veiculo "
                f"WHERE a.dim_version <= {bound}"
            )
