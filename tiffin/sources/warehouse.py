"""The layered warehouse: Parquet folders per layer and table under a common root.

Every write goes to a new folder; a commit to the log of the warehouse (``manifest``) then makes the folders of
one or more tables what is read. Readers see the old tables until then. A write that fails, at whatever step,
leaves them as they were; what it has written is read by nobody and goes with ``vacuum``. A load has an id, and a
table takes in a load of the same id once.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping
from contextlib import suppress
from dataclasses import dataclass, replace
from functools import reduce
from threading import Lock

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tiffin.schemas import AUDIT_SCHEMA, BY_SILVER_NAME, TableSpec
from tiffin.sources.manifest import Change, Manifest, TableState

BRONZE, SILVER, GOLD, AUDIT, STAGE = "bronze", "silver", "gold", "audit", "stage"
AUDIT_TABLE = "rejected_rows"
LOG = "_log"
_HOUR_MS = 3_600_000

Figures = Mapping[str, Column]


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    @property
    def manifest(self) -> Manifest:
        return Manifest(self.spark, f"{self._root}/{LOG}")

    @property
    def _root(self) -> str:
        return self.root.rstrip("/")

    def folder(self, layer: str, table: str) -> str:
        return f"{self._root}/{layer}/{table}"

    def states(self, layer: str) -> dict[str, TableState]:
        """The tables of a layer, and what is known of them."""
        found = self.manifest.state().items()
        return {name.removeprefix(f"{layer}/"): s for name, s in found if name.startswith(f"{layer}/")}

    def exists(self, layer: str, table: str) -> bool:
        return table in self.states(layer)

    def version(self, layer: str, table: str) -> str:
        """What a table is now; empty if it is not there."""
        state = self.states(layer).get(table)
        return state.version if state else ""

    def read(self, layer: str, table: str, schema: StructType | None = None) -> DataFrame:
        """A stored table. A given schema spares the job that reads it from a file."""
        state = self.states(layer).get(table)
        if state is None:
            raise LookupError(f"there is no table {layer}/{table} in {self.root}")
        return self._parquet(state.folders, schema)

    def _parquet(self, folders: list[str], schema: StructType | None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*[f"{self._root}/{folder}" for folder in folders])

    def bronze(self, spec: TableSpec) -> DataFrame:
        return self.read(BRONZE, spec.bronze_name, spec.bronze_schema)

    def silver(self, spec: TableSpec) -> DataFrame:
        return self.read(SILVER, spec.silver_name, spec.silver_schema)

    def silver_by_name(self, name: str) -> DataFrame:
        return self.silver(BY_SILVER_NAME[name])

    def audit(self) -> DataFrame:
        """All audit records. Those of each table are stored apart, so a filter on its name reads no others."""
        stored = StructType([f for f in AUDIT_SCHEMA if f.name != "table_name"])
        parts = [
            self._parquet(state.folders, stored)
            .withColumn("table_name", F.lit(name.removeprefix(f"{AUDIT_TABLE}/")))
            .select(*AUDIT_SCHEMA.names)
            for name, state in sorted(self.states(AUDIT).items())
            if name.startswith(f"{AUDIT_TABLE}/")
        ]
        return reduce(DataFrame.unionAll, parts or [self.spark.createDataFrame([], AUDIT_SCHEMA)])

    def write(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        mode: str = "overwrite",
        figures: Figures | None = None,
        known: Mapping[str, int] | None = None,
    ) -> int:
        """Write ``df`` and return the number of rows written.

        Rows are counted during the write, without a second pass, and so are ``figures``: sums over the rows that
        are kept with the table, as are the ``known`` ones. ``mode`` is ``overwrite`` (rebuild), ``append`` (add to what is there) or
        ``ignore`` (keep a table that exists; 0 rows).
        """
        if mode == "ignore" and self.exists(layer, table):
            return 0
        load = uuid.uuid4().hex if mode == "append" else None
        change = self.written(df, layer, table, figures, load)
        self.commit(replace(change, figures={**change.figures, **(known or {})}))
        return change.rows

    def load(self, rows: DataFrame, spec: TableSpec, load: str, rejected: DataFrame | None = None) -> list[int]:
        """Append a load to a bronze table, and its malformed records to the audit, both or neither."""
        changes = [self.written(rows, BRONZE, spec.bronze_name, load=load)]
        if rejected is not None:
            changes.append(self._rejected(rejected, spec, load))
        self.commit(*changes)
        return [change.rows for change in changes]

    def loaded(self, spec: TableSpec, load: str) -> int | None:
        """The rows that a bronze table has taken in by a load; None if it has not."""
        state = self.states(BRONZE).get(spec.bronze_name)
        return state.loads.get(load) if state else None

    def rebuild(
        self,
        kept: DataFrame,
        rejected: DataFrame,
        spec: TableSpec,
        figures: Figures | None = None,
        on: str | None = None,
    ) -> tuple[int, int]:
        """Rebuild a silver table and append its audit records, in one commit; both counts.

        ``on`` is the version of the silver table when the build began; if another build has replaced it since,
        this one ends with a ``Conflict``.
        """
        silver = self.written(kept, SILVER, spec.silver_name, figures, on=on)
        audit = self._rejected(rejected, spec, uuid.uuid4().hex)
        self.commit(silver, audit)
        return silver.rows, audit.rows

    def _rejected(self, records: DataFrame, spec: TableSpec, load: str) -> Change:
        return self.written(records.drop("table_name"), AUDIT, f"{AUDIT_TABLE}/{spec.silver_name}", load=load)

    def written(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        figures: Figures | None = None,
        load: str | None = None,
        on: str | None = None,
    ) -> Change:
        """``df`` in a new folder, which is read only once the change is committed."""
        folder = f"{layer}/{table}/v-{uuid.uuid4().hex}"
        seen = {}
        if figures:
            observed = Observation()
            sums = [F.coalesce(F.sum(c.cast("bigint")), F.lit(0)).alias(n) for n, c in figures.items()]
            df, seen = df.observe(observed, *sums), observed
        rows = self._counted(df, f"{self._root}/{folder}", "error")
        kept = {name: int(seen.get[name]) for name in figures} if figures else {}
        return Change(f"{layer}/{table}", folder, rows, kept, load, on)

    def commit(self, *changes: Change) -> None:
        """Make written folders the tables to be read, all at once.

        The version before a replaced one stays, for readers that have begun with it.
        """
        for folder in self.manifest.commit(changes):
            with suppress(Exception):  # nobody reads it, and vacuum comes by
                self.delete(f"{self._root}/{folder}")

    def vacuum(self, older_than_hours: float = 24) -> list[str]:
        """Remove the folders of writes that failed or were replaced, if as old as given; their paths."""
        needed = {f for s in self.manifest.state().values() for f in (*s.folders, *s.before)}
        latest = time.time() * 1000 - older_than_hours * _HOUR_MS
        gone = []
        fs, root = self._file_system(self._root)
        for layer in (BRONZE, SILVER, GOLD, AUDIT):
            for status in fs.globStatus(self._hadoop_path(f"{self._root}/{layer}/{{*/v-*,*/*/v-*}}")) or ():
                path = status.getPath().toString()
                name = path[path.rindex(f"/{layer}/") + 1 :]
                if name not in needed and status.getModificationTime() <= latest:
                    self.delete(path)
                    gone.append(name)
        return gone

    def delete(self, path: str) -> None:
        fs, hadoop_path = self._file_system(path)
        fs.delete(hadoop_path, True)

    def _counted(self, df: DataFrame, path: str, mode: str) -> int:
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.mode(mode).parquet(path)
        return seen.get["rows"]

    def _hadoop_path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _file_system(self, path: str):
        hadoop_path = self._hadoop_path(path)
        fs = hadoop_path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs, hadoop_path


class Stage:
    """Intermediate tables of one run, each written on first use and read back from then on.

    Every run has a folder of its own, so a plan of an earlier run never loses the files it reads.
    Tables of different names are written at the same time. Use it as a context to remove the folder when
    the run ends, also by an error.
    """

    def __init__(self, warehouse: Warehouse):
        self._warehouse = warehouse
        self._run = uuid.uuid4().hex
        self._written: dict[str, tuple[StructType, int]] = {}
        self._locks: dict[str, Lock] = {}
        self._lock = Lock()

    def __enter__(self) -> Stage:
        return self

    def __exit__(self, *_: object) -> None:
        with suppress(Exception):
            self._warehouse.delete(self._warehouse.folder(STAGE, self._run))

    def store(self, name: str, plan: DataFrame) -> tuple[DataFrame, int]:
        """The stored table and its number of rows."""
        table = f"{self._run}/{name}"
        with self._lock:
            own = self._locks.setdefault(name, Lock())
        with own:
            if name not in self._written:
                path = self._warehouse.folder(STAGE, table)
                rows = self._warehouse._counted(plan, path, "error")
                self._written[name] = (plan.schema, rows)
            schema, rows = self._written[name]
        folder = self._warehouse.folder(STAGE, table)
        return self._warehouse.spark.read.schema(schema).parquet(folder), rows
