"""The layers on storage.

Batches (Bronze, Silver and rejected rows, one per entity and run date) and Gold
tables are folders of versions. A version counts once its marker file exists: an empty
file, written last, whose creation is one step on any storage. So readers see the old rows or the new
ones and never a load that failed or is still being written; nothing is renamed.

A Gold version is described by a file of its own: the schema, with the value that each column has in files
from before it was added, and the folders that hold the rows. A table with a ``day``
has one folder per day, and a merge writes the days of its batch only: the next version names
the old folders of all other days.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tallyroll.operators.merge import repeated_keys, upsert
from tallyroll.plans.gold import typed_if_possible, with_defaults
from tallyroll.plans.quality import broken_row_counts, contract_rules
from tallyroll.schemas import CONTRACTS, ENTITIES, Contract

logger = logging.getLogger(__name__)

MARKER = "_LIVE"
DESCRIPTION = "_TABLE.json"
KEPT_BATCHES = 2  # the live version of a batch and the one before, for readers that have begun
# Spark's Parquet reader gives a column that a file lacks the value of this SQL text in the column's metadata.
EXISTS_DEFAULT = "EXISTS_DEFAULT"


class ContractViolation(ValueError):
    """Rows that the serving table does not accept; nothing was published."""

    def __init__(self, table: str, broken: dict[str, int]):
        self.table, self.broken = table, broken
        listed = ", ".join(f"{rule}: {rows} rows" for rule, rows in broken.items())
        super().__init__(f"{table} rejects the load ({listed})")


@dataclass(frozen=True)
class Description:
    """What a Gold version holds: ``folders`` (below the table's own) with their rows, and the schema."""

    schema: StructType
    folders: dict[str, int]

    def to_json(self) -> str:
        return json.dumps({"schema": self.schema.jsonValue(), "folders": self.folders})

    @classmethod
    def from_json(cls, text: str) -> Description:
        found = json.loads(text)
        return cls(StructType.fromJson(found["schema"]), found["folders"])


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str

    # --- versions -----------------------------------------------------------
    def _path(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def _remove(self, path: str) -> None:
        fs, folder = self._path(path)
        fs.delete(folder, True)

    def _versions(self, folder: str) -> list[tuple[int, bool]]:
        """All versions, oldest first, and whether each is live."""
        fs, path = self._path(folder)
        if not fs.exists(path):
            return []
        found = []
        for status in fs.listStatus(path):
            name = status.getPath().getName()
            if name.startswith("v="):
                marker = self.spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), MARKER)
                found.append((int(name[2:]), bool(fs.exists(marker))))
        return sorted(found)

    def _next_version(self, folder: str) -> int:
        return max([v for v, _ in self._versions(folder)], default=0) + 1

    def _live(self, folder: str) -> int | None:
        return max([v for v, is_live in self._versions(folder) if is_live], default=None)

    @staticmethod
    def _version_path(folder: str, version: int) -> str:
        return f"{folder}/v={version:06d}"

    def _publish(self, folder: str, version: int) -> None:
        fs, marker = self._path(f"{self._version_path(folder, version)}/{MARKER}")
        fs.create(marker, False).close()

    # --- batches ------------------------------------------------------------
    def batch_path(self, layer: str, entity: str, run_date: str) -> str:
        return f"{self.root}/{layer}/{entity}/run_date={run_date}"

    def write_batch(
        self,
        df: DataFrame,
        layer: str,
        entity: str,
        run_date: str,
        accept: Callable[[dict[str, int]], None] | None = None,
    ) -> int:
        """Replace one batch, also by an empty one; returns the rows written.

        Rows become the next version. The counts (``rows``, and the
        filled cells of every column) are taken in the stage that writes, where a
        retried task is counted once; ``accept`` may raise over them. Only then
        does the marker make the version live. Older versions than the one before go.
        """
        folder = self.batch_path(layer, entity, run_date)
        seen = Observation()
        filled = [F.count(F.col(c)).alias(c) for c in df.columns] if accept else []
        version = self._next_version(folder)
        path = self._version_path(folder, version)
        try:
            df.observe(seen, F.count(F.lit(1)).alias("rows"), *filled).write.mode("error").parquet(path)
            counts = seen.get
            if accept:
                accept(counts)
            self._publish(folder, version)
        except BaseException:
            self._remove(path)
            raise
        live = [v for v, is_live in self._versions(folder) if is_live]
        for old, _ in self._versions(folder):
            if old < live[-KEPT_BATCHES:][0]:
                self._remove(self._version_path(folder, old))
        return counts["rows"]

    def read_batch(self, layer: str, entity: str, run_date: str) -> DataFrame:
        """The live version of a batch."""
        folder = self.batch_path(layer, entity, run_date)
        version = self._live(folder)
        if version is None:
            raise LookupError(f"there is no batch {folder}")
        return self.spark.read.parquet(self._version_path(folder, version))

    # --- Gold tables --------------------------------------------------------
    def table_path(self, table: str) -> str:
        return f"{self.root}/gold/{table}"

    def live_version(self, table: str) -> int | None:
        return self._live(self.table_path(table))

    def describe(self, table: str, version: int | None = None) -> Description | None:
        """The description of a version, by default the live one; None if the table was never loaded."""
        version = version if version is not None else self.live_version(table)
        if version is None:
            return None
        fs, path = self._path(f"{self._version_path(self.table_path(table), version)}/{DESCRIPTION}")
        stream = fs.open(path)
        try:
            return Description.from_json(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _write_description(self, table: str, version: int, description: Description) -> None:
        fs, path = self._path(f"{self._version_path(self.table_path(table), version)}/{DESCRIPTION}")
        stream = fs.create(path, True)
        try:
            stream.write(bytearray(description.to_json().encode()))
        finally:
            stream.close()

    def _schema(self, table: str, contract: Contract) -> StructType:
        """The contract's columns, each with the value that files from before it was added have.

        A default is evaluated once, when its column first comes to the table, so that
        a column of times does not change from read to read.
        """
        live = self.describe(table)
        known = {f.name: f for f in live.schema} if live else {}
        plain = self.spark.createDataFrame([], contract.schema).schema
        added = {f.name: f.default for f in contract.fields if f.default is not None and f.name not in known}
        values = {}
        if added:
            texts = [F.expr(default).cast(plain[name].dataType).cast("string").alias(name) for name, default in added.items()]
            values = self.spark.range(1).select(*texts).first().asDict()
        fields = []
        for field in plain:
            metadata = known[field.name].metadata if field.name in known else {}
            if field.name in values:
                metadata = {EXISTS_DEFAULT: f"CAST('{values[field.name]}' AS {field.dataType.simpleString()})"}
            fields.append(StructField(field.name, field.dataType, True, metadata))
        return StructType(fields)

    def _read_folders(self, table: str, schema: StructType, folders: Sequence[str], day: str | None) -> DataFrame:
        path = self.table_path(table)
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read
        if day is None:
            return reader.schema(schema).parquet(*[f"{path}/{f}" for f in folders])
        # The day is in the folders' names, so a filter on it leaves out folders; so is the version.
        found = reader.option("basePath", path).schema(schema).parquet(*[f"{path}/{f}" for f in folders])
        return found.select(*schema.names)

    def read_table(self, table: str) -> DataFrame:
        """The live version; a declared table that was never loaded is empty."""
        description = self.describe(table)
        if description is None:
            if table not in CONTRACTS:
                raise LookupError(f"{table} is not a Gold table")
            return self.spark.createDataFrame([], CONTRACTS[table].schema)
        return self._read_folders(table, description.schema, sorted(description.folders), self._day_of(description))

    @staticmethod
    def _day_of(description: Description) -> str | None:
        first = next(iter(description.folders), "")
        return first.split("/")[1].split("=")[0] if "/" in first else None

    def table_head(self, table: str, rows: int, order: Sequence[str]) -> DataFrame:
        """The first ``rows`` rows of a table with a day, in ``order`` (the day first): only the first days' folders are read."""
        description = self.describe(table)
        if description is None:
            return self.read_table(table).limit(0)
        day = self._day_of(description)
        if day is None or order[0] != day:
            raise ValueError(f"{table} has no folders in the order of {order[0]}")
        wanted, held = [], 0
        for folder in sorted(description.folders, key=lambda f: f.split("/")[1]):
            if held >= rows:
                break
            wanted.append(folder)
            held += description.folders[folder]
        return self._read_folders(table, description.schema, wanted, day).orderBy(*order).limit(rows)

    def drop_old_versions(self, table: str, keep: int = 2) -> list[int]:
        """Delete all but the newest ``keep`` live versions and what failed loads left before them.

        Folders that a version still kept has rows in stay. A version's marker goes first.
        """
        folder = self.table_path(table)
        versions = self._versions(folder)
        live = [v for v, is_live in versions if is_live]
        if len(live) <= keep:
            return []
        kept = live[-keep:]
        used = {f for v in kept for f in self.describe(table, v).folders}
        dropped = []
        for version, is_live in versions:
            if version >= kept[0]:
                break
            path = self._version_path(folder, version)
            if is_live:
                self._remove(f"{path}/{MARKER}")
            name = path.rsplit("/", 1)[1]
            fs, hadoop_path = self._path(path)
            if name not in used:
                needed = {f.split("/")[1] for f in used if f.startswith(f"{name}/")}
                for status in fs.listStatus(hadoop_path):
                    if status.getPath().getName() not in needed:
                        fs.delete(status.getPath(), True)
                if not needed:
                    fs.delete(hadoop_path, True)
            if is_live or not fs.exists(hadoop_path):
                dropped.append(version)
        return dropped

    def _load(self, df: DataFrame, contract: Contract, kept: dict[str, int]) -> int:
        """Write ``df`` as the next version, beside the folders ``kept``; returns its rows.

        Rows are range-partitioned by the sort order of the table, so that a day is in few
        files. Rule violations are counted in the stage that writes (behind that shuffle, whose
        sampling would count rows twice), and only the key columns are read
        back for the key check. The version goes live only if no rule is broken.
        """
        table = contract.table
        folder = self.table_path(table)
        rules = contract_rules(contract)
        seen = Observation()
        laid = with_defaults(df, contract).repartitionByRange(*contract.sort).sortWithinPartitions(*contract.sort)
        judged = laid.observe(seen, F.count(F.lit(1)).alias("rows"), *broken_row_counts(rules))
        schema = self._schema(table, contract)
        version = self._next_version(folder)
        path = self._version_path(folder, version)
        name = path.rsplit("/", 1)[1]
        try:
            writer = typed_if_possible(judged, contract).write.mode("error")
            (writer.partitionBy(contract.day) if contract.day else writer).parquet(path)
            counts = seen.get
            if counts["rows"] == 0 and not kept:
                logger.warning("%s: empty input, table left as it was", table)
                self._remove(path)
                return 0
            broken = {r.name: counts[f"broken_{i}"] for i, r in enumerate(rules) if r.broken and counts[f"broken_{i}"]}
            if contract.day:
                fs, written = self._path(path)
                days = [s.getPath().getName() for s in fs.listStatus(written) if s.isDirectory()]
                fresh = self._read_folders(table, schema, [f"{name}/{d}" for d in days], contract.day)
                # As many numbers as the batch has days.
                sizes = {str(r[0]): r[1] for r in fresh.groupBy(contract.day).count().collect()}
                folders = {f"{name}/{d}": sizes.get(d.split("=", 1)[1], 0) for d in days}
            else:
                fresh, folders = self._read_folders(table, schema, [name], None), {name: counts["rows"]}
            repeated = repeated_keys(fresh, contract.key).agg(F.sum("n")).first()[0]
            if repeated:
                broken[rules[0].name] = repeated
            if broken:
                raise ContractViolation(table, broken)
            self._write_description(table, version, Description(schema, {**kept, **folders}))
            self._publish(folder, version)
        except BaseException:
            self._remove(path)
            raise
        return counts["rows"]

    def replace_table(self, df: DataFrame, contract: Contract) -> int:
        """Load a whole table; returns its rows, 0 when the input was empty and nothing changed."""
        return self._load(df, contract, {})

    def upsert_table(self, df: DataFrame, contract: Contract) -> int:
        """Merge rows by key and publish the result; returns the rows of ``df``.

        The batch is written to a folder of its own first, so it is computed once. A table with a
        ``day``, which is part of its key, has only the days of the batch read and written
        again. A key twice in ``df`` is refused.
        """
        table = contract.table
        aside = f"{self.root}/_aside/{uuid.uuid4().hex}"
        seen = Observation()
        try:
            df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(aside)
            rows = seen.get["rows"]
            if rows == 0:
                return 0
            batch = self.spark.read.schema(df.schema).parquet(aside)
            repeated = repeated_keys(batch, contract.key).agg(F.sum("n")).first()[0]
            if repeated:
                raise ContractViolation(table, {"key repeated in one batch": repeated})
            live = self.describe(table)
            if live is None:
                return self.replace_table(batch, contract)
            touched = dict(live.folders)
            if contract.day:
                days = batch.select(F.col(contract.day).cast("date").cast("string")).distinct().collect()
                names = {f"{contract.day}={r[0]}" for r in days}
                touched = {f: n for f, n in live.folders.items() if f.split("/")[1] in names}
            kept = {f: n for f, n in live.folders.items() if f not in touched}
            old = self._read_folders(table, self._schema(table, contract), sorted(touched), contract.day)
            defaults = {f.name: F.expr(f.default) for f in contract.fields if f.default is not None}
            self._load(upsert(old, batch, contract.key, defaults), contract, kept)
            return rows
        finally:
            self._remove(aside)

    # --- SQL names ----------------------------------------------------------
    def register_views(self, run_date: str | None = None) -> list[str]:
        """Make every Gold table, and the Silver batch of ``run_date``, a view for ``spark.sql``."""
        views = {t: self.read_table(t) for t in CONTRACTS}
        if run_date is not None:
            views |= {f"silver_{e}": self.read_batch("silver", e, run_date) for e in ENTITIES}
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        return sorted(views)
