"""A table of Parquet folders whose state changes by one rename.

Rows lie below ``data/v=<version>/<partition>=<value>``; a manifest per version names, for each
partition, the version that holds it now and its number of rows. A load writes the partitions it
changes as a new version and then puts its manifest in place. Readers follow the newest manifest: they
see the table before the load or after it, never between, and any earlier version for as long as it is kept.

A manifest has one entry per partition (days, say), so it stays small however many rows there are.
Versions are numbered past whatever lies in ``data``: one that was never finished is not used again. Two writers
cannot both place the same manifest; the slower one is told.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedsieve.sources.files import delete_folder, make_folder, names_in, place_text, read_text

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
VERSION = "v"


class Overtaken(RuntimeError):
    """Another writer has placed a manifest since this one began."""


@dataclass(frozen=True)
class Manifest:
    """Which version holds each partition (by its folder's value), and how many rows."""

    version: int = 0
    partitions: dict[str, tuple[int, int]] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)


class VersionedTable:
    """Handle on one table; ``partition`` is the column its folders are named by."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, partition: str):
        self.spark, self.path, self.partition = spark, path.rstrip("/"), partition
        self.schema = schema
        self.data, self.manifests = f"{self.path}/data", f"{self.path}/manifests"

    def versions(self) -> list[int]:
        """Finished versions that can be read, oldest first."""
        names = names_in(self.spark, self.manifests)
        return sorted(int(n.split(".")[0]) for n in names if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest manifest, or that of a version; an empty one before the first load."""
        known = self.versions()
        if version is None:
            version = known[-1] if known else 0
        elif version not in known:
            raise ValueError(f"{self.path} has no version {version}, only {known}")
        if version == 0:
            return Manifest()
        found = json.loads(read_text(self.spark, self._manifest_path(version)))
        held = {value: tuple(entry) for value, entry in found["partitions"].items()}
        return Manifest(version, held, found["notes"])

    def _manifest_path(self, version: int) -> str:
        return f"{self.manifests}/{version:010d}.json"

    def rows(self, version: int | None = None) -> DataFrame:
        """The rows as of a version, the newest if none is given."""
        return self.rows_of(self.manifest(version))

    def rows_of(self, manifest: Manifest, values: Iterable[str] | None = None) -> DataFrame:
        """The rows a manifest names; of the given partitions only, no other folder is listed."""
        wanted = manifest.partitions.keys() if values is None else values
        folders = [
            f"{self.data}/{VERSION}={manifest.partitions[value][0]}/{self.partition}={value}"
            for value in wanted
            if value in manifest.partitions
        ]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        marked = T.StructType([*self.schema.fields, T.StructField(VERSION, T.IntegerType())])
        stored = self.spark.read.schema(marked).option("basePath", self.data).parquet(*folders)
        return stored.select(*self.schema.fieldNames())

    def row_count(self, version: int | None = None) -> int:
        """Rows as of a version, from its manifest: no file is opened."""
        return sum(n for _, n in self.manifest(version).partitions.values())

    def greatest(self, column: str, version: int | None = None) -> DataFrame:
        """One row: the greatest value of a column that never decreases from partition to partition.

        Of a table by day (month, ...) of ``column`` only the newest one is read, and earlier ones one by one only while
        those read hold nothing but nulls. Rows without a partition value are taken to have no value.
        """
        manifest = self.manifest(version)
        for value in sorted(manifest.partitions.keys() - {NO_VALUE}, reverse=True):
            found = self.rows_of(manifest, [value]).agg(F.max(column).alias(column))
            row = found.first()
            if row[0] is not None:
                return self.spark.createDataFrame([row], found.schema)
        return self.rows_of(manifest, []).agg(F.max(column).alias(column))

    def begin(self) -> int:
        """A version number for a load to write under."""
        begun = [int(n.split("=")[1]) for n in names_in(self.spark, self.data) if n.startswith(f"{VERSION}=")]
        return max([0, *begun, *self.versions()]) + 1

    def write(self, version: int, rows: DataFrame) -> dict[str, int]:
        """Write a version's partitions; nobody reads them before ``commit``. Rows by partition."""
        folder = f"{self.data}/{VERSION}={version}"
        make_folder(self.spark, folder)  # an empty version takes its number too
        (
            rows.select(*self.schema.fieldNames())
            .hint("rebalance", self.partition)
            .write.mode("overwrite")
            .partitionBy(self.partition)
            .parquet(folder)
        )
        values = [n.split("=", 1)[1] for n in names_in(self.spark, folder) if "=" in n]
        if not values:
            return {}
        found = self.spark.read.schema(self.schema).parquet(folder).groupBy(self.partition).count().collect()
        counts = {partition_value(r[0]): r["count"] for r in found}
        return {value: counts[value] for value in values if value in counts}

    def commit(
        self, before: Manifest, version: int, written: dict[str, int], touched: Iterable[str], notes: dict | None = None
    ) -> Manifest:
        """Make a version the newest. Touched partitions that it did not write are left empty."""
        held = {v: e for v, e in before.partitions.items() if v not in set(touched)}
        held |= {value: (version, n) for value, n in written.items()}
        after = Manifest(version, held, before.notes if notes is None else notes)
        if self.manifest().version != before.version:
            raise Overtaken(self.path)
        make_folder(self.spark, self.manifests)
        text = json.dumps({"partitions": held, "notes": after.notes})
        if not place_text(self.spark, self._manifest_path(version), text):
            raise Overtaken(self.path)
        return after

    def overwrite(self, rows: DataFrame, notes: dict | None = None) -> Manifest:
        """Replace the whole table by one new version."""
        before, version = self.manifest(), self.begin()
        written = self.write(version, rows)
        return self.commit(before, version, written, before.partitions.keys(), notes or {})

    def forget(self, keep: int) -> list[int]:
        """Drop all but the newest ``keep`` versions and the folders only they, or nobody, name."""
        known = self.versions()
        dropped, kept = known[: max(0, len(known) - keep)], known[max(0, len(known) - keep) :]
        needed = {v for k in kept for v, _ in self.manifest(k).partitions.values()}
        for version in dropped:
            delete_folder(self.spark, self._manifest_path(version))
        newest = kept[-1] if kept else 0
        for name in names_in(self.spark, self.data):
            version = int(name.split("=")[1]) if name.startswith(f"{VERSION}=") else None
            # A newer folder may belong to a load under way.
            if version is not None and version not in needed and version < newest:
                delete_folder(self.spark, f"{self.data}/{name}")
        return dropped


def partition_value(value) -> str:
    """The value of a partition column as its folder is named."""
    return NO_VALUE if value is None else str(value)


def partition_text(column: str):
    """Expression of ``partition_value``."""
    return F.coalesce(F.col(column).cast("string"), F.lit(NO_VALUE))
