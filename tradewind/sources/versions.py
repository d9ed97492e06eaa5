"""Sets of tables that change all at once: a version per build, and a manifest that names it.

A build writes its tables beside those of earlier builds and publishes them last, by one row in the
manifest, which is one file. Readers take the newest published version when they open the set, and
keep to it: during a build, or after one that failed, they see the set before. Old versions stay
until :meth:`Versions.remove_old` is called.

``location`` is a folder on shared storage (``<location>/<version>/<table>``), or
``catalog:<database>``, where tables are named ``<table>__<version>`` and a view named like the
table follows the newest version.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CATALOG_PREFIX = "catalog:"
MANIFEST_SCHEMA = ("number bigint, version string, state string, at timestamp, "
                   "tables map<string, string>")
PUBLISHED, REMOVED = "published", "removed"


class Versions:
    """The versions of a set of tables at a location."""

    def __init__(self, spark: SparkSession, location: str):
        self.spark = spark
        self._database = (location.removeprefix(CATALOG_PREFIX)
                          if location.startswith(CATALOG_PREFIX) else None)
        self._folder = location.rstrip("/")

    # --- manifest ---------------------------------------------------------------------

    def _manifest(self) -> DataFrame | None:
        if self._database:
            name = f"{self._database}.warehouse_versions"
            return self.spark.table(name) if self.spark.catalog.tableExists(name) else None
        files, path = self._files("manifest")
        if not files.exists(path):
            return None
        return self.spark.read.schema(MANIFEST_SCHEMA).json(f"{self._folder}/manifest")

    def _files(self, name: str):
        """The file system of the folder, and a path in it."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._folder}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def published(self) -> list[Row]:
        """(number, version, at, tables) of the versions that can be opened, newest first."""
        manifest = self._manifest()
        if manifest is None:
            return []
        gone = manifest.where(F.col("state") == REMOVED).select("version")
        return (manifest.where(F.col("state") == PUBLISHED).join(gone, "version", "left_anti")
                .select("number", "version", "at", "tables")
                .orderBy(F.desc("number"), F.desc("version")).collect())

    def find(self, version: str | None = None) -> Row:
        """A published version, the newest by default; ``LookupError`` if there is none."""
        for row in self.published():
            if version in (None, row.version):
                return row
        raise LookupError(f"no version {version or ''} is published at {self._folder}")

    def _append(self, rows: list[tuple]) -> None:
        entries = self.spark.createDataFrame(
            rows, "number bigint, version string, state string, tables map<string, string>")
        entries = entries.select("number", "version", "state", F.current_timestamp().alias("at"),
                                 "tables").coalesce(1)  # one file, which appears as a whole
        if self._database:
            entries.write.mode("append").saveAsTable(f"{self._database}.warehouse_versions",
                                                     format="parquet")
        else:
            entries.write.mode("append").json(f"{self._folder}/manifest")

    # --- tables -----------------------------------------------------------------------

    def new(self) -> str:
        """A name for the version that a build writes."""
        return f"v{uuid4().hex[:12]}"  # writing fails if it is taken

    def _place(self, version: str, name: str) -> str:
        return (f"{self._database}.{name}__{version}" if self._database
                else f"{self._folder}/{version}/{name}")

    def write(self, frame: DataFrame, version: str, name: str,
              partition: str | None = None) -> None:
        # Keys are hashes in hexadecimal, which zstd halves and the default leaves as they are.
        writer = frame.write.mode("errorifexists").option("compression", "zstd")
        if partition:
            writer = writer.partitionBy(partition)
        if self._database:
            writer.saveAsTable(self._place(version, name), format="parquet")
        else:
            writer.parquet(self._place(version, name))

    def read(self, version: str, name: str, schema: StructType) -> DataFrame:
        if self._database:
            return self.spark.table(self._place(version, name))
        return self.spark.read.schema(schema).parquet(self._place(version, name))

    def open(self, version: str | None = None) -> dict[str, DataFrame]:
        """The tables of a published version by name."""
        row = self.find(version)
        return {name: self.read(row.version, name, StructType.fromDDL(ddl))
                for name, ddl in row.tables.items()}

    def publish(self, version: str, schemas: dict[str, StructType]) -> None:
        """Make a version the newest; its tables have to be complete."""
        number = max((row.number for row in self.published()), default=0) + 1
        self._append([(number, version, PUBLISHED,
                       {name: schema.toDDL() for name, schema in schemas.items()})])
        if self._database:
            for name in schemas:
                self.spark.sql(f"CREATE OR REPLACE VIEW {self._database}.{name} AS "
                               f"SELECT * FROM {self._place(version, name)}")

    def discard(self, version: str, names: list[str]) -> None:
        """Delete the tables of a version that is not, or no longer, published."""
        if self._database:
            for name in names:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._place(version, name)}")
            return
        files, path = self._files(version)
        files.delete(path, True)

    def remove_old(self, keep: int = 1) -> list[str]:
        """Delete all published versions but the ``keep`` newest; returns their names.

        Only call it when nobody reads them any more. They leave the manifest first, so nobody
        opens one that is half deleted.
        """
        old = self.published()[max(1, keep):]
        if old:
            self._append([(row.number, row.version, REMOVED, {}) for row in old])
        for row in old:
            self.discard(row.version, list(row.tables))
        return [row.version for row in old]
