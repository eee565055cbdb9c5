"""Result tables: Parquet at a location, registered in the catalog."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ruleframe.session import session_settings
from ruleframe.sources.rules import rules_schema

LEGACY_FORMAT = "spark.sql.parquet.writeLegacyFormat"


def quoted(table: str) -> str:
    """A table name with each part in backticks, unless it is quoted already."""
    if "`" in table:
        return table
    return ".".join(f"`{part}`" for part in table.split("."))


class RowsLost(RuntimeError):
    """A written result does not hold as many rows as were computed for it."""


def write_result(
    df: DataFrame,
    table: str,
    location: str,
    partition_by: tuple[str, ...] = (),
    legacy_format: bool = True,
) -> int:
    """Replace ``location`` by ``df`` as Parquet, register it as external ``table``, and return its rows.

    The result is written beside the location first, and its rows are counted in the files and compared
    with those that were computed. Only then the folders change places, by renames, and the catalog entry is
    renewed. So a job that fails leaves the former table as it was, and a result may be computed from the very
    table it replaces, by whatever route it is read. Any former table of that name is replaced.
    """
    spark = df.sparkSession
    files = _Files(spark, location)
    beside = files.sibling("new")
    computed = Observation(f"rows-{uuid.uuid4().hex}")
    try:
        with session_settings(spark, {LEGACY_FORMAT: str(legacy_format).lower()}):
            writer = df.observe(computed, F.count(F.lit(1)).alias("rows")).write.format("parquet")
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            writer.save(beside)
        stored = spark.read.schema(df.schema).parquet(beside).count()
        if stored != computed.get["rows"]:
            raise RowsLost(f"{stored} of {computed.get['rows']} rows are in the files written for {location}")
        files.swap(beside)
    finally:
        files.delete(beside)
    _register(spark, table, df.schema, files.target, partition_by)
    spark.catalog.refreshByPath(location)
    return stored


def _register(
    spark: SparkSession, table: str, schema: StructType, location: str, partition_by: tuple[str, ...]
) -> None:
    """An external table over the files at a location, instead of any former one of that name."""
    names = [name.lower() for name in partition_by]
    columns = [f for f in schema.fields if f.name.lower() not in names]
    columns += [f for name in names for f in schema.fields if f.name.lower() == name]
    parts = ", ".join(f"`{name}`" for name in partition_by)
    drop_table(spark, table)
    path = location.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {quoted(table)} ({StructType(columns).toDDL()}) USING parquet "
        f"{f'PARTITIONED BY ({parts}) ' if parts else ''}LOCATION '{path}'"
    )
    if parts:
        spark.sql(f"ALTER TABLE {quoted(table)} RECOVER PARTITIONS")


class _Files:
    """The folder of a table, and the folders beside it, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, location: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        path = self._path(location)
        self._files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.target = self._files.makeQualified(path).toString().rstrip("/")

    def sibling(self, label: str) -> str:
        """A path next to the folder that nothing was written to yet; its name keeps it from being read as data."""
        folder, _, name = self.target.rpartition("/")
        return f"{folder}/_{name}.{label}-{uuid.uuid4().hex}"

    def swap(self, beside: str) -> None:
        """Put ``beside`` in the place of the folder; the former files are deleted last."""
        before = self.sibling("old")
        replaced = self._files.exists(self._path(self.target))
        if replaced and not self._files.rename(self._path(self.target), self._path(before)):
            raise OSError(f"cannot move {self.target} aside")
        if not self._files.rename(self._path(beside), self._path(self.target)):
            if replaced:
                self._files.rename(self._path(before), self._path(self.target))
            raise OSError(f"cannot move {beside} to {self.target}")
        if replaced:
            self.delete(before)

    def delete(self, folder: str) -> None:
        self._files.delete(self._path(folder), True)


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table if it exists; the files of an external table stay."""
    spark.sql(f"DROP TABLE IF EXISTS {quoted(table)}")


def create_table_from_rules(
    spark: SparkSession, table: str, rules: DataFrame, location: str
) -> None:
    """Register ``location`` as an external table with the columns and types of ``rules``."""
    spark.catalog.createTable(table, path=location, source="parquet", schema=rules_schema(rules))


def read_back(spark: SparkSession, location: str) -> DataFrame:
    """The stored result."""
    return spark.read.parquet(location)
