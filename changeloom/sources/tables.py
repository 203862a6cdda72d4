"""Bounded tables: Parquet folders with a declared schema, and database tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from changeloom import files
from changeloom.registry import Registry, Table
from changeloom.session import empty_frame


def scan(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A Parquet folder with a declared schema; a folder that was never written has no rows.

    Nothing is inferred, so no job runs before the query does, and marker files beside the data are ignored.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not files.has_data(spark, path):
        return empty_frame(spark, schema)
    return spark.read.schema(schema).parquet(path)


def database_table(
    spark: SparkSession,
    url: str,
    table: Table,
    schema: str,
    bounds: tuple[str, int, int, int],
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A source table over JDBC, e.g. for its initial snapshot. Needs the driver on the classpath.

    ``bounds`` (column, low, high, partitions) says how it is read in parallel.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"{schema}.{table.name}")
    column, low, high, parts = bounds
    reader = (
        reader.option("partitionColumn", column)
        .option("lowerBound", low)
        .option("upperBound", high)
        .option("numPartitions", parts)
    )
    for name, value in (options or {}).items():
        reader = reader.option(name, value)
    return reader.load()


def column_catalogue(
    spark: SparkSession,
    url: str,
    registry: Registry,
    options: Mapping[str, str] | None = None,
    type_column: str = "column_type",
):
    """Rows of the source's ``information_schema.columns`` for ``Registry.resolve``; metadata only.

    ``type_column`` is ``column_type`` for MySQL and ``udt_name`` for Postgres, which has no ``column_type``.
    """
    query = (
        f"SELECT table_name, column_name, ordinal_position, {type_column} AS column_type "
        f"FROM information_schema.columns WHERE table_schema = '{registry.schema}'"
    )
    reader = spark.read.format("jdbc").option("url", url).option("query", query)
    for name, value in (options or {}).items():
        reader = reader.option(name, value)
    return [row.asDict() for row in reader.load().toLocalIterator()]
