"""Tables that are replaced as a whole while others read them: written beside, then made current by the catalogue.

Each generation is a folder of its own. The catalogue's table points at one of them; ``ALTER TABLE … SET LOCATION`` moves the pointer, in one step.
A reload that fails half way leaves a folder that nothing points at, and the old rows where they were. Readers that planned
before the switch go on with the old folder, which stays until ``forget``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from changeloom import files


def reload(frame: DataFrame, table: str, root: str) -> str:
    """Replace all rows of a catalogue table, whose generations lie below ``root``; returns the new one. The table is made if it is new.

    ``frame`` may read the table itself. Its columns are those of the table.
    """
    spark = frame.sparkSession
    path = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    frame.write.parquet(path)
    switch(spark, table, path, frame)
    return path


def switch(spark: SparkSession, table: str, path: str, frame: DataFrame) -> None:
    """Make a written folder the table's current one; also the way back to an earlier generation."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields)
    if spark.catalog.tableExists(table):
        if columns != ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.table(table).schema.fields):
            raise ValueError(f"{table} has other columns; put a view over a table of another name")
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{path}'")


def current(spark: SparkSession, table: str) -> str:
    """The folder that a table points at."""
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").select("data_type").collect()
    return rows[0][0]


def forget(spark: SparkSession, table: str, root: str) -> list[str]:
    """Delete all generations but the current one, those of reloads that failed too; call it when no reader needs them. Returns what went."""
    kept = current(spark, table).rstrip("/").rsplit("/", 1)[-1]
    gone = [name for name in files.children(spark, root) if name != kept]
    for name in gone:
        files.delete(spark, f"{root.rstrip('/')}/{name}")
    return gone
