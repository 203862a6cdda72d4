"""The registry out of the source's own ``CREATE TABLE`` text, read by column expressions.

The text may come in any number of rows (files, statements, dumps); each row holds whole statements. Comments go, names may be quoted in any
of the usual ways, and lines that are no columns (keys, indexes, checks, references) give none.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from changeloom.registry import Registry, Table, column_type

#: Words that begin a line of a table's body that is not a column.
NO_COLUMN = ("primary", "unique", "key", "index", "constraint", "foreign", "check", "fulltext", "spatial", "exclude")
_NAME = "[`\"\\[]?([A-Za-z_][A-Za-z0-9_$]*)[`\"\\]]?"
_STATEMENT = rf"(?is)create\s+(?:temporary\s+)?table\s+(?:if\s+not\s+exists\s+)?(?:{_NAME}\s*\.\s*)?{_NAME}\s*\((.*)\)[^()]*$"
#: A type with its arguments, of one word or of those that belong together.
_TYPE = r"^(double precision|character varying|timestamp with(?:out)? time zone|[a-z0-9_]+)(\s*\([^)]*\))?(?:\s+unsigned)?"


def columns_of(texts: DataFrame, text: str = "ddl") -> DataFrame:
    """The columns of every table: ``table_name``, ``column_name``, ``ordinal_position``, ``column_type``, ``key_position`` (from 1; null if not in the primary key).

    Texts without a table, null and empty ones give no rows. A table that is created twice, in different rows or in one, keeps the columns of each.
    """
    plain = F.regexp_replace(F.regexp_replace(F.col(f"`{text}`"), r"(?s)/\*.*?\*/", " "), r"(?m)(--|#).*$", " ")
    # Quoted text may hold anything; nothing of it is needed.
    plain = F.regexp_replace(plain, r"'(?:[^'\\]|''|\\.)*'", "''")
    statements = texts.select(F.explode(F.split(plain, ";")).alias("s")).where(F.col("s").rlike(r"(?is)create\s+(temporary\s+)?table"))
    parts = statements.select(
        F.regexp_extract("s", _STATEMENT, 2).alias("table_name"),
        # Commas inside of brackets, as in decimal(12, 2), do not end a line.
        F.split(F.regexp_replace(F.regexp_extract("s", _STATEMENT, 3), r",(?=[^()]*\))", "\u0001"), ",").alias("lines"),
    ).where("table_name <> ''")
    lines = F.transform("lines", lambda line: F.trim(F.regexp_replace(F.translate(line, "\u0001", ","), r"\s+", " ")))
    named = parts.select("table_name", lines.alias("lines"))
    first = lambda line: F.lower(F.regexp_extract(line, f"^{_NAME}", 1))
    quoted = lambda line: line.rlike("^[`\"\\[]")
    body = named.select(
        "table_name",
        F.filter("lines", lambda line: (quoted(line) | ~first(line).isin(*NO_COLUMN)) & (first(line) != "")).alias("columns"),
        F.array_join(F.filter("lines", lambda line: line.rlike(r"(?i)^(constraint [^ ]+ )?primary key")), " ").alias("keys"),
    )
    listed = F.transform(F.split(F.regexp_extract("keys", r"\(([^)]*)\)", 1), ","), lambda k: F.regexp_extract(F.trim(k), _NAME, 1))
    rows = body.select("table_name", listed.alias("keys"), F.posexplode("columns").alias("place", "line"))
    name = F.regexp_extract("line", f"^{_NAME}", 1)
    rest = F.trim(F.regexp_replace("line", f"^{_NAME}", ""))
    kind = F.lower(F.concat(F.regexp_extract(F.lower(rest), _TYPE, 1), F.regexp_replace(F.regexp_extract(F.lower(rest), _TYPE, 2), " ", "")))
    inline = rest.rlike(r"(?i)\bprimary key\b")
    found = rows.select("table_name", name.alias("column_name"), (F.col("place") + 1).alias("ordinal_position"), kind.alias("column_type"), "keys", inline.alias("inline"))
    place = F.array_position("keys", F.col("column_name")).cast("int")
    return found.select("table_name", "column_name", "ordinal_position", "column_type", F.when(place > 0, place).when(F.col("inline"), 1).alias("key_position"))


def registry(texts: DataFrame, prefix: str, schema: str, text: str = "ddl", exact: bool = False) -> Registry:
    """All tables of a source with columns, keys and time units. What is collected is metadata: one row for each column.

    A table without a primary key takes its first column for one, as rows without any cannot be kept.
    """
    by_table: dict[str, list[dict]] = {}
    for row in columns_of(texts, text).collect():
        by_table.setdefault(row["table_name"], []).append(row.asDict())
    tables = []
    for name, rows in sorted(by_table.items()):
        rows.sort(key=lambda r: r["ordinal_position"])
        key = [r["column_name"] for r in sorted(rows, key=lambda r: r["key_position"] or 0) if r["key_position"]]
        tables.append(Table(name, tuple(key or [rows[0]["column_name"]])))
    catalogue = [row for rows in by_table.values() for row in rows]
    return replace(Registry(prefix, schema, tuple(tables)).resolve(catalogue, exact))


def types_of(columns: DataFrame) -> DataFrame:
    """The columns with the Spark type they are captured as and their time unit; one lookup for each different type."""
    kinds = [row[0] for row in columns.select("column_type").distinct().collect()]
    if not kinds:
        return columns.withColumns({"captured_as": F.lit(None).cast("string"), "unit": F.lit(None).cast("string")})
    types = F.create_map(*[F.lit(text) for kind in kinds for text in (kind, column_type(kind)[0])])
    units = F.create_map(*[part for kind in kinds for part in (F.lit(kind), F.lit(column_type(kind)[1]).cast("string"))])
    return columns.withColumns({"captured_as": types[F.col("column_type")], "unit": units[F.col("column_type")]})
