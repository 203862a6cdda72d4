"""Captured tables: where a change comes from, what its rows look like and where they go.

One ``Table`` holds the only declaration of its columns. The change-log parser, the sink and the scans all use it.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace
from functools import cached_property, partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from changeloom.functions.times import to_time
from changeloom.operators.changes import OP, SEQ
from changeloom.plans import transforms
from changeloom.session import empty_frame


@dataclass(frozen=True)
class Table:
    name: str
    key: tuple[str, ...]
    columns: str | None = None
    """DDL of one captured row, e.g. ``"id bigint, name string"``; None until a column catalogue is given."""
    target: str | None = None
    derive: Callable[[], list[Column]] | None = None
    """Columns of a target row over those of a captured row; a plain copy by default."""
    required: tuple[str, ...] | None = None
    """Columns that must not be NULL for a row to be in the target; the key by default."""
    units: Mapping[str, str] = field(default_factory=dict)
    """Unit (``ms``, ``us``, ``days``) of each raw time column."""

    @property
    def sink(self) -> str:
        return self.target or self.name

    @cached_property
    def row_type(self) -> StructType:
        if not self.columns:
            raise ValueError(f"table {self.name!r} has no columns; resolve it against a column catalogue first")
        return StructType.fromDDL(self.columns)

    def target_columns(self) -> list[Column]:
        return self.derive() if self.derive else [F.col(f"`{name}`") for name in self.row_type.fieldNames()]

    def target_type(self, spark: SparkSession) -> StructType:
        return empty_frame(spark, self.row_type).select(*self.target_columns()).schema

    def wanted(self) -> Column:
        """Whether a captured row belongs in the target."""
        names = self.key if self.required is None else self.required
        return F.expr(" AND ".join(f"`{n}` IS NOT NULL" for n in names) or "true")

    def project(self, rows: DataFrame) -> DataFrame:
        """Captured rows to target rows."""
        return rows.where(self.wanted()).select(*self.target_columns())

    def project_latest(self, latest: DataFrame) -> DataFrame:
        """The same for the last change per key; a row that no longer belongs in the target counts as deleted."""
        op = F.when(self.wanted(), F.col(OP)).otherwise("d").alias(OP)
        return latest.select(*self.target_columns(), op, SEQ)


@dataclass(frozen=True)
class Registry:
    """The tables of one source database. Topics are named ``<prefix>.<schema>.<table>``."""

    prefix: str
    schema: str
    tables: tuple[Table, ...]

    def __iter__(self):
        return iter(self.tables)

    def __len__(self) -> int:
        return len(self.tables)

    def __getitem__(self, name: str) -> Table:
        for table in self.tables:
            if table.name == name:
                return table
        raise KeyError(name)

    def topic(self, table: Table | str) -> str:
        return f"{self.prefix}.{self.schema}.{table if isinstance(table, str) else table.name}"

    def select(self, *patterns: str) -> "Registry":
        """Tables by name or glob, in registry order; a pattern that matches nothing is an error."""
        for pattern in patterns:
            if not any(fnmatch.fnmatchcase(t.name, pattern) for t in self.tables):
                raise KeyError(f"no table matches {pattern!r}")
        chosen = [t for t in self.tables if any(fnmatch.fnmatchcase(t.name, p) for p in patterns)]
        return replace(self, tables=tuple(chosen))

    def groups(self, size: int = 5) -> list["Registry"]:
        """Slices of ``size`` tables, each meant for one streaming query."""
        return [replace(self, tables=self.tables[i : i + size]) for i in range(0, len(self.tables), size)]

    def resolve(self, catalogue: Iterable[Mapping[str, object]], exact: bool = False) -> "Registry":
        """Fill in the columns from rows of the source's ``information_schema.columns``.

        Each row has ``table_name``, ``column_name``, ``ordinal_position`` and ``column_type``. The catalogue is
        metadata: its size is the number of source columns, never the number of rows. Tables missing from it
        keep the columns they have; a table that then has none is an error.
        """
        by_table: dict[str, list[Mapping[str, object]]] = {}
        for row in catalogue:
            by_table.setdefault(str(row["table_name"]), []).append(row)
        resolved = []
        for table in self.tables:
            found = sorted(by_table.get(table.name, ()), key=lambda r: int(r["ordinal_position"]))
            if found:
                typed = [(str(r["column_name"]), *column_type(str(r["column_type"]), exact)) for r in found]
                missing = set(table.key) - {name for name, _, _ in typed}
                if missing:
                    raise ValueError(f"table {table.name!r} has no key column {sorted(missing)}")
                table = replace(
                    table,
                    columns=", ".join(f"`{name}` {kind}" for name, kind, _ in typed),
                    units={name: unit for name, _, unit in typed if unit},
                )
            if not table.columns:
                raise ValueError(f"table {table.name!r} is not in the column catalogue")
            resolved.append(table)
        return replace(self, tables=tuple(resolved))


def column_type(source_type: str, exact: bool = False) -> tuple[str, str | None]:
    """Spark type and time unit of a source column type, e.g. ``datetime(6)`` to ``("bigint", "us")``.

    Decimals arrive as doubles unless ``exact`` keeps their precision. Time columns stay raw numbers in the
    log; the unit says how to read them.
    """
    text = source_type.strip().lower()
    base, _, rest = text.partition("(")
    base = base.split()[0]
    args = rest.partition(")")[0].replace(" ", "")
    if base in ("bigint", "bigserial", "int8"):
        return "bigint", None
    if base in ("tinyint", "smallint", "mediumint", "int", "integer", "serial", "int2", "int4"):
        return "int", None
    if base in ("decimal", "numeric"):
        return (f"decimal({args or '10,0'})", None) if exact else ("double", None)
    if base in ("double", "float", "real", "float4", "float8"):
        return "double", None
    if base in ("bool", "boolean"):
        return "boolean", None
    if base == "date":
        return "int", "days"
    if base == "datetime":
        return "bigint", "us" if args and int(args) > 3 else "ms"
    if base == "timestamp":
        return "bigint", "ms" if args and int(args) <= 3 else "us"
    return "string", None


def with_times(rows: DataFrame, table: Table, suffix: str = "_ts") -> DataFrame:
    """Add a timestamp or date column next to each raw time column."""
    return rows.withColumns({f"{name}{suffix}": to_time(rows[name], unit) for name, unit in table.units.items()})


# Columns and keys of the personnel, sales and demo tables.
EMPLOYEES = Table("employees", ("emp_id",), "emp_id bigint, name string, department string, salary double")
ATTENDANCE = Table(
    "attendance",
    ("id",),
    "id bigint, emp_id bigint, check_in bigint, check_out bigint, status string",
    target="attendance_analytics",
    required=("emp_id",),
    units={"check_in": "ms", "check_out": "ms"},
)
LEAVE_REQUESTS = Table(
    "leave_requests",
    ("id",),
    "id bigint, emp_id bigint, leave_type string, start_date int, end_date int, days int, status string, reason string",
    required=("emp_id",),
    units={"start_date": "days", "end_date": "days"},
)
PAYROLL = Table(
    "payroll",
    ("id",),
    "id bigint, emp_id bigint, `month` string, base_salary double, deduction double, bonus double, net_salary double",
    required=("emp_id",),
)
CUSTOMERS = Table(
    "customers",
    ("cus_id",),
    "cus_id bigint, name string, email string, create_at int, region string, segment string, registered_channel string",
    required=(),
    units={"create_at": "days"},
)
ORDERS = Table("orders", ("id",), "id bigint, cus_id bigint, amount bigint, order_at bigint", units={"order_at": "ms"})
PRODUCTS = Table(
    "products",
    ("product_id",),
    "product_id bigint, name string, category string, price bigint",
    target="product_catalog",
    required=(),
)
ORDER_ITEMS = Table(
    "order_items",
    ("item_id",),
    "item_id bigint, order_id bigint, product_id bigint, quantity bigint, unit_price bigint",
    required=(),
)
CUSTOMER_EVENTS = Table(
    "customer_events",
    ("event_id",),
    "event_id bigint, cus_id bigint, event_type string, event_at bigint",
    units={"event_at": "ms"},
)

HRM = Registry(
    "hrm",
    "hrm",
    (
        replace(EMPLOYEES, required=()),
        replace(ATTENDANCE, derive=transforms.attendance_columns),
        LEAVE_REQUESTS,
        replace(PAYROLL, derive=transforms.payroll_columns),
    ),
)
"""Personnel tables with the full derived columns."""

HRM_BASIC = Registry(
    "hrm",
    "hrm",
    (
        EMPLOYEES,
        replace(LEAVE_REQUESTS, required=None),
        replace(PAYROLL, required=None),
        replace(ATTENDANCE, derive=transforms.attendance_basic_columns),
    ),
)
"""Personnel tables as plain copies, with hours and status only for attendance."""


def hrm_reduced(source: str = "mysql") -> Registry:
    """The reduced personnel set of a MySQL or Postgres source.

    They differ in the schema part of the topic and in the unit of time columns: a Postgres ``timestamp``
    is captured in microseconds.
    """
    prefix, schema, unit = {"mysql": ("hrm_mysql", "hrm", "ms"), "postgres": ("hrm_pg", "public", "us")}[source]
    attendance = partial(transforms.attendance_reduced_columns, unit=unit)
    return Registry(
        prefix,
        schema,
        (
            replace(EMPLOYEES, required=()),
            replace(ATTENDANCE, required=(), derive=attendance, units={"check_in": unit, "check_out": unit}),
            replace(LEAVE_REQUESTS, required=()),
            replace(PAYROLL, target="payroll_analytics", required=(), derive=transforms.payroll_flat_columns),
        ),
    )


CRM = Registry("crm", "crm", (CUSTOMERS, ORDERS, PRODUCTS, ORDER_ITEMS, CUSTOMER_EVENTS))

DEMO = Registry(
    "hrm_demo", "public", (Table("employees", ("id",), "id bigint, name string, salary double", required=()),)
)

# The administration tables, their keys where these are not ``id``, and their target names where
# these differ.
ADMIN_TABLES = """
adm_ministry adm_department adm_branch adm_procedure
admin_procedures admin_document_definitions admin_doc_def_versions admin_procedure_documents
admin_applications admin_app_documents admin_app_logs
enterprise enterprises enterprise_response
dossiers dossier_legacy dossier_status_historys dossier_status_history processing_result result_goods
goods_declaration goods_certificate
dn_enterprise dn_inspection_dossier dn_documents dn_dossier_history dn_inspection_result
dn_inspection_result_document dn_products dn_signatures
registrations registration_statuses registration_audit_log registration_data registration_documents
registration_history registration_versions
alerts alert_audit_logs audit_logs
invoices invoice_items orders order_items products product_categories
qc_enterprise qc_application qc_application_status qc_application_status_history qc_application_goods
qc_application_attachments qc_application_import_docs qc_audit_log qc_ministry qc_procedure
applications application_documents document_definition_versions
files file_links attachment attachments
app_user auth_config messages message_store routing_messages received_responses response_packages
signatures signature_info signature_verification_log
planning procedures procedure_documents sync_sessions
system_limits system_limit_audits storage_config theme_config status_codes asset
flyway_schema_history test_table
""".split()
ADMIN_KEYS = {
    "enterprise": "tax_code",
    "dossiers": "dossier_id",
    "registration_statuses": "code",
    "registration_data": "data_id",
    "alerts": "alert_id",
    "attachment": "attachment_id",
    "signatures": "signature_id",
    "procedures": "code",
    "sync_sessions": "sync_id",
    "system_limits": "limit_id",
    "status_codes": "code",
    "flyway_schema_history": "installed_rank",
    "test_table": "column1",
}
ADMIN_TARGETS = {"files": "sys_files"}
# The columns that the administration views read. All other columns come from the catalogue.
ADMIN_COLUMNS = {
    "dossiers": "dossier_id string, tax_code string, procedure_type string, submitted_at bigint, "
    "processed_at bigint, status string, is_deleted int",
    "alerts": "alert_id string, alert_type string, severity string, status string",
    "registrations": "id string, amend_version int, enterprise_id string, procedure_code string, status string, "
    "procedure_name string",
    "invoices": "id string, amount double, status string",
    "enterprise": "tax_code string, enterprise_name string",
    "dn_inspection_result": "id bigint, inspection_dossier_id bigint, result_content string",
    "test_table": "column1 string",
}
ADMIN_UNITS = {"dossiers": {"submitted_at": "us", "processed_at": "us"}}

ADMIN = Registry(
    "admin_db",
    "admin_db",
    tuple(
        Table(
            name,
            (ADMIN_KEYS.get(name, "id"),),
            ADMIN_COLUMNS.get(name),
            target=ADMIN_TARGETS.get(name),
            units=ADMIN_UNITS.get(name, {}),
        )
        for name in ADMIN_TABLES
    ),
)
"""The administration tables, plain copies. Call ``resolve`` with the source's column catalogue before use."""
