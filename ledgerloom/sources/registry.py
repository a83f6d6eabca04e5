"""Declared source tables: columns, types and primary keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class SourceColumn:
    source_name: str
    name: str
    type: str
    nullable: bool = False


@dataclass(frozen=True)
class SourceTable:
    name: str
    primary_key: tuple[str, ...]
    columns: tuple[SourceColumn, ...]

    def schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(c.name, T.DataType.fromDDL(c.type), c.nullable)
                for c in self.columns
            ]
        )

    def source_key(self) -> tuple[str, ...]:
        by_name = {c.name: c.source_name for c in self.columns}
        return tuple(by_name[k] for k in self.primary_key)


def _table(name: str, primary_key: tuple[str, ...], *columns: tuple) -> SourceTable:
    return SourceTable(name, primary_key, tuple(SourceColumn(*c) for c in columns))


# The eight source tables. Per column: name at the source, name here, type,
# and True where NULL is allowed. Long texts and pictures that no product uses are not read.
SOURCES: dict[str, SourceTable] = {
    t.name: t
    for t in (
        _table(
            "offices",
            ("office_code",),
            ("officeCode", "office_code", "string"),
            ("city", "city", "string"),
            ("phone", "phone", "string"),
            ("addressLine1", "address_line1", "string"),
            ("addressLine2", "address_line2", "string", True),
            ("state", "state", "string", True),
            ("country", "country", "string"),
            ("postalCode", "postal_code", "string"),
            ("territory", "territory", "string"),
        ),
        _table(
            "employees",
            ("employee_number",),
            ("employeeNumber", "employee_number", "int"),
            ("lastName", "last_name", "string"),
            ("firstName", "first_name", "string"),
            ("extension", "extension", "string"),
            ("email", "email", "string"),
            ("officeCode", "office_code", "string"),
            ("reportsTo", "reports_to", "int", True),
            ("jobTitle", "job_title", "string"),
        ),
        _table(
            "customers",
            ("customer_number",),
            ("customerNumber", "customer_number", "int"),
            ("customerName", "customer_name", "string"),
            ("contactLastName", "contact_last_name", "string"),
            ("contactFirstName", "contact_first_name", "string"),
            ("phone", "phone", "string"),
            ("addressLine1", "address_line1", "string"),
            ("addressLine2", "address_line2", "string", True),
            ("city", "city", "string"),
            ("state", "state", "string", True),
            ("postalCode", "postal_code", "string", True),
            ("country", "country", "string"),
            ("salesRepEmployeeNumber", "sales_rep_employee_number", "int", True),
            ("creditLimit", "credit_limit", "decimal(10,2)", True),
        ),
        _table(
            "productlines",
            ("product_line",),
            ("productLine", "product_line", "string"),
            ("textDescription", "text_description", "string", True),
        ),
        _table(
            "products",
            ("product_code",),
            ("productCode", "product_code", "string"),
            ("productName", "product_name", "string"),
            ("productLine", "product_line", "string"),
            ("productScale", "product_scale", "string"),
            ("productVendor", "product_vendor", "string"),
            ("productDescription", "product_description", "string"),
            ("quantityInStock", "quantity_in_stock", "smallint"),
            ("buyPrice", "buy_price", "decimal(10,2)"),
            ("MSRP", "msrp", "decimal(10,2)"),
        ),
        _table(
            "orders",
            ("order_number",),
            ("orderNumber", "order_number", "int"),
            ("orderDate", "order_date", "date"),
            ("requiredDate", "required_date", "date"),
            ("shippedDate", "shipped_date", "date", True),
            ("status", "status", "string"),
            ("customerNumber", "customer_number", "int"),
        ),
        _table(
            "orderdetails",
            ("order_number", "product_code"),
            ("orderNumber", "order_number", "int"),
            ("productCode", "product_code", "string"),
            ("quantityOrdered", "quantity_ordered", "int"),
            ("priceEach", "price_each", "decimal(10,2)"),
            ("orderLineNumber", "order_line_number", "smallint"),
        ),
        _table(
            "payments",
            ("customer_number", "check_number"),
            ("customerNumber", "customer_number", "int"),
            ("checkNumber", "check_number", "string"),
            ("paymentDate", "payment_date", "date"),
            ("amount", "amount", "decimal(10,2)"),
        ),
    )
}


def conform(df: DataFrame, table: SourceTable, extra: tuple[str, ...] = ()) -> DataFrame:
    """Pick the declared columns, under their names here and in their declared types, and the
    ``extra`` ones as they are."""
    present = {c.lower(): c for c in df.columns}
    picked, missing = [], []
    for column in table.columns:
        found = present.get(column.source_name.lower(), present.get(column.name.lower()))
        if found is None:
            missing.append(column.source_name)
        else:
            picked.append(F.col(f"`{found}`").cast(column.type).alias(column.name))
    if missing:
        raise ValueError(f"source {table.name} lacks columns {', '.join(missing)}")
    return df.select(*picked, *extra)


def require_columns(df: DataFrame, table: SourceTable) -> DataFrame:
    """The frame itself, once it is known to carry every declared column."""
    missing = [c.name for c in table.columns if c.name not in df.columns]
    if missing:
        raise ValueError(f"source {table.name} lacks columns {', '.join(missing)}")
    return df
