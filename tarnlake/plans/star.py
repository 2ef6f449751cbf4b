"""The retail star: its dimensions, its three fact feeds and their silver tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from tarnlake.functions import LINEAGE_COLUMNS
from tarnlake.operators.roles import Role


@dataclass(frozen=True)
class Feed:
    """One fact feed: the schema it lands in and the silver table made of it."""

    name: str
    schema: str
    roles: tuple[Role, ...]
    silver_columns: tuple[str, ...]
    measures: tuple[str, ...] = ()

    @property
    def bronze_table(self) -> str:
        return f"{self.name}_bronze"

    @property
    def silver_table(self) -> str:
        return f"{self.name}_silver"


# The data model. Table, column and key names below are what the feeds
# and their readers use.

DIMENSION_KEYS: Mapping[str, str] = {
    "dim_customer": "customer_key",
    "dim_date": "date_key",
    "dim_employee": "employee_key",
    "dim_invoice": "invoice_key",
    "dim_product": "product_key",
    "dim_shipper": "shipper_key",
    "dim_supplier": "supplier_key",
}

CUSTOMER_SCHEMA = """
    customer_key BIGINT, company STRING, last_name STRING, first_name STRING,
    job_title STRING, business_phone STRING, fax_number STRING, address STRING,
    city STRING, state_province STRING, zip_postal_code STRING, country_region STRING
"""
SUPPLIER_SCHEMA = """
    supplier_key BIGINT, company STRING, last_name STRING, first_name STRING,
    job_title STRING
"""
INVOICE_SCHEMA = """
    invoice_key BIGINT, order_key BIGINT, invoice_date STRING, due_date STRING,
    tax DOUBLE, shipping DOUBLE, amount_due DOUBLE
"""
EMPLOYEE_SCHEMA = """
    employee_key BIGINT, company STRING, last_name STRING, first_name STRING,
    email_address STRING, job_title STRING, business_phone STRING, home_phone STRING,
    fax_number STRING, address STRING, city STRING, state_province STRING,
    zip_postal_code STRING, country_region STRING, web_page STRING
"""
SHIPPER_SCHEMA = """
    shipper_key BIGINT, company STRING, address STRING, city STRING,
    state_province STRING, zip_postal_code STRING, country_region STRING
"""
PRODUCT_SCHEMA = """
    product_key BIGINT, product_code STRING, product_name STRING,
    standard_cost DOUBLE, list_price DOUBLE, category STRING
"""

ORDERS_SCHEMA = """
    fact_order_key BIGINT, order_key BIGINT, employee_key BIGINT, customer_key BIGINT,
    product_key BIGINT, shipper_key BIGINT, order_date_key BIGINT, paid_date_key BIGINT,
    shipped_date_key BIGINT, quantity BIGINT, unit_price DOUBLE, discount DOUBLE,
    shipping_fee DOUBLE, taxes DOUBLE, tax_rate DOUBLE, payment_type STRING,
    order_status STRING, order_details_status STRING
"""
PURCHASE_ORDERS_SCHEMA = """
    fact_purchase_order_key BIGINT, purchase_order_key BIGINT, supplier_key BIGINT,
    product_key BIGINT, inventory_key BIGINT, created_by BIGINT,
    purchase_order_status STRING, po_detail_posted_to_inventory BIGINT,
    po_detail_unit_cost DOUBLE, po_detail_quantity BIGINT, shipping_fee DOUBLE,
    taxes DOUBLE, payment_date STRING, payment_amount DOUBLE, approved_by BIGINT,
    submitted_by BIGINT, submitted_date_key BIGINT, creation_date_key BIGINT,
    po_detail_date_received_key BIGINT, approved_date_key BIGINT
"""
INVENTORY_TRANSACTIONS_SCHEMA = """
    fact_inventory_transaction_key BIGINT, inventory_transaction_key BIGINT,
    product_key BIGINT, transaction_created_date_key BIGINT,
    transaction_modified_date_key BIGINT, inventory_transaction_type STRING,
    quantity BIGINT, purchase_order_key BIGINT, order_key BIGINT
"""

PRODUCT_ATTRS = {
    "product_code": "product_code",
    "product_name": "product_name",
    "standard_cost": "product_standard_cost",
    "list_price": "product_list_price",
    "category": "product_category",
}
PERSON = ("first_name", "last_name", "job_title", "company")
CONTACT = ("company", "last_name", "first_name", "job_title")
PLACE = ("company", "state_province", "country_region")
DAY = ("day_name_of_week", "day_of_month", "weekday_weekend", "month_name")
PERIODS = ("calendar_quarter", "calendar_year")


def _day_attrs(prefix: str, short: bool) -> dict[str, str]:
    # Some roles drop "calendar" from the names of their quarter and year.
    periods = {name: f"{prefix}_{name.removeprefix('calendar_') if short else name}" for name in PERIODS}
    return {name: f"{prefix}_{name}" for name in DAY} | periods


def _date(fact_key: str, prefix: str, short: bool = True) -> Role:
    return Role("dim_date", fact_key, "date_key", _day_attrs(prefix, short), "left")


def _person(fact_key: str) -> Role:
    return Role.prefixed("dim_employee", fact_key, "employee_key", fact_key, PERSON, "left")


_product = Role("dim_product", "product_key", "product_key", PRODUCT_ATTRS)
_customer = Role.prefixed(
    "dim_customer", "customer_key", "customer_key", "customer", ("last_name", "first_name")
)
_employee = Role.prefixed(
    "dim_employee", "employee_key", "employee_key", "employee",
    ("last_name", "first_name", "job_title", "company"),
)
_shipper = Role.prefixed("dim_shipper", "shipper_key", "shipper_key", "shipper", PLACE)
_supplier = Role.prefixed("dim_supplier", "supplier_key", "supplier_key", "supplier", CONTACT)


def _keyed(*roles: Role) -> tuple[str, ...]:
    """Each role's fact key followed by its attributes: the column order of silver."""
    return tuple(name for role in roles for name in (role.fact_key, *role.attrs.values()))


# Roles are listed large dimensions first, since that is the order they are joined in.
# The columns keep the order their readers expect.

_order_dates = (
    _date("order_date_key", "order"),
    _date("paid_date_key", "paid", short=False),
    _date("shipped_date_key", "shipped", short=False),
)
ORDERS = Feed(
    name="fact_orders",
    schema=ORDERS_SCHEMA,
    roles=(_customer, _product, _employee, _shipper, *_order_dates),
    silver_columns=(
        "fact_order_key",
        "order_key",
        *_keyed(_employee, _customer, _product, _shipper, *_order_dates),
        "quantity",
        "unit_price",
        "discount",
        "shipping_fee",
        "taxes",
        "tax_rate",
        "payment_type",
        "order_status",
        "order_details_status",
    ),
    measures=("quantity", "unit_price"),
)

_people = (_person("submitted_by"), _person("approved_by"), _person("created_by"))
_purchase_dates = (
    _date("creation_date_key", "creation"),
    _date("submitted_date_key", "submitted"),
    _date("po_detail_date_received_key", "received"),
)
PURCHASE_ORDERS = Feed(
    name="fact_purchase_orders",
    schema=PURCHASE_ORDERS_SCHEMA,
    roles=(_product, _supplier, *_people, *_purchase_dates),
    silver_columns=(
        "fact_purchase_order_key",
        "purchase_order_key",
        *_keyed(*_people, _product, _supplier, *_purchase_dates),
        "po_detail_quantity",
        "po_detail_unit_cost",
        "shipping_fee",
        "taxes",
        "purchase_order_status",
        "payment_amount",
        "payment_date",
        *LINEAGE_COLUMNS,
    ),
    measures=("po_detail_quantity", "po_detail_unit_cost"),
)

_transaction_dates = (
    _date("transaction_created_date_key", "transaction_created"),
    _date("transaction_modified_date_key", "transaction_modified"),
)
INVENTORY_TRANSACTIONS = Feed(
    name="fact_inventory_transactions",
    schema=INVENTORY_TRANSACTIONS_SCHEMA,
    roles=(_product, *_transaction_dates),
    silver_columns=(
        "fact_inventory_transaction_key",
        *_keyed(_product, *_transaction_dates),
        "inventory_transaction_type",
        "quantity",
    ),
    measures=("quantity",),
)

FEEDS = (ORDERS, PURCHASE_ORDERS, INVENTORY_TRANSACTIONS)

GOLD_MONTHLY_ORDERS = "fact_monthly_orders_by_customer_gold"
GOLD_PRODUCT_ORDERS = "fact_product_orders_by_customer_gold"
GOLD_PURCHASE_VALUE = "fact_orders_per_supplier_gold"
GOLD_QUARTER_QUANTITIES = "fact_inventory_quantity_by_quarter_gold"
