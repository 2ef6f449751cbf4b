"""Invented rows in the shape of the feeds, with their awkward cases."""

from __future__ import annotations

import csv
import json
from collections import Counter
from datetime import date
from pathlib import Path
from uuid import uuid4

from tarnlake.functions import date_dimension
from tarnlake.plans import star
from tarnlake.plans.lake import Lake


# Column names and status words in the rows below are those of the data model
# that the feeds use. All other values are invented.


def bag(rows):
    return Counter(tuple(row) for row in rows)


def order(number, **changes):
    row = {
        "fact_order_key": number,
        "order_key": 500 + number // 2,
        "employee_key": 1 + number % 3,
        "customer_key": 1 + number % 4,
        "product_key": 1 + number % 5,
        "shipper_key": 1 + number % 2,
        "order_date_key": 20240100 + number,
        "paid_date_key": 20240200 + number,
        "shipped_date_key": 20240300 + number,
        "quantity": 10 * number,
        "unit_price": 2.5 * number,
        "discount": 0.0,
        "shipping_fee": 4.0,
        "taxes": 0.0,
        "tax_rate": 0.0,
        "payment_type": "Card",
        "order_status": "Closed",
        "order_details_status": "Invoiced",
    }
    return row | changes


def purchase(number, **changes):
    row = {
        "fact_purchase_order_key": number,
        "purchase_order_key": 900 + number,
        "supplier_key": 1 + number % 2,
        "product_key": 1 + number % 5,
        "inventory_key": number,
        "created_by": 1,
        "purchase_order_status": "Approved",
        "po_detail_posted_to_inventory": 1,
        "po_detail_unit_cost": 1.25 * number,
        "po_detail_quantity": 3 * number,
        "shipping_fee": 0.0,
        "taxes": 0.0,
        "payment_date": None,
        "payment_amount": 0.0,
        "approved_by": 2,
        "submitted_by": 3,
        "submitted_date_key": 20240110 + number,
        "creation_date_key": 20240110 + number,
        "po_detail_date_received_key": 20240120 + number % 5,
        "approved_date_key": 20240120,
    }
    return row | changes


def transaction(number, **changes):
    row = {
        "fact_inventory_transaction_key": number,
        "inventory_transaction_key": 70 + number,
        "product_key": 1 + number % 5,
        "transaction_created_date_key": (20240115, 20240420)[number % 2],
        "transaction_modified_date_key": 20240421,
        "inventory_transaction_type": ("Purchased", "Sold", "On Hold")[number % 3],
        "quantity": number,
        "purchase_order_key": None,
        "order_key": None,
    }
    return row | changes


# Nothing shipped, nothing paid, an unknown customer, the word None, a day of no calendar.
ORDERS_CLEAN = [order(n) for n in range(1, 8)]
ORDERS_ODD = [
    order(8, shipper_key=None, shipped_date_key=None),
    order(9, paid_date_key=None, payment_type=None),
    order(10, customer_key=99),
    order(11, order_details_status="None"),
    order(12, order_date_key=19000101),
    order(13, customer_key=None),
    order(14, product_key=None),
]
PURCHASES = [
    *[purchase(n) for n in range(1, 6)],
    purchase(6, created_by=None, approved_by=None, submitted_date_key=None),
    purchase(7, supplier_key=77),
    purchase(8, po_detail_date_received_key=None, inventory_key=None),
]
TRANSACTIONS = [transaction(n) for n in range(1, 20)] + [
    transaction(20, product_key=55),
    transaction(21, transaction_created_date_key=None),
]


def frame(spark, rows, schema):
    fields = spark.createDataFrame([], schema).columns
    return spark.createDataFrame([tuple(row.get(f) for f in fields) for row in rows], schema)


def dims(spark):
    people = [("Äström", "Ida"), ("Brown", "Max"), ("Cole", "Zoë"), ("Brown", "Max")]
    return {
        "dim_customer": frame(
            spark,
            [{"customer_key": i, "last_name": n, "first_name": f} for i, (n, f) in enumerate(people, 1)],
            star.CUSTOMER_SCHEMA,
        ),
        "dim_employee": frame(
            spark,
            [
                {"employee_key": i, "last_name": f"Clerk{i}", "first_name": "Al", "job_title": "Clerk, Sales",
                 "company": "House"}
                for i in (1, 2, 3)
            ],
            star.EMPLOYEE_SCHEMA,
        ),
        # Products 4 and 5 share a name.
        "dim_product": frame(
            spark,
            [
                {"product_key": i, "product_code": f"P-{i}", "product_name": f"Tea {min(i, 4)}",
                 "standard_cost": 1.0 * i, "list_price": 2.5 * i, "category": "Tea"}
                for i in range(1, 6)
            ],
            star.PRODUCT_SCHEMA,
        ),
        "dim_shipper": frame(
            spark,
            [{"shipper_key": i, "company": f"Van {i}", "state_province": "X", "country_region": "Y"} for i in (1, 2)],
            star.SHIPPER_SCHEMA,
        ),
        "dim_supplier": frame(
            spark,
            [{"supplier_key": i, "company": f"Maker {i}", "last_name": "L", "first_name": "F", "job_title": "J"}
             for i in (1, 2)],
            star.SUPPLIER_SCHEMA,
        ),
        "dim_date": date_dimension(spark, date(2024, 1, 1), date(2024, 12, 31)),
    }


def land_array(folder, name, rows):
    Path(folder).mkdir(parents=True, exist_ok=True)
    Path(folder, name).write_text(json.dumps(rows, ensure_ascii=False, indent=1), encoding="utf-8")


def land_csv(folder, name, rows):
    """CSV with NULL spelled out, whatever the file is called."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    with open(Path(folder, name), "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(rows[0])
        writer.writerows([["NULL" if v is None else v for v in row.values()] for row in rows])


def lake(spark, root, **options) -> Lake:
    return Lake(spark, f"lake_{uuid4().hex[:8]}", str(root), **options).create()
