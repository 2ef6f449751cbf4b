"""Dimensions from files to audited tables, the way a lake is first filled."""

from datetime import date

from fixtures import bag, lake, land_array

from tarnlake.functions import date_dimension
from tarnlake.operators import audit_database, preview, replace_collections
from tarnlake.plans import star
from tarnlake.sources import read_csv_dim, read_documents

CUSTOMERS = [
    {"customer_key": 1, "company": "A", "last_name": "Pérez", "first_name": "Ana", "zip_postal_code": "01234"},
    {"customer_key": 2, "company": "B", "last_name": "Ødegård", "first_name": "Bo", "notes": "not wanted"},
]
INVOICES = [
    {"invoice_key": 5, "order_key": 30, "invoice_date": "2024-01-15 00:00:00", "due_date": None, "tax": 0,
     "shipping": 2.5, "amount_due": 100},
]
EMPLOYEES = """employee_key,company,last_name,first_name,email_address,job_title,business_phone,home_phone,\
fax_number,address,city,state_province,zip_postal_code,country_region,web_page
1,House,Dahl,Eva,e@house.example,"Keeper, Night Shift",1,2,3,"1 ""High"" St",Ulm,BW,00123,DE,#w#
2,House,Falk,Gus,,,,,,,,,,,
"""


def names(schema):
    return [part.split()[0] for part in schema.split(",")]


def test_dimensions_from_files(spark, tmp_path):
    land_array(tmp_path / "in", "customers.json", CUSTOMERS)
    land_array(tmp_path / "in", "invoices.json", INVOICES)
    (tmp_path / "in" / "employees.csv").write_text(EMPLOYEES, encoding="utf-8")
    loaded = replace_collections(
        spark,
        {name: str(tmp_path / "in" / f"{name}.json") for name in ("customers", "invoices")},
        str(tmp_path / "documents"),
    )
    assert bag(loaded.collect()) == bag([("customers", 2), ("invoices", 1)])

    def documents(name, schema):
        return read_documents(
            spark, "json", names(schema), str(tmp_path / "documents" / name), schema=schema
        )

    lk = lake(spark, tmp_path / "lake")
    tables = lk.load_dims(
        {
            "dim_customer": documents("customers", star.CUSTOMER_SCHEMA),
            "dim_invoice": documents("invoices", star.INVOICE_SCHEMA),
            "dim_employee": read_csv_dim(spark, str(tmp_path / "in" / "employees.csv"), star.EMPLOYEE_SCHEMA),
            "dim_date": date_dimension(spark, date(2024, 1, 1), date(2024, 1, 31)),
        }
    )
    assert tables["dim_customer"].columns == names(star.CUSTOMER_SCHEMA)
    first = preview(tables["dim_customer"], "customer_key", 1).first()
    assert (first.last_name, first.zip_postal_code, first.job_title) == ("Pérez", "01234", None)
    clerk = preview(tables["dim_employee"], "employee_key", 1).first()
    assert (clerk.job_title, clerk.address, clerk.zip_postal_code) == (
        "Keeper, Night Shift", '1 "High" St', "00123",
    )
    invoice = tables["dim_invoice"].first()
    assert (invoice.invoice_date, invoice.tax) == ("2024-01-15 00:00:00", 0.0)
    audit = {r.table_name: (r.row_count, r.duplicate_keys) for r in
             audit_database(spark, lk.database, star.DIMENSION_KEYS).collect()}
    assert audit == {"dim_customer": (2, 0), "dim_invoice": (1, 0), "dim_employee": (2, 0), "dim_date": (31, 0)}
