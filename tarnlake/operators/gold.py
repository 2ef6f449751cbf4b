"""Gold aggregates over silver tables.

Column names in the results are fixed by the data model. None of these sort: a table
has no read order, so order the result where it is read (``preview.top``) or ask
``create_gold`` to cluster the files.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.operators.roles import Role, enrich
from tarnlake.operators.skew import join_counted


def monthly_product_count(silver: DataFrame, by_year: bool = False) -> DataFrame:
    """Order lines per customer and month name. Years merge unless ``by_year``."""
    year = [F.col("order_year").alias("OrderYear")] if by_year else []
    return silver.groupBy(
        F.col("customer_key").alias("CustomerID"),
        F.col("customer_last_name").alias("LastName"),
        F.col("customer_first_name").alias("FirstName"),
        *year,
        F.col("order_month_name").alias("OrderMonth"),
    ).agg(F.count("product_key").alias("ProductCount"))


def monthly_product_count_by_key(
    facts: DataFrame,
    dims: Mapping[str, DataFrame],
    count: Column | None = None,
    by_year: bool = False,
) -> DataFrame:
    """``monthly_product_count`` of facts not yet enriched: count on keys, then name.

    Only customer and order date are joined. The customer dimension meets one row per
    customer and month, not one per line, so neither the names nor a customer with a
    third of the lines are ever shuffled line by line. ``count`` may replace the count
    of lines, for facts that are already counted in part.
    """
    calendar = {"month_name": "OrderMonth"}
    if by_year:
        calendar["calendar_year"] = "OrderYear"
    months = list(calendar.values())
    keyed = (
        enrich(facts, dims, [Role("dim_date", "order_date_key", "date_key", calendar, "left")])
        .groupBy("customer_key", *months)
        .agg((F.count("product_key") if count is None else count).alias("ProductCount"))
    )
    names = {"last_name": "LastName", "first_name": "FirstName"}
    return enrich(keyed, dims, [Role("dim_customer", "customer_key", "customer_key", names)]).select(
        F.col("customer_key").alias("CustomerID"),
        "LastName",
        "FirstName",
        *reversed(months),
        "ProductCount",
    )


Keep = Callable[[DataFrame], DataFrame]


def customer_line_totals(silver: DataFrame, keep: Keep | None = None, share: float = 1e-5) -> DataFrame:
    """One row per order line, with the line count of its customer.

    The count is aggregated first (map-side, so a customer of any size is one small
    row per task) and joined back. A window over the customer would need no second
    read, but it would sort all lines of one customer in one task. ``keep`` and ``share``
    are those of ``join_counted``.
    """
    totals = (
        silver.groupBy(F.col("customer_key").alias("CustomerID"))
        .agg(F.count("product_key").alias("ProductCount"), F.count(F.lit(1)).alias("lines"))
    )
    lines = silver.select(
        "customer_key",
        F.col("customer_last_name").alias("CustomerName"),
        F.col("product_key").alias("ProductNumber"),
    )
    return join_counted(lines, totals, "customer_key", "CustomerID", "lines", share, keep).select(
        "CustomerID", "CustomerName", "ProductNumber", "ProductCount"
    )


def customer_line_totals_by_key(
    facts: DataFrame, dims: Mapping[str, DataFrame], keep: Keep | None = None, share: float = 1e-5
) -> DataFrame:
    """``customer_line_totals`` of facts not yet enriched.

    The name is put to the customer's count instead of to each line, so lines are joined
    once and carry two keys. Names are those of now, not of when a line was loaded.
    """
    totals = facts.groupBy("customer_key").agg(
        F.count("product_key").alias("ProductCount"), F.count(F.lit(1)).alias("lines")
    )
    name = Role("dim_customer", "customer_key", "customer_key", {"last_name": "CustomerName"})
    named = enrich(totals, dims, [name]).withColumnRenamed("customer_key", "CustomerID")
    lines = facts.select("customer_key", F.col("product_key").alias("ProductNumber"))
    return join_counted(lines, named, "customer_key", "CustomerID", "lines", share, keep).select(
        "CustomerID", "CustomerName", "ProductNumber", "ProductCount"
    )


def _money(price: str) -> Column:
    # Sums of doubles depend on their order, and rounding then tips over; decimals do not.
    return F.col(price).cast("decimal(18,4)")


def purchase_value(silver: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Quantity times list price per supplier and product name, at the dimensions of now.

    Quantities are summed per key pair before the dimensions are joined; the price is a
    function of the product key, so it factors out of that sum.
    """
    pairs = silver.groupBy("supplier_key", "product_key").agg(
        F.sum("po_detail_quantity").alias("quantity")
    )
    named = enrich(
        pairs,
        dims,
        [
            Role(
                "dim_product",
                "product_key",
                "product_key",
                {"product_name": "product_name", "list_price": "list_price"},
            ),
            Role("dim_supplier", "supplier_key", "supplier_key", {"company": "supplier_company"}),
        ],
    )
    return named.groupBy("supplier_company", "product_name").agg(
        F.sum(F.col("quantity") * _money("list_price")).cast("double").alias("total_list_price")
    )


def purchase_value_as_loaded(silver: DataFrame) -> DataFrame:
    """``purchase_value`` at the names and prices each silver row was loaded with."""
    return silver.groupBy("supplier_company", "product_name").agg(
        F.sum(F.col("po_detail_quantity") * _money("product_list_price")).cast("double").alias("total_list_price")
    )


def quarter_quantities_by_product_key(
    transactions: DataFrame, dims: Mapping[str, DataFrame], by_year: bool = False
) -> DataFrame:
    """Quantity by created quarter, type and product key; batch or streaming.

    The part of ``quarter_quantities_by_product`` that may hold stream state: only the
    calendar is joined before the aggregate, so the shuffle carries partial sums.
    """
    calendar = {"calendar_quarter": "created_quarter"}
    if by_year:
        calendar["calendar_year"] = "created_year"
    created = Role("dim_date", "transaction_created_date_key", "date_key", calendar, "left")
    return (
        enrich(transactions, dims, [created])
        .groupBy(*calendar.values(), "inventory_transaction_type", "product_key")
        .agg(F.sum("quantity").alias("quantity"))
    )


def quarter_quantities_by_product(
    keyed: DataFrame, dims: Mapping[str, DataFrame], how: str = "left"
) -> DataFrame:
    """Product names put to the keyed sums, products of one name merged.

    ``keyed`` comes from ``quarter_quantities_by_product_key``: directly in batch, or as
    the finishing step of a complete-mode stream. A product without a name stays, as null,
    unless ``how`` is ``inner``, which also leaves out sums of products that are not known.
    """
    by = [name for name in keyed.columns if name not in ("product_key", "quantity")]
    product = Role("dim_product", "product_key", "product_key", {"product_name": "product_name"}, how)
    return (
        enrich(keyed, dims, [product])
        .groupBy(*by, "product_name")
        .agg(F.sum("quantity").alias("total_quantity"))
    )
