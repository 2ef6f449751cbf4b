"""The retail star seen in a set of order-processing tables.

Maps ``region nation customer supplier part orders lineitem`` to the dimensions and fact
feeds of ``star``. Key nulls, which those tables lack, follow from status columns: an
order in progress has no payment day and part of it no shipper.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import cached_property
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.functions import date_dimension_for, date_key
from tarnlake.operators.roles import Role
from tarnlake.plans.workspace import run_folder, stored, written_at


def _priority() -> Column:
    # Reads '1-URGENT' to '5-LOW'; the digit stands for who handled the order.
    return F.substring("o_orderpriority", 1, 1).cast("bigint")


def _line_key() -> Column:
    return F.col("l_orderkey") * 8 + F.col("l_linenumber")


class SampleStar:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("customer_key"),
            F.col("c_name").alias("last_name"),
            F.col("c_mktsegment").alias("first_name"),
        )

    @cached_property
    def dim_product(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_key"),
            F.col("p_brand").alias("product_code"),
            F.col("p_name").alias("product_name"),
            (F.col("p_retailprice") / 2).alias("standard_cost"),
            F.col("p_retailprice").alias("list_price"),
            F.col("p_type").alias("category"),
        )

    @cached_property
    def dim_supplier(self) -> DataFrame:
        nation = self.table("nation")
        return (
            self.table("supplier")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("supplier_key"),
                F.col("s_name").alias("company"),
                F.col("n_name").alias("last_name"),
                F.substring("s_name", 10, 9).alias("first_name"),
                F.lower("n_name").alias("job_title"),
            )
        )

    @cached_property
    def dim_employee(self) -> DataFrame:
        region = self.table("region")
        return (
            self.table("nation")
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("n_nationkey").cast("bigint").alias("employee_key"),
                F.col("r_name").alias("company"),
                F.col("n_name").alias("last_name"),
                F.lower("n_name").alias("first_name"),
                F.lower("r_name").alias("job_title"),
            )
        )

    @cached_property
    def dim_shipper(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").cast("bigint").alias("shipper_key"),
            F.col("r_name").alias("company"),
            F.lower("r_name").alias("state_province"),
            F.substring("r_name", 1, 2).alias("country_region"),
        )

    @cached_property
    def dim_date(self) -> DataFrame:
        """The calendar of all days of these tables: made once a session, then a stored table.

        Queries that join a date read it and not the facts' date columns once more, and
        Spark knows its size.
        """
        dated = (self.table("orders"), self.table("lineitem"))
        written = " ".join(written_at(self.spark, file) for table in dated for file in table.inputFiles())
        view = f"tarnlake_calendar_{sha256(f'{self.folder} {written}'.encode()).hexdigest()[:16]}"
        if not self.spark.catalog.tableExists(view):
            days = date_dimension_for(
                (dated[0], "o_orderdate"), (dated[1], "l_shipdate")
            )
            stored(days, run_folder(self.spark, "calendar")).createOrReplaceTempView(view)
        return self.spark.table(view)

    @property
    def dims(self) -> dict[str, DataFrame]:
        return self.dims_of(
            "dim_customer", "dim_date", "dim_employee", "dim_product", "dim_shipper", "dim_supplier"
        )

    def dims_of(self, *names: str) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in names}

    def dims_for(self, roles: Iterable[Role]) -> dict[str, DataFrame]:
        """The dimensions that play any of ``roles``."""
        return self.dims_of(*{role.dim: None for role in roles})

    def _lines_with_orders(self) -> DataFrame:
        return self.table("lineitem").join(
            self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")
        )

    def order_facts(self) -> DataFrame:
        in_progress = F.col("o_orderstatus") == "P"
        return self._lines_with_orders().select(
            _line_key().alias("fact_order_key"),
            F.col("l_orderkey").alias("order_key"),
            F.col("l_linenumber").cast("bigint").alias("employee_key"),
            F.col("o_custkey").alias("customer_key"),
            F.col("l_partkey").alias("product_key"),
            F.when(in_progress & (F.col("l_returnflag") == "N"), F.lit(None))
            .otherwise(_priority() - 1)
            .alias("shipper_key"),
            date_key("o_orderdate").alias("order_date_key"),
            F.when(F.col("o_orderstatus") == "F", date_key("o_orderdate")).alias("paid_date_key"),
            F.when(F.col("l_linestatus") == "F", date_key("l_shipdate")).alias("shipped_date_key"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            F.col("l_extendedprice").alias("unit_price"),
            F.col("l_discount").alias("discount"),
            F.col("o_totalprice").alias("shipping_fee"),
            (F.col("l_extendedprice") * F.col("l_tax")).alias("taxes"),
            F.col("l_tax").alias("tax_rate"),
            F.when(F.col("o_orderstatus") == "F", F.lit("Check")).alias("payment_type"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("l_linestatus").alias("order_details_status"),
        )

    def purchase_order_facts(self) -> DataFrame:
        filled = F.col("o_orderstatus") == "F"
        return self._lines_with_orders().select(
            _line_key().alias("fact_purchase_order_key"),
            F.col("l_orderkey").alias("purchase_order_key"),
            F.col("l_suppkey").alias("supplier_key"),
            F.col("l_partkey").alias("product_key"),
            F.when(F.col("l_linestatus") == "F", _line_key()).alias("inventory_key"),
            F.when(F.col("l_returnflag") != "N", F.col("l_linenumber")).cast("bigint").alias("created_by"),
            F.col("o_orderstatus").alias("purchase_order_status"),
            F.when(F.col("l_linestatus") == "F", 1).otherwise(0).cast("bigint")
            .alias("po_detail_posted_to_inventory"),
            F.col("l_extendedprice").alias("po_detail_unit_cost"),
            F.col("l_quantity").cast("bigint").alias("po_detail_quantity"),
            F.col("l_discount").alias("shipping_fee"),
            F.col("l_tax").alias("taxes"),
            F.lit(None).cast("string").alias("payment_date"),
            F.col("o_totalprice").alias("payment_amount"),
            F.when(filled, _priority()).alias("approved_by"),
            F.col("l_linenumber").cast("bigint").alias("submitted_by"),
            F.when(F.col("l_returnflag") != "A", date_key("o_orderdate")).alias("submitted_date_key"),
            date_key("o_orderdate").alias("creation_date_key"),
            F.when(F.col("l_linestatus") == "F", date_key("l_shipdate"))
            .alias("po_detail_date_received_key"),
            F.when(filled, date_key("o_orderdate")).alias("approved_date_key"),
        )

    def purchase_lines(self) -> DataFrame:
        """The part of the purchase facts that needs no order: keys and quantity."""
        return self.table("lineitem").select(
            F.col("l_suppkey").alias("supplier_key"),
            F.col("l_partkey").alias("product_key"),
            F.col("l_quantity").cast("bigint").alias("po_detail_quantity"),
        )

    def inventory_transaction_facts(self) -> DataFrame:
        return self.table("lineitem").select(
            _line_key().alias("fact_inventory_transaction_key"),
            F.col("l_orderkey").alias("inventory_transaction_key"),
            F.col("l_partkey").alias("product_key"),
            date_key("l_shipdate").alias("transaction_created_date_key"),
            F.when(F.col("l_linestatus") == "F", date_key("l_shipdate"))
            .alias("transaction_modified_date_key"),
            F.col("l_returnflag").alias("inventory_transaction_type"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            F.lit(None).cast("bigint").alias("purchase_order_key"),
            F.when(F.col("l_returnflag") == "R", F.col("l_orderkey")).alias("order_key"),
        )

    def orders_counted(self) -> DataFrame:
        """Order facts one per order, with ``lines`` counted before orders are joined.

        The count is taken on the join key, so it needs no shuffle beyond the join's own,
        and an order with many lines is one row by then.
        """
        lines = (
            self.table("lineitem").groupBy("l_orderkey").agg(F.count("l_partkey").alias("lines"))
        )
        return lines.join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_custkey").alias("customer_key"),
            date_key("o_orderdate").alias("order_date_key"),
            "lines",
        )
