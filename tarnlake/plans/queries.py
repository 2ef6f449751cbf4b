"""The registered queries: every operator, run over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.functions import LINEAGE_COLUMNS, with_lineage
from tarnlake.operators import (
    at_least,
    audit_database,
    audit_lake,
    create_gold,
    customer_line_totals,
    customer_line_totals_by_key,
    enrich,
    find_hot_keys,
    keeps_columns,
    monthly_product_count,
    monthly_product_count_by_key,
    not_shrunk,
    preview,
    purchase_value,
    purchase_value_as_loaded,
    quarter_quantities_by_product,
    quarter_quantities_by_product_key,
    replace_collections,
    top,
)
from tarnlake.operators.layout import clustered, manifest, read_ranges
from tarnlake.operators.sketches import RANK_ERROR, RELATIVE_ERROR
from tarnlake.plans.lake import Lake
from tarnlake.plans.landing import JSON_TIMESTAMPS, land_arrays, land_csv_lines, land_lines
from tarnlake.plans.sample_star import SampleStar
from tarnlake.plans.star import DIMENSION_KEYS, INVENTORY_TRANSACTIONS, ORDERS, PURCHASE_ORDERS, Feed
from tarnlake.plans.workspace import remove, run_folder, stored
from tarnlake.sources import infer_schema_once, read_csv_dim, read_documents, scan_documents
from tarnlake.streaming import append_stream, complete_stream, stream_json

Query = Callable[[SparkSession, str], DataFrame]


def _lake(spark: SparkSession, purpose: str) -> Lake:
    root = run_folder(spark, purpose)
    return Lake(spark, root.rsplit("/", 1)[1].replace("-", "_"), root).create()


def _without_lineage(df: DataFrame) -> DataFrame:
    return df.drop(*LINEAGE_COLUMNS, "_corrupt_record", "_rescued")


# Gold in batch


def _orders_silver_of(star: SampleStar, columns: tuple[str, ...]) -> DataFrame:
    """Silver order lines: all inner roles, and the left ones that ``columns`` need."""
    return enrich(star.order_facts(), star.dims_for(ORDERS.roles), ORDERS.roles, columns)


def monthly_orders_by_customer(spark: SparkSession, folder: str) -> DataFrame:
    columns = (
        "customer_key", "customer_last_name", "customer_first_name", "order_month_name", "product_key",
    )
    return monthly_product_count(_orders_silver_of(SampleStar(spark, folder), columns))


def monthly_orders_by_customer_and_year(spark: SparkSession, folder: str) -> DataFrame:
    columns = (
        "customer_key", "customer_last_name", "customer_first_name", "order_month_name",
        "order_year", "product_key",
    )
    return monthly_product_count(_orders_silver_of(SampleStar(spark, folder), columns), by_year=True)


def monthly_orders_by_key(spark: SparkSession, folder: str, by_year: bool = False) -> DataFrame:
    """Counted on keys before names are met; customer and date are the only roles."""
    star = SampleStar(spark, folder)
    dims = {"dim_customer": star.dim_customer, "dim_date": star.dim_date}
    return monthly_product_count_by_key(
        star.orders_counted(), dims, count=F.sum("lines"), by_year=by_year
    )


def monthly_orders_by_key_and_year(spark: SparkSession, folder: str) -> DataFrame:
    return monthly_orders_by_key(spark, folder, by_year=True)


def _keep(spark: SparkSession) -> Callable[[DataFrame], DataFrame]:
    return lambda df: stored(df, run_folder(spark, "counts"))


def customer_totals(spark: SparkSession, folder: str, share: float = 1e-5) -> DataFrame:
    columns = ("customer_key", "customer_last_name", "product_key")
    silver = _orders_silver_of(SampleStar(spark, folder), columns)
    return customer_line_totals(stored(silver, run_folder(spark, "silver")), _keep(spark), share)


def customer_totals_split(spark: SparkSession, folder: str) -> DataFrame:
    """A share near the mean of the sample: some customers are broadcast, others shuffled."""
    return customer_totals(spark, folder, share=8e-4)


def customer_totals_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """Of plain facts: the customer is the only role."""
    star = SampleStar(spark, folder)
    facts = stored(star.order_facts().select("customer_key", "product_key"), run_folder(spark, "facts"))
    return customer_line_totals_by_key(facts, star.dims_of("dim_customer"), _keep(spark))


def value_by_supplier_product(spark: SparkSession, folder: str) -> DataFrame:
    star = SampleStar(spark, folder)
    dims = star.dims_of("dim_product", "dim_supplier")
    value = purchase_value(star.purchase_lines(), dims)
    return value.withColumn("total_list_price", F.round("total_list_price", 2))


def value_by_supplier_product_as_loaded(spark: SparkSession, folder: str) -> DataFrame:
    star = SampleStar(spark, folder)
    roles = [role for role in PURCHASE_ORDERS.roles if role.how == "inner"]
    silver = enrich(star.purchase_lines(), star.dims_for(roles), roles)
    value = purchase_value_as_loaded(silver)
    return value.withColumn("total_list_price", F.round("total_list_price", 2))


def top_purchase_values(spark: SparkSession, folder: str) -> DataFrame:
    value = value_by_supplier_product(spark, folder)
    return top(value, "total_list_price", ["supplier_company", "product_name"], 20)


def quantity_by_quarter_batch(spark: SparkSession, folder: str) -> DataFrame:
    star = SampleStar(spark, folder)
    dims = {"dim_product": star.dim_product, "dim_date": star.dim_date}
    keyed = quarter_quantities_by_product_key(star.inventory_transaction_facts(), dims)
    return quarter_quantities_by_product(keyed, dims)


# Silver in batch


def _silver(spark: SparkSession, folder: str, feed: Feed) -> DataFrame:
    star = SampleStar(spark, folder)
    facts = {
        ORDERS.name: star.order_facts,
        PURCHASE_ORDERS.name: star.purchase_order_facts,
        INVENTORY_TRANSACTIONS.name: star.inventory_transaction_facts,
    }[feed.name]()
    columns = [name for name in feed.silver_columns if name not in LINEAGE_COLUMNS]
    return enrich(facts, star.dims_for(feed.roles), feed.roles, columns)


def orders_silver(spark: SparkSession, folder: str) -> DataFrame:
    return _silver(spark, folder, ORDERS)


def orders_silver_salted(spark: SparkSession, folder: str) -> DataFrame:
    """The customer and product roles as shuffled joins, their largest keys split.

    The sample's dimensions would be broadcast; as salted roles they are joined as ones
    above the threshold are.
    """
    star = SampleStar(spark, folder)
    facts = star.order_facts()
    spread_by = ("fact_order_key",)
    hot = {
        key: find_hot_keys(facts, key, spread_by, share=1e-3, rows_per_salt=20)
        for key in ("customer_key", "product_key")
    }
    return enrich(facts, star.dims_for(ORDERS.roles), ORDERS.roles, ORDERS.silver_columns, hot)


def purchase_silver(spark: SparkSession, folder: str) -> DataFrame:
    return _silver(spark, folder, PURCHASE_ORDERS)


def inventory_silver(spark: SparkSession, folder: str) -> DataFrame:
    return _silver(spark, folder, INVENTORY_TRANSACTIONS)


# Landed files through bronze, silver and gold tables


def _orders_lake(spark: SparkSession, folder: str, purpose: str) -> Lake:
    star = SampleStar(spark, folder)
    lake = _lake(spark, purpose)
    lake.load_dims(star.dims_for(ORDERS.roles))
    land_lines(star.order_facts(), f"{lake.root}/landing")
    lake.bronze(ORDERS, f"{lake.root}/landing", multi_line=False)
    return lake


def orders_lake_silver(spark: SparkSession, folder: str) -> DataFrame:
    return _orders_lake(spark, folder, "orders-silver").silver(ORDERS)


def orders_lake_monthly(spark: SparkSession, folder: str) -> DataFrame:
    lake = _orders_lake(spark, folder, "orders-gold")
    lake.silver(ORDERS)
    return lake.gold_monthly_orders()


def orders_lake_totals(spark: SparkSession, folder: str) -> DataFrame:
    lake = _orders_lake(spark, folder, "orders-totals")
    lake.silver(ORDERS)
    return lake.gold_product_orders()


def _purchases_lake(spark: SparkSession, folder: str, purpose: str) -> Lake:
    star = SampleStar(spark, folder)
    lake = _lake(spark, purpose)
    lake.load_dims(star.dims_for(PURCHASE_ORDERS.roles))
    land_lines(star.purchase_order_facts(), f"{lake.root}/landing")
    lake.bronze(PURCHASE_ORDERS, f"{lake.root}/landing", multi_line=False)
    return lake


def purchases_lake_silver(spark: SparkSession, folder: str) -> DataFrame:
    return _without_lineage(_purchases_lake(spark, folder, "purchases-silver").silver(PURCHASE_ORDERS))


def purchases_lake_value(spark: SparkSession, folder: str) -> DataFrame:
    lake = _purchases_lake(spark, folder, "purchases-gold")
    lake.silver(PURCHASE_ORDERS)
    value = lake.gold_purchases()
    return value.withColumn("total_list_price", F.round("total_list_price", 2))


def _inventory_lake(spark: SparkSession, folder: str, purpose: str) -> Lake:
    star = SampleStar(spark, folder)
    lake = _lake(spark, purpose)
    lake.load_dims({"dim_product": star.dim_product, "dim_date": star.dim_date})
    land_lines(star.inventory_transaction_facts(), f"{lake.root}/landing")
    lake.bronze(INVENTORY_TRANSACTIONS, f"{lake.root}/landing", multi_line=False)
    return lake


def inventory_lake_silver(spark: SparkSession, folder: str) -> DataFrame:
    return _inventory_lake(spark, folder, "inventory-silver").silver(INVENTORY_TRANSACTIONS)


def quantity_by_quarter_type_product(spark: SparkSession, folder: str) -> DataFrame:
    """The streamed form: state in the stream, names put to the complete result."""
    return _inventory_lake(spark, folder, "inventory-gold").gold_inventory()


def quantity_by_quarter_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Three deliveries, each of which writes the groups it changed; merged twice on the way."""
    star = SampleStar(spark, folder)
    lake = _lake(spark, "inventory-changes")
    lake.load_dims({"dim_product": star.dim_product, "dim_date": star.dim_date})
    facts = star.inventory_transaction_facts()
    for kind in ("R", "A", "N"):
        land_lines(facts.where(F.col("inventory_transaction_type") == kind), f"{lake.root}/landing")
        lake.bronze(INVENTORY_TRANSACTIONS, f"{lake.root}/landing", multi_line=False)
        gold = lake.gold_inventory_changes(compact_after=1)
    return gold


def quantity_by_quarter_sorted(spark: SparkSession, folder: str) -> DataFrame:
    """The streaming aggregate itself, sorted, as a complete-mode result."""
    lake = _inventory_lake(spark, folder, "inventory-sorted")
    keyed = lake.quantities_by_key().orderBy(F.desc("quantity"))
    return complete_stream(
        keyed, lake.qualified("quantities"), f"{lake.root}/sorted/checkpoint", f"{lake.root}/sorted/data"
    )


# Bronze


def _checked_lineage(bronze: DataFrame) -> DataFrame:
    """Bronze as it is, with what must hold of its lineage in place of values that vary."""
    name = F.element_at(F.split("source_file", "/"), -1)
    return bronze.drop("_corrupt_record", "_rescued").withColumns(
        {
            "receipt_time": F.col("receipt_time").isNotNull() & (F.col("receipt_time") <= F.current_timestamp()),
            "source_file": name.rlike(r"^part-.*[.]json([.]gz)?$"),
        }
    )


def orders_bronze(spark: SparkSession, folder: str) -> DataFrame:
    lake = _orders_lake(spark, folder, "orders-bronze")
    return _checked_lineage(lake.table(ORDERS.bronze_table))


def purchases_bronze(spark: SparkSession, folder: str) -> DataFrame:
    lake = _purchases_lake(spark, folder, "purchases-bronze")
    return _checked_lineage(lake.table(PURCHASE_ORDERS.bronze_table))


def inventory_bronze(spark: SparkSession, folder: str) -> DataFrame:
    lake = _inventory_lake(spark, folder, "inventory-bronze")
    return _checked_lineage(lake.table(INVENTORY_TRANSACTIONS.bronze_table))


def bronze_rescued(spark: SparkSession, folder: str) -> DataFrame:
    """Records with a field that the feed does not have, and with a value of another type."""
    star = SampleStar(spark, folder)
    lake = _lake(spark, "rescued")
    facts = star.inventory_transaction_facts()
    odd = F.col("quantity") % 2 == 1
    landed = facts.withColumn("coupon", F.when(odd, F.concat(F.lit("C"), "product_key"))).withColumn(
        "purchase_order_key", F.when(F.col("quantity") == 4, F.lit("none yet"))
    )
    land_lines(landed, f"{lake.root}/landing")
    bronze = lake.bronze(INVENTORY_TRANSACTIONS, f"{lake.root}/landing", multi_line=False)
    return bronze.select("fact_inventory_transaction_key", "quantity", "purchase_order_key", "_rescued")


def bronze_inferred_feed(spark: SparkSession, folder: str) -> DataFrame:
    """A feed whose schema is taken from what landed, with the feed's types laid over it."""
    lake = _lake(spark, "inferred-feed")
    landing = f"{lake.root}/landing"
    facts = SampleStar(spark, folder).inventory_transaction_facts()
    land_lines(facts.withColumn("batch_no", F.col("quantity") % 3), landing)
    schema = lake.inferred(INVENTORY_TRANSACTIONS, landing, multi_line=False)
    bronze = lake.bronze(INVENTORY_TRANSACTIONS, landing, multi_line=False, schema=schema)
    return bronze.select(*facts.columns, "batch_no")


def view_scan(spark: SparkSession, folder: str) -> DataFrame:
    """SQL over the view that a lake gives its silver stream, run as a stream."""
    lake = _inventory_lake(spark, folder, "views")
    lake.enriched(INVENTORY_TRANSACTIONS)
    counted = spark.sql(
        f"SELECT inventory_transaction_type, count(*) AS line_count, sum(quantity) AS total_quantity "
        f"FROM {lake.view(f'{INVENTORY_TRANSACTIONS.silver_table}_stream')} GROUP BY inventory_transaction_type"
    )
    return complete_stream(
        counted, lake.qualified("line_counts"), f"{lake.root}/views/checkpoint", f"{lake.root}/views/data"
    )


def bronze_followed(spark: SparkSession, folder: str) -> DataFrame:
    """Three deliveries: plain, with a field more, with that field as a fraction and another one."""
    facts = SampleStar(spark, folder).inventory_transaction_facts()
    lake = _lake(spark, "followed")
    landing, third = f"{lake.root}/landing", F.col("quantity") % 3
    deliveries = (
        facts.where(third == 0),
        facts.where(third == 1).withColumn("weight", F.col("quantity")),
        facts.where(third == 2).withColumns({"weight": F.col("quantity") + 0.5, "coupon": F.concat(F.lit("C"), "product_key")}),
    )
    for delivery in deliveries:
        land_lines(delivery, landing)
        lake.bronze_following(INVENTORY_TRANSACTIONS, landing, multi_line=False)
    view = lake.view(f"{INVENTORY_TRANSACTIONS.name}_followed")
    rows = spark.sql(f"SELECT *, _rescued IS NOT NULL AS beside FROM {view}")
    return _without_lineage(rows)


def _events_bronze(
    events: DataFrame, root: str, landing: str, table: str, multi_line: bool
) -> DataFrame:
    raw = stream_json(events.sparkSession, landing, events.schema, multi_line, **JSON_TIMESTAMPS)
    return append_stream(with_lineage(raw), table, f"{root}/checkpoint", f"{root}/data")


def bronze_events(spark: SparkSession, folder: str) -> DataFrame:
    """Line-delimited files, the landing form for volume."""
    events = SampleStar(spark, folder).table("events")
    lake = _lake(spark, "events")
    land_lines(events, f"{lake.root}/landing")
    bronze = _events_bronze(
        events, lake.root, f"{lake.root}/landing", lake.qualified("events_bronze"), False
    )
    return _without_lineage(bronze)


def bronze_event_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """Files of one JSON array each."""
    events = SampleStar(spark, folder).table("events")
    lake = _lake(spark, "arrays")
    land_arrays(events, f"{lake.root}/landing")
    bronze = _events_bronze(
        events, lake.root, f"{lake.root}/landing", lake.qualified("events_bronze"), True
    )
    return _without_lineage(bronze)


def bronze_restart(spark: SparkSession, folder: str) -> DataFrame:
    """Two deliveries, and a run between them that finds nothing new."""
    events = SampleStar(spark, folder).table("events")
    lake = _lake(spark, "restart")
    landing, table = f"{lake.root}/landing", lake.qualified("events_bronze")
    first = (F.col("event_type") == "click").eqNullSafe(F.lit(True))
    land_lines(events.where(first), landing)
    _events_bronze(events, lake.root, landing, table, False)
    _events_bronze(events, lake.root, landing, table, False)
    land_lines(events.where(~first), landing)
    return _without_lineage(_events_bronze(events, lake.root, landing, table, False))


def bronze_inferred(spark: SparkSession, folder: str) -> DataFrame:
    """The landed schema inferred once, with hints, and reused by the stream."""
    events = SampleStar(spark, folder).table("events")
    lake = _lake(spark, "inferred")
    landing, store = f"{lake.root}/landing", f"{lake.root}/schema"
    land_lines(events, landing)
    hints = "ts TIMESTAMP_NTZ, value DOUBLE, props STRING"
    infer_schema_once(spark, landing, store, hints, multi_line=False)
    schema = infer_schema_once(spark, landing, store, multi_line=False)
    raw = stream_json(spark, landing, schema, multi_line=False, **JSON_TIMESTAMPS)
    bronze = append_stream(
        with_lineage(raw), lake.qualified("events_bronze"), f"{lake.root}/checkpoint", f"{lake.root}/data"
    )
    return _without_lineage(bronze)


def bronze_refilled(spark: SparkSession, folder: str) -> DataFrame:
    """Two deliveries, with the checkpoint lost between them: the ledger knows the first."""
    facts = SampleStar(spark, folder).inventory_transaction_facts()
    lake = _lake(spark, "refilled")
    landing, first = f"{lake.root}/landing", F.col("inventory_transaction_type") == "R"
    land_lines(facts.where(first), landing)
    lake.bronze(INVENTORY_TRANSACTIONS, landing, multi_line=False, once=True)
    remove(spark, f"{lake.root}/{INVENTORY_TRANSACTIONS.name}/bronze/checkpoint")
    land_lines(facts.where(~first), landing)
    return _without_lineage(lake.bronze(INVENTORY_TRANSACTIONS, landing, multi_line=False, once=True))


def bronze_salvaged(spark: SparkSession, folder: str) -> DataFrame:
    """A feed some of whose files are CSV under a name of the others, replayed with their lineage."""
    facts = SampleStar(spark, folder).inventory_transaction_facts()
    lake = _lake(spark, "salvaged")
    landing, odd = f"{lake.root}/landing", F.col("inventory_transaction_type") == "R"
    land_lines(facts.where(~odd), landing)
    land_csv_lines(facts.where(odd), landing)
    lake.bronze(INVENTORY_TRANSACTIONS, landing, multi_line=False, once=True)
    lake.salvage(INVENTORY_TRANSACTIONS)
    lake.salvage(INVENTORY_TRANSACTIONS)  # finds nothing more to do
    bronze = lake.table(INVENTORY_TRANSACTIONS.bronze_table).where("fact_inventory_transaction_key IS NOT NULL")
    return _without_lineage(bronze.withColumn("lineage", F.col("source_file").rlike(r"[.]json([.]gz)?$")))


# Dimensions


def _refused(load: Callable[[], object]) -> int:
    """1 if a load fails, as it should."""
    try:
        load()
    except (ValueError, PySparkException, Py4JJavaError):
        return 1
    return 0


def dims_guarded(spark: SparkSession, folder: str) -> DataFrame:
    """Dimensions after a good load and three that must change nothing.

    One breaks off while it is read, one holds a key twice, one holds but a few rows; each
    comes with another dimension that is sound, and must not be replaced either.
    """
    star = SampleStar(spark, folder)
    lake = _lake(spark, "guarded")
    good = star.dims_of("dim_customer", "dim_product")
    lake.load_dims(good)
    customers, products = good["dim_customer"], good["dim_product"].limit(1)
    breaks = customers.withColumn("first_name", F.when(F.col("customer_key") > 0, F.raise_error(F.lit("source lost"))))
    few = {"dim_customer": [not_shrunk(0.5)]}
    refused = (
        _refused(lambda: lake.load_dims({"dim_product": products, "dim_customer": breaks}))
        + _refused(lambda: lake.load_dims({"dim_product": products, "dim_customer": customers.unionByName(customers)}))
        + _refused(lambda: lake.load_dims({"dim_product": products, "dim_customer": customers.limit(1)}, checks=few))
    )
    kept = [
        lake.table(name).select(F.lit(name).alias("dim"), F.col(key).alias("key"), F.col(value).alias("value"))
        for name, key, value in (("dim_customer", "customer_key", "last_name"), ("dim_product", "product_key", "product_name"))
    ]
    return kept[0].unionByName(kept[1]).withColumn("refused", F.lit(refused))


def dim_rolled_back(spark: SparkSession, folder: str) -> DataFrame:
    """A dimension loaded twice, with other columns the second time, then taken back; both as read."""
    customers = SampleStar(spark, folder).dim_customer
    lake = _lake(spark, "rolled-back")
    lake.load_dims({"dim_customer": customers})
    second = lake.load_dims({"dim_customer": customers.where("customer_key % 2 = 0").withColumn("rank", F.lit(1))})["dim_customer"]
    second = second.select(F.lit("second").alias("state"), "customer_key", "last_name")
    back = lake.roll_back_dim("dim_customer")
    return second.unionByName(back.select(F.lit("back").alias("state"), "customer_key", "last_name"))


def silver_rebuilt(spark: SparkSession, folder: str) -> DataFrame:
    """Silver of two deliveries made again from bronze, with products as they were at each."""
    star = SampleStar(spark, folder)
    lake = _lake(spark, "rebuilt")
    landing, facts = f"{lake.root}/landing", star.inventory_transaction_facts()
    renamed = star.dim_product.withColumn("product_name", F.upper("product_name"))
    returned = F.col("inventory_transaction_type") == "R"
    for products, delivery in ((star.dim_product, facts.where(returned)), (renamed, facts.where(~returned))):
        lake.load_dims({"dim_product": products, "dim_date": star.dim_date})
        lake.note_dims()
        land_lines(delivery, landing)
        lake.bronze(INVENTORY_TRANSACTIONS, landing, multi_line=False)
    return lake.rebuilt_silver(INVENTORY_TRANSACTIONS)


def gold_guarded(spark: SparkSession, folder: str) -> DataFrame:
    """A gold table that a build from nothing must not replace."""
    lake = _lake(spark, "gold-guarded")
    name, monthly = lake.qualified("monthly_orders"), monthly_orders_by_customer(spark, folder)
    create_gold(monthly, name)
    refused = _refused(lambda: create_gold(monthly.where(F.lit(False)), name, checks=[at_least(1), keeps_columns]))
    return spark.table(name).withColumn("refused", F.lit(refused))


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return SampleStar(spark, folder).dim_date


def audit_tables(spark: SparkSession, folder: str) -> DataFrame:
    lake = _lake(spark, "audit")
    lake.load_dims(SampleStar(spark, folder).dims)
    return audit_database(spark, lake.database, DIMENSION_KEYS)


def audit_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Dimensions, bronze and silver after a delivery with one record cut short."""
    lake = _orders_lake(spark, folder, "audit-orders")
    broken = spark.createDataFrame([('{"fact_order_key": 1, "order_key":',)], "value string")
    broken.write.mode("append").text(f"{lake.root}/landing")
    lake.bronze(ORDERS, f"{lake.root}/landing", multi_line=False)
    lake.silver(ORDERS)
    facts = {ORDERS.bronze_table: "fact_order_key", ORDERS.silver_table: "fact_order_key"}
    dims = {"dim_customer": DIMENSION_KEYS["dim_customer"]}
    return audit_lake(spark, lake.database, dims, facts).drop("column_types")


def audit_once(spark: SparkSession, folder: str) -> DataFrame:
    """The audit of three deliveries from their notes; the keys of the last two are counted, as they meet."""
    facts = SampleStar(spark, folder).inventory_transaction_facts()
    key = "fact_inventory_transaction_key"
    lake = _lake(spark, "audit-once")
    landing = f"{lake.root}/landing"
    middle = facts.agg(F.floor((F.min(key) + F.max(key)) / 2)).first()[0]
    upper = F.col(key) > middle
    for delivery in (facts.where(~upper), facts.where(upper), facts.where(upper & (F.col("quantity") == 7))):
        land_lines(delivery, landing)
        lake.bronze(INVENTORY_TRANSACTIONS, landing, multi_line=False, once=True)
    audit = lake.audit_once(INVENTORY_TRANSACTIONS)
    off = F.abs(F.col("estimated_keys") - F.col("distinct_keys")) / F.col("distinct_keys")
    return audit.withColumn("estimated_keys", off < 4 * RELATIVE_ERROR)


def quantiles_once(spark: SparkSession, folder: str) -> DataFrame:
    """Quantiles of a measure from merged sketches, with whether their ranks are as close as they should be."""
    facts = SampleStar(spark, folder).inventory_transaction_facts()
    lake = _lake(spark, "quantiles")
    landing, third = f"{lake.root}/landing", F.pmod(F.xxhash64("fact_inventory_transaction_key"), F.lit(3))
    for part in range(3):
        land_lines(facts.where(third == part), landing)
        lake.bronze(INVENTORY_TRANSACTIONS, landing, multi_line=False, once=True)
    told = lake.quantiles(INVENTORY_TRANSACTIONS, (0.1, 0.5, 0.9))
    x, error = F.col("quantity"), F.lit(2 * RANK_ERROR)
    close = [  # one value for each fraction
        F.struct(
            F.lit(row["measure"]).alias("measure"),
            F.lit(row["fraction"]).alias("fraction"),
            (
                (F.avg((x < row["value"]).cast("int")) <= F.lit(row["fraction"]) + error)
                & (F.avg((x <= row["value"]).cast("int")) >= F.lit(row["fraction"]) - error)
            ).alias("is_close"),
        )
        for row in told.collect()
    ]
    return facts.agg(F.array(*close).alias("close")).select(F.inline("close"))


def topk_preview(spark: SparkSession, folder: str) -> DataFrame:
    return preview(SampleStar(spark, folder).dim_customer, "customer_key")


def gold_table(spark: SparkSession, folder: str) -> DataFrame:
    """A gold table whose files are clustered by its measure."""
    lake = _lake(spark, "gold")
    return create_gold(
        monthly_orders_by_customer(spark, folder),
        lake.qualified("monthly_orders"),
        order_by=["ProductCount", "CustomerID", "OrderMonth"],
    )


def clustered_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Ranges of two columns out of a table laid out by both, read through its manifest."""
    lines = SampleStar(spark, folder).purchase_lines()
    root, columns = run_folder(spark, "clustered"), ["product_key", "supplier_key"]
    table = stored(clustered(lines, columns, 64), f"{root}/lines")
    files = stored(manifest(table, columns), f"{root}/manifest")
    found = read_ranges(spark, files, table, {"product_key": (1, 50), "supplier_key": (3, 5)})
    return found.withColumn("few_files", F.lit(len(found.inputFiles()) <= 32))


def csv_dim(spark: SparkSession, folder: str) -> DataFrame:
    """Names get a quote, a comma and a line break on the way out."""
    customers = SampleStar(spark, folder).table("customer")
    odd = F.concat(F.lit('a "q", b\n'), "c_name")
    customers = customers.withColumn("c_name", F.when(F.col("c_custkey") % 7 == 0, odd).otherwise(F.col("c_name")))
    path = f"{run_folder(spark, 'csv')}/customer"
    customers.write.options(header=True, quote='"', escape='"').csv(path)
    return read_csv_dim(spark, path, customers.schema, multi_line=True)


def document_scan(spark: SparkSession, folder: str) -> DataFrame:
    customers = SampleStar(spark, folder).table("customer")
    path = f"{run_folder(spark, 'documents')}/customers"
    customers.write.json(path)
    documents = read_documents(
        spark,
        "json",
        ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"],
        path,
        schema="c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING",
    )
    return scan_documents(
        documents,
        conditions={"c_mktsegment": "BUILDING"},
        projection=["c_custkey", "c_name", "c_nationkey"],
        sort=[("c_nationkey", 1), ("c_custkey", -1)],
    )


def replace_collection(spark: SparkSession, folder: str) -> DataFrame:
    star = SampleStar(spark, folder)
    root = run_folder(spark, "collections")
    names = ("customer", "supplier", "orders")
    files = {name: f"{root}/files/{name}" for name in names}
    for name, path in files.items():
        star.table(name).write.options(**JSON_TIMESTAMPS).json(path)
    schemas = {name: star.table(name).schema for name in names}
    load = {"target": f"{root}/collections", "schemas": schemas, "multi_line": False}
    replace_collections(spark, files, options=JSON_TIMESTAMPS, **load)
    return replace_collections(spark, files, options=JSON_TIMESTAMPS, **load)


def replaced_documents(spark: SparkSession, folder: str) -> DataFrame:
    """A collection replaced by a delivery, then by one that does not parse and so must not count."""
    customers = SampleStar(spark, folder).table("customer")
    root = run_folder(spark, "replaced")
    customers.write.json(f"{root}/good")
    broken = spark.createDataFrame([('{"c_custkey": 1}',), ('{"c_custkey": ',)], "value string")
    broken.write.text(f"{root}/broken")
    load = {"target": f"{root}/collections", "schemas": {"customer": customers.schema}, "multi_line": False}
    replace_collections(spark, {"customer": f"{root}/good"}, **load)
    with suppress(PySparkException, Py4JJavaError):
        replace_collections(spark, {"customer": f"{root}/broken"}, **load)
    return spark.read.schema(customers.schema).json(f"{root}/collections/customer")


QUERIES: dict[str, Query] = {
    "monthly_orders_by_customer": monthly_orders_by_customer,
    "monthly_orders_by_customer_and_year": monthly_orders_by_customer_and_year,
    "monthly_orders_by_key": monthly_orders_by_key,
    "monthly_orders_by_key_and_year": monthly_orders_by_key_and_year,
    "customer_line_totals": customer_totals,
    "customer_line_totals_split": customer_totals_split,
    "customer_line_totals_by_key": customer_totals_by_key,
    "value_by_supplier_product": value_by_supplier_product,
    "value_by_supplier_product_as_loaded": value_by_supplier_product_as_loaded,
    "top_purchase_values": top_purchase_values,
    "quantity_by_quarter_batch": quantity_by_quarter_batch,
    "quantity_by_quarter_type_product": quantity_by_quarter_type_product,
    "quantity_by_quarter_changes": quantity_by_quarter_changes,
    "quantity_by_quarter_sorted": quantity_by_quarter_sorted,
    "orders_silver": orders_silver,
    "orders_silver_salted": orders_silver_salted,
    "purchase_silver": purchase_silver,
    "inventory_silver": inventory_silver,
    "orders_lake_silver": orders_lake_silver,
    "orders_lake_monthly": orders_lake_monthly,
    "orders_lake_totals": orders_lake_totals,
    "purchases_lake_silver": purchases_lake_silver,
    "purchases_lake_value": purchases_lake_value,
    "inventory_lake_silver": inventory_lake_silver,
    "orders_bronze": orders_bronze,
    "purchases_bronze": purchases_bronze,
    "inventory_bronze": inventory_bronze,
    "bronze_rescued": bronze_rescued,
    "bronze_inferred_feed": bronze_inferred_feed,
    "view_scan": view_scan,
    "bronze_events": bronze_events,
    "bronze_event_arrays": bronze_event_arrays,
    "bronze_restart": bronze_restart,
    "bronze_inferred": bronze_inferred,
    "bronze_followed": bronze_followed,
    "bronze_refilled": bronze_refilled,
    "bronze_salvaged": bronze_salvaged,
    "dims_guarded": dims_guarded,
    "dim_rolled_back": dim_rolled_back,
    "silver_rebuilt": silver_rebuilt,
    "gold_guarded": gold_guarded,
    "dim_date": dim_date,
    "audit_tables": audit_tables,
    "audit_orders": audit_orders,
    "audit_once": audit_once,
    "quantiles_once": quantiles_once,
    "topk_preview": topk_preview,
    "gold_table": gold_table,
    "clustered_ranges": clustered_ranges,
    "csv_dim": csv_dim,
    "document_scan": document_scan,
    "replace_collection": replace_collection,
    "replaced_documents": replaced_documents,
}
