from datetime import date
from pathlib import Path

import pytest
from fixtures import (
    ORDERS_CLEAN,
    ORDERS_ODD,
    PURCHASES,
    TRANSACTIONS,
    bag,
    dims,
    frame,
    lake,
    land_array,
    land_csv,
    order,
    transaction,
)
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tarnlake.functions import date_dimension, with_lineage
from tarnlake.operators import audit_tables, enrich, quarter_quantities_by_product, quarter_quantities_by_product_key
from tarnlake.plans.star import (
    FEEDS,
    GOLD_MONTHLY_ORDERS,
    INVENTORY_TRANSACTIONS,
    ORDERS,
    ORDERS_SCHEMA,
    PURCHASE_ORDERS,
)
from tarnlake.sources import read_csv_dim
from tarnlake.streaming import append_stream, complete_stream, stream_json, stream_table


@pytest.fixture(scope="module")
def star(spark):
    return dims(spark)


def test_only_new_files_are_ingested(spark, tmp_path):
    lk, landing = lake(spark, tmp_path / "lake"), tmp_path / "in"
    land_array(landing, "2.json", [order(n) for n in range(19)])
    assert lk.bronze(ORDERS, str(landing)).count() == 19
    assert lk.bronze(ORDERS, str(landing)).count() == 19
    land_array(landing, "3.json", [order(n) for n in range(20, 40)])
    assert lk.bronze(ORDERS, str(landing)).count() == 39


def test_bronze_adds_lineage_and_drops_nothing(spark, tmp_path):
    lk, landing = lake(spark, tmp_path / "lake"), tmp_path / "in"
    rows = ORDERS_CLEAN + ORDERS_ODD
    land_array(landing, "a.json", rows)
    land_array(landing, "b.json", rows[:3])
    bronze = lk.bronze(ORDERS, str(landing))
    assert bronze.columns[-4:] == ["_corrupt_record", "_rescued", "receipt_time", "source_file"]
    assert bag(bronze.drop("_corrupt_record", "_rescued", "receipt_time", "source_file").collect()) == bag(
        tuple(r.values()) for r in rows + rows[:3]
    )
    files = {Path(r.source_file).name: r["count"] for r in bronze.groupBy("source_file").count().collect()}
    assert files == {"a.json": len(rows), "b.json": 3}
    assert bronze.where("receipt_time IS NULL").count() == 0


def test_receipt_time_is_one_value_per_micro_batch(spark, tmp_path):
    lk, landing = lake(spark, tmp_path / "lake", max_files=1), tmp_path / "in"
    for number in range(3):
        land_array(landing, f"{number}.json", ORDERS_CLEAN[number::3])
    bronze = lk.bronze(ORDERS, str(landing))
    assert bronze.select("receipt_time", "source_file").distinct().count() == 3
    assert bronze.select("receipt_time").distinct().count() == 3


def test_batches_bounded_by_size(spark, tmp_path):
    lk, landing = lake(spark, tmp_path / "lake", max_files=None), tmp_path / "in"
    for number in range(3):
        land_array(landing, f"{number}.json", ORDERS_CLEAN)
    bronze = lk.bronze(ORDERS, str(landing), maxBytesPerTrigger="1")
    assert bronze.count() == 3 * len(ORDERS_CLEAN)
    assert bronze.select("receipt_time").distinct().count() == 3


def test_a_csv_file_among_the_json(spark, tmp_path, star):
    lk, landing = lake(spark, tmp_path / "lake"), tmp_path / "in"
    lk.load_dims(star)
    land_csv(landing, "1.json", [order(n, paid_date_key=None if n < 3 else 20240203) for n in range(1, 6)])
    land_array(landing, "2.json", ORDERS_CLEAN)
    bronze = lk.bronze(ORDERS, str(landing))
    assert bronze.count() == 1 + len(ORDERS_CLEAN)
    (bad,) = bronze.where("_corrupt_record IS NOT NULL").collect()
    assert bad.fact_order_key is None and bad._corrupt_record.startswith("fact_order_key,order_key")
    assert lk.silver(ORDERS).count() == len(ORDERS_CLEAN)
    (audit,) = audit_tables({"b": (bronze, "fact_order_key")}).collect()
    assert audit.corrupt_rows == 1 and audit.null_keys == 1
    # Recovery: the same file through the CSV reader.
    again = read_csv_dim(spark, str(landing / "1.json"), ORDERS_SCHEMA, nullValue="NULL")
    assert again.count() == 5 and again.where("paid_date_key IS NULL").count() == 2


def test_other_modes_for_malformed_files(spark, tmp_path):
    landing = tmp_path / "in"
    land_csv(landing, "1.json", ORDERS_CLEAN)
    land_array(landing, "2.json", ORDERS_CLEAN)
    dropping = lake(spark, tmp_path / "drop").bronze(ORDERS, str(landing), mode="DROPMALFORMED")
    assert dropping.count() == len(ORDERS_CLEAN)
    with pytest.raises(StreamingQueryException):
        lake(spark, tmp_path / "fail").bronze(ORDERS, str(landing), mode="FAILFAST")


def test_a_failed_run_leaves_nothing_half_done(spark, tmp_path):
    landing, root = tmp_path / "in", tmp_path / "lake"
    land_array(landing, "1.json", ORDERS_CLEAN)
    lk = lake(spark, root)
    assert lk.bronze(ORDERS, str(landing)).count() == 7
    land_csv(landing, "2.json", ORDERS_CLEAN)
    with pytest.raises(StreamingQueryException):
        lk.bronze(ORDERS, str(landing), mode="FAILFAST")
    assert lk.table(ORDERS.bronze_table).count() == 7
    assert lk.bronze(ORDERS, str(landing)).count() == 8  # permissive: the bad file is one row


def test_line_delimited_files(spark, tmp_path):
    lk, landing = lake(spark, tmp_path / "lake"), tmp_path / "in"
    frame(spark, ORDERS_CLEAN, ORDERS_SCHEMA).write.json(str(landing))
    assert lk.bronze(ORDERS, str(landing), multi_line=False).count() == len(ORDERS_CLEAN)


@pytest.mark.parametrize(
    "feed,rows", [(ORDERS, ORDERS_CLEAN + ORDERS_ODD), (PURCHASE_ORDERS, PURCHASES), (INVENTORY_TRANSACTIONS, TRANSACTIONS)],
    ids=[f.name for f in FEEDS],
)
def test_streamed_silver_equals_batch_silver(spark, tmp_path, star, feed, rows):
    lk, landing = lake(spark, tmp_path / "lake", max_files=1), tmp_path / "in"
    lk.load_dims(star)
    for number in range(3):
        land_array(landing, f"{number}.json", rows[number::3])
    lk.bronze(feed, str(landing))
    silver = lk.silver(feed)
    assert silver.columns == list(feed.silver_columns)
    lineage = ["receipt_time", "source_file"]
    batch = enrich(with_lineage(frame(spark, rows, feed.schema)), star, feed.roles, feed.silver_columns)
    assert bag(silver.drop(*lineage).collect()) == bag(batch.drop(*lineage).collect())
    if feed is PURCHASE_ORDERS:
        assert silver.where("source_file = '' OR receipt_time IS NULL").count() == 0


def test_silver_takes_only_new_bronze_rows(spark, tmp_path, star):
    lk, landing = lake(spark, tmp_path / "lake"), tmp_path / "in"
    lk.load_dims(star)
    counts = []
    for number, rows in enumerate((ORDERS_CLEAN[:3], [], ORDERS_CLEAN[3:])):
        if rows:
            land_array(landing, f"{number}.json", rows)
        lk.bronze(ORDERS, str(landing))
        counts.append(lk.silver(ORDERS).count())
    assert counts == [3, 3, 7]


def test_silver_keeps_the_attributes_it_was_loaded_with(spark, tmp_path, star):
    lk, landing = lake(spark, tmp_path / "lake"), tmp_path / "in"
    lk.load_dims(star)
    land_array(landing, "1.json", [order(1)])
    lk.bronze(ORDERS, str(landing))
    lk.silver(ORDERS)
    renamed = star["dim_customer"].withColumn("last_name", F.concat(F.lit("New "), "last_name"))
    lk.load_dims({"dim_customer": renamed})
    land_array(landing, "2.json", [order(5)])
    lk.bronze(ORDERS, str(landing))
    names = {r.fact_order_key: r.customer_last_name for r in lk.silver(ORDERS).collect()}
    assert names == {1: "Brown", 5: "New Brown"}


def test_a_new_session_catalog_picks_the_tables_up(spark, tmp_path, star):
    root, landing = tmp_path / "lake", tmp_path / "in"
    land_array(landing, "1.json", TRANSACTIONS)
    first = lake(spark, root)
    first.load_dims(star)
    first.bronze(INVENTORY_TRANSACTIONS, str(landing))
    first.silver(INVENTORY_TRANSACTIONS)
    before = bag(first.gold_inventory().collect())
    # Another database stands for the empty catalog of a restarted session.
    second = lake(spark, root)
    second.load_dims(star)
    assert second.bronze(INVENTORY_TRANSACTIONS, str(landing)).count() == len(TRANSACTIONS)
    assert second.silver(INVENTORY_TRANSACTIONS).count() == 20
    assert bag(second.gold_inventory().collect()) == before


def test_orders_and_purchases_to_gold(spark, tmp_path, star):
    lk = lake(spark, tmp_path / "lake")
    lk.load_dims(star)
    for feed, rows in ((ORDERS, ORDERS_CLEAN + ORDERS_ODD), (PURCHASE_ORDERS, PURCHASES)):
        land_array(tmp_path / feed.name, "1.json", rows)
        lk.bronze(feed, str(tmp_path / feed.name))
        lk.silver(feed)
    monthly, totals = lk.gold_monthly_orders(), lk.gold_product_orders()
    assert monthly.agg(F.sum("ProductCount")).first()[0] == lk.table(ORDERS.silver_table).count()
    assert totals.count() == 10
    assert lk.table(GOLD_MONTHLY_ORDERS).count() == monthly.count()
    assert lk.gold_purchases().count() == lk.gold_purchases().count() > 0


def test_streaming_gold_follows_new_files(spark, tmp_path, star):
    lk, landing = lake(spark, tmp_path / "lake", max_files=1), tmp_path / "in"
    lk.load_dims(star)
    rows = []
    for number, part in enumerate((TRANSACTIONS[:8], TRANSACTIONS[8:])):
        land_array(landing, f"{number}.json", part)
        rows += part
        lk.bronze(INVENTORY_TRANSACTIONS, str(landing))
        gold = lk.gold_inventory()
        known = enrich(
            frame(spark, rows, INVENTORY_TRANSACTIONS.schema), star, INVENTORY_TRANSACTIONS.roles,
            INVENTORY_TRANSACTIONS.silver_columns,
        )
        batch = quarter_quantities_by_product(quarter_quantities_by_product_key(known, star), star)
        assert bag(gold.collect()) == bag(batch.collect())


def test_streaming_gold_with_rocksdb_state(spark, tmp_path, star, conf):
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    conf(spark__sql__streaming__stateStore__providerClass=provider)
    lk, landing = lake(spark, tmp_path / "lake"), tmp_path / "in"
    lk.load_dims(star)
    for number in range(2):
        land_array(landing, f"{number}.json", [transaction(n) for n in range(10)])
        lk.bronze(INVENTORY_TRANSACTIONS, str(landing))
        gold = lk.gold_inventory()
    assert gold.agg(F.sum("total_quantity")).first()[0] == 90


def test_streaming_gold_before_any_row(spark, tmp_path):
    Path(tmp_path / "in").mkdir()
    lk = lake(spark, tmp_path / "lake")
    stream = stream_json(spark, str(tmp_path / "in"), "k BIGINT, v BIGINT")
    table = complete_stream(
        stream.groupBy("k").agg(F.sum("v").alias("v")), lk.qualified("t"), str(tmp_path / "c"), str(tmp_path / "d")
    )
    assert table.columns == ["k", "v"] and table.count() == 0


def test_sorted_streaming_aggregate(spark, tmp_path):
    lk = lake(spark, tmp_path / "lake")
    land_array(tmp_path / "in", "1.json", [transaction(n) for n in range(9)])
    stream = stream_json(spark, str(tmp_path / "in"), INVENTORY_TRANSACTIONS.schema)
    totals = stream.groupBy("product_key").agg(F.sum("quantity").alias("q")).orderBy(F.col("q").desc())
    batches = []
    table = complete_stream(
        totals, lk.qualified("q"), str(tmp_path / "c"), str(tmp_path / "d"),
        finish=lambda batch: batches.append([r.q for r in batch.collect()]) or batch,
    )
    assert batches == [[11, 9, 7, 5, 4]]
    assert bag(table.select("q").collect()) == bag([(11,), (9,), (7,), (5,), (4,)])


def test_partitioned_silver(spark, tmp_path, star):
    lk, landing = lake(spark, tmp_path / "lake"), tmp_path / "in"
    lk.load_dims(star)
    rows = ORDERS_CLEAN + ORDERS_ODD
    counts = []
    for part in (rows[:6], rows[6:]):
        land_array(landing, f"{len(counts)}.json", part)
        lk.bronze(ORDERS, str(landing))
        counts.append(lk.silver(ORDERS, partition_by=["order_year"]).count())
    assert counts == [6, 10]
    year = lk.table(ORDERS.silver_table).where("order_year = 2024")
    assert "PartitionFilters: [isnotnull(order_year" in year._jdf.queryExecution().executedPlan().toString()
    assert year.count() == 9


def test_sql_over_streaming_views(spark, tmp_path, star):
    lk, landing = lake(spark, tmp_path / "lake"), tmp_path / "in"
    lk.load_dims(star)
    land_array(landing, "1.json", ORDERS_CLEAN)
    lk.bronze(ORDERS, str(landing))
    assert spark.table(lk.view("fact_orders_raw")).isStreaming
    lk.enriched(ORDERS)
    view = spark.sql(f"SELECT *, quantity * unit_price AS value FROM {lk.view('fact_orders_silver_stream')}")
    assert view.isStreaming and view.columns[-1] == "value"
    stream_table(spark, lk.qualified(ORDERS.bronze_table), view="bronze_again")
    assert spark.sql("SELECT receipt_time FROM bronze_again").isStreaming


def test_calendar_may_be_shorter_than_the_facts(spark, tmp_path, star):
    short = dict(star, dim_date=date_dimension(spark, date(2024, 1, 1), date(2024, 1, 3)))
    facts = frame(spark, ORDERS_CLEAN, ORDERS_SCHEMA)
    rows = enrich(facts, short, ORDERS.roles).collect()
    assert len(rows) == 7 and sum(r.order_year is None for r in rows) == 4


def test_unknown_fields_and_misfits_are_rescued(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "a.json").write_text(
        '{"k": 1, "v": "x"}\n{"k": 2, "coupon": "C9", "n": null}\n{"k": "two", "v": 5}\n{"k": \n7\n'
    )
    raw = stream_json(spark, str(landing), "k BIGINT, v STRING", multi_line=False, rescue=True)
    table = append_stream(raw, f"rescued_{tmp_path.name}", str(tmp_path / "c"), str(tmp_path / "d"))
    found = {(r.k, r.v, r._corrupt_record, r._rescued) for r in table.collect()}
    assert found == {
        (1, "x", None, None),
        (2, None, None, '{"coupon":"C9"}'),
        (None, "5", None, '{"k":"two"}'),
        (None, None, '{"k": ', None),
        (None, None, None, "7"),
    }


def test_lines_that_fit_are_parsed_once_and_no_other_way(spark, tmp_path):
    """Fractions for whole numbers, digits as text, numbers as text, arrays, blank lines, a duplicate name."""
    landing = tmp_path / "in"
    landing.mkdir()
    lines = [
        '{"k": 1, "v": "x", "d": 0.5}', '{"k": 2.5, "v": "y"}', '{"k": "3", "v": 7, "d": 1}', '[{"k": 4}, {"k": 5, "w": 1}]', "",
        '{"k": 6, "v": {"a": 1}}', "[]", "null", '{"k": null, "d": null}', "{}", '{"k": 9000000000000000000}', "1,2,3", '{"k": 10, "d": "z"}',
    ]
    (landing / "a.json").write_text("\n".join(lines) + "\n")
    raw = stream_json(spark, str(landing), "k BIGINT, v STRING, d DOUBLE", multi_line=False, rescue=True)
    table = append_stream(with_lineage(raw), f"once_{tmp_path.name}", str(tmp_path / "c"), str(tmp_path / "d"))
    assert table.where("source_file = ''").count() == 0
    found = bag((r.k, r.v, r.d, r._corrupt_record, r._rescued) for r in table.collect())
    assert found == bag([
        (1, "x", 0.5, None, None),
        (None, "y", None, None, '{"k":2.5}'),
        (3, "7", 1.0, None, None),
        (4, None, None, None, None),
        (5, None, None, None, '{"w":1}'),
        (6, '{"a":1}', None, None, None),
        (None, None, None, None, "null"),
        (None, None, None, None, None),
        (None, None, None, None, None),
        (9000000000000000000, None, None, None, None),
        (None, None, None, "1,2,3", None),
        (10, None, None, None, '{"d":"z"}'),
    ])


def test_arrays_are_rescued_record_by_record(spark, tmp_path):
    landing = tmp_path / "in"
    land_array(landing, "a.json", [{"k": 1}, {"k": 2, "more": {"a": [1]}}])
    (landing / "b.json").write_text('[{"k": 3}, {"k":')
    (landing / "c.json").write_text("[]")
    raw = stream_json(spark, str(landing), "k BIGINT", rescue=True)
    table = append_stream(raw, f"arrays_{tmp_path.name}", str(tmp_path / "c"), str(tmp_path / "d"))
    found = {(r.k, r._corrupt_record, r._rescued) for r in table.collect()}
    assert found == {(1, None, None), (2, None, '{"more":{"a":[1]}}'), (None, '[{"k": 3}, {"k":', None)}


def test_inventory_gold_meets_products_after_the_aggregate(spark, tmp_path, star):
    lk, landing = lake(spark, tmp_path / "lake"), tmp_path / "in"
    lk.load_dims(star)
    land_array(landing, "1.json", TRANSACTIONS)
    lk.bronze(INVENTORY_TRANSACTIONS, str(landing))
    plan = lk.quantities_by_key()._jdf.queryExecution().analyzed().toString()
    below = plan[plan.index("Aggregate") :]
    assert "product_name" not in below and below.count("Join ") == 1


def test_inventory_gold_is_written_once_per_run_and_then_pointed_at(spark, tmp_path, star):
    lk, landing = lake(spark, tmp_path / "lake"), tmp_path / "in"
    lk.load_dims(star)
    folder = tmp_path / "lake" / INVENTORY_TRANSACTIONS.name / "gold" / "data"
    for n, row in enumerate(TRANSACTIONS):
        land_array(landing, f"{n}.json", [row])
    lk.bronze(INVENTORY_TRANSACTIONS, str(landing))
    first = bag(lk.gold_inventory().collect())
    assert len(list(folder.iterdir())) == 1
    land_array(landing, "more.json", [TRANSACTIONS[0]])
    lk.bronze(INVENTORY_TRANSACTIONS, str(landing))
    assert bag(lk.gold_inventory().collect()) != first
    assert len(list(folder.iterdir())) == 2
