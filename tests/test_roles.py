import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from fixtures import ORDERS_CLEAN, ORDERS_ODD, PURCHASES, TRANSACTIONS, bag, dims, frame

from tarnlake.operators import HotKeys, Role, enrich
from tarnlake.plans.star import FEEDS, INVENTORY_TRANSACTIONS, ORDERS, PURCHASE_ORDERS


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture(scope="module")
def star(spark):
    return dims(spark)


def test_inner_roles_drop_and_left_roles_keep(spark, star):
    facts = frame(spark, ORDERS_CLEAN + ORDERS_ODD, ORDERS.schema)
    rows = {r.fact_order_key: r for r in enrich(facts, star, ORDERS.roles, ORDERS.silver_columns).collect()}
    # No shipper, an unknown customer, no customer and no product are inner misses.
    assert set(rows) == {1, 2, 3, 4, 5, 6, 7, 9, 11, 12}
    assert rows[9].paid_month_name is None and rows[9].order_month_name == "January"
    assert rows[12].order_month_name is None and rows[12].order_year is None
    assert rows[11].order_details_status == "None"
    assert rows[4].customer_last_name == "Äström"


def test_each_role_has_its_own_attributes(spark, star):
    facts = frame(spark, PURCHASES, PURCHASE_ORDERS.schema)
    columns = [c for c in PURCHASE_ORDERS.silver_columns if c not in ("receipt_time", "source_file")]
    rows = {r.fact_purchase_order_key: r for r in enrich(facts, star, PURCHASE_ORDERS.roles, columns).collect()}
    assert set(rows) == {1, 2, 3, 4, 5, 6, 8}
    one = rows[1]
    assert (one.submitted_by_last_name, one.approved_by_last_name, one.created_by_last_name) == (
        "Clerk3", "Clerk2", "Clerk1",
    )
    assert one.creation_day_of_month == 11 and one.received_day_of_month == 21
    assert rows[6].created_by_company is None and rows[6].submitted_by_company == "House"
    assert rows[8].received_year is None and rows[8].creation_year == 2024


def test_inventory_roles(spark, star):
    facts = frame(spark, TRANSACTIONS, INVENTORY_TRANSACTIONS.schema)
    rows = enrich(facts, star, INVENTORY_TRANSACTIONS.roles, INVENTORY_TRANSACTIONS.silver_columns).collect()
    assert len(rows) == 20
    assert sum(r.transaction_created_quarter is None for r in rows) == 1


def test_idle_left_roles_are_not_joined(spark, star):
    facts = frame(spark, ORDERS_CLEAN + ORDERS_ODD, ORDERS.schema)
    columns = ["fact_order_key", "paid_month_name"]
    full = enrich(facts, star, ORDERS.roles).select(*columns)
    narrow = enrich(facts, star, ORDERS.roles, columns)
    assert bag(narrow.collect()) == bag(full.collect())
    assert final_plan(narrow).count("LeftOuter") == 1 and final_plan(full).count("LeftOuter") == 3


KEY = st.one_of(st.none(), st.integers(0, 4))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(KEY, KEY), max_size=12), st.sets(st.integers(0, 4)), st.sets(st.integers(0, 4)))
def test_enrichment_is_what_the_keys_say(spark, facts, inner_keys, left_keys):
    roles = [
        Role("l", "b", "k", {"v": "left_v"}, "left"),
        Role("i", "a", "k", {"v": "inner_v"}),
    ]
    given_dims = {
        name: spark.createDataFrame([(k, k * 10) for k in sorted(keys)], "k bigint, v bigint")
        for name, keys in (("i", inner_keys), ("l", left_keys))
    }
    expected = [
        (a, b, a * 10, b * 10 if b in left_keys else None) for a, b in facts if a in inner_keys
    ]
    result = enrich(
        spark.createDataFrame(facts, "a bigint, b bigint"), given_dims, roles, ["a", "b", "inner_v", "left_v"]
    )
    assert bag(result.collect()) == bag(expected)


def test_silver_shapes():
    assert [len(f.silver_columns) for f in FEEDS] == [50, 58, 23]
    assert ORDERS.silver_columns[:4] == ("fact_order_key", "order_key", "employee_key", "employee_last_name")
    assert "order_quarter" in ORDERS.silver_columns and "paid_calendar_quarter" in ORDERS.silver_columns
    for feed in FEEDS:
        assert len(set(feed.silver_columns)) == len(feed.silver_columns)


def test_dropped_columns_stay_out():
    assert not {"inventory_key", "approved_date_key", "po_detail_posted_to_inventory"} & set(
        PURCHASE_ORDERS.silver_columns
    )
    assert not {"receipt_time", "source_file"} & set(ORDERS.silver_columns)


def test_salted_roles_give_the_same_rows(spark, star):
    rows = (ORDERS_CLEAN + ORDERS_ODD) * 3
    facts = frame(spark, rows, ORDERS.schema)
    hot = {
        "shipper_key": HotKeys({1: 4, 2: 3}, ("fact_order_key",), 4),
        "paid_date_key": HotKeys({20240201: 4}, ("fact_order_key",), 4),
        "customer_key": HotKeys({}, ("fact_order_key",), 4),
    }
    plain = enrich(facts, star, ORDERS.roles, ORDERS.silver_columns)
    salted = enrich(facts, star, ORDERS.roles, ORDERS.silver_columns, hot)
    assert bag(plain.collect()) == bag(salted.collect())


def test_dimension_broadcast_follows_its_size(spark, star, conf):
    facts = frame(spark, ORDERS_CLEAN, ORDERS.schema)
    role = [Role("dim_customer", "customer_key", "customer_key", {"last_name": "name"})]
    large = {"dim_customer": spark.range(1, 200_000).selectExpr("id AS customer_key", "'x' AS last_name")}
    assert "SortMergeJoin" not in final_plan(enrich(facts, star, role))
    conf(spark__sql__autoBroadcastJoinThreshold="10000", spark__sql__adaptive__autoBroadcastJoinThreshold="10000")
    wide = spark.range(200_000).selectExpr("id + 1 AS customer_key")
    plan = final_plan(enrich(wide, large, role))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_calendar_is_built_once_for_all_date_roles(spark, star):
    facts = frame(spark, ORDERS_CLEAN, ORDERS.schema)
    dates = [role for role in ORDERS.roles if role.dim == "dim_date"]
    plan = final_plan(enrich(facts, star, dates))
    assert plan.count("ReusedExchange") == 2


def test_adaptive_execution_splits_a_hot_key(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    facts = spark.range(300_000).selectExpr("id", "if(id % 3 = 0, 7, id) AS k")
    dim = {"d": spark.range(300_000).selectExpr("id AS dk", "id * 2 AS v")}
    for how in ("inner", "left"):
        enriched = enrich(facts, dim, [Role("d", "k", "dk", {"v": "v"}, how)])
        assert "skew=true" in final_plan(enriched)
        assert enriched.count() == 300_000
