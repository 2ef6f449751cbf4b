"""Histories of dimensions, and joins as of a fact's time."""

from datetime import datetime, timedelta

import pytest
from fixtures import ORDERS_CLEAN, ORDERS_ODD, bag, dims, lake, land_array
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnlake.operators.history import first_states, join_as_of, next_states, overlapping
from tarnlake.operators.roles import Role
from tarnlake.plans.star import ORDERS

DAY = datetime(2024, 1, 1)
SCHEMA = "k INT, v STRING, w INT"


def states(df):
    return sorted((r.k, r.valid_from, r.valid_to or datetime(2999, 1, 1), r.v, r.w) for r in df.collect())


def history(spark, loads):
    """Of (days, rows) in turn."""
    found = None
    for days, rows in loads:
        dim, at = spark.createDataFrame(rows, SCHEMA), DAY + timedelta(days=days)
        found = first_states(dim, at) if found is None else next_states(found, dim, "k", at)
    return found


LOADS = [
    (0, [(1, "a", 1), (2, "b", None), (3, "c", 3)]),
    (10, [(1, "a", 1), (2, "b", None), (3, "C", 3)]),
    (50, [(1, "a", None), (4, "d", 4), (None, "x", 0)]),
    (400, [(1, "a", None), (2, "b", None), (4, "d", 4)]),
]


def test_states_follow_the_loads(spark):
    end, at = datetime(2999, 1, 1), lambda days: DAY + timedelta(days=days)
    found = history(spark, LOADS)
    assert states(found) == sorted([
        (1, at(0), at(50), "a", 1), (1, at(50), end, "a", None),
        (2, at(0), at(50), "b", None), (2, at(400), end, "b", None),
        (3, at(0), at(10), "c", 3), (3, at(10), at(50), "C", 3),
        (4, at(50), end, "d", 4),
    ], key=lambda s: (s[0], s[1]))
    assert overlapping(found, "k").count() == 0


def test_overlaps_are_found(spark):
    found = history(spark, LOADS[:1])
    assert overlapping(found.unionByName(found.withColumn("valid_from", F.lit(DAY + timedelta(days=1)))), "k").count() == 3


ROLE = {how: Role("dim", "key", "k", {"v": "dim_v"}, how) for how in ("inner", "left")}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([1, 2, 3, 4, 9, None]), st.integers(-5, 500)), max_size=30), st.sampled_from(["inner", "left"]), st.sampled_from([1, 30, 1000]))
def test_facts_meet_the_state_of_their_time(spark, facts, how, days):
    told = history(spark, LOADS)
    rows = [(n, key, DAY + timedelta(days=d)) for n, (key, d) in enumerate(facts)] + [(1000, 1, None)]
    df = spark.createDataFrame(rows, "n INT, key INT, t TIMESTAMP")
    known = states(told)
    expected = []
    for n, key, t in rows:
        values = [v for k, a, b, v, _ in known if k == key and t is not None and a <= t < b]
        assert len(values) <= 1
        if values or how == "left":
            expected.append((n, values[0] if values else None))
    assert bag((r.n, r.dim_v) for r in join_as_of(df, told, ROLE[how], "t", days).collect()) == bag(expected)


def test_no_facts_and_no_states(spark):
    told = history(spark, LOADS)
    none = spark.createDataFrame([], "n INT, key INT, t TIMESTAMP")
    assert join_as_of(none, told, ROLE["left"], "t").count() == 0
    one = spark.createDataFrame([(1, 1, DAY)], "n INT, key INT, t TIMESTAMP")
    assert join_as_of(one, told.where("k < 0"), ROLE["left"], "t").first().dim_v is None


@pytest.mark.parametrize("rows", [ORDERS_CLEAN + ORDERS_ODD])
def test_silver_is_rebuilt_as_it_was_loaded(spark, tmp_path, rows):
    lk, landing, star = lake(spark, tmp_path / "lake"), tmp_path / "in", dims(spark)
    for number, part in enumerate((rows[:4], rows[4:7], rows[7:])):
        changed = {
            name: df.withColumn("last_name", F.concat(F.lit(f"{number} "), "last_name")) if name in ("dim_customer", "dim_employee") else df
            for name, df in star.items()
        }
        lk.load_dims(changed)
        lk.note_dims()
        land_array(landing, f"{number}.json", part)
        lk.bronze(ORDERS, str(landing))
        silver = lk.silver(ORDERS)
    assert bag(lk.rebuilt_silver(ORDERS).collect()) == bag(silver.collect())
    assert len({r.customer_last_name[:1] for r in silver.collect()}) == 3
