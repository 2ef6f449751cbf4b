"""Schemas that follow a feed: the widening of types, the log, and rows filled back."""

import json
import shutil
from pathlib import Path

import pytest
from fixtures import bag, lake, transaction
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tarnlake.plans.star import INVENTORY_TRANSACTIONS
from tarnlake.sources.schema_log import SchemaLog, filled_back, merged, observed, widened
from tarnlake.streaming import Ledger

FEED = INVENTORY_TRANSACTIONS
KEY = "fact_inventory_transaction_key"
SIMPLE = [
    NullType(), BooleanType(), ShortType(), IntegerType(), LongType(), FloatType(), DoubleType(), DecimalType(10, 2),
    DecimalType(30, 0), DateType(), TimestampNTZType(), TimestampType(), StringType(), ArrayType(LongType()),
    StructType().add("a", LongType()), StructType().add("a", StringType()).add("b", DoubleType()),
]
TYPES = st.sampled_from(SIMPLE)


@settings(max_examples=300, deadline=None)
@given(TYPES, TYPES, TYPES)
def test_widening_is_a_lattice(a, b, c):
    assert widened(a, a) == a
    assert fields(widened(a, b)) == fields(widened(b, a))
    assert fields(widened(widened(a, b), c)) == fields(widened(a, widened(b, c)))
    assert fields(widened(widened(a, b), a)) == fields(widened(a, b))  # as wide as what it came from


def fields(kind):
    """A type but for the order of the fields of a record."""
    if isinstance(kind, StructType):
        return {f.name: fields(f.dataType) for f in kind}
    if isinstance(kind, ArrayType):
        return [fields(kind.elementType)]
    return kind.simpleString()


@pytest.mark.parametrize(
    "a, b, both",
    [
        (IntegerType(), LongType(), LongType()),
        (LongType(), DoubleType(), DoubleType()),
        (LongType(), StringType(), StringType()),
        (LongType(), BooleanType(), StringType()),
        (DateType(), TimestampType(), TimestampType()),
        (DecimalType(10, 2), LongType(), DecimalType(21, 2)),
        (DecimalType(38, 0), DecimalType(10, 10), DoubleType()),
        (DecimalType(10, 2), DateType(), StringType()),
        (ArrayType(LongType()), ArrayType(DoubleType()), ArrayType(DoubleType())),
        (ArrayType(LongType()), LongType(), StringType()),
    ],
)
def test_widened_types(a, b, both):
    assert widened(a, b) == both


def test_merged_fields_keep_their_order_and_pinned_ones_their_type(spark):
    one = StructType.fromDDL("k BIGINT, v BIGINT, s STRING")
    other = StructType.fromDDL("n DOUBLE, v DOUBLE, k STRING, nothing VOID")
    assert merged(one, other, ["k"]) == StructType.fromDDL("k BIGINT, v DOUBLE, s STRING, n DOUBLE")


def test_observed_types(spark):
    texts = ['{"a":1,"b c":"x","n":null}', '{"a":2.5,"o":{"p":[1,2]}}', "7", None, "no json", '{"VARIANT":3,"m":1}', '{"m":"x"}', "[1]"]
    found = observed(spark.createDataFrame([(t,) for t in texts], "r STRING"), "r")
    kinds = {f.name: f.dataType.simpleString() for f in found}
    assert kinds == {"a": "double", "b c": "string", "n": "void", "o": "struct<p:array<bigint>>", "VARIANT": "bigint", "m": "string"}
    assert observed(spark.createDataFrame([(None,), ("7",)], "r STRING"), "r") == StructType([])


def test_the_log_keeps_all_versions(spark, tmp_path, monkeypatch):
    log = SchemaLog(spark, str(tmp_path / "log"))
    assert log.latest() is None and log.versions() == {} and log.seen() == 0
    first, second = StructType.fromDDL("k BIGINT"), StructType.fromDDL("k BIGINT, `ü n` STRING")
    assert (log.append(first), log.append(second)) == (1, 2)
    assert log.versions() == {1: first, 2: second} and log.latest() == (2, second)
    log.see(4)
    log.see(3)
    assert log.seen() == 4 and log.latest() == (2, second)
    late = SchemaLog(spark, str(tmp_path / "log"))
    monkeypatch.setattr(SchemaLog, "versions", lambda self: {1: first})
    with pytest.raises(OSError, match="taken by another"):
        late.append(first)


def test_rows_are_filled_back(spark):
    rows = spark.createDataFrame(
        [(1, 5, None, "f"), (2, None, '{"v":2.5,"new":"x","deep":{"a":[1]}}', "f"), (3, None, '{"v":[1],"other":1}', "f"), (4, None, "7", "f")],
        "k BIGINT, v BIGINT, _rescued STRING, source_file STRING",
    )
    wider = StructType.fromDDL("k BIGINT, v DOUBLE, new STRING, deep STRUCT<a: ARRAY<BIGINT>>")
    found = {r.k: r for r in filled_back(rows, wider, "_rescued").collect()}
    assert (found[1].v, found[1].new, found[1]._rescued, found[1].source_file) == (5.0, None, None, "f")
    assert (found[2].v, found[2].new, found[2].deep.a, found[2]._rescued) == (2.5, "x", [1], None)
    assert (found[3].v, json.loads(found[3]._rescued)) == (None, {"v": [1], "other": 1})
    assert found[4]._rescued == "7"


def land(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in records))


def deliver(lk, landing, name, records, **how):
    land(landing, name, records)
    return lk.bronze_following(FEED, str(landing), multi_line=False, **how)


@pytest.fixture
def place(spark, tmp_path):
    return lake(spark, tmp_path / "lake"), tmp_path / "in"


def test_three_deliveries(spark, place):
    lk, landing = place
    deliver(lk, landing, "1.json", [transaction(1), transaction(2)])
    assert len(lk.schema_log(FEED).versions()) == 1
    rows = deliver(lk, landing, "2.json", [{**transaction(3), "weight": 4, "tags": {"a": 1}}])
    assert dict(rows.dtypes)["weight"] == "bigint" and dict(rows.dtypes)["tags"] == "struct<a:bigint>"
    rows = deliver(lk, landing, "3.json", [{**transaction(4), "weight": 4.5, "coupon": "C"}, {**transaction(5), "weight": 6, "tags": {"a": "x"}}])
    assert dict(rows.dtypes)["weight"] == "double" and dict(rows.dtypes)["tags"] == "struct<a:string>"
    deliver(lk, landing, "4.json", [{**transaction(6), "weight": 7.25, "coupon": "D", "tags": {"a": "y"}}])
    assert len(lk.schema_log(FEED).versions()) == 3
    found = {r[KEY]: (r.weight, r.coupon, r.tags and r.tags.a, r._rescued) for r in lk.followed(FEED).collect()}
    first = {transaction(n)[KEY]: n for n in range(1, 7)}
    assert {first[k]: v for k, v in found.items()} == {
        1: (None, None, None, None), 2: (None, None, None, None), 3: (4.0, None, "1", None), 4: (4.5, "C", None, None),
        5: (6.0, None, "x", None), 6: (7.25, "D", "y", None),
    }
    view = spark.sql(f"SELECT count(*) AS n FROM {lk.view(f'{FEED.name}_followed')}")
    assert view.first().n == 6
    # The fourth delivery was read as the third version and needs nothing filled back.
    last = spark.read.parquet(lk._ledger_of(FEED, 3).data)
    assert [(r.weight, r.coupon, r._rescued) for r in last.collect()] == [(7.25, "D", None)]


def test_keys_keep_their_type(spark, place):
    lk, landing = place
    rows = deliver(lk, landing, "1.json", [transaction(1), {**transaction(2), "product_key": "P-2", "quantity": "many"}])
    assert dict(rows.dtypes)["product_key"] == "bigint" and dict(rows.dtypes)["quantity"] == "string"
    odd = rows.where("quantity = 'many'").first()
    assert odd.product_key is None and json.loads(odd._rescued) == {"product_key": "P-2"}


def test_nothing_is_read_twice_when_the_version_changes(spark, place, monkeypatch):
    """A run stops after its rows were committed and before the next version was made."""
    lk, landing = place
    deliver(lk, landing, "1.json", [transaction(1)])
    with monkeypatch.context() as broken:
        broken.setattr(SchemaLog, "follow", lambda *args: (_ for _ in ()).throw(OSError("driver lost")))
        with pytest.raises(OSError, match="driver lost"):
            deliver(lk, landing, "2.json", [{**transaction(2), "weight": 1}])
    assert len(lk.schema_log(FEED).versions()) == 1
    rows = deliver(lk, landing, "3.json", [transaction(3)])
    assert len(lk.schema_log(FEED).versions()) == 2  # the stopped run's fields are found now
    shutil.rmtree(Path(lk.root) / FEED.name / "followed" / "checkpoint")
    rows = deliver(lk, landing, "4.json", [{**transaction(4), "weight": 2}])
    assert bag(rows.select("weight").collect()) == bag([(None,), (1,), (None,), (2,)])


def test_only_new_commits_are_looked_through(spark, place, monkeypatch):
    lk, landing = place
    deliver(lk, landing, "1.json", [transaction(1)])
    asked = []
    monkeypatch.setattr(Ledger, "committed_after", lambda self, n, of=Ledger.committed_after: asked.append(n) or of(self, n))
    deliver(lk, landing, "2.json", [transaction(2)])
    deliver(lk, landing, "3.json", [transaction(3)])
    assert asked == [1, 2]
    monkeypatch.undo()
    new = lk._ledger_of(FEED, 1).committed_after(2)
    assert [r[KEY] for r in new.collect()] == [transaction(3)[KEY]]


def test_a_feed_that_never_changes_has_one_version(spark, place):
    lk, landing = place
    for n in range(2):
        rows = deliver(lk, landing, f"{n}.json", [transaction(n)])
    assert len(lk.schema_log(FEED).versions()) == 1
    assert rows.count() == 2
