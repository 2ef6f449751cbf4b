"""Appends that a ledger keeps from happening twice, and the replay of odd files."""

import shutil
from pathlib import Path

import pytest
from fixtures import ORDERS_CLEAN, bag, dims, lake, land_array, land_csv, order, transaction
from pyspark.sql import functions as F

from tarnlake.functions import with_lineage
from tarnlake.plans.star import INVENTORY_TRANSACTIONS, ORDERS
from tarnlake.streaming import Ledger, append_once, stream_json


def keys(df):
    return sorted(r[0] for r in df.select(df.columns[0]).collect())


def stream(spark, landing, **how):
    return with_lineage(stream_json(spark, str(landing), "k BIGINT", **how))


@pytest.fixture
def place(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"), str(tmp_path / "data"))
    return ledger, lake(spark, tmp_path / "lake").qualified("t"), tmp_path


def fill(spark, place, checkpoint="c", **how):
    ledger, table, root = place
    return append_once(stream(spark, root / "in", **how), table, str(root / checkpoint), ledger)


def test_only_new_files(spark, place):
    land_array(place[2] / "in", "1.json", [{"k": 1}, {"k": 2}])
    assert keys(fill(spark, place)) == [1, 2]
    assert keys(fill(spark, place)) == [1, 2]
    land_array(place[2] / "in", "2.json", [{"k": 3}])
    assert keys(fill(spark, place)) == [1, 2, 3]


def test_a_lost_checkpoint_fills_nothing_twice(spark, place):
    for n in range(4):
        land_array(place[2] / "in", f"{n}.json", [{"k": n}])
    fill(spark, place, max_files=2)
    shutil.rmtree(place[2] / "c")
    land_array(place[2] / "in", "new.json", [{"k": 10}, {"k": 11}])
    assert keys(fill(spark, place, max_files=3)) == [0, 1, 2, 3, 10, 11]
    assert keys(fill(spark, place, "another")) == [0, 1, 2, 3, 10, 11]
    entries = place[0].entries()
    assert entries.count() == 5 and entries.select("source_file").distinct().count() == 5
    assert entries.where("length IS NULL OR length = 0").count() == 0


def test_a_file_of_another_length_is_another_file(spark, place):
    land_array(place[2] / "in", "1.json", [{"k": 1}])
    fill(spark, place)
    land_array(place[2] / "in", "1.json", [{"k": 1}, {"k": 2}])
    assert keys(fill(spark, place, "another")) == [1, 1, 2]


def test_names_that_a_uri_writes_otherwise(spark, place):
    land_array(place[2] / "in", "a b%ü.json", [{"k": 1}])
    fill(spark, place)
    assert keys(fill(spark, place, "another")) == [1]


def test_nothing_has_landed(spark, place):
    (place[2] / "in").mkdir()
    table = fill(spark, place)
    assert table.columns[0] == "k" and table.count() == 0


STEPS = {"before the commit": "_commit", "after the commit": "_move"}


@pytest.mark.parametrize("step", STEPS)
def test_a_run_that_stops_is_made_good(spark, place, monkeypatch, step):
    """The old checkpoint, a new one, and what the next start does itself all lead to the same rows."""
    land_array(place[2] / "in", "1.json", [{"k": 1}])
    fill(spark, place)
    land_array(place[2] / "in", "2.json", [{"k": 2}, {"k": 3}])
    with monkeypatch.context() as broken:
        broken.setattr(Ledger, STEPS[step], lambda *args: (_ for _ in ()).throw(OSError("executor lost")))
        with pytest.raises(Exception, match="executor lost"):
            fill(spark, place)
    assert keys(place[0].table(place[1])) == [1]  # no reader sees half a commit
    place[0].recover()
    assert keys(place[0].table(place[1])) == ([1] if step.startswith("before") else [1, 2, 3])
    assert keys(fill(spark, place, "another")) == [1, 2, 3]
    assert not list(Path(place[0].root, "staged").iterdir())


def test_a_move_that_stops_half_way_goes_on(spark, place, monkeypatch):
    ledger, table, root = place
    rows = spark.range(100).repartition(5).select("id", F.lit((root / "f").as_uri()).alias("source_file"))
    (root / "f").write_text("x")
    move = Ledger._move
    moved = []

    def half(self, token, number):
        staged = sorted(Path(self.root, "staged", token).glob("part-*"))
        Path(self.data).mkdir(exist_ok=True)
        staged[0].rename(Path(self.data, f"{number:09d}-{staged[0].name}"))
        moved.append(token)
        raise OSError("driver lost")

    monkeypatch.setattr(Ledger, "_move", half)
    with pytest.raises(OSError, match="driver lost"):
        ledger.append(rows)
    monkeypatch.setattr(Ledger, "_move", move)
    ledger.recover()
    assert keys(ledger.table(table)) == list(range(100))
    assert ledger.append(rows) == []
    assert keys(ledger.table(table)) == list(range(100))


def test_a_table_of_a_plain_stream_is_not_taken_over(spark, tmp_path):
    lk = lake(spark, tmp_path / "lake")
    land_array(tmp_path / "in", "1.json", ORDERS_CLEAN)
    lk.bronze(ORDERS, str(tmp_path / "in"))
    with pytest.raises(ValueError, match="without a ledger"):
        lk.bronze(ORDERS, str(tmp_path / "in"), once=True)


def test_formats_with_a_log_of_their_own(spark, tmp_path):
    with pytest.raises(ValueError, match="delta keeps a log"):
        Ledger(spark, str(tmp_path / "l"), str(tmp_path / "d"), "delta")


def test_silver_follows_a_table_filled_once(spark, tmp_path):
    lk, landing = lake(spark, tmp_path / "lake"), tmp_path / "in"
    lk.load_dims(dims(spark))
    counts = []
    for number, part in enumerate((ORDERS_CLEAN[:3], ORDERS_CLEAN[3:])):
        land_array(landing, f"{number}.json", part)
        lk.bronze(ORDERS, str(landing), once=True)
        shutil.rmtree(tmp_path / "lake" / ORDERS.name / "bronze" / "checkpoint")
        counts.append(lk.silver(ORDERS).count())
    assert counts == [3, 7]


# Files in another form


@pytest.fixture
def odd_lake(spark, tmp_path):
    lk, landing = lake(spark, tmp_path / "lake"), tmp_path / "in"
    land_csv(landing, "1.json", [order(n, paid_date_key=None if n < 3 else 20240203) for n in range(1, 20)])
    land_array(landing, "2.json", ORDERS_CLEAN)
    (landing / "3.json").write_text('[{"fact_order_key": 1}, {"fact_order_')
    lk.bronze(ORDERS, str(landing), once=True)
    return lk, landing


def test_a_csv_file_reaches_bronze_once(spark, odd_lake):
    lk, landing = odd_lake
    letters = {Path(r.source_file).name: (r.records, r.way) for r in lk.dead_letters(ORDERS).collect()}
    assert letters == {"1.json": (1, None), "3.json": (1, None)}
    assert lk.salvage(ORDERS, nullValue="NULL") == 1
    assert lk.salvage(ORDERS, nullValue="NULL") == 0
    good = lk.table(ORDERS.bronze_table).where("fact_order_key IS NOT NULL")
    assert good.count() == 19 + len(ORDERS_CLEAN)
    replayed = good.where(F.col("source_file").endswith("1.json"))
    assert replayed.count() == 19 and replayed.where("receipt_time IS NULL").count() == 0
    assert replayed.where("paid_date_key IS NULL").count() == 2
    expected = [tuple(order(n, paid_date_key=None if n < 3 else 20240203).values()) for n in range(1, 20)]
    names = list(order(1))
    assert bag(replayed.select(*names).collect()) == bag(expected)
    assert {Path(r.source_file).name: r.way for r in lk.dead_letters(ORDERS).collect()} == {"1.json": "csv", "3.json": "unreadable"}


def test_bronze_goes_on_after_a_replay(spark, odd_lake):
    lk, landing = odd_lake
    lk.salvage(ORDERS, nullValue="NULL")
    shutil.rmtree(Path(lk.root) / ORDERS.name / "bronze" / "checkpoint")
    land_csv(landing, "4.json", [order(50)])
    lk.bronze(ORDERS, str(landing), once=True)
    assert lk.salvage(ORDERS, nullValue="NULL") == 1
    assert lk.table(ORDERS.bronze_table).where("fact_order_key IS NOT NULL").count() == 20 + len(ORDERS_CLEAN)


def test_a_replay_that_stops_is_not_made_twice(spark, odd_lake, monkeypatch):
    lk, _ = odd_lake
    with monkeypatch.context() as broken:
        broken.setattr(Ledger, "_move", lambda *args: (_ for _ in ()).throw(OSError("driver lost")))
        with pytest.raises(OSError, match="driver lost"):
            lk.salvage(ORDERS, nullValue="NULL")
    assert lk.salvage(ORDERS, nullValue="NULL") == 0  # the first call's commit is brought to its end
    assert lk.table(ORDERS.bronze_table).where("fact_order_key IS NOT NULL").count() == 19 + len(ORDERS_CLEAN)


def test_headers_in_another_order_unknown_columns_and_misfits(spark, tmp_path):
    lk, landing = lake(spark, tmp_path / "lake"), tmp_path / "in"
    landing.mkdir()
    names = list(transaction(1))
    turned = names[::-1]
    cells = {**transaction(1), "quantity": "many"}
    (landing / "a.json").write_text(",".join([*turned, "remark"]) + "\n" + ",".join([*("" if cells[n] is None else str(cells[n]) for n in turned), '"late, but ""here"""']) + "\n")
    (landing / "b.json").write_text(",".join(names[:2]) + "\n77,78\n")
    (landing / "c.json").write_text("some,other,file\n1,2,3\n")
    lk.bronze(INVENTORY_TRANSACTIONS, str(landing), once=True)
    assert lk.salvage(INVENTORY_TRANSACTIONS) == 2
    rows = {r[names[0]]: r for r in lk.table(INVENTORY_TRANSACTIONS.bronze_table).where(f"{names[0]} IS NOT NULL").collect()}
    assert set(rows) == {transaction(1)[names[0]], 77}
    one = rows[transaction(1)[names[0]]]
    assert one.quantity is None and one.product_key == transaction(1)["product_key"]
    assert one._rescued == '{"quantity":"many","remark":"late, but \\"here\\""}'
    assert rows[77].product_key is None and rows[77]._rescued is None
