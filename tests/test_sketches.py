"""Audits from what commits noted."""

import pytest
from fixtures import lake, land_array, land_csv, transaction
from pyspark.sql import functions as F

from tarnlake.operators.sketches import RANK_ERROR, RELATIVE_ERROR, Profile, audit_commits, measure_quantiles
from tarnlake.plans.star import INVENTORY_TRANSACTIONS
from tarnlake.streaming import Ledger

FEED = INVENTORY_TRANSACTIONS


@pytest.fixture
def filled(spark, tmp_path):
    """A ledger, and appends of key ranges as deliveries of a file each."""
    ledger = Ledger(spark, str(tmp_path / "ledger"), str(tmp_path / "data"), profile=Profile("k", ("v",)))

    def add(keys):
        file = tmp_path / f"f{len(list(tmp_path.iterdir()))}"
        file.write_text("x")
        rows = spark.createDataFrame([(k, float(k or 0)) for k in keys], "k BIGINT, v DOUBLE") if isinstance(keys, list) else keys
        ledger.append(rows.withColumn("source_file", F.lit(file.as_uri())))
        return audit_commits(ledger, "t").first()

    return ledger, add


def test_deliveries_of_their_own_ranges_are_audited_without_reading(filled):
    _, add = filled
    add([1, 2, 2, None])
    row = add([3, 4, 5])
    assert (row.row_count, row.distinct_keys, row.null_keys, row.duplicate_keys, row.exact, row.rows_read) == (7, 5, 1, 1, True, 0)


def test_only_deliveries_whose_ranges_meet_are_read(filled):
    ledger, add = filled
    add(list(range(0, 100)))
    add(list(range(200, 300)))
    row = add([250, 299, 400])
    assert (row.row_count, row.distinct_keys, row.duplicate_keys, row.exact, row.rows_read) == (203, 201, 2, True, 103)
    row = audit_commits(ledger, "t", exact=False).first()
    assert (row.distinct_keys, row.exact, row.rows_read) == (203, False, 0)
    assert abs(row.estimated_keys - 201) <= 201 * 4 * RELATIVE_ERROR + 1


def test_ranges_that_meet_through_others(filled):
    _, add = filled
    add([1, 50])
    add([40, 90])
    row = add([80, 120])
    assert (row.distinct_keys, row.rows_read) == (6, 6)


def test_error_of_merged_key_sketches(spark, filled):
    ledger, add = filled
    for n in range(4):
        add(spark.range(n * 20_000, n * 20_000 + 25_000).select(F.col("id").alias("k"), F.col("id").cast("double").alias("v")))
    row = audit_commits(ledger, "t").first()
    assert row.distinct_keys == 85_000 and row.duplicate_keys == 15_000
    assert abs(row.estimated_keys - 85_000) / 85_000 < 4 * RELATIVE_ERROR
    for r in measure_quantiles(ledger, (0.0, 0.25, 0.5, 0.99, 1.0)).collect():
        ranked = spark.range(1).select(F.lit(r.value)).first()[0]
        below = sum(max(0, min(25_000, ranked - n * 20_000)) for n in range(4)) / 100_000
        assert abs(below - r.fraction) <= 2 * RANK_ERROR


def test_empty_and_null_deliveries(filled):
    ledger, add = filled
    assert audit_commits(ledger, "t").first().row_count == 0
    row = add([None, None])
    assert (row.row_count, row.distinct_keys, row.null_keys, row.estimated_keys) == (2, 0, 2, 0)
    assert measure_quantiles(ledger, (0.5,)).first().value == 0.0


def test_what_was_noted_for_no_commit_does_not_count(filled, monkeypatch):
    ledger, add = filled
    add([1, 2])
    with monkeypatch.context() as broken:
        broken.setattr(Ledger, "_commit", lambda *args: (_ for _ in ()).throw(OSError("driver lost")))
        with pytest.raises(OSError):
            add([3, 4])
    ledger.recover()
    assert audit_commits(ledger, "t").first().row_count == 2


def test_text_keys(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "l"), str(tmp_path / "d"), profile=Profile("k"))
    (tmp_path / "f").write_text("x")
    rows = spark.createDataFrame([("b",), ("a",), ("a",)], "k STRING").withColumn("source_file", F.lit((tmp_path / "f").as_uri()))
    ledger.append(rows)
    row = audit_commits(ledger, "t").first()
    assert (row.distinct_keys, row.duplicate_keys) == (2, 1)


def test_a_feed_filled_once(spark, tmp_path):
    lk, landing = lake(spark, tmp_path / "lake"), tmp_path / "in"
    land_array(landing, "1.json", [transaction(n) for n in range(10)])
    land_csv(landing, "2.json", [transaction(20)])
    lk.bronze(FEED, str(landing), once=True)
    row = lk.audit_once(FEED).first()
    assert (row.table_name, row.row_count, row.distinct_keys, row.null_keys, row.corrupt_rows) == (FEED.bronze_table, 11, 10, 1, 1)
    lk.salvage(FEED)
    assert lk.audit_once(FEED).first().distinct_keys == 11
    quantity = sorted(transaction(n)["quantity"] for n in [*range(10), 20])
    (median,) = lk.quantiles(FEED, (0.5,)).collect()
    assert quantity[4] <= median.value <= quantity[6]
