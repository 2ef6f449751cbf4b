"""Loads that publish whole, checked versions or nothing."""

from pathlib import Path

import pytest
from fixtures import bag, dims, lake
from pyspark.sql import functions as F

from tarnlake.operators import at_least, create_gold, keeps_columns, not_shrunk, roll_back, unique_key, write_dim
from tarnlake.operators import versions as v


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def folders(path):
    return sorted(p.name for p in Path(path).iterdir() if p.is_dir())


def breaking(spark):
    """A source that is lost while it is read."""
    return spark.range(100).select(F.when(F.col("id") == 70, F.raise_error(F.lit("source lost"))).otherwise(F.col("id")).cast("long").alias("k"))


@pytest.fixture
def table(spark, tmp_path):
    return lake(spark, tmp_path).qualified("t")


def test_a_load_that_breaks_off_changes_nothing(spark, tmp_path, table):
    write_dim(spark.range(3).toDF("k"), table, path=str(tmp_path / "t"))
    before = folders(tmp_path / "t")
    with pytest.raises(Exception, match="source lost"):
        write_dim(breaking(spark), table, path=str(tmp_path / "t"))
    assert rows(spark.table(table)) == [(0,), (1,), (2,)]
    assert folders(tmp_path / "t") == before


def test_a_first_load_that_breaks_off_leaves_no_table(spark, tmp_path, table):
    with pytest.raises(Exception, match="source lost"):
        write_dim(breaking(spark), table, path=str(tmp_path / "t"))
    assert not spark.catalog.tableExists(table)


@pytest.mark.parametrize(
    "check, bad, message",
    [
        (unique_key("k"), [(1,), (1,), (None,)], "k 1 more than once"),
        (at_least(2), [(1,)], "1 rows, 2 are expected"),
        (not_shrunk(0.5), [(1,)], "1 rows, the version in use 3"),
    ],
)
def test_a_refused_load_changes_nothing(spark, tmp_path, table, check, bad, message):
    write_dim(spark.range(3).toDF("k"), table, path=str(tmp_path / "t"), checks=[check])
    with pytest.raises(ValueError, match=message):
        write_dim(spark.createDataFrame(bad, "k long"), table, path=str(tmp_path / "t"), checks=[check])
    assert rows(spark.table(table)) == [(0,), (1,), (2,)]
    assert len(folders(tmp_path / "t")) == 1


def test_null_keys_may_repeat_and_other_rows_pass(spark, table):
    good = spark.createDataFrame([(None,), (None,), (1,), (2,)], "k long")
    assert write_dim(good, table, checks=[unique_key("k"), at_least(4), not_shrunk(1.0)]).count() == 4


def test_columns_may_be_held(spark, table):
    write_dim(spark.range(3).selectExpr("id AS k", "'x' AS name"), table)
    for lacking in (spark.range(3).toDF("k"), spark.range(3).selectExpr("id AS k", "1 AS name")):
        with pytest.raises(ValueError, match="it lacks name string"):
            write_dim(lacking, table, checks=[keeps_columns])
    more = spark.range(3).selectExpr("id AS k", "'x' AS name", "1 AS more")
    assert write_dim(more, table, checks=[keeps_columns]).columns == ["k", "name", "more"]


def test_the_version_before_is_kept_and_no_other(spark, tmp_path, table):
    for n in range(1, 6):
        write_dim(spark.range(n).toDF("k"), table, path=str(tmp_path / "t"))
        assert spark.table(table).count() == n
        assert len(folders(tmp_path / "t")) == min(n, 2)


def test_rolled_back_and_loaded_again(spark, tmp_path, table):
    root = str(tmp_path / "t")
    for n in (1, 2):
        write_dim(spark.range(n).toDF("k"), table, path=root)
    assert roll_back(spark, table, root).count() == 1
    with pytest.raises(ValueError, match="no version before"):
        roll_back(spark, table, root)
    write_dim(spark.range(3).toDF("k"), table, path=root)
    assert spark.table(table).count() == 3
    assert roll_back(spark, table, root).count() == 1  # the one in use before, not the one given up


def test_a_version_may_read_the_table_it_replaces(spark, tmp_path, table):
    write_dim(spark.range(3).toDF("k"), table, path=str(tmp_path / "t"))
    write_dim(spark.table(table).unionByName(spark.range(3, 5).toDF("k")), table, path=str(tmp_path / "t"))
    assert rows(spark.table(table)) == [(n,) for n in range(5)]


def test_other_columns_and_partitions(spark, tmp_path, table):
    root = str(tmp_path / "t")
    write_dim(spark.range(3).toDF("k"), table, path=root, comment="one")
    parted = spark.range(6).selectExpr("id AS k", "id % 2 AS part")
    for _ in range(2):
        write_dim(parted, table, path=root, partition_by=["part"], comment="two")
        assert rows(spark.table(table).select("k", "part")) == [(n, n % 2) for n in range(6)]
    assert spark.table(table).where("part = 1").count() == 3
    write_dim(spark.range(2).toDF("k"), table, path=root)
    assert spark.table(table).columns == ["k"] and spark.table(table).count() == 2


def test_a_managed_table_of_old_is_replaced(spark, table):
    spark.range(4).toDF("k").write.saveAsTable(table)
    assert write_dim(spark.range(2).toDF("k"), table).count() == 2
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    assert described["Type"] == "EXTERNAL"


def test_gold_is_checked_too(spark, tmp_path, table):
    create_gold(spark.range(5).toDF("n"), table, order_by=["n"])
    with pytest.raises(ValueError, match="0 rows"):
        create_gold(spark.range(0).toDF("n"), table, checks=[at_least(1)])
    assert spark.table(table).count() == 5


def test_dimensions_are_loaded_together_or_not_at_all(spark, tmp_path):
    lk, star = lake(spark, tmp_path / "lake"), dims(spark)
    before = {name: bag(df.collect()) for name, df in lk.load_dims(star).items()}
    twice = star["dim_customer"].unionByName(star["dim_customer"])
    fewer = star["dim_product"].limit(1)
    with pytest.raises(ValueError, match="dim_customer is refused: it holds customer_key"):
        lk.load_dims({"dim_product": fewer, "dim_customer": twice})
    broken = star["dim_customer"].withColumn("last_name", F.raise_error(F.lit("source lost")))
    with pytest.raises(Exception, match="source lost"):
        lk.load_dims({"dim_product": fewer, "dim_customer": broken})
    with pytest.raises(ValueError, match="dim_product is refused|1 rows"):
        lk.load_dims({"dim_product": fewer}, checks={"dim_product": [not_shrunk(0.9)]})
    assert {name: bag(lk.table(name).collect()) for name in star} == before
    assert lk.load_dims({"dim_customer": twice}, unique=False)["dim_customer"].count() == 2 * star["dim_customer"].count()
    assert bag(lk.roll_back_dim("dim_customer").collect()) == before["dim_customer"]


def test_a_catalog_that_fails_half_way_is_put_back(spark, tmp_path, monkeypatch):
    lk = lake(spark, tmp_path / "lake")
    star = {name: df for name, df in dims(spark).items() if name in ("dim_customer", "dim_product")}
    before = {name: bag(df.collect()) for name, df in lk.load_dims(star).items()}
    point, calls = v.point, []

    def failing(*args, **how):
        calls.append(args[1])
        if len(calls) == 2:
            raise OSError("catalog lost")
        return point(*args, **how)

    monkeypatch.setattr(v, "point", failing)
    with pytest.raises(OSError, match="catalog lost"):
        lk.load_dims({name: df.limit(1) for name, df in star.items()})
    assert {name: bag(lk.table(name).collect()) for name in star} == before


def test_unfinished_folders_are_no_versions(spark, tmp_path, table):
    root = tmp_path / "t"
    write_dim(spark.range(3).toDF("k"), table, path=str(root))
    (root / "version=000000000002-dead").mkdir()
    assert len(v.versions(spark, str(root))) == 1
    write_dim(spark.range(4).toDF("k"), table, path=str(root))
    assert spark.table(table).count() == 4
