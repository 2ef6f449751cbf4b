from collections import Counter

from fixtures import bag
from pyspark.sql import functions as F

import pytest

from tarnlake.operators import HotKeys, find_hot_keys, join_counted, salted_join


def skewed(spark):
    # A third of the rows share key 7, some have no key, the rest are spread.
    rows = [(n, 7 if n % 3 == 0 else (None if n % 10 == 1 else n % 400)) for n in range(3000)]
    return rows, spark.createDataFrame(rows, "id bigint, k bigint")


def test_hot_keys_are_exact_and_bounded(spark):
    rows, facts = skewed(spark)
    counts = Counter(k for _, k in rows if k is not None)
    total = sum(counts.values())
    for share in (0.5, 0.3, 0.01, 0.002):
        hot = find_hot_keys(facts, "k", ["id"], share)
        assert set(hot.keys) == {k for k, n in counts.items() if n >= share * total}
        assert len(hot.keys) <= 1 / share


def test_hot_keys_of_nothing(spark):
    assert find_hot_keys(spark.createDataFrame([], "id bigint, k bigint"), "k", ["id"]).keys == ()


def test_salted_join_is_the_plain_join(spark):
    _, facts = skewed(spark)
    dim = spark.range(300).selectExpr("id AS dk", "id * 10 AS v")
    for how in ("inner", "left"):
        plain = facts.join(dim, facts.k == dim.dk, how).select("id", "k", "v")
        for hot in (HotKeys({7: 8}, ("id",), 8), HotKeys({}, ("id",), 8), HotKeys({7: 3, 399: 2, 5: 1}, ("id",), 3)):
            salted = salted_join(facts, dim, "k", "dk", how, hot)
            assert salted.columns == ["id", "k", "v"]
            assert bag(salted.collect()) == bag(plain.collect())


def test_salting_spreads_the_hot_key_and_the_nulls(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    _, facts = skewed(spark)
    dim = spark.range(400).selectExpr("id AS dk", "id AS v")

    def most(df, key):
        places = df.select("k", F.spark_partition_id().alias("place")).collect()
        return max(Counter(r.place for r in places if r.k == key).values())

    plain = facts.join(dim, facts.k == dim.dk, "left")
    salted = salted_join(facts, dim, "k", "dk", "left", HotKeys({7: 64}, ("id",), 64))
    for key in (7, None):
        assert most(salted, key) < most(plain, key) / 2


def test_join_counted_is_the_plain_join(spark):
    rows, facts = skewed(spark)
    counted = facts.groupBy(F.col("k").alias("ck")).agg(F.count(F.lit(1)).alias("n"))
    counts = Counter(k for _, k in rows if k is not None)
    expected = Counter((i, k, counts[k]) for i, k in rows if k is not None)
    for share in (1.0, 0.2, 1e-4):
        joined = join_counted(facts, counted, "k", "ck", "n", share).select("id", "k", "n")
        assert bag(joined.collect()) == expected


def test_join_counted_never_shuffles_hot_rows(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    _, facts = skewed(spark)
    counted = facts.groupBy(F.col("k").alias("ck")).agg(F.count(F.lit(1)).alias("n"))
    joined = join_counted(facts, counted, "k", "ck", "n", 0.2)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    # Hot rows meet a broadcast, and the rest leave them out before their shuffle.
    assert plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 1
    assert "LeftAnti" in plan.split("SortMergeJoin")[1]


def test_nothing_to_join(spark):
    empty = spark.createDataFrame([], "id bigint, k bigint")
    counted = empty.groupBy(F.col("k").alias("ck")).agg(F.count(F.lit(1)).alias("n"))
    assert join_counted(empty, counted, "k", "ck", "n").count() == 0


def test_salts_follow_the_rows_of_a_key(spark):
    rows, facts = skewed(spark)
    counts = Counter(k for _, k in rows)
    hot = find_hot_keys(facts, "k", ["id"], 0.2, rows_per_salt=100)
    assert hot.salts == {7: -(-counts[7] // 100)}
    assert hot.null_salts == -(-counts[None] // 100)


def test_shares_that_bound_nothing_are_refused(spark):
    _, facts = skewed(spark)
    counted = facts.groupBy(F.col("k").alias("ck")).agg(F.count(F.lit(1)).alias("n"))
    for share in (0, 1e-9, -1, 2):
        with pytest.raises(ValueError, match="share"):
            find_hot_keys(facts, "k", ["id"], share)
        with pytest.raises(ValueError, match="share"):
            join_counted(facts, counted, "k", "ck", "n", share)


def test_join_counted_counts_once(spark, tmp_path):
    _, facts = skewed(spark)
    facts.write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    counted = facts.groupBy(F.col("k").alias("ck")).agg(F.count(F.lit(1)).alias("n"))

    def keep(df):
        df.write.parquet(str(tmp_path / "counts"))
        return spark.read.parquet(str(tmp_path / "counts"))

    joined = join_counted(facts, counted, "k", "ck", "n", 0.2, keep)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [id") + plan.count("Relation [k") <= 2
