"""Joins with small and large written tables, and components of a link table."""

import brute
import pytest
from pyspark.sql import functions as F

from tarnlake.llm import staging
from tarnlake.llm.components import components
from tarnlake.llm.line_templates import drop_recurring_lines
from tarnlake.llm.numbering import bucket_of, number_within, range_bounds
from tarnlake.llm.prob_minhash import near_duplicates


@pytest.mark.parametrize("operator", [drop_recurring_lines, near_duplicates])
def test_results_do_not_depend_on_what_counts_as_small(spark, corpus, monkeypatch, operator):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    key = lambda row: str(row["doc_id"])
    small = sorted(operator(docs).collect(), key=key)
    monkeypatch.setattr(staging, "SMALL_ROWS", 0)
    assert sorted(operator(docs).collect(), key=key) == small


def test_small_tables_are_hinted_and_large_ones_are_not(spark, monkeypatch):
    stage = staging.Stage(spark, "hints")
    table = stage.put(spark.range(1000), "ids")
    hinted = lambda: "broadcast" in staging.small_or_not(table)._jdf.queryExecution().logical().toString()
    assert hinted()
    monkeypatch.setattr(staging, "SMALL_BYTES", 100)
    assert not hinted()


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(1000, 1400)]
    links = [*chain, *star, (5, 5), (3, 2), (2, 3), (1, 3), (160, 1399)]
    classes = brute.Classes({n for pair in links for n in pair})
    for a, b in links:
        classes.join(a, b)
    found = components(spark.createDataFrame(links, "a long, b long"), staging.Stage(spark, "test"))
    rows = {r.node: r.component for r in found.collect()}
    assert rows == {n: classes.find(n) for n in classes.parent if n != 5}
    assert components(spark.createDataFrame([], "a long, b long"), staging.Stage(spark, "test")).count() == 0


def test_numbers_have_no_gap(spark):
    df = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5).alias("g"))
    found = number_within(df, "g", ["id"], "n", 16).groupBy("g").agg(F.count("n"), F.min("n"), F.max("n"), F.count_distinct("n"))
    assert all(r[1] == r[3] + 1 == r[4] and r[2] == 0 for r in found.collect())


def test_ranges_are_even_and_never_empty(spark):
    df = spark.range(10_000).select((F.col("id") * F.col("id")).alias("k"))
    bounds = range_bounds(df, "k", 40)
    counts = [r["count"] for r in df.groupBy(bucket_of("k", bounds).alias("b")).count().collect()]
    assert len(counts) == len(bounds) + 1 == 40
    assert max(counts) < 2 * min(counts)
