"""Landed lines: files of bounded length, and each line taken apart once."""

from pathlib import Path

from fixtures import ORDERS_CLEAN, dims, frame, lake, land_array
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarnlake.operators import enrich
from tarnlake.plans import landing
from tarnlake.plans.star import ORDERS
from tarnlake.sources.schema_log import filled_back
from tarnlake.streaming.ingest import _rescued_lines

SCHEMA = StructType().add("a", "long").add("d", "double").add("s", "string")


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_more_lines_are_more_compressed_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "LINES_PER_FILE", 300, raising=False)
    df = spark.range(1000).coalesce(1).select("id", F.lit("the same text in each line").alias("text"))
    landing.land_lines(df, f"{tmp_path}/in")
    files = list((tmp_path / "in").glob("part-*"))
    assert len(files) == 4
    assert sum(file.stat().st_size for file in files) < 1000 * 26
    assert spark.read.json(f"{tmp_path}/in").select("id", "text").exceptAll(df).count() == 0
    assert spark.read.json(f"{tmp_path}/in").count() == 1000


def test_rescued_members_are_sifted_once(spark, tmp_path):
    (tmp_path / "1.json").write_text('{"a": 1, "b": 2}\n')
    rows = _rescued_lines(spark.read, str(tmp_path), SCHEMA, True, {})
    assert optimized(rows).count("map_filter(") == 1
    assert [row["_rescued"] for row in rows.collect()] == ['{"b":2}']


def test_kept_text_is_parsed_once_to_fill_back(spark):
    rows = spark.createDataFrame([(1, '{"w": 2, "x": "y"}'), (2, None), (3, "no json")], "a BIGINT, _rescued STRING")
    filled = filled_back(rows, StructType.fromDDL("a BIGINT, w BIGINT, v DOUBLE"), "_rescued")
    assert optimized(filled).count("parseJson(") == 1
    assert sorted(map(tuple, filled.collect())) == [(1, 2, None, '{"x":"y"}'), (2, None, None, None), (3, None, None, "no json")]


def test_lines_of_every_form(spark, tmp_path):
    lines = [
        '{"a":1,"d":2.5,"s":"x:y"}', '{"a":2}', '{"a":null,"s":"z"}', '[{"a":3},{}]', '[{"a":4},{"a":5}]', '{"a":6,"b" : 7}',
        '{"a":8.5}', "{'a':9}", '{"d":NaN}', '{"a":10', '{"a":11,"b":null}', ' {"a":12}',
    ]
    (tmp_path / "1.json").write_text("\n".join(lines) + "\n")
    rows = _rescued_lines(spark.read, str(tmp_path), SCHEMA, True, {}).collect()
    found = sorted(map(tuple, rows), key=str)
    expected = [
        (1, 2.5, "x:y", None, None), (2, None, None, None, None), (None, None, "z", None, None), (3, None, None, None, None),
        (None, None, None, None, None), (4, None, None, None, None), (5, None, None, None, None), (6, None, None, None, '{"b":7}'),
        (None, None, None, None, '{"a":8.5}'), (9, None, None, None, None), (None, None, None, '{"d":NaN}', None),
        (None, None, None, '{"a":10', None), (11, None, None, None, None), (12, None, None, None, None),
    ]
    assert found == sorted(expected, key=str)


def shuffle_files(spark):
    """Names of the shuffle files that this session's executor holds."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while files.hasNext():
        names.add(files.next().getName())
    return {name for name in names if name.startswith("shuffle_")}


def test_landed_lines_take_little_room(spark, tmp_path):
    """What lies on disk: files well below those of a fast codec, and no shuffle of the rows."""
    facts = spark.range(20_000).selectExpr("id AS fact_order_key", "id * 7919 % 10007 AS product_key", "rand(1) AS unit_price")
    before = shuffle_files(spark)
    landing.land_lines(facts.repartition(2, "product_key"), f"{tmp_path}/in")
    assert shuffle_files(spark) <= before
    facts.write.option("compression", "lz4").json(f"{tmp_path}/fast")
    size = {name: sum(file.stat().st_size for file in (tmp_path / name).glob("part-*")) for name in ("in", "fast")}
    assert size["in"] < 0.75 * size["fast"]
    assert spark.read.json(f"{tmp_path}/in").select(*facts.columns).exceptAll(facts).count() == 0


def test_silver_meets_dimensions_a_part_at_a_time(spark, tmp_path, conf):
    """Dimensions too large to copy: rows are shuffled in bounded parts, and none of it stays on disk."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    lk = lake(spark, tmp_path / "lake", silver_max_files=2)
    lk.load_dims(dims(spark))
    for number in range(5):
        land_array(tmp_path / "in", f"{number}.json", ORDERS_CLEAN)
        lk.bronze(ORDERS, str(tmp_path / "in"))
    before = shuffle_files(spark)
    silver = lk.silver(ORDERS)
    assert shuffle_files(spark) <= before
    batches = list(Path(lk._stream_folders(ORDERS, "silver")["checkpoint"], "commits").glob("[0-9]*"))
    assert len(batches) == 3
    assert silver.count() == 5 * enrich(frame(spark, ORDERS_CLEAN, ORDERS.schema), dims(spark), ORDERS.roles).count()
