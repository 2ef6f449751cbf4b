from types import SimpleNamespace

import pytest
from fixtures import bag, dims, lake, land_array

from tarnlake.operators import (
    audit_database,
    audit_tables,
    create_gold,
    replace_collections,
    require_unique,
    write_dim,
)
from tarnlake.plans import star
from tarnlake.plans.workspace import run_folder


def test_a_dimension_is_replaced_in_full(spark, tmp_path):
    lk = lake(spark, tmp_path)
    table = lk.qualified("dim_x")
    write_dim(spark.range(5).toDF("k"), table, path=str(tmp_path / "x"), comment="It's a dim")
    again = write_dim(spark.range(2).toDF("k"), table, path=str(tmp_path / "x"), comment="It's a dim")
    assert again.count() == 2 and spark.table(table).count() == 2
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    assert described["Comment"] == "It's a dim"
    assert described["Type"] == "EXTERNAL" and f"{tmp_path}/x/version=" in described["Location"]


def test_gold_is_replaced_and_clustered(spark, tmp_path, conf):
    lk = lake(spark, tmp_path)
    df = spark.range(1000).selectExpr("id % 10 AS g", "id AS n")
    gold = create_gold(df, lk.qualified("g"), order_by=["n"], partition_by=["g"])
    assert gold.count() == 1000 and gold.where("g = 3").count() == 100
    assert create_gold(df.limit(1), lk.qualified("g")).count() == 1


def test_collections_are_replaced_and_counted(spark, tmp_path):
    files = {}
    for name, rows in {"a": [{"k": 1}, {"k": 2}], "b": [{"k": 3, "s": "ü"}]}.items():
        land_array(tmp_path / "in", f"{name}.json", rows)
        files[name] = str(tmp_path / "in" / f"{name}.json")
    for _ in range(2):
        result = replace_collections(spark, files, str(tmp_path / "out"))
        assert bag(result.collect()) == bag([("a", 2), ("b", 1)])
    assert spark.read.json(str(tmp_path / "out" / "b")).first().s == "ü"


def test_collections_of_a_connector_namespace(spark, tmp_path):
    # A connector names the collection by an option; the file sources' "path" is such a one.
    land_array(tmp_path / "in", "a.json", [{"k": 1}, {"k": 2}])
    name = str(tmp_path / "out" / "a")
    for _ in range(2):
        result = replace_collections(
            spark, {name: str(tmp_path / "in" / "a.json")}, fmt="parquet", collection_option="path",
            options={"compression": "gzip"},
        )
        assert bag(result.collect()) == bag([(name, 2)])


def test_a_broken_collection_file_fails(spark, tmp_path):
    land_array(tmp_path / "in", "good.json", [{"k": 1}])
    (tmp_path / "in" / "bad.json").write_text('[{"k": 1}, {"k": ')
    files = {n: str(tmp_path / "in" / f"{n}.json") for n in ("bad", "good")}
    with pytest.raises(Exception, match="bad.json"):
        replace_collections(spark, files, str(tmp_path / "out"), schemas={"bad": "k BIGINT"}).collect()
    assert not (tmp_path / "out" / "good").exists()


def test_audit_counts(spark):
    df = spark.createDataFrame([(1, "x"), (1, None), (None, "y"), (2, None)], "k bigint, _corrupt_record string")
    result = audit_tables({"t": (df, "k"), "u": (spark.range(3).toDF("k"), "k")})
    assert bag(result.collect()) == bag(
        [
            ("t", 4, 2, 1, 1, 2, "k bigint, _corrupt_record string"),
            ("u", 3, 3, 0, 0, 0, "k bigint"),
        ]
    )


def test_audit_of_a_database(spark, tmp_path):
    lk = lake(spark, tmp_path)
    lk.load_dims(dims(spark))
    rows = {r.table_name: r for r in audit_database(spark, lk.database, star.DIMENSION_KEYS).collect()}
    assert set(rows) == set(star.DIMENSION_KEYS) - {"dim_invoice"}
    assert all(r.duplicate_keys == 0 and r.null_keys == 0 for r in rows.values())
    assert rows["dim_date"].row_count == 366


def test_run_folders_follow_the_session():
    def session(context_folder=None, **settings):
        context = SimpleNamespace(getCheckpointDir=lambda: context_folder)
        return SimpleNamespace(conf=settings, sparkContext=context)

    shared = session(**{"spark.checkpoint.dir": "hdfs:///shared/"})
    a, b = run_folder(shared, "x"), run_folder(shared, "x")
    assert a.startswith("hdfs:///shared/tarnlake-x-") and a != b
    assert run_folder(session("hdfs:///set"), "x").startswith("hdfs:///set/tarnlake-x-")
    warehouse = session(**{"spark.sql.warehouse.dir": "hdfs:///warehouse"})
    assert run_folder(warehouse, "x").startswith("hdfs:///warehouse/tarnlake-x-")


def test_a_broken_reload_leaves_every_collection_as_it_was(spark, tmp_path):
    land_array(tmp_path / "in", "a.json", [{"k": 1}, {"k": 2}])
    land_array(tmp_path / "in", "b.json", [{"k": 3}])
    files = {name: str(tmp_path / "in" / f"{name}.json") for name in ("a", "b")}
    target = str(tmp_path / "out")
    replace_collections(spark, files, target, schemas={"a": "k INT", "b": "k INT"})
    land_array(tmp_path / "in", "a.json", [{"k": 9}])
    (tmp_path / "in" / "b.json").write_text('[{"k": 4}, {"k":')
    with pytest.raises(Exception, match="[Mm]alformed|FAILED_READ_FILE|JsonEOF"):
        replace_collections(spark, files, target, schemas={"a": "k INT", "b": "k INT"})
    for name, expected in (("a", [1, 2]), ("b", [3])):
        assert sorted(r.k for r in spark.read.json(f"{target}/{name}").collect()) == expected
    with pytest.raises(ValueError, match="target"):
        replace_collections(spark, files)


def test_dimension_keys_must_be_unique(spark):
    twice = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "k INT, v STRING")
    with pytest.raises(ValueError, match="dim holds k 1 more than once"):
        require_unique({"dim": twice}, {"dim": "k"})
    require_unique({"dim": twice.where("v <> 'b'")}, {"dim": "k"})


def test_a_dropped_lake_leaves_nothing(spark, tmp_path):
    lk = lake(spark, tmp_path / "gone")
    write_dim(spark.range(5).toDF("k"), lk.qualified("dim_x"), path=f"{lk.root}/dimensions/dim_x")
    lk.drop()
    assert not spark.catalog.databaseExists(lk.database)
    assert not (tmp_path / "gone").exists()
