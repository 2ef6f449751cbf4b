import json
from pathlib import Path

import pytest
from fixtures import bag, land_array
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tarnlake.plans import star
from tarnlake.sources import KeyRange, infer_schema_once, read_csv_dim, read_documents, read_jdbc, scan_documents
from tarnlake.sources.jdbc import jdbc_options


def test_csv_quoting_and_declared_types(spark, tmp_path):
    file = tmp_path / "shippers.csv"
    file.write_text(
        'shipper_key,company,address,city,state_province,zip_postal_code,country_region\n'
        '1,"Vans, Fast","1 ""Old"" Rd",Ulm,BW,01234,DE\n2,Plain,,Åre,Z,99999,SE\n',
        encoding="utf-8",
    )
    rows = read_csv_dim(spark, str(file), star.SHIPPER_SCHEMA).orderBy("shipper_key").collect()
    assert tuple(rows[0]) == (1, "Vans, Fast", '1 "Old" Rd', "Ulm", "BW", "01234", "DE")
    assert rows[1].address is None and rows[1].city == "Åre"
    inferred = read_csv_dim(spark, str(file))
    assert dict(inferred.dtypes)["zip_postal_code"] == "int"
    assert dict(inferred.dtypes)["shipper_key"] == "int"


def test_csv_null_word(spark, tmp_path):
    (tmp_path / "a.json").write_text("k,paid\n1,NULL\n2,20240101\n")
    df = read_csv_dim(spark, str(tmp_path / "a.json"), nullValue="NULL")
    assert dict(df.dtypes)["paid"] == "int"
    assert bag(df.collect()) == bag([(1, None), (2, 20240101)])


PEOPLE = [
    {"k": 1, "city": "Ulm", "name": "b", "x": 1},
    {"k": 2, "city": "Åre", "name": "a", "x": 2},
    {"k": 3, "city": None, "name": "c", "x": 3},
    {"k": 4, "city": "Ulm", "name": "d", "x": 4},
]


@pytest.fixture
def people(spark, tmp_path):
    land_array(tmp_path / "people", "people.json", PEOPLE)
    return read_documents(spark, "json", ["k", "city", "name"], str(tmp_path / "people"), multiLine="true")


def test_documents_are_narrowed(people):
    assert people.columns == ["k", "city", "name"]
    assert people.count() == 4


def test_scan_arguments_apply_by_themselves(people):
    def keys(df):
        return [r.k for r in df.collect()]

    assert sorted(keys(scan_documents(people))) == [1, 2, 3, 4]
    assert sorted(keys(scan_documents(people, {"city": "Ulm"}))) == [1, 4]
    assert sorted(keys(scan_documents(people, {"city": None}))) == [3]
    assert sorted(keys(scan_documents(people, {"city": "Ulm", "name": "d"}))) == [4]
    assert sorted(keys(scan_documents(people, "k > 2"))) == [3, 4]
    assert sorted(keys(scan_documents(people, F.col("k") < 2))) == [1]
    assert scan_documents(people, projection=["name"]).columns == ["name"]
    assert keys(scan_documents(people, sort=["name"])) == [2, 1, 3, 4]
    assert keys(scan_documents(people, sort=[("city", -1), ("k", -1)])) == [2, 4, 1, 3]
    both = scan_documents(people, {"city": "Ulm"}, ["k"], [("name", -1)])
    assert both.columns == ["k"] and keys(both) == [4, 1]


def test_jdbc_options():
    options = jdbc_options("jdbc:x", "t", {"user": "u"}, KeyRange("id", 1, 100, 8), 50)
    assert options == {
        "url": "jdbc:x", "dbtable": "t", "fetchsize": "50", "user": "u",
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "100", "numPartitions": "8",
    }
    assert "partitionColumn" not in jdbc_options("jdbc:x", "t")


def test_jdbc_reaches_the_source_with_the_callers_options(spark):
    # No database here: the source itself must be what refuses.
    with pytest.raises(Exception, match="No suitable driver"):
        read_jdbc(spark, "jdbc:nowhere:db", "dim_date", {"user": "u"})
    with pytest.raises(Exception, match="no.such.Driver"):
        read_jdbc(spark, "jdbc:nowhere:db", "dim_date", {"driver": "no.such.Driver"}, view="v")


def test_a_missing_connector_is_named(spark):
    with pytest.raises(Exception, match="mongodb"):
        read_documents(spark, "mongodb", ["k"], uri="x")


def test_schema_is_inferred_once(spark, tmp_path):
    land_array(tmp_path / "in", "1.json", [{"k": 1, "paid": None, "v": 2}])
    args = (spark, str(tmp_path / "in"), str(tmp_path / "schema"))
    first = infer_schema_once(*args, hints="paid BIGINT, extra STRING")
    assert first.simpleString() == "struct<k:bigint,paid:bigint,v:bigint,extra:string>"
    land_array(tmp_path / "in", "2.json", [{"k": "text", "new": 1.5}])
    assert infer_schema_once(*args) == first


def test_an_all_null_column_is_a_string_without_a_hint(spark, tmp_path):
    land_array(tmp_path / "in", "1.json", [{"k": 1, "paid": None}])
    schema = infer_schema_once(spark, str(tmp_path / "in"), str(tmp_path / "schema"))
    assert dict((f.name, f.dataType.simpleString()) for f in schema) == {"k": "bigint", "paid": "string"}


def test_schema_store_is_plain_text(spark, tmp_path):
    land_array(tmp_path / "in", "1.json", [{"k": 1}])
    infer_schema_once(spark, str(tmp_path / "in"), str(tmp_path / "schema"))
    (part,) = Path(tmp_path / "schema").glob("part-*")
    assert json.loads(part.read_text())["type"] == "struct"


def test_inferring_from_nothing_fails(spark, tmp_path):
    with pytest.raises(PySparkException):
        infer_schema_once(spark, str(tmp_path / "none"), str(tmp_path / "schema"))
