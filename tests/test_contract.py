import json

import pytest

from tablepipe.operators.catalog import UPLOAD_METADATA_PATHS, extract_paths
from tablepipe.operators.contract import (
    TableContract,
    build_schema,
    check_contract,
    contract_report,
    metadata_columns,
    sql_type_map,
    table_columns,
    varchar_violations,
)

# Metadata of a portal dataset (FIXTURES section 4)
META = {
    "description": "Service requests, with 'quotes'",
    "rowsUpdatedAt": 1719819000,
    "columns": [
        {"name": "Request Type", "dataTypeName": "text"},
        {"name": "Created Date", "dataTypeName": "calendar_date"},
        {"name": "Amount", "dataTypeName": "money"},
        {"name": "Open?", "dataTypeName": "checkbox"},
        {"name": "Location 1", "dataTypeName": "location"},
        {"name": "Geo", "dataTypeName": "point"},
        {"name": "Zone", "dataTypeName": "polygon"},
        {"name": "Residence", "dataTypeName": "text"},
        {"name": "Ghost", "dataTypeName": "text"},
        {"name": "Created_At", "dataTypeName": "text"},
    ],
}
DATA = ["requesttype", "createddate", "amount", "open", "location1", "geo", "zone", "residence",
        "created_at", "id", "updated_at"]


def _meta(spark, doc=META):
    return metadata_columns(spark.createDataFrame([("ds", json.dumps(doc))], "dataset_id string, doc string"))


def test_type_maps():
    assert sql_type_map("postgres")["point"] == "POINT"
    assert sql_type_map("redshift")["point"] == "VARCHAR(1024)"
    m = sql_type_map("postgres", varchar_len=256)
    assert m["point"] == m["text"] == m["location"] == "VARCHAR(256)" and m["polygon"] == "VARCHAR(1024)"
    with pytest.raises(ValueError, match="warehouse"):
        sql_type_map("oracle")


def test_build_schema(spark):
    b = build_schema(_meta(spark), DATA, "postgres")
    assert b.drifted == ["ghost"]
    names = b.column_order
    # system type wins at the old position; the other system fields are appended
    assert names[:8] == ["requesttype", "createddate", "amount", "open", "location1", "geo", "zone", "residence"]
    assert names[8:] == ["created_at", "id", "updated_at"]
    cols = {c["name"]: c["sql_type"] for c in table_columns(b.contract)}
    assert cols["created_at"] == "TIMESTAMP" and cols["id"] == "VARCHAR(2048)"
    assert b.point_columns == ["geo"]
    assert cols["amount"] == "DOUBLE PRECISION" and cols["open"] == "boolean"


def test_unknown_type_only_if_loaded(spark):
    doc = dict(META, columns=META["columns"] + [{"name": "Blob", "dataTypeName": "blob"}])
    build_schema(_meta(spark, doc), DATA, "redshift")  # drifted: no error
    with pytest.raises(KeyError, match="blob"):
        build_schema(_meta(spark, doc), DATA + ["blob"], "redshift")


def test_name_collision(spark):
    doc = dict(META, columns=[{"name": "A B", "dataTypeName": "text"}, {"name": "AB", "dataTypeName": "text"}])
    with pytest.raises(ValueError, match="collide"):
        build_schema(_meta(spark, doc), ["ab"], "redshift")


def test_contract_check_and_report(spark):
    c = TableContract.from_ddl("trip_id bigint, ons bigint, name string, x double", keys=["trip_id"])
    df = spark.createDataFrame([(1, None, "a"), (2, 3, None)], "trip_id bigint, ons bigint, name string")
    with pytest.raises(AssertionError, match="x: missing"):
        check_contract(df, c)
    rep = {r.column_name: r for r in contract_report(df, c).collect()}
    assert rep["ons"].nulls == 1 and rep["ons"].ok is False  # null in an integer column
    assert rep["name"].nulls == 1 and rep["name"].ok is True
    assert rep["x"].actual is None and rep["x"].ok is False


def test_varchar_violations(spark):
    c = TableContract.from_ddl("t string", varchar={"t": 3})
    df = spark.createDataFrame([("abcd", "x"), ("ab", "x"), (None, "y")], "t string, g string")
    got = {r.g: r.t_too_long for r in varchar_violations(df, c, by="g").collect()}
    assert got == {"x": 1, "y": 0}


def test_metadata_capture(spark):
    docs = spark.createDataFrame([("ds", json.dumps(META)), ("empty", "{}")], "dataset_id string, doc string")
    got = {(r.dataset_id, r.name): (r.raw, r.display)
           for r in extract_paths(docs, "doc", UPLOAD_METADATA_PATHS, zone="UTC").collect()}
    assert got[("ds", "Data updated at")] == ("1719819000", "2024-07-01 07:30")
    assert got[("ds", "Data provided by")] == (None, None)  # missing author
    assert got[("empty", "Data updated at")] == (None, None)  # missing epoch: null, no crash
    assert got[("ds", "Description")][0].startswith("Service requests")


def test_infer_types(spark):
    from tablepipe.operators.contract import infer_types

    df = spark.createDataFrame([("1,234", "1.5", "x", " "), ("7", "2", "3", None)], "a string, b string, c string, d string")
    got = infer_types(df)
    assert dict(got.dtypes) == {"a": "bigint", "b": "double", "c": "string", "d": "string"}
    assert [r.a for r in got.collect()] == [1234, 7] and got.first().d is None


def test_enforce_varchar(spark):
    from tablepipe.operators.contract import enforce_varchar

    c = TableContract.from_ddl("t string", varchar={"t": 3})
    ok = spark.createDataFrame([("abc",), (None,)], "t string")
    assert enforce_varchar(ok, c).count() == 2
    with pytest.raises(Exception, match="VARCHAR"):
        enforce_varchar(spark.createDataFrame([("abcd",)], "t string"), c).collect()
