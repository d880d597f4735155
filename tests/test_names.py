import pytest

from tablepipe.operators.names import (
    rename_snake,
    rename_strip,
    snake_name,
    strip_name,
    system_id_name,
)


def test_snake_rule():
    assert snake_name(" Optional Kiosk ID (group) ") == "optional_kiosk_id_group"
    assert snake_name("Name (group)") == "name_group"
    assert snake_name("Est Carbon Offset") == "est_carbon_offset"


def test_strip_rule_and_system_id():
    assert strip_name(" Open? ") == "open"
    assert strip_name("Location 1") == "location1"
    assert system_id_name(strip_name(" SID")) == "id"
    # exact rename only (deliberate fix); the legacy rule mangles other names
    assert system_id_name("residence") == "residence"
    assert system_id_name("residence", legacy_sid=True) == "reidence"


def test_rename_frames(spark):
    df = spark.createDataFrame([(1, "a")], "`Trip ID` int, `Bike Type` string")
    assert rename_snake(df).columns == ["trip_id", "bike_type"]
    df = spark.createDataFrame([(1, "a", "b")], "`:sid` string, `Request Type` string, `Residence` string")
    assert rename_strip(df).columns == ["id", "requesttype", "residence"]


def test_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], "`A-B` int, `AB` int")
    with pytest.raises(ValueError, match="collide"):
        rename_strip(df)
