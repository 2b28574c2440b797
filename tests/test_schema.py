import datetime
from decimal import Decimal

import pytest

from priceloom.operators.schema import column_profile, plan_columns, resolve_target, table_shape

TYPES = "price int, flag boolean, d date, ts timestamp, dec decimal(8,2), s string"


def frame(spark):
    now = datetime.datetime(2024, 1, 1)
    return spark.createDataFrame([(1, True, now.date(), now, Decimal("2.50"), "x")], TYPES)


def test_roles_by_type(spark):
    plan = plan_columns(frame(spark).schema)
    assert plan.target == "price"
    assert plan.numeric == ("flag", "dec")
    assert plan.boolean == ("flag",)
    assert plan.categorical == ("s",)
    assert plan.ignored == ("d", "ts")


def test_target_falls_back_to_first_eligible_type(spark):
    df = spark.createDataFrame([("a", 1.0, 2, 3)], "s string, f float, n int, m bigint")
    assert resolve_target(df.schema) == "n"


def test_target_name_is_case_sensitive(spark):
    df = spark.createDataFrame([(1, 2.0)], "n int, Price double")
    assert resolve_target(df.schema) == "n"


def test_short_and_decimal_cannot_be_target(spark):
    df = spark.createDataFrame([(1, Decimal("1.0"), 2)], "a smallint, b decimal(4,1), c bigint")
    assert resolve_target(df.schema) == "c"


def test_no_target_raises(spark):
    with pytest.raises(ValueError):
        plan_columns(spark.createDataFrame([("a",)], "s string").schema)


def test_row_key_and_stale_log_target_are_no_features(spark):
    df = spark.createDataFrame([(1, 2.0, 0.5, 3)], "id int, price double, log_price double, rooms int")
    plan = plan_columns(df.schema, row_key=["id"])
    assert plan.numeric == ("rooms",)
    assert [plan.role(c) for c in df.columns] == ["row_key", "target", "ignored", "numeric"]


def test_unknown_row_key_raises(spark):
    with pytest.raises(ValueError):
        plan_columns(spark.createDataFrame([(1,)], "price int").schema, row_key=["id"])


def test_shape(spark):
    assert tuple(table_shape(spark.range(7).selectExpr("id", "id as b")).first()) == (7, 2)


def test_profile_counts_nulls_and_nans(spark):
    df = spark.createDataFrame(
        [(1.0, None), (float("nan"), "x"), (None, None)], "price double, s string"
    )
    rows = {r["name"]: r for r in column_profile(df, plan_columns(df.schema)).collect()}
    assert (rows["price"]["nulls"], rows["price"]["nans"], rows["price"]["role"]) == (1, 1, "target")
    assert (rows["s"]["nulls"], rows["s"]["nans"], rows["s"]["position"]) == (2, 0, 2)
