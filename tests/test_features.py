import math

from pyspark.sql import functions as F

from priceloom.operators import features


def test_squares_do_not_overflow(spark):
    df = spark.createDataFrame([(100000,)], "living_area int")
    out, names = features.derive(df, ["living_area"])
    assert names == ["living_area", "living_area_squared"]
    assert out.first()["living_area_squared"] == 1.0e10


def test_ratio_guard(spark):
    rows = [(6.0, 2.0), (6.0, 0.0), (6.0, -1.0), (6.0, None)]
    df = spark.createDataFrame(rows, "living_area double, land_area double")
    made = features.ratio_columns(["living_area", "land_area"])
    assert [r[0] for r in df.select(*[c.alias(n) for n, c in made.items()]).collect()] == [3.0, 0.0, 0.0, 0.0]


def test_all_derived_names_in_order(spark):
    every = ["living_area", "bedrooms", "bathrooms", "total_rooms", "land_area"]
    assert list(features.derived_columns(every)) == [
        "living_area_squared",
        "bedrooms_squared",
        "bathrooms_squared",
        "total_rooms_squared",
        "land_area_squared",
        "living_land_ratio",
        "bed_bath_ratio",
        "area_per_bedroom",
        "living_area_x_bathrooms",
        "bedrooms_x_bathrooms",
        "living_area_x_land_area",
    ]


def test_missing_inputs_skip_features(spark):
    df = spark.createDataFrame([(3.0, 2.0)], "bedrooms double, bathrooms double")
    _, names = features.derive(df, df.columns)
    assert names == [
        "bedrooms",
        "bathrooms",
        "bedrooms_squared",
        "bathrooms_squared",
        "bed_bath_ratio",
        "bedrooms_x_bathrooms",
    ]


def test_existing_feature_is_recomputed_and_listed_once(spark):
    df = spark.createDataFrame([(8.0, 2.0, -1.0)], "living_area double, land_area double, living_land_ratio double")
    out, names = features.derive(df, df.columns)
    assert names.count("living_land_ratio") == 1 and out.columns.count("living_land_ratio") == 1
    assert out.first()["living_land_ratio"] == 4.0


def test_one_projection_for_all_features(spark):
    names = ("living_area", "bedrooms", "bathrooms", "land_area")
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)], ", ".join(f"{c} double" for c in names))
    out, _ = features.derive(df, df.columns)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") == 1 and "PythonUDF" not in plan


def test_log_and_room_features(spark):
    df = spark.createDataFrame(
        [(9.0, 0.0, 3.0, 2.0, 5), (1.0, 4.0, 1.0, 1.0, 0)],
        "living_area double, land_area double, bedrooms double, bathrooms double, total_rooms int",
    )
    made = features.log_columns(df.columns) | features.room_columns(df.columns)
    rows = features.add_columns(df, made).collect()
    assert abs(rows[0]["log_living_area"] - math.log(10)) < 1e-12 and rows[0]["log_land_area"] == 0.0
    assert [r["bath_per_room"] for r in rows] == [0.4, 0.0]
    assert (rows[0]["bed_bath"], rows[0]["bed_living"], rows[0]["bath_living"]) == (6.0, 27.0, 18.0)


def test_amenity_counts_treat_null_as_absent(spark):
    df = spark.createDataFrame([(1, True, None), (0, None, 1)], "a int, b boolean, c int")
    made = features.amenity_columns({"basic_amenities": ["a", "b"], "luxury_amenities": ["c"]})
    rows = [tuple(r) for r in features.add_columns(df, made).select(*made).collect()]
    assert rows == [(2, 0, 2), (0, 1, 1)]


def test_expm1_inverts_log1p(spark):
    df = spark.range(1, 2000).select((F.col("id") * F.lit(0.37)).alias("x"))
    worst = df.select(F.max(F.abs(F.expm1(F.log1p("x")) / F.col("x") - 1))).first()[0]
    assert worst < 1e-12
