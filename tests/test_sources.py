import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.ml.feature import VectorAssembler
from pyspark.ml import Pipeline

from priceloom import sources
from priceloom.sources import shapes as shapes_module


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "data.csv"
    path.write_text("price,rooms,kind\n10.5,2,flat\n20.0,,house\n")
    return str(path)


def test_csv_types_are_inferred(spark, csv_file):
    df = sources.read_table(spark, csv_file)
    assert dict(df.dtypes) == {"price": "double", "rooms": "int", "kind": "string"}
    assert [tuple(r) for r in df.collect()] == [(10.5, 2, "flat"), (20.0, None, "house")]


def test_csv_with_schema(spark, csv_file):
    df = sources.read_table(spark, csv_file, schema="price double, rooms bigint, kind string")
    assert df.schema["rooms"].dataType.typeName() == "long"
    assert df.count() == 2


def test_first_readable_path_wins(spark, csv_file, tmp_path):
    other = tmp_path / "other.csv"
    other.write_text("price\n1\n")
    df = sources.read_first(spark, [str(tmp_path / "absent.csv"), csv_file, str(other)])
    assert df.columns == ["price", "rooms", "kind"]


def test_fallback_with_a_schema(spark, csv_file, tmp_path):
    schema = "price double, rooms int, kind string"
    df = sources.read_first(spark, [str(tmp_path / "absent.csv"), csv_file], schema=schema)
    assert df.dtypes == [("price", "double"), ("rooms", "int"), ("kind", "string")] and df.count() == 2


def test_unreachable_file_system_falls_back(spark, csv_file):
    df = sources.read_first(spark, ["hdfs://no-such-namenode.invalid:8020/data.csv", csv_file])
    assert df.count() == 2


def test_no_source_lists_every_path(spark, tmp_path):
    paths = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    with pytest.raises(sources.SourceUnavailable) as error:
        sources.read_first(spark, paths)
    assert all(p in str(error.value) for p in paths)


def test_a_broken_source_is_not_skipped(spark, csv_file):
    with pytest.raises(Exception) as error:
        sources.read_first(spark, [csv_file, csv_file], "no_such_format")
    assert not isinstance(error.value, sources.SourceUnavailable)


def test_json_to_csv(spark, tmp_path):
    records = tmp_path / "records.json"
    records.write_text('{"id": 1, "props": {"area": 80.5}}\n{"id": 2, "props": {}}\n')
    out = str(tmp_path / "flat")
    sources.json_to_csv(
        spark, str(records), "id int, props struct<area: double>", ["id", "props.area as area"], out
    )
    rows = sources.read_table(spark, out, schema="id int, area double").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, 80.5), (2, None)]


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "orc"])
def test_write_and_read_back(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    path = str(tmp_path / fmt)
    sources.write_table(df, path, fmt)
    assert sorted(tuple(r) for r in sources.read_table(spark, path, fmt, df.schema).collect()) == [(1, "a"), (2, "b")]
    with pytest.raises(AnalysisException):
        sources.write_table(df, path, fmt)


def test_partitioned_write(spark, tmp_path):
    path = str(tmp_path / "parts")
    sources.write_table(spark.range(6).selectExpr("id", "id % 2 as side"), path, partition_by=["side"])
    assert sources.read_table(spark, path, "parquet").filter("side = 1").count() == 3


def test_model_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features")]).fit(df)
    path = str(tmp_path / "model")
    sources.save_model(model, path)
    again = sources.load_model(path).transform(df).first()
    assert list(again["features"]) == [1.0, 2.0]


def test_scratch_uses_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    first, second = sources.scratch_path(spark, "x"), sources.scratch_path(spark, "x")
    assert first.startswith(configured) and first != second


def test_written_keeps_rows_and_schema(spark):
    df = spark.range(10).selectExpr("id", "cast(id as string) as name")
    stored = sources.written(df, "rows")
    assert stored.schema.simpleString() == df.schema.simpleString()
    assert sorted(r["id"] for r in stored.collect()) == list(range(10))


CSV_SCHEMA = "price double, rooms int, kind string"


def test_damaged_csv_rows_are_put_aside(spark, tmp_path):
    path = tmp_path / "data.csv"
    path.write_text("price,rooms,kind\n10.5,2,flat\nten,2,flat\n20.0,,house\n1,2\n1,2,a,b\n,,\n3.0,x,\"q,r\"\n")
    found = sources.read_quarantined(spark, str(path), CSV_SCHEMA, str(tmp_path / "side"))
    assert sorted(map(tuple, found.rows.collect()), key=repr) == [(10.5, 2, "flat"), (20.0, None, "house"), (None, None, None)]
    damaged = ["1,2", "1,2,a,b", '3.0,x,"q,r"', "ten,2,flat"]
    assert sorted(r["record"] for r in found.damaged.collect()) == damaged and found.n_damaged == 4
    assert all(r["file"].endswith("data.csv") for r in found.damaged.collect())
    # the same rows whatever a query asks for
    assert found.rows.count() == 3 and found.rows.select("kind").count() == 3
    assert found.rows.agg(F.sum("price")).first()[0] == 30.5
    with pytest.raises(AnalysisException):  # a side table is not written over
        sources.read_quarantined(spark, str(path), CSV_SCHEMA, str(tmp_path / "side"))


def test_damaged_json_rows_and_clean_or_empty_sources(spark, tmp_path):
    path = tmp_path / "data.json"
    path.write_text('{"price": 1.5, "rooms": 2, "kind": "a"}\n{"price": \n{"price": "x", "rooms": 1}\n{}\n')
    schema = f"{CSV_SCHEMA}, damaged_record string"
    found = sources.read_quarantined(spark, str(path), schema, str(tmp_path / "side"), "json")
    assert found.rows.columns == ["price", "rooms", "kind", "damaged_record"]
    assert found.rows.count() == 2 and found.n_damaged == 2
    (tmp_path / "empty.csv").write_text("price,rooms,kind\n")
    none = sources.read_quarantined(spark, str(tmp_path / "empty.csv"), CSV_SCHEMA, str(tmp_path / "side2"))
    assert none.n_damaged == none.rows.count() == 0
    with pytest.raises(ValueError, match="parquet"):
        sources.read_quarantined(spark, "x", CSV_SCHEMA, "y", "parquet")


def test_shapes_of_json_are_merged(spark, tmp_path):
    shapes = {
        "a": '{"id": 1, "at": {"x": 1, "tags": ["p"]}, "n": 3, "v": 7, "only_null": null, "w": {"z": 1}}\n',
        "b": '{"id": 2, "at": {"y": {"deep": true}, "x": 2.5, "tags": ["q", "r"]}, "n": 4.5, "v": {"k": [1, 2]}, "w": 5}\n',
        "c": '{"id": 3, "v": "text", "more": 9007199254740993}\n',
    }
    for name, text in shapes.items():
        (tmp_path / name).write_text(text)
    paths = [str(tmp_path / n) for n in shapes]
    df = sources.read_shapes(spark, paths)
    assert df.schema.simpleString() == (
        "struct<at:struct<tags:array<string>,x:double,y:struct<deep:boolean>>,id:bigint,n:double,"
        "only_null:string,v:string,w:string,more:bigint>"
    )
    rows = {r["id"]: r for r in sources.flat(df).collect()}
    assert sources.flat(df).columns == ["at_tags", "at_x", "at_y_deep", "id", "n", "only_null", "v", "w", "more"]
    assert tuple(rows[1]) == ('["p"]', 1.0, None, 1, 3.0, None, "7", '{"z": 1}', None)
    assert tuple(rows[2]) == ('["q","r"]', 2.5, True, 2, 4.5, None, '{"k": [1, 2]}', "5", None)
    assert (rows[3]["v"], rows[3]["more"]) == ("text", 9007199254740993)
    assert shapes_module.conflicts(shapes_module.json_schemas(spark, paths)) == {
        "at.x": ["bigint", "double"],
        "n": ["bigint", "double"],
        "v": ["bigint", "struct", "string"],
        "w": ["struct", "bigint"],
    }
    with pytest.raises(ValueError, match="a_b"):
        sources.flat(spark.sql("select 1 as a_b, named_struct('b', 2) as a"))
