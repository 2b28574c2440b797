import pytest

from priceloom import __main__ as cli
from priceloom import session
from priceloom.catalog.base import KEY, prop_signal
from priceloom.plans import recipes, report, tuning


@pytest.fixture(scope="module")
def tuned_report(spark):
    recipe = recipes.TUNED_RECIPE.with_(folds=2)
    grid = tuning.Grid(max_depth=(2,), max_iter=(2, 3), step_size=(0.3,))
    df = prop_signal(spark, "/root/testdata/sf0.001")
    return report.run(df, recipe, row_key=KEY, grid=grid).collect()


def values(rows, section):
    return {r["metric"]: r["value"] for r in rows if r["section"] == section}


def test_sections(tuned_report):
    sections = list(dict.fromkeys(r["section"] for r in tuned_report))
    assert sections == [
        "dataset",
        "encoding",
        "tuning",
        "training",
        "log_scale",
        "original_scale",
        "importance",
        "advanced",
        "stability",
        "summary",
        "phases",
    ]


def test_row_accounting(tuned_report):
    data = values(tuned_report, "dataset")
    assert data["rows"] == 6000 and data["columns"] == 11
    assert data["train_rows"] + data["test_rows"] + data["outlier_rows"] + data["unlabelled_rows"] == data["rows"]


def test_summary_repeats_the_top_features(tuned_report):
    importance = list(values(tuned_report, "importance").items())
    assert list(values(tuned_report, "summary").items()) == importance[:3]
    weights = [w for _, w in importance]
    assert weights == sorted(weights, reverse=True)


def test_training_block(tuned_report):
    best, done = values(tuned_report, "tuning"), values(tuned_report, "training")
    assert done["boosting_rounds"] == best["max_iter"] and done["fit_seconds"] > 0
    assert best["cv_r2"] == values(tuned_report, "stability")["cv_r2"]


def test_stability_gap(tuned_report):
    block = values(tuned_report, "stability")
    assert block["gap"] == pytest.approx(abs(block["cv_r2"] - block["test_r2"]))
    assert block["test_r2"] == values(tuned_report, "log_scale")["r2"]


def test_at_most_fifteen_features(spark):
    rows = [(i, f"f{i}", 0.5 if i < 2 else i / 1000) for i in range(40)]
    frame = spark.createDataFrame(rows, "feature_index int, feature string, importance double")
    ranked = report.importance_topk(frame).orderBy("rank").collect()
    assert len(ranked) == 15 and [r["feature"] for r in ranked[:3]] == ["f0", "f1", "f39"]


def test_text(spark):
    frame = spark.createDataFrame(
        [("log_scale", 1, "r2", 0.69179), ("importance", 1, "area", 0.5), ("advanced", 1, "adjusted_r2", None)],
        report.REPORT_SCHEMA,
    )
    text = report.as_text(frame)
    assert "r2: 0.6918" in text and " 1. area: 0.5000" in text and "adjusted_r2: n/a" in text


def test_command_line(spark, tmp_path, capsys):
    csv = str(tmp_path / "data")
    prop_signal(spark, "/root/testdata/sf0.001").write.option("header", True).csv(csv)
    out = str(tmp_path / "report")
    arguments = ["--input", str(tmp_path / "absent.csv"), "--input", csv, "--max-iter", "2", "--output", out]
    for column in KEY:
        arguments += ["--row-key", column]
    cli.main(arguments)
    assert "adjusted_r2" in capsys.readouterr().out
    assert spark.read.parquet(out).filter("section = 'importance'").count() == 15


def test_session_reuses_the_running_one(spark):
    assert session.build("again", spark__sql__shuffle__partitions="4").sparkContext is spark.sparkContext
