import json
import os
import subprocess
import sys

import pytest

from priceloom.catalog.base import KEY, prop_signal
from priceloom.plans import bundle, recipes
from priceloom.plans.boosting import Booster
from priceloom.sources import folders

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BASE = Booster(max_iter=2, max_depth=3, step_size=0.1, subsampling_rate=0.8, feature_subset="all", max_bins=32)
RECIPE = recipes.OPTIMIZED_RECIPE.with_(
    booster=BASE, train_partitions=2, encodings=(("city", "rank"), ("street", "target_mean"), ("area", "fold_mean"))
)
EXTRA = ("concat('s', l_orderkey % 90) as street", "concat('a', l_suppkey % 7) as area")


def listings(spark):
    return prop_signal(spark, "/root/testdata/sf0.001", *EXTRA).drop("price")


def answers(estimates):
    return sorted([*map(int, r[:4]), r[4].hex()] for r in estimates.select(*KEY, "prediction").collect())


@pytest.fixture(scope="module")
def fitted(spark):
    prepared = recipes.prepare(prop_signal(spark, "/root/testdata/sf0.001", *EXTRA), RECIPE, row_key=KEY)
    yield recipes.fit(prepared)
    prepared.release()


SCRIPT = """
import json, sys
sys.path[:0] = [{root!r}, {root!r} + "/tests"]
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from priceloom.plans import bundle
from test_bundle import answers, listings
json.dump(answers(bundle.load(spark, {path!r}).estimate(listings(spark))), open({out!r}, "w"))
"""


def test_another_session_estimates_the_same(spark, fitted, tmp_path):
    """All four encodings, in a process that has nothing but the folder."""
    path, out = str(tmp_path / "bundle"), str(tmp_path / "out.json")
    assert bundle.save(fitted, path) == 1
    here = answers(fitted.estimate(listings(spark)))
    assert len(here) == listings(spark).filter("bedrooms is not null").count()
    code = SCRIPT.format(root=ROOT, path=path, out=out)
    subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, timeout=300)
    assert json.load(open(out)) == here


def test_loaded_program_is_the_saved_one(spark, fitted, tmp_path):
    path = str(tmp_path / "bundle")
    bundle.save(fitted, path)
    loaded = bundle.load(spark, path)
    for part in ("plan", "recipe", "numeric", "encodings", "inputs"):
        assert getattr(loaded, part) == getattr(fitted.program, part)
    assert loaded.encoders.max_arity == fitted.encoders.max_arity
    assert [list(s.labels) for s in loaded.encoders.stages] == [list(s.labels) for s in fitted.encoders.stages]
    assert loaded.importances(spark).collect() == fitted.importances().collect()
    # a loaded program can be saved again
    assert bundle.save(loaded, path) == 2


def test_versions_and_the_marker(spark, fitted, tmp_path):
    path = str(tmp_path / "bundle")
    with pytest.raises(bundle.NoBundle, match="no committed version"):
        bundle.load(spark, path)
    assert [bundle.save(fitted, path), bundle.save(fitted, path)] == [1, 2]
    (tmp_path / "bundle" / "v000002" / bundle.MARKER).unlink()
    assert bundle.versions(spark, path) == [1]
    bundle.load(spark, path)
    with pytest.raises(bundle.NoBundle):
        bundle.load(spark, path, version=2)
    assert bundle.save(fitted, path) == 3  # a claimed number is not used again
    assert bundle.versions(spark, path) == [1, 3]
    program = tmp_path / "bundle" / "v000003" / "program.json"
    (tmp_path / "bundle" / "v000003" / ".program.json.crc").unlink()
    program.write_text(program.read_text().replace('"format": 1', '"format": 9'))
    with pytest.raises(bundle.NoBundle, match="format 9"):
        bundle.load(spark, path)


def test_of_several_writers_one_wins(spark, tmp_path):
    path = str(tmp_path / "claim")
    assert folders.create_text(spark, path, "first") and not folders.create_text(spark, path, "second")
    assert folders.read_text(spark, path) == "first"
    assert folders.names_in(spark, str(tmp_path / "nowhere")) == []
