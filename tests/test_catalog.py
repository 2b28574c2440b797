"""Every registered query with SQL, checked at the smallest scale."""

import sys

import pytest

import __spark_entry__ as entry

sys.path.insert(0, entry.__file__.rsplit("/", 1)[0] + "/tools")
import check  # noqa: E402

from priceloom.catalog import REGISTRY  # noqa: E402


@pytest.fixture(scope="module")
def duck(sf_dir):
    return check.connect(sf_dir)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.oracle_sql()) >= 35


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) & set(REGISTRY)))
def test_query_matches_sql(spark, duck, sf_dir, name):
    got = entry.queries()[name](spark, sf_dir).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).df()
    assert len(got) > 0
    assert check.compare(got, want) is None


def test_random_split_covers_all_rows(spark, sf_dir):
    rows = entry.queries()["random_split"](spark, sf_dir)
    assert rows.count() == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()


def test_entry(spark):
    report = entry.entry(spark)
    assert report.columns == ["section", "position", "metric", "value"]
    scores = {r["metric"]: r["value"] for r in report.filter("section = 'log_scale'").collect()}
    assert scores["r2"] > 0.5
