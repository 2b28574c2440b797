import pytest
from pyspark.ml.regression import GBTRegressor

from priceloom.catalog.base import KEY, prop_signal
from priceloom.plans import recipes, tuning
from priceloom.plans.boosting import Booster
from priceloom.plans.ledger import Fit, Ledger, checksum

BASE = Booster(max_iter=3, max_depth=2, step_size=0.1, subsampling_rate=0.8, feature_subset="sqrt", max_bins=32)
RECIPE = recipes.TUNED_RECIPE.with_(booster=BASE, folds=2, train_partitions=2)
GRID = tuning.Grid(max_depth=(1, 2), max_iter=(2, 3), step_size=(0.1, 0.3))


@pytest.fixture(scope="module")
def prepared(spark):
    prepared = recipes.prepare(prop_signal(spark, "/root/testdata/sf0.001"), RECIPE, row_key=KEY)
    yield prepared
    prepared.release()


@pytest.fixture
def fits(monkeypatch):
    """Counts fits, and ends the search before a given one."""
    state = {"done": 0, "stop": None}
    real = GBTRegressor.fit

    def fit(self, rows, params=None):
        if state["stop"] is not None and state["done"] >= state["stop"]:
            raise RuntimeError("the session is gone")
        state["done"] += 1
        return real(self, rows, params)

    monkeypatch.setattr(GBTRegressor, "fit", fit)
    return state


def rows_of(scores):
    """Without the last digits, which depend on the order of partial sums."""
    return sorted((*r[:-1], round(r[-1], 9)) for r in map(tuple, scores.collect()))


def test_a_search_goes_on_where_it_was_cut_off(spark, prepared, fits, tmp_path):
    whole = rows_of(tuning.cross_validate(prepared, GRID))
    assert fits["done"] == 8
    path = str(tmp_path / "ledger")
    fits.update(done=0, stop=3)
    with pytest.raises(RuntimeError, match="session is gone"):
        tuning.cross_validate(prepared, GRID, parallelism=1, ledger=Ledger(spark, path))
    written = Ledger(spark, path).finished(3)
    assert len(written) == 3
    fits.update(done=0, stop=None)
    # other rows of the same data, as a new session prepares them
    again = recipes.prepare(prop_signal(spark, "/root/testdata/sf0.001").repartition(3), RECIPE, row_key=KEY)
    resumed = tuning.cross_validate(again, GRID, ledger=Ledger(spark, path))
    again.release()
    assert fits["done"] == 5
    assert rows_of(resumed) == whole
    assert {p: f for p, f in Ledger(spark, path).finished(3).items() if p in written} == written
    fits.update(done=0)
    assert rows_of(tuning.cross_validate(prepared, GRID, ledger=Ledger(spark, path))) == whole
    assert fits["done"] == 0


def test_a_fit_without_its_marker_is_done_again(spark, prepared, fits, tmp_path):
    path = tmp_path / "ledger"
    small = tuning.Grid((1,), (2,), (0.1,))
    first = rows_of(tuning.cross_validate(prepared, small, ledger=Ledger(spark, str(path))))
    (path / "fits" / "0-1-0.1" / "_SUCCESS").unlink()
    fits.update(done=0)
    assert rows_of(tuning.cross_validate(prepared, small, ledger=Ledger(spark, str(path)))) == first
    assert fits["done"] == 1
    # more rounds than were written down are fitted, fewer are not
    more = tuning.cross_validate(prepared, tuning.Grid((1,), (1, 3), (0.1,)), ledger=Ledger(spark, str(path)))
    assert fits["done"] == 3 and more.count() == 4
    tuning.cross_validate(prepared, small, ledger=Ledger(spark, str(path)))
    assert fits["done"] == 3


def test_a_ledger_of_other_rows_or_settings_raises(spark, prepared, tmp_path):
    path = str(tmp_path / "ledger")
    Ledger(spark, path).open(prepared)
    Ledger(spark, path).open(prepared)
    rows = prop_signal(spark, "/root/testdata/sf0.001")
    for recipe, part, what in (
        (RECIPE.with_(booster=BASE.with_(seed=7)), rows, "booster differ"),
        (RECIPE, rows.filter("l_orderkey > 9"), "train_checksum, train_rows differ"),
    ):
        other = recipes.prepare(part, recipe, row_key=KEY)
        with pytest.raises(ValueError, match=what):
            Ledger(spark, path).open(other)
        other.release()
    grown = recipes.prepare(rows, RECIPE.with_(booster=BASE.with_(max_depth=9, max_memory_mb=512)), row_key=KEY)
    Ledger(spark, path).open(grown)
    grown.release()


def test_checksum_ignores_order_and_sees_repeats(spark):
    df = spark.range(1000).selectExpr("id", "cast(id as string) as s")
    assert checksum(df) == checksum(df.repartition(7))
    assert checksum(df) != checksum(df.unionByName(df.limit(2)))
    assert checksum(df.unionByName(df)) != checksum(df.filter("false"))


def test_no_fits_and_no_variance(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "none"))
    assert ledger.finished(1) == {} and ledger.table().count() == 0
    assert Fit((1.0,), 0.0, 0.1).r2(1) is None and Fit((0.25,), 1.0, 0.1).r2(1) == 0.75
