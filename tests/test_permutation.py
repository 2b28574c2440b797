import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from priceloom.catalog.base import KEY, prop_signal
from priceloom.operators.permutation import dealt, permutation_importance
from priceloom.plans import recipes
from priceloom.plans.boosting import Booster


@pytest.fixture
def rows(spark):
    return spark.range(300).selectExpr(
        "id", "cast(id % 17 as double) as a", "nullif(id % 5, 3) as b", "concat('c', id % 3) as c", "cast(id % 17 * 2 as double) as y"
    )


def test_deal_against_brute_force(rows):
    digest = lambda r: hashlib.md5(str(r["id"]).encode()).hexdigest()
    blocks = defaultdict(list)
    for r in sorted(rows.collect(), key=digest):
        blocks[int(digest(r)[16:24], 16) % 6].append(r)
    want = set()
    for part in blocks.values():
        for r, nxt in zip(part, part[1:] + part[:1]):
            for i, _ in enumerate(["as is", "a", "b", "c"], start=-1):
                want.add((r["id"], i, *[nxt[f] if j == i else r[f] for j, f in enumerate("abc")]))
    got = [tuple(r) for r in dealt(rows, ["id"], ["a", "b", "c"], "y", block_rows=50).select("id", "permuted", "a", "b", "c").collect()]
    assert len(got) == 1200 and set(got) == want


def test_only_used_features_matter_and_files_do_not(rows):
    score = lambda df: df.withColumn("prediction", F.col("a") * 2)
    found = {
        n: permutation_importance(rows.repartition(n), ["id"], ["a", "b", "c"], "y", score, 40).orderBy("feature_index").collect()
        for n in (1, 5)
    }
    losses = {r["feature"]: r for r in found[1]}
    assert losses["a"]["importance"] > 10 and losses["a"]["base_loss"] == 0
    assert losses["b"]["importance"] == losses["c"]["importance"] == 0
    assert all(r["n"] == 300 for r in found[1])
    for x, y in zip(found[1], found[5]):
        assert x["loss"] == pytest.approx(y["loss"], abs=1e-9)


def test_few_rows_repeated_keys_and_clashing_names(spark, rows):
    score = lambda df: df.withColumn("prediction", F.col("a"))
    one = permutation_importance(rows.limit(1), ["id"], ["a"], "y", score).collect()
    assert [(r["n"], r["importance"]) for r in one] == [(1, 0.0)]
    assert permutation_importance(rows.filter("false"), ["id"], ["a"], "y", score).count() == 0
    same = rows.withColumn("id", F.lit(1))
    assert dealt(same, ["id"], ["a", "b"], "y").count() == 900
    with pytest.raises(ValueError, match="permuted"):
        dealt(rows.withColumn("permuted", F.lit(1)), ["id"], ["a"], "y")


def test_importances_of_a_fitted_program(spark):
    booster = Booster(max_iter=4, max_depth=3, step_size=0.3, subsampling_rate=1.0, feature_subset="all", max_bins=32)
    recipe = recipes.TUNED_RECIPE.with_(booster=booster, encodings=(("city", "target_mean"),))
    prepared = recipes.prepare(prop_signal(spark, "/root/testdata/sf0.001"), recipe, row_key=KEY)
    fitted = recipes.fit(prepared)
    found = {r["feature"]: r for r in fitted.permutation_importances(prepared.test, block_rows=500).collect()}
    prepared.release()
    assert found.keys() == {"living_area", "bedrooms", "bathrooms", "land_area", "property_type", "city"}
    best = sorted(found, key=lambda f: -found[f]["importance"])[:2]
    assert set(best) == {"living_area", "bathrooms"}
    assert abs(found["property_type"]["importance"]) < found[best[1]]["importance"] / 10
