from collections import Counter, defaultdict

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from priceloom.operators import encode


@pytest.fixture
def cats(spark):
    return spark.createDataFrame([(x,) for x in ["b", "a", "a", "c", None, "b"]], "k string")


def test_stage_index(spark, cats):
    (model,) = encode.fit_indexers(cats, ["k"])
    unseen = spark.createDataFrame([("a",), ("b",), ("c",), (None,), ("zz",)], "k string")
    assert [r["k_indexed"] for r in model.transform(unseen).collect()] == [0.0, 1.0, 2.0, 3.0, 3.0]


def test_same_models_as_the_built_in_fit(spark, skewed):
    df = skewed.selectExpr("k", "concat('m', id % 4) as m", "cast(null as string) as nothing")
    mine = encode.fit_indexers(df, df.columns, limit=2000)
    names = [encode.indexed_name(c) for c in df.columns]
    built_in = StringIndexer(inputCols=df.columns, outputCols=names, handleInvalid="keep").fit(df)
    assert [list(m.labels) for m in mine] == [list(labels) for labels in built_in.labelsArray]
    a, b = encode.index_categories(df, mine), built_in.transform(df)
    assert a.exceptAll(b).count() == 0 and a.columns == b.columns
    for name in names:
        assert a.schema[name].metadata == b.schema[name].metadata


def test_distributed_index_gives_the_same_numbers(spark, cats):
    table = encode.frequency_index(cats, "k")
    unseen = spark.createDataFrame([("a",), ("b",), ("c",), (None,), ("zz",)], "k string")
    got = {r["k"]: r["k_indexed"] for r in encode.apply_index(unseen, table, "k").collect()}
    assert got == {"a": 0.0, "b": 1.0, "c": 2.0, None: 3.0, "zz": 3.0}


@pytest.fixture
def skewed(spark):
    """A third of the rows share one label, a tenth have none."""
    return spark.range(6000).selectExpr(
        "id",
        "case when id % 3 = 0 then 'hot' when id % 10 = 1 then null else concat('k', id % 1700) end as k",
        "cast(id % 11 as double) as y",
    )


@pytest.mark.parametrize("limit", [encode.BROADCAST_BYTES, 0])
def test_both_lookups_agree_with_the_stage(skewed, limit):
    train = skewed.filter("id % 5 < 4")
    stage = encode.index_categories(skewed, encode.fit_indexers(train, ["k"], limit=2000))
    wide = encode.apply_index(skewed, encode.frequency_index(train, "k"), "k", limit)
    assert wide.columns == [*skewed.columns, "k_indexed"]
    want = {r["id"]: r["k_indexed"] for r in stage.collect()}
    got = [(r["id"], r["k_indexed"]) for r in wide.collect()]
    assert len(got) == 6000 and dict(got) == want


def test_large_lookup_keeps_hot_rows_out_of_the_shuffle(skewed, plan_of):
    table = encode.frequency_index(skewed, "k")
    joined = encode.attach(skewed, table.select("label", "index"), "k", limit=0)
    plan = plan_of(joined)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    hot = joined.filter("k = 'hot'")
    assert hot.count() == 2000 and hot.select("index").distinct().collect() == [(0.0,)]


@pytest.mark.parametrize("limit", [encode.BROADCAST_BYTES, 0])
def test_target_means_against_brute_force(skewed, limit):
    train = skewed.filter("id % 5 < 4")
    means = encode.target_means(train, "k", "y", smoothing=4.0)
    got = {r["id"]: r["k_mean"] for r in encode.apply_target_means(skewed, means, "k", "k_mean", limit).collect()}

    sums, counts = defaultdict(float), Counter()
    for r in train.collect():
        sums[r["k"]] += r["y"]
        counts[r["k"]] += 1
    overall = sum(sums.values()) / sum(counts.values())
    assert len(got) == 6000
    for r in skewed.collect():
        k = r["k"]
        want = overall if k is None or k not in counts else (sums[k] + 4 * overall) / (counts[k] + 4)
        assert abs(got[r["id"]] - want) < 1e-9


def test_label_counts_are_partially_aggregated(skewed, plan_of):
    plan = plan_of(encode.label_counts(skewed, "k"))
    assert plan.count("HashAggregate") == 2 and "partial_count" in plan


def test_too_many_nominal_labels_raise_with_the_count(skewed):
    exact = skewed.agg(F.countDistinct("k")).first()[0]
    with pytest.raises(ValueError, match=f"'k' has {exact} labels"):
        encode.fit_indexers(skewed, ["k"], limit=exact - 1)
    assert len(encode.fit_indexers(skewed, ["k"], limit=exact)[0].labels) == exact


def test_fold_labels_are_those_of_the_rows_outside(skewed):
    df = skewed.withColumn("fold", F.col("id") % 3)
    by_fold = encode.fold_labels(df, ["k"], "fold", limit=10_000)
    assert sorted(by_fold) == [0, 1, 2]
    for k, labels in by_fold.items():
        assert labels == encode.stage_labels(df.filter(F.col("fold") != k), ["k"], limit=10_000)


@pytest.mark.parametrize("limit", [encode.BROADCAST_BYTES, 0])
def test_helper_names_may_occur_in_the_data(skewed, limit):
    df = skewed.selectExpr("id", "k", "y", "id as index", "id as label", "id as n", "id as encoded", "id as total")
    indexed = encode.apply_index(df, encode.frequency_index(df, "k"), "k", limit)
    means = encode.target_means(df, "k", "y")
    out = encode.apply_target_means(indexed, means, "k", "k_mean", limit)
    assert out.columns == [*df.columns, "k_indexed", "k_mean"]
    assert out.count() == 6000
    assert out.filter("index = id and label = id and n = id and encoded = id").count() == 6000


def test_large_lookup_shuffles_evenly(spark):
    """A label with a third of the rows does not gather in one partition."""
    df = spark.range(0, 60_000, 1, 4).selectExpr(
        "id", "case when id % 3 = 0 then 'hot' when id % 10 = 1 then null else concat('k', id % 14000) end as k"
    )
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        joined = encode.attach(df, encode.frequency_index(df, "k").select("label", "index"), "k", limit=0)
        placed = joined.withColumn("p", F.spark_partition_id())
        shuffled = placed.filter("k is not null and k <> 'hot'").groupBy("p").count()
        largest, mean = shuffled.agg(F.max("count"), F.avg("count")).first()
        hot = placed.filter("k = 'hot'").groupBy("p").count().agg(F.max("count"), F.avg("count")).first()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert largest < 1.2 * mean
    assert hot[0] < 1.2 * hot[1]


@pytest.fixture
def three(spark):
    """Three columns with a hot label each, nulls, and labels of two in common."""
    return spark.range(0, 9000, 1, 3).selectExpr(
        "id",
        "case when id % 3 = 0 then 'hot' when id % 10 = 1 then null else concat('k', id % 1700) end as k",
        "case when id % 4 = 0 then 'hot' else concat('k', id % 2100) end as m",
        "if(id % 2 = 0, null, concat('z', id % 900)) as z",
        "cast(id % 11 as double) as y",
        "cast(id * 7 % 3 as int) as fold",
        "'mine' as value_0",
    )


def lookups_for(train):
    return [
        encode.index_lookup(encode.frequency_index(train, "k"), "k"),
        encode.mean_lookup(encode.target_means(train, "m", "y"), "m"),
        encode.fold_mean_lookup(encode.fold_means(train, "z", "y", "fold"), "z", "fold"),
    ]


def test_one_pass_lookup_agrees_with_column_by_column(three):
    train = three.filter("id % 5 < 4")
    one_pass = encode.attach_many(three, lookups_for(train), limit=0)
    small = encode.attach_many(three, lookups_for(train))
    assert one_pass.columns == small.columns == [*three.columns, "k_indexed", "m_mean", "z_mean"]
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(one_pass) == rows(small) and one_pass.count() == 9000
    single = encode.apply_index(three, encode.frequency_index(train, "k"), "k")
    single = encode.apply_target_means(single, encode.target_means(train, "m", "y"), "m", "m_mean")
    assert rows(single) == rows(small.drop("z_mean"))


def test_one_pass_lookup_has_one_exchange_of_labels(spark, three, plan_of):
    """However many columns, labels meet the tables in one shuffle and the rows
    themselves move once."""

    def exchanges(n):
        out = encode.attach_many(three, lookups_for(three)[:n], limit=0)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            plan = plan_of(out)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            spark.conf.unset("spark.sql.adaptive.enabled")
        by_label = [x for x in plan.splitlines() if "Exchange hashpartitioning(at" in x and "label" in x]
        whole = [x for x in plan.splitlines() if "Exchange hashpartitioning(row_number" in x]
        return len(by_label), len(whole)

    assert exchanges(2) == exchanges(3)
    labels, whole = exchanges(3)
    assert (labels, whole) == (2, 1)  # asked labels, tables; the stored rows


def test_hot_labels_stay_out_of_the_one_pass_shuffle(three, spark):
    before = encode.HOT_SHARE
    out = encode.attach_many(three, lookups_for(three), limit=0)
    assert before == 1000 and out.filter("k = 'hot'").select("k_indexed").distinct().collect() == [(0.0,)]
    assert out.filter("k is null and k_indexed is null").count() == 0


@pytest.mark.parametrize("limit", [encode.BROADCAST_BYTES, 0])
def test_fold_means_against_brute_force(three, limit):
    train = three.filter("id % 5 < 4")
    means = encode.fold_means(train, "k", "y", "fold", smoothing=4.0)
    rows = train.collect()

    def want(label, fold):
        outside = [r for r in rows if r["fold"] != fold]
        overall = sum(r["y"] for r in outside) / len(outside)
        own = [r["y"] for r in outside if r["k"] == label and label is not None]
        return (sum(own) + 4 * overall) / (len(own) + 4) if own else overall

    for fold, part in (("fold", train), (None, three.filter("id % 5 = 4"))):
        out = encode.attach_many(part, [encode.fold_mean_lookup(means, "k", fold)], limit)
        for r in out.filter("id % 97 = 0 or k is null and id % 31 = 0").collect():
            assert r["k_mean"] == pytest.approx(want(r["k"], r["fold"] if fold else None), abs=1e-9)


def test_fold_means_of_one_fold_and_of_no_rows(spark, three):
    means = encode.fold_means(three.withColumn("fold", F.lit(0)), "k", "y", "fold")
    out = encode.attach_many(three.withColumn("fold", F.lit(0)), [encode.fold_mean_lookup(means, "k", "fold")])
    assert out.filter("k_mean is not null").count() == 0  # nothing is outside
    none = encode.fold_means(three.filter("false"), "k", "y", "fold")
    out = encode.attach_many(three, [encode.fold_mean_lookup(none, "k", None)])
    assert out.count() == 9000 and out.filter("k_mean is not null").count() == 0
