import random

from pyspark.sql import functions as F

from priceloom.operators.ranking import global_rank, top_k


def test_global_rank_equals_sorting(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 40), f"k{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "n int, label string").repartition(7)
    got = {r["label"]: r["at"] for r in global_rank(df, F.desc("n"), F.asc("label"), rank="at").collect()}
    want = {label: i for i, (_, label) in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])))}
    assert got == want


def test_global_rank_of_nothing(spark):
    assert global_rank(spark.createDataFrame([], "n int"), F.asc("n")).count() == 0


def test_top_k_breaks_ties_by_the_next_key(spark):
    df = spark.createDataFrame([(2, 0.5), (0, 0.5), (1, 0.9), (3, 0.1)], "i int, score double")
    rows = top_k(df, 3, F.desc("score"), F.asc("i")).orderBy("rank").collect()
    assert [(r["rank"], r["i"]) for r in rows] == [(1, 1), (2, 0), (3, 2)]


def test_top_k_limits_before_the_window(spark, plan_of):
    plan = plan_of(top_k(spark.range(1000), 15, F.desc("id")))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
