import numpy as np
import pytest

from priceloom.llm import hnsw

SCHEMA = "vec_id long, embedding array<float>, label int, shard string, ids string"


def brute_force(ids, vectors, queries, k):
    out = {}
    for q in queries:
        score = vectors @ vectors[ids == q][0]
        other = ids != q
        order = np.lexsort((ids[other], -score[other]))[:k]
        out[q] = list(zip(ids[other][order].tolist(), score[other][order].tolist()))
    return out


def test_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD_ROWS", 200)
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = hnsw.nearest(table, table.filter("vec_id % 20 = 0"), 20).collect()
    rows = table.collect()
    ids, vectors = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=np.float64)
    want = brute_force(ids, vectors, [i for i in ids if i % 20 == 0], 20)
    assert len(got) == 20 * len(want)
    hits = 0
    for q, best in want.items():
        own = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21))
        assert [(-r["score"], r["vec_id"]) for r in own] == sorted((-r["score"], r["vec_id"]) for r in own)
        for r in own:
            assert r["score"] == pytest.approx(float(vectors[ids == r["vec_id"]][0] @ vectors[ids == q][0]), abs=1e-12)
        hits += len({r["vec_id"] for r in own} & {i for i, _ in best})
    assert hits / len(got) >= 0.95


def test_copies_ties_and_bad_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0], 0, "x", "y") for i in range(40)]
    rows += [(100 + i, [float(i), 1.0], 0, "x", "y") for i in range(1, 4)]
    rows += [(200, None, 0, "", ""), (201, [0.0, 0.0], 0, "", ""), (202, [nan, 1.0], 0, "", ""), (203, [inf, 1.0], 0, "", "")]
    rows += [(204, [1.0, None], 0, "", ""), (205, [1.0], 0, "", ""), (None, [1.0, 1.0], 0, "", ""), (101, [1.0, 1.0], 0, "", "")]
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = hnsw.nearest(table, table.filter("vec_id in (0, 101, 200, 202)"), 5).collect()
    by = {q: [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 101)}
    assert {r["query_id"] for r in got} == {0, 101}
    assert by[0] == [(103, 3.0), (102, 2.0), (1, 1.0), (2, 1.0), (3, 1.0)]
    assert by[101] == [(103, 4.0), (102, 3.0), (0, 1.0), (1, 1.0), (2, 1.0)]


def test_few_and_no_candidates(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0], 0, "", ""), (1, [2.0, 1.0], 0, "", "")], SCHEMA)
    assert [tuple(r) for r in hnsw.nearest(few, few.filter("vec_id = 0"), 20).collect()] == [(0, 1, 1, 4.0)]
    none = few.limit(0)
    assert hnsw.nearest(none, none, 20).count() == 0


def test_blocks_and_graphs_are_not_broadcast(spark, plan_of):
    rows = [(i, [float(i % 7), 1.0, float(i)], 0, "", "") for i in range(60)]
    table = spark.createDataFrame(rows, SCHEMA)
    found = hnsw.nearest(table, table.filter("vec_id % 20 = 0"), 5)
    plan = plan_of(found)
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert found.count() == 15


def test_flat_layers_are_the_graph():
    vectors = np.random.default_rng(3).normal(size=(300, 8)).astype(np.float32)
    graph = hnsw.Graph.build(vectors)
    nodes, links = graph.layers[0]
    assert nodes.tolist() == list(range(300)) and links.dtype == np.int32
    for nodes, links in graph.layers:
        for node, row in zip(nodes.tolist(), links.tolist()):
            near = [x for x in row if x >= 0]
            assert node not in near and len(near) == len(set(near)) and set(near) <= set(nodes.tolist())
