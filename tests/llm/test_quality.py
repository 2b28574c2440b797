import numpy as np
import pyarrow as pa

from priceloom.llm import quality
from priceloom.llm.text import joined_bytes


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = quality.score(docs, quality.fit(docs, labels)).join(labels, "doc_id").collect()
    held = [r for r in scored if r["held_out"]]
    assert len(held) > 50
    good, bad = [r["score"] for r in held if r["quality"]], [r["score"] for r in held if not r["quality"]]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) > 0.93
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in scored)


def test_scores_are_sparse_dot_products():
    texts = ["The cat, the cat sat!!", "", None, "x x x", "é ü"]
    found, first = quality.features(*joined_bytes(pa.array(texts)))
    assert np.diff(first).tolist() == [7, 0, 0, 3, 2]
    assert (found[:, 0] >= 3).all() and found[0, 1] == 0 and found[first[3], 1] == 0
    assert found[first[3] : first[4], 2].tolist() == [0, quality.NEXT, quality.NEXT]
    assert found[first[3] : first[4], 3].tolist() == [0, 0, quality.NEXT_BUT_ONE]
    assert found[0, 0] == found[3, 0] and found[1, 0] == found[4, 0]


def test_ftrl_learns_and_keeps_unseen_weights_zero():
    rng = np.random.default_rng(0)
    examples = []
    for i in range(400):
        y = i % 2
        places = np.array([0, 10 + y, *rng.integers(20, 40, 3)])
        examples.append((places, np.ones(5), y))
    w = quality.ftrl(examples)
    assert w[11] > 0 > w[10] and not w[1000:].any()


def test_messy_rows(spark, clashing, messy_rows, nothing):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(20)] + [(1, 0, 1), (None, 1, 1), (2, None, 1)], "doc_id long, quality int, toxic int")
    weights = quality.fit(clashing, labels)
    scored = quality.score(clashing, weights).collect()
    assert len(scored) == len(messy_rows) and all(0 <= r["score"] <= 1 for r in scored)
    empty = 1 / (1 + np.exp(-weights[0]))
    texts = {r[0]: r[1] for r in messy_rows if r[0] is not None}
    assert all(abs(r["score"] - empty) < 1e-12 for r in scored if r["doc_id"] is not None and not (texts[r["doc_id"]] or "").strip())
    assert not any(r["held_out"] for r in scored if r["doc_id"] is None)
    none = quality.fit(nothing, labels.limit(0))
    assert {r["score"] for r in quality.score(clashing, none).collect()} == {0.5}
    assert quality.score(nothing, none).count() == 0
