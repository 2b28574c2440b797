import numpy as np
import pytest

from priceloom.llm import language_id


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def network(docs):
    return language_id.fit(docs)


def test_held_out_accuracy(docs, network):
    rows = language_id.predict(docs, network).withColumn("out", language_id.held_out()).collect()
    held = [r for r in rows if r["out"] and r["lang"] is not None]
    assert len(held) > 100
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["lang_score"] <= 1 for r in rows)


def test_lookups_are_a_convolution_of_one_hot_bytes(network):
    windows = np.frombuffer(b"the nation and\0\0\0\0\0\0" * 2, dtype=np.uint8).reshape(2, 20)
    pooled, _ = network.pooled(windows)
    hot = np.eye(256, dtype=np.float32)[windows]
    at = 0
    for table, width in zip(network.tables, language_id.WIDTHS):
        z = sum(hot[:, k : 20 - width + 1 + k] @ table[k] for k in range(width))
        assert np.allclose(pooled[:, at : at + language_id.FILTERS], z.max(axis=1), atol=1e-5)
        at += language_id.FILTERS


def test_windows_hold_every_ngram_of_whole_texts():
    data = np.random.default_rng(1).integers(1, 255, 2000).astype(np.uint8)
    offsets = np.array([0, 0, 3, 259, 515, 2000])
    windows, owner, left = language_id.cut_windows(data, offsets)
    for i, (a, b) in enumerate(zip(offsets, offsets[1:])):
        whole = data[a:b].tobytes()
        cut = [w[:n].tobytes() for w, n, o in zip(windows, left, owner) if o == i]
        grams = {c[k : k + 4] for c in cut for k in range(len(c) - 3)}
        assert grams == {whole[k : k + 4] for k in range(len(whole) - 3)}
    assert all((w[n:] == 0).all() for w, n in zip(windows, left))


def test_messy_rows(clashing, messy_rows, network):
    rows = language_id.predict(clashing, network, "language", "probability").collect()
    assert len(rows) == len(messy_rows) and "extra" in rows[0]["lang_pred"]
    for r in rows:
        blank = not any(c.isalpha() for c in r["text"] or "")
        assert (r["language"] == "und") == blank and (r["probability"] == 0) == blank
    got = language_id.identify(clashing)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"] and got.count() == len(messy_rows)
    assert got.filter("doc_id is null and held_out").count() == 0


def test_rejected_rows_go(clashing):
    kept = language_id.keep_known(clashing)
    assert kept.columns == clashing.columns
    assert all(any(c.isalpha() for c in r["text"] or "") for r in kept.collect())


def test_nothing_to_learn_from(nothing, messy):
    assert language_id.identify(nothing).count() == 0
    unlabelled = messy.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r["lang_pred"] for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_many_tags_are_all_learned_from(spark):
    """450 tags, each with a word of its own, and a bound on those learned."""
    word = lambda i: "".join(chr(97 + (i // 26**k) % 26) for k in range(3))
    rows = [(10 * i + k, f"{word(i)} {word(i)}ed {word(i)} " * 3, f"x-{i:03}") for i in range(450) for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = language_id.fit(docs, per_language=2)
    assert len(net.languages) > 400
    found = language_id.predict(docs, net)
    assert found.count() == 900 and set(r[0] for r in found.select("lang_pred").distinct().collect()) <= set(net.languages)
    right = found.filter("lang = lang_pred").count() / found.filter("lang is not null").count()
    assert right > 0.3  # 0.002 by chance
    kept = language_id.keep_known(docs, per_language=2)
    assert kept.count() > 800


def test_only_the_most_frequent_tags_above_the_bound(spark, monkeypatch, docs):
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 2)
    counts = docs.filter(language_id.learnable() & docs["lang"].isNotNull()).groupBy("lang").count().collect()
    most = sorted(r["lang"] for r in sorted(counts, key=lambda r: (-r["count"], r["lang"]))[:2])
    assert language_id.fit(docs, per_language=20).languages == most


def test_texts_in_several_languages_stay(spark, docs):
    """A text of passages in all four languages is clean, if none is most of it."""
    rows = docs.filter("lang is not null and n_chars > 400").collect()
    by = {}
    for r in rows:
        by.setdefault(r["lang"], []).append(r["text"][:400])
    mixed = [(10_000 + i, "\n".join(by[lang][i] for lang in sorted(by)), None, None, None) for i in range(5)]
    both = docs.unionByName(spark.createDataFrame(mixed, docs.schema))
    kept = {r["doc_id"] for r in language_id.keep_known(both).collect()}
    assert {m[0] for m in mixed} <= kept and len(kept) > 0.98 * docs.count()


def test_without_labels_texts_with_letters_stay(messy, messy_rows):
    unlabelled = messy.selectExpr("doc_id", "text", "cast(null as string) as lang", "source", "n_chars")
    kept = language_id.keep_known(unlabelled)
    assert kept.count() == sum(any(c.isalpha() for c in r[1] or "") for r in messy_rows)


def test_each_text_goes_to_the_worker_once(spark, network):
    rows = spark.createDataFrame(
        [(1, "the nation and the people", "en"), (2, None, None), (3, "12 34", None)], "doc_id long, text string, lang string"
    )
    found = language_id.predict(rows, network, sure="sure")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "whole_text" not in plan and "coalesce" not in plan
    got = {r["doc_id"]: r for r in found.collect()}
    assert got[2]["text"] is None and got[2]["lang_pred"] == language_id.UNKNOWN and got[2]["lang_score"] == 0.0
    assert got[3]["lang_pred"] == language_id.UNKNOWN and got[1]["lang_pred"] != language_id.UNKNOWN
