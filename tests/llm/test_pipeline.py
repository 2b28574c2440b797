"""The stages one by one, and the registered queries."""

import hashlib

import sys

import corpus_pipeline
import pytest

import __spark_entry__ as entry
from priceloom.llm import bpe, jaccard_join
from priceloom.llm.exact_dedup import drop_copies

sys.path.insert(0, entry.__file__.rsplit("/", 1)[0] + "/tools")

NUMBERS = set(range(1, 14))


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "jaccard_dedup", "mix_sources", "bpe"]
    assert entry.queries()["pipeline"] is corpus_pipeline.run


def test_every_operator_has_one_query():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert {int(n[2:].split("_")[0]) for n in names} == NUMBERS and len(names) == 13


def test_each_stage_on_its_own_input(spark, small_docs):
    docs, seen = small_docs, []
    for name, stage in corpus_pipeline.STAGES[:4]:
        made = corpus_pipeline.written(stage(spark, docs, ""), name)
        assert made.columns == small_docs.columns
        seen.append((docs, made))
        docs = made
    before, after = seen[0]
    assert after.exceptAll(before).count() == 0 and after.count() > 0.98 * before.count()
    before, after = seen[1]
    assert after.exceptAll(before).count() == 0 and after.exceptAll(drop_copies(before)).count() == 0
    before, after = seen[2]
    found = jaccard_join.jaccard_components(before, 5, 0.8)
    assert after.count() == found.select("component_key").distinct().count() and after.exceptAll(before).count() == 0
    before, after = seen[3]
    assert set(r[0] for r in after.select("doc_id").collect()) <= set(r[0] for r in before.select("doc_id").collect())
    coded = corpus_pipeline.STAGES[4][1](spark, docs, "").collect()
    texts = sorted(hashlib.sha256(r["text"].encode()).hexdigest() for r in docs.collect())
    assert sorted(r["decoded_sha256"] for r in coded) == texts
    assert all(r["n_tokens"] == len(r["ids"]) for r in coded)
    codec = bpe.loaded(bpe.default_vocabulary())
    starts, data = codec.byte_table()
    r = coded[0]
    whole = b"".join(data[starts[i] : starts[i + 1]].tobytes() for i in r["ids"])
    assert hashlib.sha256(whole).hexdigest() == r["decoded_sha256"]


@pytest.mark.parametrize("which", ["messy", "clashing", "nothing"])
def test_stages_take_any_rows(spark, request, which):
    docs = request.getfixturevalue(which)
    for name, stage in corpus_pipeline.STAGES:
        made = corpus_pipeline.written(stage(spark, docs, ""), name)
        if name != "bpe":
            assert made.columns == docs.columns
        docs = made
    assert (docs.count() > 0) == (which != "nothing")


def test_sql_states_the_same_rows(spark, sf_dir):
    import check

    con = check.connect(sf_dir)
    for name in ("op2_warc_index", "op8_exact_dedup", "op11_periodic_runs", "op12_chat_format", "op13_prefix_trie"):
        rows = entry.queries()[name](spark, sf_dir).toPandas()
        want = con.execute(entry.oracle_sql()[name]).df()
        assert check.compare(rows, want) is None, name
