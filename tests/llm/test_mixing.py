import re
from collections import Counter, defaultdict

import numpy as np

from priceloom.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets_by_hand(sizes):
    """Targets of sources given in order."""
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sizes)}
    total, capped, level = sum(sizes.values()), set(), 0
    while True:
        left = [s for s in sizes if s not in capped]
        if left:
            level = (1.5 * total - sum(2 * sizes[s] for s in capped)) / sum(weights[s] for s in left)
        new = {s for s in left if level * weights[s] > 2 * sizes[s]}
        if not new:
            return {s: min(2 * sizes[s], level * weights[s]) for s in sizes}
        capped |= new


def by_source(rows):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    return {s: sizes[s] for s in sorted(sizes, key=lambda s: (s is None, s or ""))}


def check(rows, docs):
    got = mixing.mix_counts(docs).collect()
    assert len(got) == len(rows)
    sizes = by_source(rows)
    want = targets_by_hand(sizes)
    size_of = Counter((r[0], len(WORD.findall(r[1] or "")), sizes[r[3]], round(want[r[3]], 6)) for r in rows)
    assert Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6)) for r in got) == size_of
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    taken = defaultdict(int)
    for r in got:
        taken[r["source_size"], round(r["target"], 6)] += r["taken"]
    for s, target in want.items():
        same = sum(1 for t in want if (sizes[t], round(want[t], 6)) == (sizes[s], round(target, 6)))
        assert abs(taken[sizes[s], round(target, 6)] - same * target) <= same * 2 * mixing.BLOCK_WORDS


def test_messy_rows(clashing, messy_rows):
    check(messy_rows, clashing)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check([tuple(r) for r in docs.collect()], docs)


def test_reruns_agree_for_any_layout(small_docs):
    first, second = mixing.mix_counts(small_docs).collect(), mixing.mix_counts(small_docs.repartition(7)).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, second))


def test_permutations_are_permutations():
    for size in (1, 2, 3, 7, 64, 1000, 4097):
        for key in range(3):
            assert sorted(mixing._permuted(np.arange(size), size, key).tolist()) == list(range(size))
    assert mixing._permuted(np.arange(1000), 1000, 1).tolist() != mixing._permuted(np.arange(1000), 1000, 2).tolist()


def test_each_block_once_a_pass(small_docs):
    _, filled = mixing.plan(mixing.sizes(small_docs))
    rows = filled.collect()
    assert len(rows) == len({(r["source_number"], r["pass"], r["block"]) for r in rows})
    assert len(rows) == len({(r["source_number"], r["slot"]) for r in rows})


def test_texts_hold_the_words_taken(small_docs):
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix_counts(small_docs).collect()}
    whole = {r["doc_id"]: r["text"] for r in small_docs.collect()}
    mixed = mixing.mix_texts(small_docs)
    assert mixed.columns == small_docs.columns
    words, kept = Counter(), 0
    for r in mixed.collect():
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
        assert not Counter(WORD.findall(r["text"])) - Counter(WORD.findall(whole[r["doc_id"]]))
        assert r["n_chars"] == len(r["text"])
        kept += r["text"] == whole[r["doc_id"]]
    assert words == Counter({k: v for k, v in taken.items() if v}) and kept > 50


def test_mixed_messy_and_empty(clashing, nothing):
    mixed = mixing.mix_texts(clashing)
    assert mixed.columns == clashing.columns and all(WORD.search(r["text"]) for r in mixed.collect())
    assert mixing.mix_counts(nothing).count() == 0 and mixing.mix_texts(nothing).count() == 0
