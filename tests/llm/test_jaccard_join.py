import random
from collections import Counter, defaultdict

import pytest
from llm_helpers import SCHEMA

from priceloom.llm import graph, jaccard_join


def sets_of(rows, width):
    out = []
    for r in rows:
        w = (r[1] or "").encode().lower().split()
        full = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}
        out.append(full if len(w) >= width else {tuple(w)} if w else set())
    return out


def brute_force(rows, width, percent):
    """(doc_id, n_shingles, component_id) of every row, sorted."""
    sets, root = sets_of(rows, width), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders, shared = defaultdict(list), Counter()
    for i, s in enumerate(sets):
        for token in s:
            holders[token].append(i)
    for own in holders.values():
        shared.update((a, b) for k, a in enumerate(own) for b in own[k + 1 :])
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            root[find(a)] = find(b)
    ids = defaultdict(list)
    for i, r in enumerate(rows):
        ids[find(i)].append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return sorted(((r[0], len(sets[i]), least[find(i)] if sets[i] else r[0]) for i, r in enumerate(rows)), key=repr)


def found(docs, width, threshold):
    rows = jaccard_join.jaccard_components(docs, width, threshold).select("doc_id", "n_shingles", "component_id")
    return sorted((tuple(r) for r in rows.collect()), key=repr)


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_messy_rows(clashing, messy_rows, width, percent):
    assert found(clashing, width, percent / 100) == brute_force(messy_rows, width, percent)


@pytest.mark.parametrize("members", [4, jaccard_join.GROUP_MEMBERS])
def test_chains_of_near_copies_over_many_groups(spark, monkeypatch, members):
    """Copies with edits around the threshold, a passage shared by all, groups
    cut small so that links have to be found across them."""
    monkeypatch.setattr(jaccard_join, "GROUP_MEMBERS", members)
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    passage = [word() for _ in range(12)]
    rows = []
    for cluster in range(6):
        base = [word() for _ in range(80)]
        for _ in range(12):
            text = base[:]
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(80)] = word()
            rows.append((len(rows), " ".join(passage + text if cluster % 2 else text), None, None, None))
    rows += [(500 + i, " ".join(passage + [word() for _ in range(rng.randint(5, 90))]), None, None, None) for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(docs, 3, 0.9) == brute_force(rows, 3, 90)


def test_one_of_each_component_stays(clashing, messy_rows):
    stay = jaccard_join.keep_one(clashing, 5, 0.8)
    assert stay.columns == clashing.columns
    want = brute_force(messy_rows, 5, 80)
    wordless = sum(1 for w in want if w[1] == 0)
    sets = [frozenset(s) for s in sets_of(messy_rows, 5)]
    kept = [frozenset(s) for s in sets_of([tuple(r) for r in stay.collect()], 5)]
    assert sum(1 for s in kept if not s) == wordless
    assert len([s for s in kept if s]) == len({s for s in kept if s}) and set(kept) <= set(sets)
    again = jaccard_join.jaccard_components(stay, 5, 0.8).filter("n_shingles > 0")
    assert again.count() == again.select("component_key").distinct().count()


def test_documents(small_docs):
    rows = [tuple(r) for r in small_docs.collect()]
    assert found(small_docs, 5, 0.8) == brute_force(rows, 5, 80)


def test_empty_table(nothing):
    assert found(nothing, 3, 0.9) == [] and jaccard_join.keep_one(nothing).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (3, 2), (200, 201), (201, 200)]
    got = dict(graph.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0
