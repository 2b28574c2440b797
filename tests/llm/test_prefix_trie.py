import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from llm_helpers import rows_of

from priceloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    """The turns of every conversation, shared beginnings put in."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 9
        base = turns if c is None else own.get(c - c % 5, [])
        out[c] = base[:h] + turns[h:]
    return out


def nodes_of(conversations):
    """Nodes from every prefix of every conversation. An id None is the
    smallest and written as nothing."""
    rank = lambda c: (c is not None, c or 0)
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, convs in members.items():
        children = [m for m in members if len(m) == len(node) + 1 and m[: len(node)] == node]
        under = [m for m in members if m[: len(node)] == node]
        leaves = [m for m in under if not any(len(x) == len(m) + 1 and x[: len(m)] == m for x in under)]
        saved = sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in under if m)
        ending = sorted((c for c in convs if len(conversations[c]) == len(node)), key=rank)
        digest = hashlib.sha256(",".join("" if c is None else str(c) for c in ending).encode()).hexdigest()
        parent = min(members[node[:-1]], key=rank) if node else None
        out.append((min(convs, key=rank), len(node), parent, len(convs), len(children), len(leaves), saved, digest))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def odd_rows():
    """Shared beginnings, equal conversations, nulls in every column, repeated
    rows, empty texts, turnless conversations and one long conversation."""
    rng = random.Random(4)
    rows = []
    for c in range(60):
        first = rng.choice(["hi", "hi", "Hallo"])
        for t in range(rng.randint(1, 6)):
            text = first if t == 0 else rng.choice(["ok", "größe", "", None, f"own {c}"])
            rows.append((c, rng.choice([t, t, t, None]) if c % 7 == 0 else t, rng.choice(["user", "user", None]), text))
    rows += [(100 + c, t, "user", f"same {t}") for c in range(40) for t in range(3)]
    rows += [rows[-1], (None, 0, "user", "hi"), (None, None, None, None), (1003, 0, "user", "alone")]
    rows += [(2000, t, "user", f"long {t // 2}") for t in range(70)]
    # equal (conv_id, turn) with unequal turns would be ordered by hashes
    seen, out = {}, []
    for row in rows:
        if seen.setdefault(row[:2], row[2:]) == row[2:]:
            out.append(row)
    return out


@pytest.mark.parametrize("limit", [prefix_trie.LIMIT, 40, 8])
def test_against_brute_force(spark, odd_rows, limit):
    """One container, a few rounds of bursting, and many with chains."""
    df = spark.createDataFrame(odd_rows, SCHEMA).repartition(4)
    got = rows_of(prefix_trie.prefix_trie(df, limit=limit))
    assert got == nodes_of(rebuilt(odd_rows))


def test_rebuilt_conversations(spark, odd_rows):
    rows, convs, nameless = prefix_trie.rebuilt(spark.createDataFrame(odd_rows, SCHEMA))
    want = rebuilt(odd_rows)
    assert nameless == -1
    lengths = {(None if r["c"] == nameless else r["c"]): r["n"] for r in convs.collect()}
    assert lengths == {c: len(t) for c, t in want.items()}
    assert 0 in lengths.values()
    depths = defaultdict(list)
    for r in rows.collect():
        depths[None if r["c"] == nameless else r["c"]].append(r["depth"])
    assert {c: sorted(d) for c, d in depths.items()} == {c: list(range(1, n + 1)) for c, n in lengths.items() if n}


def test_bursting_stops_where_containers_fit(spark, odd_rows):
    rows, convs, nameless = prefix_trie.rebuilt(spark.createDataFrame(odd_rows, SCHEMA))
    classes = prefix_trie._classes(rows, convs, nameless)
    path = rows.join(classes, "c")
    heads, stay = prefix_trie._burst(path, classes, 40)
    assert len(heads) >= 2 and len(stay) == len(heads) + 1
    for part in stay:
        assert all(r["load"] <= 40 or r["members"] == 1 for r in part.collect())
    assert sum(part.count() for part in stay) + sum(h.filter("ending is not null").count() for h in heads) == classes.filter("n > 0").count()


def test_long_lists_are_hashed_in_order(spark):
    """A list in several parts, with negative ids."""
    ids = sorted({(i * 7919) % 20_011 - 9000 for i in range(9000)})
    df = spark.createDataFrame([(i,) for i in ids], "conv_id long").selectExpr("conv_id", "0L as turn", "'user' as role", "'hi' as text")
    rows = prefix_trie.numbered_turns(df)[0].selectExpr("c", "1L as depth", "id1", "id2", "bytes")
    convs = rows.selectExpr("c", "1L as n")
    got = {r["depth"]: r for r in prefix_trie.trie(rows, convs).collect()}
    digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert (got[1]["n_convs"], got[1]["ends_sha256"]) == (len(ids), digest)
    assert got[0]["ends_sha256"] == prefix_trie.EMPTY_DIGEST and got[0]["saved_tokens"] == 2 * (len(ids) - 1)


def test_no_rows_and_clashing_columns(spark, odd_rows):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame(odd_rows[:80], SCHEMA).selectExpr("*", "'x' as c", "'x' as depth", "1 as rank", "'y' as n", "2 as bytes")
    assert rows_of(prefix_trie.prefix_trie(df)) == nodes_of(rebuilt(odd_rows[:80]))
