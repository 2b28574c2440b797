import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest
from llm_helpers import SCHEMA, rows_of

from priceloom.llm import periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs_of(words):
    """All maximal stretches with a period, by comparing every pair of words."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = q
        while i < len(words):
            j = i
            while j < len(words) and words[j] == words[j - q]:
                j += 1
            if j - i + q >= max(24, 3 * q):
                found.setdefault((i - q, j - i + q), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_force(doc_id, words):
    runs = runs_of(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *numbers, digest(lines), digest(kept))


@pytest.fixture(scope="module")
def repeated():
    """Texts with runs of short and long periods, broken, nested and side by
    side, in words of few and many kinds."""
    rng = random.Random(3)
    rows = []
    for k in range(160):
        n = rng.randint(0, 220)
        words = [f"w{rng.randint(0, rng.choice([0, 1, 2, 9, 400]))}é"[: rng.randint(2, 4)] for _ in range(n)]
        if n and k % 4:
            a = rng.randrange(n)
            p = rng.randint(1, 1 + (n - a) // 3)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            if k % 3 == 0:
                words[rng.randrange(n)] = "other"
            words += words[: rng.randint(0, n)] * rng.randint(0, 2)
        rows.append((k, rng.choice([" ", "\n", " \t"]).join(words), None, None, None))
    return rows


def test_against_brute_force(spark, messy_rows, repeated):
    rows = messy_rows + repeated
    got = rows_of(periodic_runs.digests(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    want = [brute_force(r[0], WORD.findall(r[1] or "")) for r in rows]
    assert sum(w[1] for w in want) > 100
    assert got == sorted(want, key=repr)


def test_planted_periods(spark, repeated):
    rows = [*repeated, (None, "a b c", None, None, None), (7, None, None, None, None)]

    def planted(doc_id, text):
        words, h = WORD.findall(text or ""), zlib.crc32(str(doc_id).encode())
        if doc_id is None or h % 10 or not words:
            return text or ""
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return " ".join(words[i if i < a else a + (i - a) % p] for i in range(n))

    got = rows_of(periodic_runs.with_planted_periods(spark.createDataFrame(rows, SCHEMA)))
    assert got == sorted([(r[0], planted(r[0], r[1])) for r in rows], key=repr)
    assert sum(planted(r[0], r[1]) != r[1] for r in repeated) > 5


def test_very_long_texts(spark):
    """Half a million words of one kind, of a long period, and of no period."""
    n = 500_000
    texts = ["a " * n, " ".join(str(i % (n // 4)) for i in range(n)), " ".join(map(str, range(n)))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in periodic_runs.with_runs(df).collect()}
    assert [tuple(r) for r in rows[0]["runs"]] == [(0, n, 1)] and rows[0]["collapsed"] == "a"
    assert [tuple(r) for r in rows[1]["runs"]] == [(0, n, n // 4)]
    assert rows[1]["collapsed"].split(" ") == [str(i) for i in range(n // 4)]
    assert rows[2]["runs"] == [] and rows[2]["n_words"] == n and rows[2]["collapsed"] == texts[2]


def test_other_columns_stay_and_clashing_ones_are_replaced(clashing, messy_rows):
    df = clashing.selectExpr("*", "'mine' as runs", "1 as n_words", "'x' as start")
    out = periodic_runs.with_runs(df)
    assert out.columns == [*clashing.columns, "start", "n_words", "runs", "collapsed"]
    assert out.count() == len(messy_rows)
    assert out.filter("start <> 'x' or row_key <> 'extra' or size(runs) < 0").count() == 0


def test_empty_table(nothing):
    assert periodic_runs.digests(nothing).count() == 0
    assert periodic_runs.digests(periodic_runs.with_planted_periods(nothing)).count() == 0


def test_no_shuffle(small_docs, plan_of):
    assert "Exchange" not in plan_of(periodic_runs.digests(periodic_runs.with_planted_periods(small_docs)))
