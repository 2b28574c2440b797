import hashlib
import random
import re

from llm_helpers import SCHEMA

from priceloom.llm import pii

PLAIN = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def plain_spans(text):
    out = []
    for number, (kind, pattern) in enumerate(PLAIN):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), number, m.end(), kind))
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out)]


def check(docs, rows):
    got = pii.find(docs).collect()
    assert len(got) == len(rows)
    want = sorted((str(r[0]), ",".join(plain_spans(r[1]))) for r in rows)
    base = lambda r: ",".join(s for s in r["spans"].split(",") if not s.startswith("id:"))
    assert sorted((str(r["doc_id"]), base(r)) for r in got) == want
    for r in got:
        spans = base(r)
        assert r["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS[:4]] == [sum(s.startswith(k) for s in spans.split(",")) for k in pii.KINDS[:4]]
        assert r["n_found"] == sum(s.startswith("id:") for s in r["spans"].split(","))
    return got


def test_expressions_match_their_plain_forms(spark):
    rng = random.Random(2)
    bits = ["a", "b.", "@", "1", "23", "255", ".", "-", " ", "+", "(", ")", "é", "😀", "\n", "%", "4111 1111 1111 1111", "x@y.co", "1.2.3.4"]
    rows = [(i, "".join(rng.choices(bits, k=rng.randint(0, 40))), None, None, None) for i in range(900)]
    rows += [(5000, "1" * 5000 + " " + "1 " * 4000, None, None, None), (5001, "a" * 30_000, None, None, None)]
    rows += [(5002, "a@b.c " * 300, None, None, None), (5003, "x@y.com%z@w.org", None, None, None)]
    check(spark.createDataFrame(rows, SCHEMA).repartition(3), rows)


def test_messy_rows(clashing, messy_rows, nothing):
    check(clashing, messy_rows)
    assert pii.find(nothing).count() == 0


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    rows = [(i, f"text {i} please reach me under user{i}@mail.org thanks a lot", None, None, None) for i in range(12)]
    rows += [(100, "text please reach me under user77(at)mail thanks a lot", None, None, None)]
    rows += [(101, "version 2.0 of chapter 12 in 1999 was good", None, None, None)]
    got = {r["doc_id"]: r for r in check(spark.createDataFrame(rows, SCHEMA), rows)}
    text = rows[12][1]
    a = text.index("user77")
    assert got[100]["spans"] == f"id:{a}:{a + len('user77(at)mail')}"
    assert got[101]["spans"] == "" and got[0]["n_found"] == 0


def test_main_path_is_native(small_docs, plan_of):
    plan = plan_of(pii.find(small_docs))
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def ids(spark, texts):
    """The unseen identifiers found in each text."""
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    out = {}
    for r in check(spark.createDataFrame(rows, SCHEMA), rows):
        spans = [s.split(":") for s in r["spans"].split(",") if s.startswith("id:")]
        out[r["doc_id"]] = [texts[r["doc_id"]][int(a) : int(b)] for _, a, b in spans]
    return [out[i] for i in range(len(texts))]


def words(i):
    return f"w{chr(97 + i % 26)}{chr(97 + i // 26)}x"


def test_more_unseen_identifiers_than_seeds(spark):
    seeds = [f"my handle user{i}@mail.org {words(i)} then" for i in range(30)]
    unseen = [f"my handle user{i}(at)mail {words(300 + i)} then" for i in range(50)]
    ordinary = [f"it costs {i}0 dollars {words(i)}" for i in range(1, 40)]
    # by a word that many numbers stand by too, and few seeds, in places of ordinary numbers
    mixed = [f"it is a{i}@mail.org {words(i)}" for i in range(10)] + [f"it is {i}5 dollars" for i in range(1, 60)]
    got = ids(spark, seeds + unseen + ordinary + mixed)
    assert got[30:80] == [[f"user{i}(at)mail"] for i in range(50)]
    assert not any(got[:30] + got[80:])


def test_found_identifiers_are_seeds_of_the_next_round(spark):
    near = [f"my handle user{i}@mail.org {words(i)} then" for i in range(12)]
    between = [f"my handle K{i}-77 badge" for i in range(6)]
    far = [f"{words(400 + i)} Z{i}-99 badge" for i in range(4)]
    got = ids(spark, near + between + far)
    assert got[12:18] == [[f"K{i}-77"] for i in range(6)]
    assert got[18:] == [[f"Z{i}-99"] for i in range(4)]


def test_words_beside_each_other_are_contexts_too(spark):
    seeds = [f"{words(i)} field1 user{i}@mail.org {words(50 + i)}" for i in range(12)]
    got = ids(spark, [*seeds, "other field1 user77(at)mail thing", "\n".join(["last", "field1", " " * 80 + "user78(at)mail", "thing"])])
    assert "user77(at)mail" in got[12] and "user78(at)mail" in got[13]


def test_what_goes_with_ordinary_words_does_not_count(spark):
    key = lambda i: hashlib.sha1(str(i).encode()).hexdigest()
    ordinary = [f"{words(i)} of {words(i + 9)} and x = {i} of {words(i + 99)}" for i in range(60)]
    beside = [f"{words(i)} of user{i}@mail.org {words(50 + i)}" for i in range(12)] + ["sort of 77-12 thing"]
    keys = [f'{words(i)} token = "{key(i)}"### {words(70 + i)}' for i in range(8)]
    other = ['a token = "ab12-short" here', f"the sum of {key(99)} it", f"last x = {key(98)} it"]
    got = ids(spark, ordinary + beside + keys + other)
    assert not any(got[:73])
    assert got[73:] == [*[[key(i)] for i in range(8)], ["ab12-short"], [], []]


def test_planted_keys(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = {
        (r["doc_id"], f"id:{m.start(1)}:{m.end(1)}")
        for r in docs.collect()
        for m in re.finditer(r'token = "([0-9a-f]+)"', r["text"] or "", re.I)
    }
    got = {(r["doc_id"], s) for r in pii.find(docs).collect() for s in r["spans"].split(",") if s.startswith("id:")}
    assert got == want and len(want) > 10


def test_very_many_matches(spark):
    texts = [" ".join(str(i) for i in range(60_000)), " ".join(f"u{i}@mail.org" for i in range(30_000))]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in check(spark.createDataFrame(rows, SCHEMA), rows)}
    assert got[1]["n_email"] == 30_000
