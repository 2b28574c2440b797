import hashlib
from collections import defaultdict

from llm_helpers import rows_of

from priceloom.llm import exact_dedup

CASES = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r[1] or "").translate(CASES)].append(r[0])
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), i == keep, digest) for i in ids]
    return sorted(out, key=repr)


def test_against_brute_force(messy, messy_rows):
    assert rows_of(exact_dedup.duplicate_groups(messy, hash_all=True)) == brute_force(messy_rows)


def test_unshared_texts_are_not_hashed(messy, messy_rows):
    rows = exact_dedup.duplicate_groups(messy).collect()
    unread = [r for r in rows if r["text_hash"] is None]
    assert unread and all(r["group_size"] == 1 for r in unread)
    assert all(r["text_hash"] for r in rows if r["group_size"] > 1)


def test_one_row_of_each_text_stays(clashing, messy_rows):
    stay = exact_dedup.drop_copies(clashing)
    assert stay.columns == clashing.columns
    texts = [(r["text"] or "").translate(CASES) for r in stay.collect()]
    assert sorted(texts) == sorted({(r[1] or "").translate(CASES) for r in messy_rows})


def test_empty_table(nothing):
    assert exact_dedup.duplicate_groups(nothing, hash_all=True).count() == 0
    assert exact_dedup.drop_copies(nothing).count() == 0


def test_no_text_is_shuffled_for_groups(messy, plan_of):
    plan = plan_of(exact_dedup.duplicate_groups(messy))
    assert "CartesianProduct" not in plan and "Python" not in plan
