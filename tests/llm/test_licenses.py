import re

from llm_helpers import SCHEMA

from priceloom.llm import licenses


def shingles(text):
    w = re.findall(r"[A-Za-z0-9\x80-\U0010ffff]+", text)
    w = [x.lower() if x.isascii() else x for x in w]
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)]


def best_share(text, notice):
    """Largest share of a notice's shingles in any run as long as two classes."""
    own, all_ = set(shingles(notice)), shingles(text)
    size = 2 << (len(own) - 1).bit_length()
    return max((len(own & set(all_[i : i + size])) / len(own) for i in range(len(all_))), default=0)


def test_documents_against_brute_force(small_docs):
    got = {}
    for r in licenses.scan(small_docs).collect():
        got.setdefault((r["doc_id"], r["license"]), []).append(r)
    for d in small_docs.collect():
        for name, notice in licenses.NOTICES.items():
            share = best_share(d["text"] or "", notice)
            # a window of the scan starts every class, so it sees what fits one
            assert ((d["doc_id"], name) in got) == (share >= 0.8), (d["doc_id"], name, share)


def test_notices_in_place(spark):
    rows = []
    for i, (_, notice) in enumerate(licenses.NOTICES.items()):
        rows.append((i, "é word " * (37 * i) + notice.upper() + " more words here" * 50, None, None, None))
    changed = licenses.NOTICES["MIT-text"].replace("free of charge", "free of cost")
    rows += [(90, "lead " * 300 + changed, None, None, None), (91, " ".join(licenses.NOTICES["MIT-text"].split()[:30]), None, None, None)]
    got = licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()
    by = {(r["doc_id"], r["license"]): r for r in got}
    for i, (name, notice) in enumerate(licenses.NOTICES.items()):
        r = by[i, name]
        text = rows[i][1]
        assert r["containment"] == 1.0
        assert text[r["start"] : r["end"]].lower().split() == notice.rstrip(".").rstrip("/").lower().split(), name
    assert 0.8 <= by[90, "MIT-text"]["containment"] < 1 and (91, "MIT-text") not in by


def test_bands_keep_their_promise():
    assert (1 - (1 - 0.19) ** licenses.bands_for(0.19, 0.9999)) >= 0.9999
    known = licenses.Templates(licenses.NOTICES)
    assert all(bands >= 10 for bands in known.classes.values())


def test_messy_rows(clashing, nothing):
    assert licenses.scan(clashing).count() == 0 and licenses.scan(nothing).count() == 0
