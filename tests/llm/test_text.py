import random

import numpy as np
import pyarrow as pa

from priceloom.llm.text import CHUNK_BYTES, hash_runs, joined_bytes, shingle_sets, slices, words


def test_words_are_those_of_bytes_split():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab \t\n\x0b\r\x1c é") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    data, offsets = joined_bytes(pa.array(texts))
    starts, ends, first = words(data, offsets)
    got = [data[s:e].tobytes() for s, e in zip(starts, ends)]
    assert [got[a:b] for a, b in zip(first, first[1:])] == [t.encode().split() for t in texts]


def test_equal_words_hash_equally_across_pieces():
    text = ("alpha beta " * (CHUNK_BYTES // 8)).encode()
    data = np.frombuffer(text, dtype=np.uint8)
    starts, ends, _ = words(data, np.array([0, len(data)]))
    hashes = hash_runs(data, starts, ends)
    assert len(set(hashes.tolist())) == 2 and (hashes[::2] == hashes[0]).all()


def test_shingle_sets_against_brute_force():
    rng = random.Random(2)
    texts = [" ".join(rng.choices("a b c dd A".split(), k=rng.randint(0, 9))) for _ in range(400)] + [None, ""]
    for width in (1, 3, 5):
        sets = shingle_sets(pa.array(texts), width)
        seen = {}
        for text, got in zip(texts, sets):
            w = (text or "").lower().split()
            want = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
            assert len(got) == len(want) and (np.diff(got.astype(object)) > 0).all()
            key = frozenset(want)
            assert seen.setdefault(key, got.tobytes()) == got.tobytes()
        assert len(set(seen.values())) == len(seen)


def test_slices_keep_rows_and_order():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (5, 0, 100, 3, 400, 1)], "i": list(range(6))})
    parts = list(slices(iter([batch]), "text", limit=100))
    assert [i for p in parts for i in p.column("i").to_pylist()] == list(range(6)) and len(parts) > 2
