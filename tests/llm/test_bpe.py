import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from priceloom.llm import bpe


@pytest.fixture(scope="module")
def exact():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.no_padding()
    t.no_truncation()
    return t


def test_ids_and_text_of_random_strings(exact):
    rng = random.Random(4)
    alphabet = "abcdefghi ABC 0123 \n\t\r'!?.,é漢字😀  　\x1c\x85́<|endoftext|>'s're "
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 120))) for _ in range(1500)]
    texts += ["<|endoftext|>a<|endoftext|> b", "", "x" * 2000, "ab" * 1500, " " * 300 + "z", "\x00", "'S 's", "\r\n\r\n"]
    found = bpe.loaded(bpe.default_vocabulary()).encode_batch(texts)
    for text, pieces, want in zip(texts, found, exact.encode_batch(texts, add_special_tokens=False)):
        ids = [i for p in pieces for i in p[0]]
        assert ids == want.ids, text
        assert b"".join(p[2] for p in pieces).decode() == exact.decode(ids, skip_special_tokens=False) == text


def test_speculation_is_verified():
    """Some greedy proposals hold and some do not; all end up exact."""
    codec = bpe.Bpe(bpe.default_vocabulary())
    words = [" the", " thhasted", "ation", " onhare", "zzzzq", "élan"]
    got = codec.encode_words(words)
    raw = [w.encode() for w in words]
    exact = codec.merged(raw)
    flat, owner = codec.greedy(raw)
    proposed = [tuple(flat[owner == i].tolist()) for i in range(len(words))]
    assert list(got.values()) == exact
    assert any(a == b for a, b in zip(proposed, exact)) and any(a != b for a, b in zip(proposed, exact))


def test_memory_of_words_is_bounded(monkeypatch, exact):
    monkeypatch.setattr(bpe, "MEMO_WORDS", 50)
    monkeypatch.setattr(bpe, "MEMO_PIECES", 40)
    codec, rng = bpe.Bpe(bpe.default_vocabulary()), random.Random(6)
    for _ in range(20):
        texts = [" ".join("".join(rng.choices("abcde", k=5)) for _ in range(10)) for _ in range(5)]
        for text, pieces in zip(texts, codec.encode_batch(texts)):
            assert [i for p in pieces for i in p[0]] == exact.encode(text, add_special_tokens=False).ids
    assert len(codec.pieces) <= 40 + 50 and len(codec.memo) <= 50 + 50



def test_ids_are_packed_with_each_piece():
    """Each remembered piece keeps its ids as 32-bit integers in bytes, also
    after the memories are renewed, and the ids of texts are laid out from them."""
    codec, rng = bpe.Bpe(bpe.default_vocabulary(), (50, 40)), random.Random(7)
    for _ in range(6):
        texts = [" ".join("".join(rng.choices("abcde,", k=5)) for _ in range(10)) for _ in range(5)] + [""]
        coded = codec.encode_batch(texts)
        for pieces in coded:
            for ids, _, _, packed in pieces:
                assert np.frombuffer(packed, dtype=np.int32).tolist() == list(ids)
        flat, ends = bpe._flat(coded)
        assert [flat[a:b].tolist() for a, b in zip(ends, ends[1:])] == [[i for p in ps for i in p[0]] for ps in coded]


def test_digests_of_messy_rows(clashing, messy_rows, exact):
    got = sorted((tuple(r) for r in bpe.digests(clashing).collect()), key=repr)
    want = []
    for r in messy_rows:
        ids = exact.encode(r[1] or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((r[0], len(ids), sha(",".join(map(str, ids))), sha(exact.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want, key=repr)


def test_round_trip_of_tables(clashing, nothing):
    rows = bpe.decode(bpe.encode(clashing)).select("text", "decoded", "ids").collect()
    assert all((r["text"] or "") == r["decoded"] for r in rows) and any(r["ids"] for r in rows)
    assert bpe.decode(bpe.encode(nothing)).count() == 0


def test_digests_are_of_the_ids(spark, monkeypatch):
    """A fault in the ids shows in the digest of the decoded text."""
    codec = bpe.Bpe(bpe.default_vocabulary())
    coded = codec.encode_batch(["Hello größe 🙂 x", "", "a b"])
    flat, ends = bpe._flat(coded)
    table = codec.byte_table()
    assert [t.decode() for t in bpe.decoded_texts(table, flat, ends)] == ["Hello größe 🙂 x", "", "a b"]
    flat[-1] += 1
    good, empty, bad = bpe.decoded_texts(table, flat, ends)
    assert good.decode() == "Hello größe 🙂 x" and empty == b"" and bad != b"a b"


def test_loading_leaves_the_collector_on():
    """A Python worker is reused by later stages; their cyclic garbage must be
    freed after the vocabulary is loaded."""
    import gc
    import weakref

    bpe._loaded.pop((bpe.default_vocabulary(), bpe.SMALL_MEMO), None)
    bpe.loaded(bpe.default_vocabulary(), bpe.SMALL_MEMO)
    assert gc.isenabled()

    class Node:
        pass

    a, b = Node(), Node()
    a.other, b.other = b, a
    gone = weakref.ref(a)
    del a, b
    gc.collect()
    assert gone() is None
