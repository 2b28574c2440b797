import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from llm_helpers import rows_of

from priceloom.llm import bpe, chat_format

SCHEMA = "conv_id long, turn long, role string, text string"


def turns_by_conversation(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(ts)] for c, ts in out.items()}


def escape(text, marks):
    text = text.replace("\\", "\\\\")
    for mark in marks:
        text = text.replace(mark, f"{mark[0]}\\{mark[1:]}")
    return text


MARKS = ("### ", "</turn>", "<|endoftext|>")


def shown(turns):
    return "".join(f"### {escape(r, (*MARKS, ': '))}: {escape(t, MARKS)}</turn>\n" for r, t in turns)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_force(rows):
    out = []
    for conv, turns in turns_by_conversation(rows).items():
        loss = "".join(t for r, t in turns if r == "assistant")
        both = "".join(f"{r}\n{t}\n" for r, t in turns)
        out.append((conv, len(turns), digest(both), len(loss), digest(loss), len(shown(turns))))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def odd_rows():
    """Marks of the template and the vocabulary in texts and roles, nulls in
    every column, empty texts, ties, repeated rows, and one long conversation."""
    rng = random.Random(9)
    parts = ["### ", "</turn>", "\\", "<|endoftext|>", ": ", "\n", "Ok. ", "größe ", "🙂", "</", "###", "turn>", "é", " "]
    rows = []
    for c in range(40):
        for t in range(rng.randint(1, 7)):
            role = rng.choice(["user", "assistant", "assistant", None, "a: b", "x</turn>\n### user"])
            rows.append((c, rng.choice([t, t, None]), role, rng.choice([None, "", "".join(rng.choices(parts, k=rng.randint(1, 12)))])))
    rows += [rows[3], rows[3], (None, 0, "assistant", "no id"), (None, None, None, None), (50, 2, "assistant", "tie"), (50, 2, "assistant", "Tie")]
    rows += [(60, t, ["user", "assistant"][t % 2], f"turn {t} " + "".join(rng.choices(parts, k=4))) for t in range(900)]
    return rows


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(5)


@pytest.mark.parametrize(("segment", "hot"), [(1 << 20, 1 << 26), (300, 1 << 26), (300, 20_000)])
def test_read_back_against_brute_force(odd, odd_rows, segment, hot):
    """Whole conversations, cut ones, and hot ones dealt by ranges."""
    whole, ranged = chat_format.format_conversations(odd, segment_bytes=segment, hot_bytes=hot)
    assert (ranged is None) == (hot > 20_000)
    assert rows_of(chat_format.read_back(whole, ranged)) == brute_force(odd_rows)
    if ranged is not None:
        assert ranged.select("conv_id").distinct().count() == 1
        assert whole.filter("conv_id = 60").count() == 0
    if segment == 300:
        assert max(r["count"] for r in (ranged or whole).groupBy("conv_id").count().collect()) > 50


@pytest.mark.parametrize("segment", [1 << 20, 300])
def test_tokens_and_mask(odd, odd_rows, segment):
    """The tokens are those of the whole conversation, and a token is under the
    mask if it shows a character of an assistant's text."""
    turns = turns_by_conversation(odd_rows)
    library = bpe.Bpe(bpe.default_vocabulary())
    rows = chat_format.format_conversations(odd, segment_bytes=segment)[0].collect()
    parts = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["segment"]):
        parts[r["conv_id"]].append(r)
    assert parts.keys() == turns.keys()
    for conv, rs in parts.items():
        text = "".join(r["formatted"] for r in rs)
        assert text == shown(turns[conv])
        assert [i for r in rs for i in r["ids"]] == [i for p in library.encode_batch([text])[0] for i in p[0]]
        learned, at = [], 0
        for role, body in turns[conv]:
            head = len(f"### {escape(role, (*MARKS, ': '))}: ".encode())
            size = len(escape(body, MARKS).encode())
            learned += [False] * head + [role == "assistant"] * size + [False] * len("</turn>\n")
        for r in rs:
            assert r["token_ends"][-1] == len(r["formatted"].encode())
            here = np.array(learned[at : at + r["token_ends"][-1]])
            at += r["token_ends"][-1]
            starts = [0, *r["token_ends"][:-1]]
            assert r["loss"] == [bool(here[a:b].any()) for a, b in zip(starts, r["token_ends"])]


def test_a_damaged_segment_raises(odd):
    whole = chat_format.format_conversations(odd)[0].selectExpr("conv_id", "substr(formatted, 2) as formatted", "loss_spans")
    with pytest.raises(Exception, match="no turn at character 0"):
        chat_format.read_back(whole).collect()


def test_other_columns_are_not_read_and_no_rows_give_none(spark, odd, odd_rows):
    extra = odd.selectExpr("*", "'x' as formatted", "1 as segment", "'y' as size", "'z' as head")
    whole, ranged = chat_format.format_conversations(extra)
    assert rows_of(chat_format.read_back(whole, ranged)) == brute_force(odd_rows)
    none = spark.createDataFrame([], SCHEMA)
    assert chat_format.read_back(*chat_format.format_conversations(none)).count() == 0


def test_a_long_text(spark):
    text = "Wörd </turn> " * 150_000
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", text)], SCHEMA)
    (row,) = chat_format.read_back(*chat_format.format_conversations(df)).collect()
    assert (row["n_turns"], row["loss_chars"], row["loss_sha256"]) == (2, len(text), digest(text))
