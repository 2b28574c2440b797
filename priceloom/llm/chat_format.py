"""Chat formatting with offset-aligned masks.

Conversations are rendered whole by a template, encoded once, and the spans of
their turns are intersected with the spans of the tokens by binary search: both
are sorted, so a turn's first and last token are two lookups. The byte-level
tokens tile the text, so their offsets are running sums of their lengths.

A turn is ``### role: text</turn>`` and a line feed. Texts and roles are escaped
reversibly: a backslash is doubled, and a string that the template or the
vocabulary gives a meaning gets a backslash after its first character, so that
it occurs nowhere but where the template put it. Reading back takes the
character after each backslash as it is.

Turns of a conversation are put together by one shuffle on its id and a sort
within partitions, then streamed. A conversation over ``SEGMENT_BYTES`` comes out
in segments cut between turns, so that memory is bounded by them and the longest
turn; a turn's first token never reaches over the line feed before, so the
segments' tokens are those of the whole. Conversations with a thousandth of all
bytes and more than HOT_BYTES, of which there are a thousand at most, are dealt
by ranges of their turns over many tasks, and only their segments are read back
in one line each, as a digest over a whole conversation needs.

Defined results: rows go by turn, a null one first, ties by role and text; null
role or text counts as empty; rows without an id are one conversation without
an id; a repeated row is a turn each time; an empty text has no tokens of its
own and no loss; an empty table gives no rows; other columns are not read."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priceloom.llm.bpe import default_vocabulary, loaded
from priceloom.llm.common import HOT_SHARE

SEGMENT_BYTES = 1 << 20
PARTITION_BYTES = 128 << 20
HOT_BYTES = 64 << 20
#: Pieces and words that a worker remembers, less than for whole documents.
MEMO = 120_000, 80_000

SEGMENTS = (
    "conv_id long, segment long, formatted string, ids array<int>, token_ends array<int>, loss array<boolean>, "
    "loss_spans array<struct<start:int,end:int>>"
)
READ_BACK = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
ESCAPED = re.compile(r"\\(.)", re.DOTALL)


@dataclass(frozen=True)
class Template:
    """Marks around a turn's role and text. No mark may end as it begins, nor
    hold a backslash. ``reserved`` are further strings that texts must not show,
    such as the vocabulary's added tokens. ``learned`` is the role whose texts
    the loss is taken of."""

    begin: str = "### "
    middle: str = ": "
    end: str = "</turn>"
    reserved: tuple[str, ...] = ("<|endoftext|>",)
    learned: str = "assistant"

    def escape(self, text: Column, role: bool = False) -> Column:
        text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        for mark in (self.begin, self.end, *self.reserved, *([self.middle] if role else [])):
            text = F.replace(text, F.lit(mark), F.lit(f"{mark[0]}\\{mark[1:]}"))
        return text

    def turns(self) -> re.Pattern:
        begin, middle, end = (re.escape(m) for m in (self.begin, self.middle, self.end))
        return re.compile(f"{begin}(.*?){middle}(.*?){end}\n", re.DOTALL)


TEMPLATE = Template()


def unescaped(text: str) -> str:
    return ESCAPED.sub(r"\1", text) if "\\" in text else text


def _rendered(rows: DataFrame, template: Template) -> DataFrame:
    """Each row's turn as text, the bytes before and in its escaped text, and
    whether it is learned from."""
    head = F.concat(F.lit(template.begin), template.escape(F.col("role"), role=True), F.lit(template.middle))
    parts = rows.select("conv_id", head.alias("head"), template.escape(F.col("text")).alias("body"), (F.col("role") == template.learned).alias("learned"))
    return parts.select(
        "conv_id",
        F.concat("head", "body", F.lit(template.end + "\n")).alias("shown"),
        F.octet_length("head").alias("from"),
        F.octet_length("body").alias("long"),
        "learned",
    )


def _segments(path: str, ranged: bool, segment_bytes: int):
    """Sorted turns to segments: as many whole conversations at a time as make
    ``segment_bytes``, or a part of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, MEMO)
        token_bytes = np.diff(bpe.byte_table()[0])
        base = TaskContext.get().partitionId() << 32 if ranged else 0
        ready: list[tuple] = []  # (conversation, segment, turns)
        turns: list[tuple] = []
        size = whole = number = 0
        current: object = ()

        def shown() -> pa.RecordBatch:
            texts = ["".join([t[0] for t in part]) for _, _, part in ready]
            return _encoded(bpe, token_bytes, ready, texts)

        for batch in batches:
            ids, texts = batch.column("conv_id").to_pylist(), batch.column("shown").to_pylist()
            froms, longs = batch.column("from").to_pylist(), batch.column("long").to_pylist()
            learned = batch.column("learned").to_pylist()
            for key, *turn in zip(ids, texts, froms, longs, learned):
                if key != current or size >= segment_bytes:
                    if turns:
                        ready.append((current, base + number, turns))
                        whole += size
                        number += 1
                    if key != current:
                        current, number = key, 0
                    turns, size = [], 0
                    if whole >= segment_bytes:
                        yield shown()
                        ready, whole = [], 0
                turns.append(turn)
                size += turn[1] + turn[2]
        if turns:
            ready.append((current, base + number, turns))
        if ready:
            yield shown()

    return run


def _encoded(bpe, token_bytes: np.ndarray, ready: list[tuple], texts: list[str]) -> pa.RecordBatch:
    ids, ends, masks, spans = [], [], [], []
    for (_, _, turns), text, pieces in zip(ready, texts, bpe.encode_batch(texts)):
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        tokens = np.fromiter((i for piece in pieces for i in piece[0]), np.int32, sum([len(p[0]) for p in pieces]))
        stop = np.cumsum(token_bytes[tokens])
        begin = stop - token_bytes[tokens]
        starts = np.cumsum([0] + [len(t[0].encode()) for t in turns])[:-1] + np.array([t[1] for t in turns])
        chosen = np.array([t[3] and t[2] > 0 for t in turns], dtype=bool)
        low = starts[chosen]
        high = low + np.array([t[2] for t in turns], dtype=np.int64)[chosen]
        # the tokens that share a byte with a learned text
        first, last = np.searchsorted(stop, low, side="right"), np.searchsorted(begin, high, side="left")
        edge = np.zeros(len(tokens) + 1, dtype=np.int64)
        np.add.at(edge, first, 1)
        np.add.at(edge, last, -1)
        # what these tokens show of it, in characters
        character = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        clipped = np.maximum(begin[first], low), np.minimum(stop[last - 1], high)
        ids.append(tokens)
        ends.append(stop)
        masks.append(np.cumsum(edge[:-1]) > 0)
        spans.append(np.column_stack([character[c] for c in clipped]))
    places = pa.array(np.cumsum([0] + [len(i) for i in ids]), pa.int32())
    flat = np.concatenate(spans) if spans else np.zeros((0, 2))
    structs = pa.StructArray.from_arrays([pa.array(flat[:, i], pa.int32()) for i in (0, 1)], names=["start", "end"])
    arrays = [
        pa.array([r[0] for r in ready], pa.int64()),
        pa.array([r[1] for r in ready], pa.int64()),
        pa.array(texts, pa.string()),
        *[pa.ListArray.from_arrays(places, pa.array(np.concatenate(c), t)) for c, t in ((ids, pa.int32()), (ends, pa.int32()), (masks, pa.bool_()))],
        pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(s) for s in spans]), pa.int32()), structs),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["conv_id", "segment", "formatted", "ids", "token_ends", "loss", "loss_spans"])


def _read(template: Template):
    """Segments in order to one row per conversation."""
    pattern = template.turns()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: object = ()
        rows: list[tuple] = []

        def opened() -> list:
            return [0, hashlib.sha256(), 0, hashlib.sha256(), 0]

        def closed() -> tuple:
            turns, all_text, chars, loss_text, shown = state
            return current, turns, all_text.hexdigest(), chars, loss_text.hexdigest(), shown

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = [c.split()[0] for c in READ_BACK.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        state = opened()
        for batch in batches:
            for key, text, spans in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_spans")]):
                if key != current:
                    if state[0]:
                        rows.append(closed())
                    current, state = key, opened()
                at = 0
                for turn in pattern.finditer(text):
                    if turn.start() != at:
                        raise ValueError(f"conversation {key}: no turn at character {at} of a segment")
                    at = turn.end()
                    state[0] += 1
                    state[1].update(f"{unescaped(turn[1])}\n{unescaped(turn[2])}\n".encode())
                if at != len(text):
                    raise ValueError(f"conversation {key}: no turn at character {at} of a segment")
                for span in spans:
                    learned = unescaped(text[span["start"] : span["end"]])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(text)
            if len(rows) >= 1000:
                yield batch_of(rows)
                rows = []
        if state[0]:
            rows.append(closed())
        if rows:
            yield batch_of(rows)

    return run


def _parts(conversations: DataFrame, hot_bytes: int) -> tuple[DataFrame, DataFrame | None, int]:
    """The rows of ordinary and of hot conversations, and how many partitions
    the bytes make."""
    spark = conversations.sparkSession
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role"), text("text"))
    size = F.sum(F.octet_length("role") + F.octet_length("text") + F.lit(16)).alias("size")
    sizes = rows.groupBy("conv_id").agg(size)
    total = sizes.agg(F.sum("size")).first()[0] or 0
    partitions = max(2 * spark.sparkContext.defaultParallelism, -(-total // PARTITION_BYTES))
    least = max(hot_bytes, total * HOT_SHARE)
    hot = [r["conv_id"] for r in sizes.filter(F.col("size") >= F.lit(least)).collect()] if total >= hot_bytes else []
    if not hot:
        return rows, None, partitions
    is_hot = F.coalesce(F.col("conv_id").isin([k for k in hot if k is not None]), F.lit(None in hot))
    return rows.filter(~is_hot), rows.filter(is_hot), partitions


_ORDER = (F.asc_nulls_first, "conv_id"), (F.asc_nulls_first, "turn"), (F.asc, "role"), (F.asc, "text")


def format_conversations(
    conversations: DataFrame, template: Template = TEMPLATE, path: str | None = None,
    segment_bytes: int = SEGMENT_BYTES, hot_bytes: int = HOT_BYTES,
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of SEGMENTS for (conv_id, turn, role, text): the formatted text, its
    tokens with the byte where each ends, which of them show learned text, and
    the characters they show of it. ``conv_id`` and ``segment`` order a
    conversation's rows. The second table holds the conversations dealt by
    ranges, if any; in the first a conversation's rows follow each other."""
    path = path or default_vocabulary()
    order = [how(name) for how, name in _ORDER]
    ordinary, hot, partitions = _parts(conversations, hot_bytes)
    placed = ordinary.repartition(partitions, "conv_id").sortWithinPartitions(*order)
    whole = _rendered(placed, template).mapInArrow(_segments(path, False, segment_bytes), SEGMENTS)
    if hot is None:
        return whole, None
    dealt = hot.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    return whole, _rendered(dealt, template).mapInArrow(_segments(path, True, segment_bytes), SEGMENTS)


def read_back(whole: DataFrame, ranged: DataFrame | None = None, template: Template = TEMPLATE) -> DataFrame:
    """Rows of READ_BACK: turns and learned text as the formatted text, its
    marks and its loss spans give them again."""
    columns = ("conv_id", "formatted", "loss_spans")
    out = whole.select(*columns).mapInArrow(_read(template), READ_BACK)
    if ranged is None:
        return out
    lined = ranged.select("segment", *columns).repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return out.unionByName(lined.select(*columns).mapInArrow(_read(template), READ_BACK))
