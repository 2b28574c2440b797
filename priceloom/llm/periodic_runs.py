"""Periodic runs of words by an online sparse diagonal program.

A diagonal is a lag: words i and i - lag lie on it. Going through a text, each
word's earlier occurrences raise the match lengths of their lags; a lag that is
not raised at the next word ends, and its run is emitted if it is long enough.

Taken word by word the lags are as many as a word has earlier occurrences, which
is quadratic in a text that repeats itself. The occurrences are therefore those
of blocks that begin at a word: 16 words for lags up to 16, 32 for those up to
32, and so on, and only the nearest earlier one counts. A run of smallest period
q has at least max(24, 3q) words, so every block of its level fits into it, and
the nearest earlier occurrence of a block of at least q words inside a run is
exactly q words before. So one lag is active at a time on each level, it lasts
exactly as long as the run, and it is the run's smallest period. A level looks
only at words whose block of the level before occurs twice in the text, so in
ordinary prose nothing is left after the first. Time is n log n in the words of
a text, memory linear in the longest text.

Words are runs of bytes other than space and \\x09-\\x0D and are compared by
64-bit hashes, as are blocks.

Defined results: a null or empty text, or one without words, has no runs and
collapses to an empty text; equal rows give equal results, each its own; an
empty table gives no rows; columns of the table that are named like an added
one are replaced, all others kept."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from priceloom.llm.common import text_of
from priceloom.llm.text import hash_runs, joined_bytes, mix, slices, words

#: A run has at least this many words, and this many times its period.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Words of a block on the first level: the longest block that every run of a
#: period up to its length holds, and its earlier occurrence with it.
FIRST_BLOCK = 16
WORD = r"[^\x20\x09-\x0D]+"
_LEFT, _RIGHT, _TEXT = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))

RUN = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])
ADDED = ("n_words", "runs", "collapsed")


def _blocks(hashes: np.ndarray, left: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the blocks twice as long that begin at ``left``."""
    return mix(hashes[left] * _LEFT + hashes[left + size] * _RIGHT)


def find_runs(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, by text, start, period.
    ``hashes`` are the words of all texts, ``first`` the place of each text's
    first word, with the number of words at the end."""
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    stop = np.repeat(first[1:], counts)
    hashes = mix(hashes + (text.astype(np.uint64) + np.uint64(1)) * _TEXT)
    size, at = 1, np.arange(len(hashes))
    while size < FIRST_BLOCK:
        at = at[at + 2 * size <= stop[at]]
        longer = _blocks(hashes, at, size)
        hashes[at] = longer
        size *= 2
    found, shortest = [], 0
    while len(at):
        here = hashes[at]
        order = np.argsort(here, kind="stable")
        equal = here[order[1:]] == here[order[:-1]]
        words_, before = at[order[1:][equal]], at[order[:-1][equal]]
        found.append(_ended(words_, words_ - before, shortest, size))
        # only blocks that occur twice can begin a longer one that does
        alive = np.zeros(len(hashes), dtype=bool)
        alive[words_] = alive[before] = True
        at = np.flatnonzero(alive)
        at = at[at + 2 * size <= stop[at]]
        at = at[alive[at + size]]
        hashes[at] = _blocks(hashes, at, size)
        shortest, size = size, 2 * size
    runs = np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)
    owner = text[runs[:, 0]] if len(runs) else np.zeros(0, dtype=np.int64)
    runs = np.column_stack([owner, runs])
    runs[:, 1] -= first[runs[:, 0]]
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def _ended(at: np.ndarray, lag: np.ndarray, shortest: int, size: int) -> np.ndarray:
    """(start, length, period) of the diagonals of one level that grew long
    enough, given the words and lags that raise them."""
    own = (lag > shortest) & (lag <= size)
    at, lag = at[own], lag[own]
    order = np.argsort(at, kind="stable")
    at, lag = at[order], lag[order]
    ends = np.flatnonzero(np.append((np.diff(at) != 1) | (np.diff(lag) != 0), True)) if len(at) else np.zeros(0, dtype=np.int64)
    begins = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)[: len(ends)]
    period = lag[begins]
    matched = at[ends] - at[begins] + size
    length = matched + period
    long_enough = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    return np.column_stack([at[begins] - period, length, period])[long_enough]


def _collapsed(data, starts, ends, first, runs) -> tuple[np.ndarray, np.ndarray]:
    """The kept words of all texts, a space between those of one text: bytes,
    and where each text starts. A run's words after its first period go."""
    edge = np.zeros(len(starts) + 1, dtype=np.int64)
    if len(runs):
        begin = first[runs[:, 0]] + runs[:, 1]
        np.add.at(edge, begin + runs[:, 3], 1)
        np.add.at(edge, begin + runs[:, 2], -1)
    kept = np.cumsum(edge[:-1]) == 0
    number = np.concatenate([[0], np.cumsum(kept)])[first]
    starts, ends = starts[kept], ends[kept]
    last = np.zeros(len(starts), dtype=bool)
    last[number[1:][np.diff(number) > 0] - 1] = True  # no space after a text's last word
    sizes = ends - starts + ~last
    out_ends = np.concatenate([[0], np.cumsum(sizes)])
    total = int(out_ends[-1])
    place = np.arange(total) + np.repeat(starts - out_ends[:-1], sizes)
    out = np.append(data, np.uint8(32))[np.minimum(place, len(data))]
    out[(out_ends[1:] - 1)[~last]] = 32
    return out, out_ends[number]


def _arrays(part: pa.RecordBatch, column: str) -> list[pa.Array]:
    data, offsets = joined_bytes(part.column(column))
    starts, ends, first = words(data, offsets)
    runs = find_runs(hash_runs(data, starts, ends), first)
    held = np.searchsorted(runs[:, 0], np.arange(len(first)))
    structs = pa.StructArray.from_arrays(
        [pa.array(runs[:, i], pa.int64()) for i in (1, 2, 3)], fields=[pa.field(f.name, pa.int64()) for f in RUN.fields]
    )
    text, text_ends = _collapsed(data, starts, ends, first, runs)
    buffers = [None, pa.py_buffer(text_ends.astype(np.int32).tobytes()), pa.py_buffer(text.tobytes())]
    return [
        pa.array(np.diff(first), pa.int64()),
        pa.ListArray.from_arrays(pa.array(held, pa.int32()), structs),
        pa.StringArray.from_buffers(len(first) - 1, buffers[1], buffers[2]),
    ]


def with_runs(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Adds ``n_words``, ``runs`` (array of start, length, period, by start and
    period) and ``collapsed``, the text without the repetitions: the words that
    no run holds after its first period, joined by one space. No row moves."""
    names = [c for c in docs.columns if c not in ADDED]
    fields = [docs.schema[c] for c in names]
    types = (LongType(), ArrayType(RUN), StringType())
    schema = StructType([*fields, *[StructField(c, t) for c, t in zip(ADDED, types)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_column):
            yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + _arrays(part, text_column), [*names, *ADDED])

    return docs.select(*names).mapInArrow(run, schema)


def strongest(runs: Column) -> Column:
    """The run with the greatest length/period, compared without rounding; the
    first of equal ones; null without runs."""
    first = F.lit(None).cast(RUN)
    return F.aggregate(
        runs,
        first,
        lambda best, x: F.when(best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best),
    )


def digests(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """doc_id, n_runs, the strongest run and digests of runs and collapsed text."""
    found = with_runs(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(text_column).alias("text")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    best = found.withColumn("best", strongest(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("div(1000 * best.length, best.period)").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth text by crc32 of the id is made
    periodic from some word on, a function of the id. A null id leaves its text."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")

    def periodic(words_: Column) -> Column:
        n = F.size(words_).cast("long")
        a = F.pmod(g, n)
        p = F.lit(1) + F.floor((n - a) / (g % 8 + 3)).cast("long")
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        filled = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words_, place(i).cast("int")))
        return F.when(n > 0, F.array_join(filled, " ")).otherwise("")

    text = text_of()
    made = F.transform(F.array(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), periodic)[0]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(h % 10 == 0, made).otherwise(text).alias("text"))
