"""Mixing sources to target weights, in fixed-length blocks of words.

The words of a source, its texts in the order of their hashed keys, form one
virtual stream, packed into blocks of ``block_words`` words. A source's target
gives its number of slots. Slots are drawn onto the output shards by one
multinomial per source; slot j of a source takes block permutation(j mod blocks)
of pass j div blocks, where the permutation is a keyed Feistel network over the
block numbers. So within a pass no block is used twice, and as no target exceeds
twice its source, no document gives more than twice its words. Blocks and slots
meet in a join on (source, block).

Stream positions are running sums within (source, piece) plus the totals of the
pieces before, so a source with a third of all rows is summed in PIECES parts.
Only single rows of scalars reach the driver.

Targets: ``share`` of all sizes is split over the sources by weight, 3, 1, 2
repeating in the order of the source names by code point, null last; a target
stops at ``most`` times its source's size and the excess goes to the others by
weight, until none is above.

Defined results: null or empty text has size 0 and gives nothing; a null source
is a source; rows equal in source, id and text share their key, their place in
the stream is then arbitrary among them; an empty table gives no rows; extra
columns are not read by ``plan``."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from priceloom.llm.common import free_name, text_of, written
from priceloom.llm.text import SPACE, joined_bytes, runs, slices

WEIGHTS, SHARE, MOST = (3.0, 1.0, 2.0), 1.5, 2.0
BLOCK_WORDS, SHARD_SLOTS, PIECES, SEED = 64, 4096, 1024, 20
#: Slots that a task fills, and that it returns at once.
TASK_SLOTS, BATCH_SLOTS = 1 << 20, 1 << 15
WORD = r"[^\x20\x09-\x0D]+"


def _sources(sized: DataFrame, share: float, most: float) -> DataFrame:
    """(source, source_number, source_size, target) of every source."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")  # one row per source
    numbered = sums.withColumn("source_number", F.row_number().over(order) - 1)
    weight = F.array(*[F.lit(w) for w in WEIGHTS])[F.col("source_number") % len(WEIGHTS)]
    table = numbered.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    table = written(table.withColumn("level", F.col("cap") / F.col("weight")), "sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, before = None, -1
    while True:
        capped = F.lit(False) if level is None else F.col("level") < level
        now = table.agg(
            F.count_if(capped), F.sum(F.when(capped, F.col("cap"))), F.sum(F.when(~capped, F.col("weight")))
        ).first()
        if now[0] == before or not now[2]:
            break
        before, level = now[0], (total * share - (now[1] or 0.0)) / now[2]
    filled = F.least(F.col("cap"), F.lit(level if level is not None else 0.0) * F.col("weight"))
    return written(table.withColumn("target", filled).drop("cap", "weight", "level"), "targets")


def _permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of range(size): four Feistel rounds over the
    next even power of two, walking on until a value is inside."""
    half = max(1, (int(size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    keys = [np.uint64(int.from_bytes(hashlib.blake2b(f"{key}/{r}".encode(), digest_size=8).digest(), "big") | 1) for r in range(4)]
    while len(todo):
        x = out[todo]
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(33)) & mask)
        x = (left << np.uint64(half)) | right
        out[todo] = x
        todo = todo[x >= size]
    return out.astype(np.int64)


def _draws(seed: int, shards: int):
    """One multinomial over the shards per source: where its slots begin."""

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                rng = np.random.default_rng([seed, int(row.source_number)])
                if row.slots < shards:
                    shard, count = np.unique(rng.integers(0, shards, row.slots), return_counts=True)
                else:
                    count = rng.multinomial(row.slots, np.full(shards, 1 / shards))
                    shard = np.flatnonzero(count)
                    count = count[shard]
                yield pd.DataFrame(
                    {
                        "source_number": row.source_number,
                        "blocks": row.blocks,
                        "shard": shard,
                        "first_slot": np.cumsum(count) - count,
                        "count": count,
                    }
                )

    return draw


def _slots(seed: int):
    def expand(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made, size = [], 0
        for frame in frames:
            for row in frame.itertuples():
                slot = row.first_slot + np.arange(row.count_)
                passes, index = slot // row.blocks, slot % row.blocks
                block = np.empty_like(index)
                for p in np.unique(passes):
                    here = passes == p
                    block[here] = _permuted(index[here], row.blocks, hash((seed, int(row.source_number), int(p))))
                made.append(pd.DataFrame({"source_number": row.source_number, "shard": row.shard, "slot": slot, "pass": passes, "block": block}))
                size += len(slot)
                if size >= BATCH_SLOTS:
                    yield pd.concat(made)
                    made, size = [], 0
        if made:
            yield pd.concat(made)

    return expand


def plan(
    sized: DataFrame, block_words: int = BLOCK_WORDS, share: float = SHARE, most: float = MOST, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """For rows (row_key, doc_id, source, size): the placed rows with
    source_size, target and begin, their place in the source's stream; and the
    filled slots (source_number, shard, slot, pass, block)."""
    spark = sized.sparkSession
    sized = written(sized, "sized")
    sources = _sources(sized, share, most)
    piece = F.pmod("row_key", F.lit(PIECES))
    numbers = sources.select(F.col("source").alias("s"), "source_number", "source_size", "target")
    rows = sized.join(numbers, F.col("source").eqNullSafe(F.col("s"))).drop("s", "source").withColumn("piece", piece)
    line = Window.partitionBy("source_number", "piece").orderBy("row_key").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum("size").over(line))
    pieces = sized.groupBy("source", piece.alias("piece")).agg(F.sum("size").alias("words"))
    pieces = pieces.join(numbers, F.col("source").eqNullSafe(F.col("s"))).select("source_number", "piece", "words")
    before = Window.partitionBy("source_number").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.withColumn("offset", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")
    placed = rows.join(starts, ["source_number", "piece"])
    placed = placed.withColumn("begin", F.col("offset") + F.col("end") - F.col("size")).drop("piece", "offset", "end")
    placed = written(placed, "placed")

    blocks = F.ceil(F.col("source_size") / block_words)
    wanted = F.round(F.col("target") / F.col("source_size") * blocks).cast("long")
    counts = sources.filter("source_size > 0").select(
        "source_number", blocks.alias("blocks"), F.least(wanted, blocks * int(most)).alias("slots")
    )
    counts = counts.filter("slots > 0")
    total = counts.agg(F.sum("slots")).first()[0] or 0
    shards = max(1, -(-total // SHARD_SLOTS))
    drawn = counts.mapInPandas(
        _draws(seed, shards), "source_number long, blocks long, shard long, first_slot long, count long"
    )
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-total // TASK_SLOTS))
    drawn = drawn.withColumnRenamed("count", "count_").repartition(tasks, "source_number", "shard")
    filled = drawn.mapInPandas(_slots(seed), "source_number long, shard long, slot long, pass long, block long")
    return placed, written(filled, "slots")


def _used(placed: DataFrame, filled: DataFrame, block_words: int) -> DataFrame:
    """(source_number, begin, block, pass) for every block of a row in a slot."""
    last = F.floor((F.col("begin") + F.col("size") - 1) / block_words)
    spans = placed.filter("size > 0").select(
        "source_number", "row_key", "begin", "size",
        F.explode(F.sequence(F.floor(F.col("begin") / block_words), last)).alias("block"),
    )
    return spans.join(filled.select("source_number", "block", "pass"), ["source_number", "block"])


def _overlap(block_words: int):
    block_end = (F.col("block") + 1) * block_words
    return F.least(F.col("begin") + F.col("size"), block_end) - F.greatest("begin", block_end - block_words)


def sizes(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64("doc_id", F.xxhash64(text_of())).alias("row_key"),
    )


def mix_counts(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row."""
    placed, filled = plan(sizes(docs), block_words)
    used = _used(placed, filled, block_words).groupBy("source_number", "begin").agg(F.sum(_overlap(block_words)).alias("taken"))
    some = placed.filter("size > 0").join(used, ["source_number", "begin"], "left")
    none = placed.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    both = some.select(*columns).unionByName(none.select(*columns))
    return both.withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))


def mix_texts(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mixed rows, with the columns of docs: for each pass one row of each
    document that gave words in it. A document that gave all of them keeps its
    text as it is; otherwise the text holds the taken words, runs of them as
    they stand and one line feed between runs. Rows equal in id, source and text
    take what the first of them takes. Rows without words are not in a mix."""
    key, text, takes = (free_name(docs, n) for n in ("row_key", "whole_text", "takes"))
    placed, filled = plan(sizes(docs), block_words)
    used = _used(placed, filled, block_words)
    low = F.greatest("begin", F.col("block") * block_words) - F.col("begin")
    runs_of = used.select("row_key", "source_number", "begin", F.struct("pass", low.alias("low"), (low + _overlap(block_words)).alias("high")).alias("take"))
    by_row = runs_of.groupBy("row_key", "source_number", "begin").agg(F.sort_array(F.collect_list("take")).alias("takes"))
    one = by_row.groupBy("row_key").agg(F.min_by("takes", "begin").alias(takes)).withColumnRenamed("row_key", key)
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64(text_of())))
    joined = keyed.join(one, key).drop(key).withColumn(text, text_of())
    schema = docs.schema
    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            data, offsets = joined_bytes(part.column(text))
            starts, ends, first = runs(~SPACE[data], offsets)
            taken = part.column(takes).to_pylist()
            rows, texts = [], []
            for i, spans in enumerate(taken):
                words = int(first[i + 1] - first[i])
                for number in sorted({s["pass"] for s in spans}):
                    merged: list[list[int]] = []
                    for s in spans:
                        if s["pass"] != number:
                            continue
                        if merged and merged[-1][1] == s["low"]:
                            merged[-1][1] = s["high"]
                        else:
                            merged.append([s["low"], s["high"]])
                    rows.append(i)
                    if merged == [[0, words]]:
                        texts.append(data[offsets[i] : offsets[i + 1]].tobytes().decode())
                    else:
                        texts.append(b"\n".join(data[starts[first[i] + a] : ends[first[i] + b - 1]].tobytes() for a, b in merged).decode())
            chosen = part.take(pa.array(rows, pa.int64()))
            arrays = []
            for name in names:
                if name == "text":
                    arrays.append(pa.array(texts, chosen.schema.field("text").type))
                elif name == "n_chars":
                    arrays.append(pa.array([len(t) for t in texts], chosen.schema.field(name).type))
                else:
                    arrays.append(chosen.column(name))
            yield pa.RecordBatch.from_arrays(arrays, names)

    return joined.mapInArrow(cut, schema)
