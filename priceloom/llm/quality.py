"""Quality classifier: hashed word n-grams, logistic regression, FTRL-proximal.

Tokens are runs of letters and digits (any byte from 128 on counts as a letter)
and runs of other visible characters, lower-cased in A-Z. Features are hashed
token unigrams and bigrams, and bigrams of one token repeated next to itself or
next but one, which share two features of their own. A text's features are
counts divided by the number of n-grams. Training follows the regularised leader
per coordinate; a score is the sparse dot product of the whole text's features
with the weights, through the logistic function.

Training uses at most about ``sample`` labelled rows, drawn by a hash of the id
among the learnable ones; the bound is a parameter. Labels, language, source
and id are never features.

Defined results: null and empty texts have no features and score by the bias;
null labels are not learned from; an id labelled more than once gives an example
for each label; without any example every score is 0.5; a null id is not held
out; repeated rows are scored each; extra columns are not read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceloom.llm.common import held_out, learnable, text_of
from priceloom.llm.text import LOWER, SPACE, hash_runs, joined_bytes, mix, slices

BITS, SAMPLE, EPOCHS = 18, 6000, 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.0005, 0.01
SCALE = 8.0
LEAST_SCORE = 0.3
NEXT, NEXT_BUT_ONE = 1, 2  # the features of repeated tokens
KIND = np.full(256, 2, dtype=np.uint8)
KIND[48:58] = KIND[65:91] = KIND[97:123] = KIND[128:] = 1
KIND[SPACE] = 0


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes, and for each text the number of its first token."""
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
    data = LOWER[data]
    kind = KIND[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    edge[1:-1] |= kind[1:] != kind[:-1]
    edge[[0, -1]] = True
    cuts = np.flatnonzero(edge)
    seen = kind[cuts[:-1]] > 0
    starts, ends = cuts[:-1][seen], cuts[1:][seen]
    return hash_runs(data, starts, ends), np.searchsorted(starts, offsets)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all n-grams of each text, text by text, and where
    each text's begin. Every token gives four places: itself, the bigram with
    the token before, and the two marks of repetition (0: none)."""
    hashes, first = tokens(data, offsets)
    size = (1 << BITS) - 3
    place = lambda h: (h % np.uint64(size)).astype(np.int64) + 3
    out = np.zeros((len(hashes), 4), dtype=np.int64)
    out[:, 0] = place(hashes)
    index = np.arange(len(hashes)) - np.repeat(first[:-1], np.diff(first))
    one, two = index >= 1, index >= 2
    before = np.roll(hashes, 1)
    out[one, 1] = place(mix(before[one] * np.uint64(0x9E3779B97F4A7C15) + hashes[one]))
    out[:, 2] = np.where(one & (before == hashes), NEXT, 0)
    out[:, 3] = np.where(two & (np.roll(hashes, 2) == hashes), NEXT_BUT_ONE, 0)
    return out, first


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        found, first = features(*joined_bytes(part.column("text")))
        places, values = [], []
        for i in range(part.num_rows):
            own = found[first[i] : first[i + 1]].ravel()
            own, times = np.unique(own[own > 0], return_counts=True)
            places.append(own)
            values.append(times * (SCALE / max(1, first[i + 1] - first[i])))
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                part.column("quality"),
                pa.array([p.astype(np.int32) for p in places], pa.list_(pa.int32())),
                pa.array([v.astype(np.float32) for v in values], pa.list_(pa.float32())),
            ],
            ["doc_id", "quality", "places", "counts"],
        )


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 3) -> np.ndarray:
    """Weights after EPOCHS passes; place 0 is the bias."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(at: np.ndarray | slice) -> np.ndarray:
        drawn = np.sign(z[at]) * L1 - z[at]
        return np.where(np.abs(z[at]) <= L1, 0.0, drawn / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(examples)).tolist():
            at, x, y = examples[i]
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    return weights(slice(None))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    named = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    named = named.filter(learnable() & F.col("quality").isNotNull())
    share = sample / max(1, named.count())
    draw = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1_000_003)) / 1_000_003
    # at most about ``sample`` rows by the draw, a few more by chance
    chosen = F.broadcast(named.filter(draw < share))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = texts.join(chosen, "doc_id").select("doc_id", "quality", "text")
    found = rows.mapInArrow(_examples, "doc_id long, quality int, places array<int>, counts array<float>").toArrow()
    found = found.sort_by([("doc_id", "ascending"), ("quality", "ascending")])
    examples = []
    for label, places, counts in zip(*(found.column(c) for c in ("quality", "places", "counts"))):
        at = np.concatenate([[0], places.values.to_numpy().astype(np.int64)])
        x = np.concatenate([[1.0], counts.values.to_numpy().astype(np.float64)])
        examples.append((at, x, int(label.as_py() > 0)))
    return ftrl(examples)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    held = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = held.value.copy()
        bias, w[0] = w[0], 0.0
        for part in slices(batches, "text"):
            found, first = features(*joined_bytes(part.column("text")))
            sums = np.concatenate([[0.0], np.cumsum(w[found].sum(axis=1))])
            sizes = np.maximum(np.diff(first), 1)
            logit = bias + SCALE * (sums[first[1:]] - sums[first[:-1]]) / sizes
            scores = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(scores), pa.array((scores >= LEAST_SCORE).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
