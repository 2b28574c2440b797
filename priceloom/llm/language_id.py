"""Language identification with a byte convolutional network in numpy.

The network reads fixed-length windows of bytes: filters of several widths over
one-hot bytes, rectified, the maximum over all positions, and a softmax over
the languages. A filter over one-hot bytes is a sum of table rows, one table per
offset, so a window is scored by lookups. It is trained here, with Adam, on
windows of labelled texts. Every text is cut into windows that overlap by the
widest filter less one, so each n-gram of the whole text is seen, and window
probabilities are averaged by their bytes.

Training takes at most about ``per_language`` texts of each language, and
MOST_TEXTS in all, chosen by a hash of the text, and WINDOWS_PER_TEXT windows of
each. Any number of tags is taken; of more than MOST_LANGUAGES the most frequent
are learned, so that the network and its sample have a bound. Only text and
language of learnable rows are used.

A text is rejected if the network cannot tell the language of its parts: what
counts is the mean over its windows of the best probability, by how far it is
above chance. A text in several languages, each of which is told, stays.

Defined results: null text and text without a letter give ``und`` with score 0;
without any learnable row every text gives ``und``, and none with a letter is
rejected; repeated rows are predicted each; a null id is neither held out nor
learned from; extra columns are not read."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceloom.llm.common import free_name, held_out, learnable, text_of
from priceloom.llm.text import LOWER, joined_bytes, slices

WIDTHS, FILTERS, WINDOW = (2, 3, 4), 16, 256
STRIDE = WINDOW - max(WIDTHS) + 1
PER_LANGUAGE, WINDOWS_PER_TEXT, MOST_LANGUAGES, MOST_TEXTS = 1200, 2, 2000, 100_000
#: Least distance from chance to certainty that a text's parts have to cover.
MARGIN = 0.15
#: Probabilities held at once.
HELD = 4_000_000
EPOCHS, LEAST_STEPS, BATCH, RATE = 4, 250, 64, 0.01
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


@dataclass
class Network:
    languages: list[str]
    tables: list[np.ndarray]  # per width: (width, 256, FILTERS)
    weights: np.ndarray  # (len(WIDTHS) * FILTERS, languages)
    bias: np.ndarray

    def pooled(self, windows: np.ndarray, where: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
        """The largest value of each filter in each window; on request also the
        positions. Byte 0 pads and has zero rows."""
        best, places = [], []
        for table, width in zip(self.tables, WIDTHS):
            n = windows.shape[1] - width + 1
            z = table[0][windows[:, :n]]
            for k in range(1, width):
                z += table[k][windows[:, k : n + k]]
            if where:
                at = z.argmax(axis=1)
                places.append(at)
                best.append(np.take_along_axis(z, at[:, None, :], axis=1)[:, 0])
            else:
                best.append(z.max(axis=1))
        return np.concatenate(best, axis=1), places

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.languages)), dtype=np.float64)
        for i in range(0, len(windows), 32):
            hidden = np.maximum(self.pooled(windows[i : i + 32])[0], 0)
            out[i : i + 32] = _softmax(hidden @ self.weights + self.bias)
        return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all texts, padded with zeros; the text and the bytes of each."""
    sizes = np.diff(offsets)
    counts = np.where(sizes > 0, -(-np.maximum(sizes - (WINDOW - STRIDE), 1) // STRIDE), 0)
    owner = np.repeat(np.arange(len(sizes)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    begins = offsets[:-1][owner] + within * STRIDE
    left = np.minimum(offsets[1:][owner] - begins, WINDOW)
    padded = np.concatenate([data, np.zeros(WINDOW, dtype=np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[begins]
    windows = np.where(np.arange(WINDOW)[None, :] < left[:, None], windows, 0)
    return windows, owner, left


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7) -> Network:
    rng = np.random.default_rng(seed)
    tables = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
    weights = rng.normal(0, 0.2, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32)
    net = Network(languages, tables, weights, np.zeros(len(languages), dtype=np.float32))
    params = [*net.tables, net.weights, net.bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    steps = 0
    epochs = max(EPOCHS, -(-LEAST_STEPS // max(1, -(-len(windows) // BATCH))))
    for _ in range(epochs if len(windows) else 0):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            x, y = windows[pick], labels[pick]
            raw, places = net.pooled(x, where=True)
            hidden = np.maximum(raw, 0)
            delta = _softmax(hidden @ net.weights + net.bias)
            delta[np.arange(len(y)), y] -= 1
            delta = (delta / len(y)).astype(np.float32)
            back = (delta @ net.weights.T) * (raw > 0)
            grads = [np.zeros_like(t) for t in net.tables]
            column = np.broadcast_to(np.arange(FILTERS), places[0].shape)
            for i, (place, width) in enumerate(zip(places, WIDTHS)):
                part = back[:, i * FILTERS : (i + 1) * FILTERS]
                for k in range(width):
                    np.add.at(grads[i][k], (np.take_along_axis(x, place + k, axis=1), column), part)
            grads += [hidden.T @ delta, delta.sum(axis=0)]
            steps += 1
            for p, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.99**steps)) + 1e-8)
            for t in net.tables:
                t[:, 0] = 0
    return net


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Network | None:
    """Trains on a bounded sample; None if nothing can be learned from."""
    rows = docs.select(F.col("doc_id"), text_of().alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(learnable() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).drop("doc_id")
    most = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    counts = {r.lang: r["count"] for r in most.collect()}
    if not counts:
        return None
    languages = sorted(counts)
    texts = min(per_language, max(1, MOST_TEXTS // len(languages)))
    shares = [(lang, min(1.0, texts / counts[lang])) for lang in languages]
    share = docs.sparkSession.createDataFrame(shares, "lang string, share double")
    draw = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1_000_003)) / 1_000_003
    sampled = rows.join(F.broadcast(share), "lang").filter(draw < F.col("share"))
    texts = [
        F.substring("text", (1 + F.pmod(F.xxhash64("text", F.lit(k)), F.char_length("text"))).cast("int"), F.lit(WINDOW))
        if k
        else F.substring("text", 1, WINDOW)
        for k in range(WINDOWS_PER_TEXT)
    ]
    pieces = sampled.select("lang", F.explode(F.array(*texts)).alias("piece")).filter(F.octet_length("piece") >= 4)
    # the sample's order decides the batches, so it is fixed
    found = pieces.toArrow().sort_by([("piece", "ascending"), ("lang", "ascending")])
    data, offsets = joined_bytes(found.column("piece"))
    windows, owner, left = cut_windows(LOWER[data], offsets)
    kept = (np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, dtype=bool)) & (left >= 4)
    number = {lang: i for i, lang in enumerate(languages)}
    labels = np.array([number[x] for x in found.column("lang").to_pylist()], dtype=np.int64)
    return train(windows[kept], labels[owner[kept]], languages)


def _judged(model: Network, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text the best language, its probability, and the mean of its
    windows' best ones, windows weighing by their bytes."""
    data, offsets = joined_bytes(column)
    windows, owner, left = cut_windows(LOWER[data], offsets)
    total, sure = np.zeros((len(column), len(model.languages))), np.zeros(len(column))
    step = max(1, HELD // len(model.languages))
    for at in range(0, len(windows), step):
        found = model.probabilities(windows[at : at + step]) * left[at : at + step, None]
        np.add.at(total, owner[at : at + step], found)
        np.add.at(sure, owner[at : at + step], found.max(axis=1))
    weight = np.maximum(total.sum(axis=1), 1e-300)
    return total.argmax(axis=1), total.max(axis=1) / weight, sure / weight


def predict(
    docs: DataFrame, net: Network | None, language: str = "lang_pred", score: str = "lang_score", sure: str | None = None
) -> DataFrame:
    """Adds the predicted language and its probability to all columns, and as
    ``sure`` how well the text's parts are told, if it is named."""
    held = docs.sparkSession.sparkContext.broadcast(net)
    added = [language, score, *([sure] if sure else [])]
    names = [c for c in docs.columns if c not in added]
    # a string text passes once, its nulls read as empty in the worker; any
    # other type goes as its text beside it
    direct = "text" in names and dict(docs.select(*names).dtypes)["text"] == "string"
    text = "text" if direct else free_name(docs, "whole_text")
    schema = docs.select(*names).schema.add(language, "string").add(score, "double")
    if sure:
        schema = schema.add(sure, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        rows = HELD if model is None else max(1, HELD // len(model.languages))
        for slice_ in slices(batches, text):
            for at in range(0, slice_.num_rows, rows):
                part = slice_.slice(at, rows)
                column = pc.fill_null(part.column(text), "")
                letters = [bool(t) and LETTER.search(t) is not None for t in column.to_pylist()]
                found, scores, told = [UNKNOWN] * part.num_rows, [0.0] * part.num_rows, [0.0] * part.num_rows
                if model is not None:
                    best, *shares = [x.tolist() for x in _judged(model, column)]
                    found = [model.languages[i] if ok else UNKNOWN for i, ok in zip(best, letters)]
                    scores, told = ([min(s, 1.0) if ok else 0.0 for s, ok in zip(x, letters)] for x in shares)
                arrays = [part.column(n) for n in names] + [pa.array(found, pa.string()), pa.array(scores, pa.float64())]
                arrays += [pa.array(told, pa.float64())] if sure else []
                yield pa.RecordBatch.from_arrays(arrays, [*names, *added])

    sent = docs.select(*names) if direct else docs.select(*names, text_of().alias(text))
    return sent.mapInArrow(run, schema)


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    net = fit(docs, per_language)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return predict(rows, net, score="score").select("doc_id", "held_out", "lang_pred", "score")


def keep_known(docs: DataFrame, margin: float = MARGIN, per_language: int = PER_LANGUAGE) -> DataFrame:
    """The rows whose parts are in known languages: how well they are told is at
    least ``margin`` of the way from chance to certainty. If nothing was learned,
    the rows with a letter."""
    net = fit(docs, per_language)
    if net is None:
        return docs.filter(text_of().rlike(r"\p{L}"))
    language, score, sure = (free_name(docs, n) for n in ("lang_pred", "lang_score", "lang_sure"))
    found = predict(docs, net, language, score, sure)
    chance = 1 / len(net.languages)
    least = chance + margin * (1 - chance)
    return found.filter((F.col(language) != UNKNOWN) & (F.col(sure) >= least - 1e-9)).drop(language, score, sure)
