"""Byte-pair encoding by speculation and verification, and decoding.

For each distinct word a greedy longest match over the vocabulary proposes
tokens. The proposal is the exact encoding if every token encodes to itself and
every two neighbours, joined, encode to just these two; those verdicts are kept
as sorted arrays and looked up for all words at once, and a verdict that is
not known yet is made once by exact merging. Only words with a failing
neighbour pair are merged exactly from bytes, many side by side.

Words come from the byte-level pattern; strings of added tokens are cut out
first, as the vocabulary file says. Tokens of a word are remembered per Python
worker up to MEMO_WORDS words, and those of pieces up to twice MEMO_PIECES, so memory is bounded. Texts are handled whole.

Defined results: a null or empty text has no tokens; repeated rows are encoded
each; extra columns are not read, unless the caller keeps them."""

from __future__ import annotations

import gc
import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from priceloom.llm.common import text_of
from priceloom.llm.text import slices

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO_WORDS, MEMO_PIECES = 250_000, 200_000
#: The same where ids are returned and a worker may share its executor's memory
#: with the stages before.
SMALL_MEMO = 120_000, 80_000
NO_RANK, ALONE = 1 << 40, 0xFFFFFFFF
SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: White space counts alike for this expression and the pattern above, unless a
#: text has one of the separators that only one of them takes for white space.
SAFE_PIECES = re.compile(r" ?\S+|\s+(?!\S)|\s+")
CONTROLS = re.compile("[\x1c-\x1f\x85\u180e\u200b]")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_characters() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class SlotMap:
    """Looks up many integer keys at once: open addressing in flat arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = int(len(keys) * 2).bit_length()
        self.keys, self.values = np.full(1 << self.bits, -1, dtype=np.int64), np.zeros(1 << self.bits, dtype=np.int64)
        slot, rest = self._slots(keys), np.arange(len(keys))
        while len(rest):
            first = np.zeros(len(rest), dtype=bool)
            first[np.unique(slot, return_index=True)[1]] = True
            first &= self.keys[slot] == -1
            self.keys[slot[first]], self.values[slot[first]] = keys[rest[first]], values[rest[first]]
            rest, slot = rest[~first], self._next(slot[~first])

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _next(self, slot: np.ndarray) -> np.ndarray:
        return (slot + 1) & ((1 << self.bits) - 1)

    def get(self, keys: np.ndarray, missing: int) -> np.ndarray:
        slot = self._slots(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], missing)
        rest = np.flatnonzero((there != keys) & (there != -1))
        slot = self._next(slot[rest])
        while len(rest):
            there = self.keys[slot]
            hit = there == keys[rest]
            out[rest[hit]] = self.values[slot[hit]]
            more = ~hit & (there != -1)
            rest, slot = rest[more], self._next(slot[more])
        return out


class Bpe:
    """One vocabulary, loaded once per Python worker."""

    def __init__(self, path: str, memo: tuple[int, int] | None = None):
        self.most_words, self.most_pieces = memo or (MEMO_WORDS, MEMO_PIECES)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        stand_in = _byte_characters()
        as_bytes = lambda token: bytes(stand_in[c] for c in token)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes: dict[int, bytes] = {}
        self.id_of: dict[bytes, int] = {}
        for token, number in spec["model"]["vocab"].items():
            if token in self.added:
                continue
            self.bytes[number] = as_bytes(token)
            self.id_of[self.bytes[number]] = number
        for content, number in self.added.items():
            self.bytes[number] = content.encode()
        pairs = []
        for merge in spec["model"]["merges"]:
            left, right = (as_bytes(p) for p in (merge.split(" ") if isinstance(merge, str) else merge))
            pairs.append(((self.id_of[left] << 32) | self.id_of[right], self.id_of[left + right]))
        self.merge_id = np.array([p[1] for p in pairs], dtype=np.int64)
        self.rank = SlotMap(np.array([p[0] for p in pairs], dtype=np.int64), np.arange(len(pairs)))
        self._grow_trie()
        self.byte_id = np.array([self.id_of[bytes([b])] for b in range(256)], dtype=np.int64)
        self.names = {i: str(i) for i in self.bytes}
        self.words = regex.compile(PATTERN)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.memo: dict[str, tuple[tuple[int, ...], str, bytes, bytes]] = {}
        self.older: dict[str, tuple[tuple[int, ...], str, bytes]] = {}
        self.pieces: dict[str, tuple[tuple[int, ...], str, bytes]] = {}
        self.known = np.zeros(0, dtype=np.int64)
        self.verdict = np.zeros(0, dtype=bool)

    def _grow_trie(self) -> None:
        """Steps of the vocabulary's prefix tree, node * 256 + byte -> node."""
        nodes: dict[bytes, int] = {b"": 0}
        steps, accepted = [], [-1]
        for token, number in self.id_of.items():
            node = 0
            for i in range(len(token)):
                below = nodes.get(token[: i + 1])
                if below is None:
                    below = nodes[token[: i + 1]] = len(accepted)
                    accepted.append(-1)
                    steps.append((node << 8 | token[i], below))
                node = below
            accepted[node] = number
        self.steps = SlotMap(*np.array(steps, dtype=np.int64).T)
        self.accepted = np.array(accepted, dtype=np.int64)

    def merged(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Exact merging of many words side by side. In each round every word
        that still has a known pair merges its lowest ranked one, leftmost on
        ties; words without one leave the round."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        ids = self.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(words)), sizes)
        out: list[tuple[int, ...]] = [()] * len(words)

        def ranks(left: np.ndarray) -> np.ndarray:
            got = np.full(len(left), NO_RANK, dtype=np.int64)
            right = left + 1
            here = right < len(ids)
            here[here] = owner[left[here]] == owner[right[here]]
            at = left[here]
            got[here] = self.rank.get((ids[at] << 32) | ids[at + 1], NO_RANK)
            return got

        rank = ranks(np.arange(len(ids)))
        while len(ids):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            lowest = np.minimum.reduceat(rank, starts)
            done = lowest == NO_RANK
            lengths = np.diff(np.append(starts, len(ids)))
            if done.any():
                finished = np.repeat(done, lengths)
                flat, place = ids[finished].tolist(), 0
                for word, n in zip(owner[starts[done]].tolist(), lengths[done].tolist()):
                    out[word] = tuple(flat[place : place + n])
                    place += n
                ids, owner, rank = ids[~finished], owner[~finished], rank[~finished]
                if not len(ids):
                    break
                lengths, lowest = lengths[~done], lowest[~done]
            at = np.flatnonzero(rank == np.repeat(lowest, lengths))
            at = at[np.concatenate([[True], owner[at][1:] != owner[at][:-1]])]
            ids[at] = self.merge_id[rank[at]]
            keep = np.ones(len(ids), dtype=bool)
            keep[at + 1] = False
            moved = at - np.arange(len(at))
            ids, owner, rank = ids[keep], owner[keep], rank[keep]
            rank[moved] = ranks(moved)
            before = moved[moved > 0] - 1
            before = before[owner[before] == owner[before + 1]]
            rank[before] = ranks(before)
        return out

    def greedy(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Longest-match tokens of all words, in one array, and the word of each."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        data = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        ends = np.cumsum(sizes)
        stop = np.repeat(ends, sizes)
        length, token = np.ones(len(data), dtype=np.int64), self.byte_id[data]
        node, at, depth = np.zeros(len(data), dtype=np.int64), np.arange(len(data)), 0
        while len(at):
            inside = at + depth < stop[at]
            at, node = at[inside], node[inside]
            node = self.steps.get((node << 8) | data[at + depth], -1)
            at, node, depth = at[node >= 0], node[node >= 0], depth + 1
            found = self.accepted[node]
            hit = found >= 0
            length[at[hit]], token[at[hit]] = depth, found[hit]
        at, word = ends - sizes, np.arange(len(words))
        at, word = at[sizes > 0], word[sizes > 0]
        tokens, owners = [token[:0]], [word[:0]]
        while len(at):
            tokens.append(token[at])
            owners.append(word)
            at = at + length[at]
            more = at < ends[word]
            at, word = at[more], word[more]
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(tokens)[order], owner[order]

    def _verdicts(self, keys: np.ndarray) -> np.ndarray:
        """For keys left * 2**32 + right (right 2**32 - 1: the token alone),
        whether exact merging leaves them as they are."""
        at = np.searchsorted(self.known, keys)
        fresh = np.unique(keys[(at >= len(self.known)) | (self.known[np.minimum(at, max(len(self.known) - 1, 0))] != keys)]) if len(self.known) else np.unique(keys)
        if len(fresh):
            if len(self.known) > 4 * self.most_words:
                self.known, self.verdict = self.known[:0], self.verdict[:0]
                return self._verdicts(keys)
            claims = [(k >> 32,) if k & ALONE == ALONE else (k >> 32, k & ALONE) for k in fresh.tolist()]
            exact = self.merged([b"".join([self.bytes[i] for i in ids]) for ids in claims])
            found = [a == b for a, b in zip(exact, claims)]
            known, verdict = np.concatenate([self.known, fresh]), np.concatenate([self.verdict, np.array(found, dtype=bool)])
            order = np.argsort(known)
            self.known, self.verdict = known[order], verdict[order]
            at = np.searchsorted(self.known, keys)
        return self.verdict[at]

    def encode_words(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """Tokens of distinct words: all proposals first, then one check of all
        neighbour pairs, then exact merging of the words that failed."""
        raw = [w.encode() for w in words]
        flat, owner = self.greedy(raw)
        if not len(flat):
            return {w: () for w in words}
        inner = owner[1:] == owner[:-1]
        keys = np.concatenate([(flat << 32) | ALONE, ((flat[:-1] << 32) | flat[1:])[inner]])
        owners = np.concatenate([owner, owner[1:][inner]])
        failing = np.unique(owners[~self._verdicts(keys)])
        ends, ids = np.cumsum(np.bincount(owner, minlength=len(words))).tolist(), flat.tolist()
        proposed = [tuple(ids[a:b]) for a, b in zip([0, *ends], ends)]
        for i, exact in zip(failing.tolist(), self.merged([raw[i] for i in failing.tolist()])):
            proposed[i] = exact
        return dict(zip(words, proposed))

    def cut_text(self, text: str) -> list[str]:
        """Pieces in order, each encoded by itself: strings of added tokens, a
        run of visible characters with the space before it, or white space."""
        findall = SAFE_PIECES.findall if CONTROLS.search(text) is None else self.words.findall
        if self.cut is None or not any(a in text for a in self.added):
            return findall(text)
        out: list[str] = []
        for part in self.cut.split(text):
            out += [part] if part in self.added else findall(part)
        return out

    def _remember(self, new: list[str]) -> None:
        """Encode pieces that are not known."""
        # a run of letters, with or without a space before it, is one word
        split = [
            (p,) if p.isalpha() or (p[0] == " " and p[1:].isalpha()) or p in self.added else self.words.findall(p)
            for p in new
        ]
        memo = self.memo
        missing = list({w for ws in split for w in ws if w not in memo})
        if len(memo) + len(missing) > self.most_words:
            self.memo = memo = {}
            missing = list({w for ws in split for w in ws})
        fresh = self.encode_words([w for w in missing if w not in self.added])
        fresh |= {w: (self.added[w],) for w in missing if w in self.added}
        name, raw = self.names, self.bytes
        memo.update(
            (w, (ids, ",".join([name[i] for i in ids]), b"".join([raw[i] for i in ids]), array("i", ids).tobytes()))
            for w, ids in fresh.items()
        )
        pieces = self.pieces
        for piece, ws in zip(new, split):
            if len(ws) == 1:
                pieces[piece] = memo[ws[0]]
            else:
                ids, names, bytes_, packed = zip(*[memo[w] for w in ws])
                pieces[piece] = tuple([i for part in ids for i in part]), ",".join(names), b"".join(bytes_), b"".join(packed)

    def encode_batch(self, texts: list[str]) -> list[list[tuple[tuple[int, ...], str, bytes]]]:
        """For each text, for each of its pieces: ids, ids in decimals, the
        bytes the ids decode to, and the ids as 32-bit integers in bytes."""
        cut = [self.cut_text(t) for t in texts]
        if len(self.pieces) > self.most_pieces:
            self.pieces, self.older = {}, self.pieces
        pieces, older = self.pieces, self.older
        new = {p for ps in cut for p in ps if p not in pieces}
        if older:
            again = [p for p in new if p in older]
            pieces.update((p, older[p]) for p in again)
            new.difference_update(again)
        self._remember(list(new))
        return [[pieces[p] for p in ps] for ps in cut]

    def byte_table(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all tokens in one array, and where each starts."""
        whole = [self.bytes.get(i, b"") for i in range(max(self.bytes) + 1)]
        return np.concatenate([[0], np.cumsum([len(b) for b in whole])]), np.frombuffer(b"".join(whole), dtype=np.uint8)


_loaded: dict[tuple, Bpe] = {}


def loaded(path: str, memo: tuple[int, int] | None = None) -> Bpe:
    if (path, memo) not in _loaded:
        # The worker is reused by later stages: its collector stays on, else
        # their cyclic garbage is never freed; the vocabulary is frozen instead,
        # so that collections do not walk it.
        was_on = gc.isenabled()
        gc.disable()
        try:
            _loaded[path, memo] = Bpe(path, memo)
        finally:
            gc.freeze()
            if was_on:
                gc.enable()
    return _loaded[path, memo]


def _digest(decoded: bytes) -> str:
    return hashlib.sha256(decoded.decode("utf-8", "replace").encode()).hexdigest()


def _flat(coded: list[list[tuple]]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in one array, and where each text starts."""
    packed = [b"".join([p[3] for p in text]) for text in coded]
    ends = np.cumsum([0] + [len(text) for text in packed]) // 4
    return np.frombuffer(b"".join(packed), dtype=np.int32).astype(np.int64), ends


def decoded_texts(table: tuple[np.ndarray, np.ndarray], ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The bytes that the ids of each text stand for."""
    starts, data = table
    sizes = starts[ids + 1] - starts[ids]
    stops = np.concatenate([[0], np.cumsum(sizes)])
    whole = data[np.arange(int(stops[-1])) + np.repeat(starts[ids] - stops[:-1], sizes)].tobytes()
    cuts = stops[ends].tolist()
    return [whole[a:b] for a, b in zip(cuts, cuts[1:])]


def encode(docs: DataFrame, path: str | None = None, text_column: str = "text") -> DataFrame:
    """Adds to all columns of docs ``ids`` (array of int) and ``decoded_sha256``,
    the digest of the text that these ids decode to."""
    path = path or default_vocabulary()
    added = ("ids", "decoded_sha256")
    fields = [f for f in docs.schema.fields if f.name not in added]
    schema = StructType([*fields, StructField("ids", ArrayType(IntegerType())), StructField(added[1], StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, SMALL_MEMO)
        table = bpe.byte_table()
        for part in slices(batches, text_column):
            coded = bpe.encode_batch([t or "" for t in part.column(text_column).to_pylist()])
            flat, ends = _flat(coded)
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32)))
            digests = [_digest(text) for text in decoded_texts(table, flat, ends)]
            arrays = [part.column(f.name) for f in fields] + [ids, pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, [*(f.name for f in fields), *added])

    return docs.mapInArrow(run, schema)


def decode(coded: DataFrame, path: str | None = None) -> DataFrame:
    """Adds the column ``decoded``, the text that the column ``ids`` stands for;
    null ids give an empty text."""
    path = path or default_vocabulary()
    fields = [f for f in coded.schema.fields if f.name != "decoded"]
    schema = StructType([*fields, StructField("decoded", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, data = loaded(path).byte_table()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = []
                for ids in part.column("ids"):
                    ids = np.asarray(ids.values.to_numpy() if ids.is_valid else [], dtype=np.int64)
                    sizes = starts[ids + 1] - starts[ids]
                    place = np.arange(int(sizes.sum())) + np.repeat(starts[ids] - (np.cumsum(sizes) - sizes), sizes)
                    texts.append(data[place].tobytes().decode("utf-8", "replace"))
                arrays = [part.column(f.name) for f in fields] + [pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, [*(f.name for f in fields), "decoded"])

    return coded.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row: encodes,
    looks up the bytes of the ids again and hashes both, without moving the ids."""
    path = path or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        table = bpe.byte_table()
        for part in slices(batches, "text"):
            coded = bpe.encode_batch([t or "" for t in part.column("text").to_pylist()])
            flat, ends = _flat(coded)
            listed = [hashlib.sha256(",".join([p[1] for p in text]).encode()).hexdigest() for text in coded]
            decoded = [_digest(text) for text in decoded_texts(table, flat, ends)]
            arrays = [part.column("doc_id"), pa.array(np.diff(ends), pa.int64()), pa.array(listed), pa.array(decoded)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
