"""N-gram Jaccard self-join over a token-group matrix.

Each document is the set of its distinct word n-grams. Documents with equal
sets form one class. For the classes

1. a prefix of each set, under one order of all tokens, is enough to see every
   pair that can reach the threshold: two such sets share a prefix token;
2. classes that share prefix tokens are partitioned into groups of similar
   sets, bounded in members and in tokens;
3. the token-group matrix has one row per (token, group), the union of the
   members' tokens. A set is a candidate for a group with one of its prefix
   tokens and a size that allows a link. Its counted tokens outside the group's
   union bound its overlap with any member; a group is opened for the set only
   if that bound reaches the threshold, and only the sets that open it go there,
   in parts with the bounds of a group. Groups cut from one cluster are opened for
   each other if they share a prefix token;
4. an opened group is compared in full with the sets that open it: overlaps with
   all members by products of token incidence blocks, links by exact integers.
   Each comparison returns a spanning forest of its links, not all of them, so no
   link between different texts is lost for the components and no group of copies
   is multiplied out;
5. components come from star contraction on Spark.

The token order: first the tokens with a hash below a fixed bound, by the exact
number of classes that hold them and by hash, then the others by hash. Any order
gives the same result; in this one a class with enough tokens of its own has a
prefix that nobody shares and is done with, and passages that many documents
share come last. Tokens are 64-bit hashes.

Defined results: null text, empty text and text without words have no
shingles and link with nothing; a text of fewer words than the width is one
shingle; repeated rows and repeated or null ids are rows of their own, and
null ids never become a component id unless all of the component are null;
extra columns are not read."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from priceloom.llm import graph
from priceloom.llm.common import attach, free_name, text_of, written
from priceloom.llm.text import shingle_sets, slices

#: Tokens are counted if their hash is in this share of all hashes, as a multiple
#: of the share that two linked sets may differ in.
COUNTED = 1.4
#: Members and tokens of a group at most (a longer text is a group of its own).
GROUP_MEMBERS, GROUP_TOKENS = 256, 200_000
FILTER_BITS = 1 << 24
#: Two longs a row; above this many, sets and groups meet by shuffle.
BROADCAST_ROWS = 500_000
TOKEN_BLOCK = 1024
#: The classes of one label and size lie in this many cells.
CELLS = 64
#: The part of a group that holds its members; parts from 0 on ask for it.
OWN = -1

ROW = "doc_id long, row_key long, set_id binary, n_shingles long, counted int, prefix array<long>"


def _ratio(threshold: float) -> Fraction:
    return Fraction(str(threshold))


def _bound(ratio: Fraction) -> int:
    """Hashes below this are counted."""
    return int(min(0.49, COUNTED * float(1 - ratio)) * (1 << 64))


def _prefix_length(n: Column, ratio: Fraction) -> Column:
    up, down = ratio.numerator, ratio.denominator
    return n - F.ceil(n * up / down) + 1


def _prefixes(docs: DataFrame, width: int, ratio: Fraction) -> DataFrame:
    """Of each set the tokens with a counted hash, and more in order of their
    hashes where these are fewer than the prefix needs."""
    up, down, bound = ratio.numerator, ratio.denominator, np.uint64(_bound(ratio))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            ids, sizes, counted, prefixes = [], [], [], []
            for tokens in shingle_sets(part.column("text"), width):
                n = len(tokens)
                ids.append(hashlib.blake2b(tokens.data, digest_size=16).digest())
                sizes.append(n)
                counted.append(int(np.searchsorted(tokens, bound)))
                prefixes.append(tokens[: max(counted[-1], n - -(-up * n // down) + 1)] if n else tokens)
            ends = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])])
            flat = np.concatenate(prefixes).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))
            columns = [part.column("doc_id"), part.column("row_key"), pa.array(ids, pa.binary())]
            columns += [pa.array(sizes, pa.int64()), pa.array(counted, pa.int32()), lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row_key", "set_id", "n_shingles", "counted", "prefix"])

    return docs.mapInArrow(cut, ROW)


def _bit_filter(keys: DataFrame, column: str) -> np.ndarray:
    """A bit array of fixed size over hashed keys: no key is missed."""
    bit = F.pmod(F.col(column), F.lit(FILTER_BITS))
    packed = keys.select((bit / 32).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast(pmod({column}, 32) as int))").alias("b"))
    out = np.zeros(FILTER_BITS // 32, dtype=np.uint32)
    for row in packed.groupBy("w").agg(F.expr("bit_or(b)").alias("b")).toLocalIterator():
        out[row.w] = row.b
    return out


def _needed_sets(docs: DataFrame, width: int, bits: np.ndarray) -> DataFrame:
    """(row_key, set_id, tokens) of the rows whose key passes the bit filter;
    a task returns a key once."""
    held = docs.sparkSession.sparkContext.broadcast(bits)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        seen: set[int] = set()
        for batch in batches:
            keys = batch.column("row_key").to_numpy()
            at = np.mod(keys, FILTER_BITS)
            hit = ((table[at // 32] >> (at % 32).astype(np.uint32)) & 1).astype(bool)
            for i in np.flatnonzero(hit).tolist():
                hit[i] = int(keys[i]) not in seen
                seen.add(int(keys[i]))
            for part in slices(iter([batch.filter(pa.array(hit))]), "text"):
                sets = shingle_sets(part.column("text"), width)
                ids = [hashlib.blake2b(s.data, digest_size=16).digest() for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row_key"), pa.array(ids, pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["row_key", "set_id", "tokens"],
                )

    return docs.select("row_key", "text").mapInArrow(read, "row_key long, set_id binary, tokens binary")


def _held(classes: DataFrame) -> DataFrame:
    """The tokens that more than one class holds, with the number of those."""
    tokens = classes.select(F.explode("prefix").alias("token"), "row_key", "n", "counted")
    counts = written(tokens.groupBy("token").agg(F.count("*").alias("classes")).filter("classes > 1"), "token-counts")
    return written(tokens.join(counts, "token"), "held")


def _early(ratio: Fraction) -> Column:
    return F.col("token").between(0, _bound(ratio) - 1)


def _shared(held: DataFrame, ratio: Fraction) -> DataFrame:
    """(token, row_key, n, classes) of the prefix tokens that a class shares with
    some class of a size that allows a link. Of the sizes of a token's classes, the
    same one or the next one above or below is such a size if any is; sizes are
    counted before they are sorted, so a token that many classes hold brings no more
    rows to a task than there are sizes."""
    held = held.withColumn("early", _early(ratio))
    own = Window.partitionBy("row_key", "early")
    place = F.row_number().over(own.orderBy("classes", "token")) + F.col("counted") - F.count("*").over(own)
    # counted tokens that nobody shares come before these
    first = held.withColumn("place", place).filter(~F.col("early") | (F.col("place") <= _prefix_length(F.col("n"), ratio)))
    first = written(first.select("token", "row_key", "n", "classes"), "first")
    up, down = ratio.numerator, ratio.denominator
    sizes = first.groupBy("token", "n").agg(F.count("*").alias("same"))
    line = Window.partitionBy("token").orderBy("n")
    near = sizes.withColumns({"below": F.lag("n").over(line), "above": F.lead("n").over(line)})
    fits = (F.col("below") * down >= F.col("n") * up) | (F.col("n") * down >= F.col("above") * up)
    kept = near.filter(fits | (F.col("same") > 1)).select("token", "n", "same")
    marked = attach(first, kept, ["token", "n"], "same", first.count())
    return marked.filter(F.col("same").isNotNull()).select("token", "row_key", "n", "classes")


def _least_labels(tokens: DataFrame, label: str, total: int) -> DataFrame:
    """(row_key, n, label): the least label among the classes that share a token
    with a class, folded up before it moves."""
    least = tokens.groupBy("token").agg(F.min(label).alias("least"), F.count("*").alias("sharers"))
    near = attach(tokens.select("token", "row_key", "n"), least, ["token"], "sharers", total)
    return near.groupBy("row_key", "n").agg(F.min("least").alias("label"))


def _groups(tokens: DataFrame) -> DataFrame:
    """(row_key, n, label, grp) of all classes that share a prefix token. Two rounds of
    taking the least label among sharers bring similar sets together; the rest
    is cutting by members and tokens: a label's classes lie in a line of cells, by
    size and hash, whose running sums are taken over the cells."""
    total = tokens.count()
    label = written(_least_labels(tokens, "row_key", total), "labels").drop("n")
    again = written(tokens.join(label, "row_key"), "labelled")
    label = _least_labels(again, "label", total)
    label = written(label.withColumn("cell", F.pmod(F.xxhash64("row_key"), F.lit(CELLS))), "cells")
    cells = label.groupBy("label", "n", "cell").agg(F.count("*").alias("held"))
    line = Window.partitionBy("label").orderBy("n", "cell").rowsBetween(Window.unboundedPreceding, -1)
    before = {"rows_before": F.sum("held").over(line), "tokens_before": F.sum(F.col("held") * F.col("n")).over(line)}
    cells = cells.withColumns(before).na.fill(0, list(before))
    placed = attach(label, cells, ["label", "n", "cell"], "held", label.count())
    place = F.row_number().over(Window.partitionBy("label", "n", "cell").orderBy("row_key"))
    rows, size = F.col("rows_before") + place, F.col("tokens_before") + place * F.col("n")
    part = F.greatest(F.floor(rows / GROUP_MEMBERS), F.floor(size / GROUP_TOKENS))
    return placed.select("row_key", "n", "label", F.xxhash64("label", part).alias("grp"))


def _to_open(
    tokens: DataFrame, held: DataFrame, groups: DataFrame, ratio: Fraction
) -> tuple[DataFrame, DataFrame]:
    """Pairs of groups (g, h), g < h, cut from one cluster, to be compared with each
    other, and the classes (row_key, n, h) for which another cluster's group h has
    to be opened."""
    up, down = ratio.numerator, ratio.denominator
    placed = written(tokens.select("token", "row_key").join(groups, "row_key"), "placed")
    matrix = placed.groupBy("token", "grp", "label").agg(F.min("n").alias("low"), F.max("n").alias("high"))

    def fits(low: str, high: str) -> Column:
        return (F.col(high) * down >= F.col("b.low") * up) & (F.col("b.high") * down >= F.col(low) * up)

    left, right = matrix.alias("a"), matrix.alias("b")
    same_token, ordered = F.col("a.token") == F.col("b.token"), F.col("a.grp") < F.col("b.grp")
    of_one = same_token & (F.col("a.label") == F.col("b.label")) & ordered & fits("a.low", "a.high")
    within = left.join(right, of_one).select(F.col("a.grp").alias("g"), F.col("b.grp").alias("h"))

    members = placed.alias("a")
    of_two = same_token & (F.col("a.label") != F.col("b.label")) & ordered & fits("a.n", "a.n")
    asked = members.join(right, of_two).select("a.row_key", "a.n", F.col("b.grp").alias("h"))
    asked = written(asked.distinct(), "asked")
    own = held.filter(_early(ratio)).join(groups.select("row_key", "grp"), "row_key")
    union = own.select("token", F.col("grp").alias("h")).distinct()
    inside = asked.join(own.select("row_key", "token", "counted"), "row_key").join(union, ["token", "h"], "left_semi")
    inside = inside.groupBy("row_key", "n", "counted", "h").agg(F.count("*").alias("inside"))
    # without counted tokens to judge by, a group is opened
    few = asked.join(own.select("row_key").distinct(), "row_key", "left_anti").select("row_key", "n", "h")
    most_outside = F.col("n") - F.ceil(F.col("n") * up / down)
    near = inside.filter(F.col("counted") - F.col("inside") <= most_outside).select("row_key", "n", "h")
    # a class may be too small for its counted tokens to bound anything
    small = asked.join(own.select("row_key", "counted").distinct(), "row_key").filter(F.col("counted") <= most_outside)
    asks = near.unionByName(few).unionByName(small.select("row_key", "n", "h")).distinct()
    return within.distinct(), asks


def _dealt(asks: DataFrame) -> DataFrame:
    """(row_key, grp, part): the classes that ask for a group in parts of about the
    bounds of a group, so that a group that many ask for is opened in many tasks."""
    whole = asks.groupBy("h").agg(F.count("*").alias("asking"), F.sum("n").alias("asked_tokens"))
    parts = F.ceil(F.greatest(F.col("asking") / GROUP_MEMBERS, F.col("asked_tokens") / GROUP_TOKENS))
    sized = attach(asks, whole.withColumn("parts", parts), ["h"], "asking", asks.count())
    part = F.pmod(F.xxhash64("row_key", F.lit("part")), F.col("parts"))
    return sized.select("row_key", F.col("h").alias("grp"), part.alias("part"))


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections between two lists of sets."""
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    values = np.concatenate(left + right)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in left + right])
    distinct, code = np.unique(values, return_inverse=True)
    twice = np.bincount(code) > 1
    number = np.cumsum(twice) - 1
    keep = twice[code]
    code, owner = number[code[keep]], owner[keep]
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    total = int(code[-1]) + 1 if len(code) else 0
    for at in range(0, total, TOKEN_BLOCK):
        a, b = np.searchsorted(code, [at, at + TOKEN_BLOCK])
        block = np.zeros((len(left) + len(right), TOKEN_BLOCK), dtype=np.float32)
        block[owner[a:b], code[a:b] - at] = 1
        out += block[: len(left)] @ block[len(left) :].T
    return out.astype(np.int64)


def _forest(pairs: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The pairs that join two trees, in order."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for a, b in pairs.tolist():
        x, y = find(a), find(b)
        if x != y:
            root[y] = x
            kept.append((a, b))
    return kept


def _members(ids: list[bytes], sets: list[bytes]) -> tuple[list[bytes], list[np.ndarray]]:
    """Distinct sets of a group."""
    own = dict(zip(ids, sets))
    return list(own), [np.frombuffer(t, dtype=np.uint64) for t in own.values()]


def _open(ratio: Fraction):
    up, down = ratio.numerator, ratio.denominator

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids, sets = _members(row["ids"], row["sets"])
                alone = row["other_ids"] is None
                more_ids, more = (ids, sets) if alone else _members(row["other_ids"], row["other_sets"])
                shared = _overlaps(sets, more)
                sizes, others = np.array([len(s) for s in sets]), np.array([len(s) for s in more])
                union = sizes[:, None] + others[None, :] - shared
                linked = shared * down >= union * up
                if alone:
                    linked = np.triu(linked, 1)
                pairs = np.argwhere(linked)
                names = ids if alone else ids + more_ids
                if not alone:
                    pairs[:, 1] += len(ids)
                for a, b in _forest(pairs, len(names)):
                    us.append(names[a])
                    vs.append(names[b])
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], ["u", "v"])

    return compare


def links(docs: DataFrame, rows: DataFrame, width: int, ratio: Fraction) -> DataFrame:
    """A spanning set of links (u, v) between set ids, for rows of _prefixes."""
    classes = rows.filter("n_shingles > 0").groupBy("set_id").agg(
        F.min("row_key").alias("row_key"), F.first("n_shingles").alias("n"), F.first("counted").alias("counted"),
        F.first("prefix").alias("prefix"),
    )
    classes = written(classes, "classes")
    held = _held(classes)
    tokens = written(_shared(held, ratio), "shared")
    groups = written(_groups(tokens), "groups")
    pairs, asks = _to_open(tokens, held, groups, ratio)
    pairs, asks = written(pairs, "pairs"), written(asks, "asks")
    sets = _needed_sets(docs, width, _bit_filter(groups, "row_key"))
    # a set goes to its own group and to those that it asks for, in one shuffle
    needed = groups.select("row_key", "grp", F.lit(OWN).alias("part")).unionByName(_dealt(asks))
    needed = written(needed, "needed")
    if needed.count() <= BROADCAST_ROWS:
        needed = F.broadcast(needed)
    members = (
        sets.join(needed, "row_key")
        .groupBy("grp", "part")
        .agg(F.collect_list(F.struct("set_id", "tokens")).alias("m"))
        .select("grp", "part", F.col("m.set_id").alias("ids"), F.col("m.tokens").alias("sets"))
    )
    members = written(members, "members")
    own, asking = (members.filter(c).drop("part") for c in (F.col("part") == OWN, F.col("part") != OWN))
    none = F.lit(None)
    alone = own.filter(F.size("ids") > 1).select(
        "ids", "sets", none.cast("array<binary>").alias("other_ids"), none.cast("array<binary>").alias("other_sets")
    )
    others = own.select(F.col("grp").alias("h"), F.col("ids").alias("other_ids"), F.col("sets").alias("other_sets"))
    lefts = pairs.join(own, pairs.g == own.grp).select("h", "ids", "sets")
    lefts = lefts.unionByName(asking.withColumnRenamed("grp", "h"))
    crossed = lefts.join(others, "h").select("ids", "sets", "other_ids", "other_sets")
    return alone.mapInArrow(_open(ratio), "u binary, v binary").unionByName(
        crossed.mapInArrow(_open(ratio), "u binary, v binary")
    )


def jaccard_components(docs: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row per row of docs: doc_id, row_key, n_shingles, component_id and
    component_key, the least row key of the component. Only ``doc_id`` and
    ``text`` are read. row_key is equal for rows equal in both."""
    ratio = _ratio(threshold)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    base = base.withColumn("row_key", F.xxhash64("doc_id", F.xxhash64("text")))
    rows = written(_prefixes(base, width, ratio), "prefixes")
    classes = rows.filter("n_shingles > 0").groupBy("set_id").agg(
        F.count("*").alias("rows"), F.min("doc_id").alias("low"), F.min("row_key").alias("low_key")
    )
    roots = graph.components(links(base, rows, width, ratio))
    rooted = classes.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left")
    rooted = written(rooted.withColumn("root", F.coalesce("root", "set_id")), "rooted")
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"), F.min("low_key").alias("component_key"))
    named = written(rooted.join(least, "root").select("set_id", "rows", "component_id", "component_key"), "named")
    slim = rows.select("doc_id", "row_key", "n_shingles", "set_id")
    full = attach(slim.filter("n_shingles > 0"), named, ["set_id"], "rows", rows.count())
    columns = ["doc_id", "row_key", "n_shingles", "component_id", "component_key"]
    empty = slim.filter("n_shingles = 0").withColumns({"component_id": F.col("doc_id"), "component_key": F.col("row_key")})
    return full.select(*columns).unionByName(empty.select(*columns))


def keep_one(docs: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of docs without the near duplicates: of each component the row
    with the least key stays, and one row of rows equal in id and text. Rows
    without words all stay."""
    found = jaccard_components(docs, width, threshold).filter("n_shingles > 0")
    marks = found.groupBy("row_key").agg(
        F.max(F.col("row_key") != F.col("component_key")).alias("goes"), F.count("*").alias("times")
    )
    key, goes, times = (free_name(docs, n) for n in ("row_key", "goes", "times"))
    marks = marks.filter("goes or times > 1").toDF(key, goes, times)
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64(text_of())))
    marked = keyed.join(marks, key, "left")
    alone = marked.filter(F.col(goes).isNull())
    again = marked.filter(~F.col(goes)).dropDuplicates([key])
    return alone.unionByName(again).drop(key, goes, times)
