"""Prefix trie of conversations, built as burst tries.

Conversations are sequences of turn ids (128-bit hashes of role and text) with
the bytes of each text. Equal sequences are one, with its smallest conversation
and their number. A container holds the suffixes under one trie head; the first
holds all of them under the root. A container with more than ``limit`` turns is
burst by the next turn id: each suffix moves to the head one turn deeper, heads
are grouped and counted, and suffixes that end there leave. The containers that
are left lie on one task each, where their suffixes are sorted and swept into
nodes with a stack. A head sums up what its containers or heads below give.

A round of bursting is a grouping and a join on the suffixes of containers that
are too large; there are as many rounds as turns are shared by more turns than
the limit. A single suffix longer than that is a chain: its rows are its nodes,
and its sums are taken over blocks of turns. No text is moved, only ids.

A node's list of conversations ending in it is hashed in order: ids are listed
natively in parts of at most LISTED ids, and the parts of one list are read one
after the other, as its digest needs.

Defined results: turns go by turn number, a null one first, ties by the hashes
of role and text; null role or text counts as empty; rows without an id are one
conversation, smaller than any other, shown as null and as nothing in digests;
repeated rows are a turn each; a conversation without turns ends at the root; an
empty table gives no nodes; other columns are not read."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from priceloom.llm.common import attach, written
from priceloom.operators.ranking import global_rank

#: Most turns in a container that one task sweeps.
LIMIT = 65_536
LISTED, CHAIN_BLOCK, TASK_TURNS = 4096, 4096, 500_000
BORROWING, SHARED = 9, 5
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()
KEY = ["k1", "k2"]
NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
SWEPT = "k1 long, k2 long, " + ", ".join(f"{c} long" for c in NODE) + ", ending long"


def _hash(seed: int, *columns: str | Column) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, int | None]:
    """(c, rank, id1, id2, bytes), ranks consecutive within a conversation, and
    the number that stands for rows without an id."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("c"),
        F.col("turn").cast("long").alias("turn"),
        _hash(1, text("role"), text("text")).alias("id1"),
        _hash(2, text("role"), text("text")).alias("id2"),
        F.octet_length(text("text")).cast("long").alias("bytes"),
    )
    rows = written(rows, "turns")
    least, blank = rows.agg(F.min("c"), F.count_if(F.col("c").isNull())).first()
    nameless = (least or 0) - 1 if blank else None
    if blank:
        rows = rows.fillna({"c": nameless})
    ranked = global_rank(rows, F.asc("c"), F.asc_nulls_first("turn"), F.asc("id1"), F.asc("id2"))
    return written(ranked.drop("turn"), "ranked"), nameless


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame, int | None]:
    """Conversations that share beginnings: c takes the first h turns of
    c - c % 5 before its own turns after the first h, where h is crc32 of the id
    modulo 9. Turns (c, depth, id1, id2, bytes), depth from 1, and (c, n)."""
    turns, nameless = numbered_turns(conversations)
    own = turns.groupBy("c").agg(F.min("rank").alias("first"), F.count("*").alias("n_own"))
    named = F.lit(True) if nameless is None else F.col("c") != nameless
    h = F.when(named, F.crc32(F.col("c").cast("string")) % BORROWING).otherwise(0)
    base = F.when(named, F.col("c") - F.col("c") % SHARED).otherwise(F.col("c"))
    own = written(own.withColumn("h", h).withColumn("base", base), "own")
    lengths = own.select(F.col("c").alias("base"), F.col("n_own").alias("n_base"))
    convs = own.join(lengths, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = written(convs.drop("n_base"), "conversations")

    placed = attach(turns, convs.select("c", "first", "n_own", "h", "taken"), ["c"], "n_own", turns.count())
    at = F.col("rank") - F.col("first")
    kept = placed.filter(at >= F.col("h")).withColumn("depth", F.col("taken") + at - F.col("h") + 1)
    lent = placed.filter(at < BORROWING - 1).select(F.col("c").alias("base"), at.alias("at"), "id1", "id2", "bytes")
    borrowed = lent.join(convs.select("base", "c", "h"), "base").filter("at < h").withColumn("depth", F.col("at") + 1)
    columns = ("c", "depth", "id1", "id2", "bytes")
    rows = written(kept.select(*columns).unionByName(borrowed.select(*columns)), "rebuilt")
    n = F.col("taken") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))
    return rows, convs.select("c", n.alias("n")), nameless


def _fold_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of lists, in order, to one row per list: its smallest conversation,
    its size, the turns of its sequence and its digest."""
    current: tuple | None = None
    first, weight, digest = 0, 0, hashlib.sha256()
    out: list[tuple] = []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["c", "weight", "n", "ends"])

    for batch in batches:
        for key1, key2, n, least, size, text in zip(*[c.to_pylist() for c in batch.columns]):
            if (key1, key2, n) != current:
                if current is not None:
                    out.append((first, weight, current[2], digest.hexdigest()))
                current, first, weight, digest = (key1, key2, n), least, 0, hashlib.sha256()
            digest.update(f",{text}".encode() if weight else text.encode())
            weight += size
        if len(out) > 10_000:
            yield batch_of(out)
            out = []
    if current is not None:
        out.append((first, weight, current[2], digest.hexdigest()))
        yield batch_of(out)


def _classes(rows: DataFrame, convs: DataFrame, nameless: int | None) -> DataFrame:
    """(c, weight, n, ends): one row per distinct sequence."""
    prints = rows.groupBy("c").agg(*[F.bit_xor(_hash(s, "depth", "id1", "id2")).alias(f"p{s}") for s in (1, 2)])
    zero = F.lit(0).cast("long")
    seqs = convs.join(prints, "c", "left").withColumns({p: F.coalesce(p, zero) for p in ("p1", "p2")})
    part = F.shiftright("c", LISTED.bit_length() - 1)
    parts = seqs.groupBy("p1", "p2", "n", part.alias("part")).agg(F.array_sort(F.collect_list("c")).alias("ids"))
    shown = lambda c: c.cast("string") if nameless is None else F.when(c == nameless, "").otherwise(c.cast("string"))
    lists = parts.select(
        "p1", "p2", "n", "part", F.get("ids", F.lit(0)).alias("least"), F.size("ids").cast("long").alias("size"),
        F.array_join(F.transform("ids", shown), ",").alias("text"),
    )
    lined = lists.repartition("p1", "p2", "n").sortWithinPartitions("p1", "p2", "n", "part").drop("part")
    return written(lined.mapInArrow(_fold_lists, "c long, weight long, n long, ends string"), "classes")


def _burst(path: DataFrame, classes: DataFrame, limit: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Heads of each depth from 1 on, (k1, k2, up1, up2, conv_id, n_convs,
    bytes, ending), and for each depth from 0 on the containers that stay:
    (c, k1, k2, head, members)."""
    zero = F.lit(0).cast("long")
    held = written(classes.filter("n > 0").select("c", "n", "weight", zero.alias("k1"), zero.alias("k2")), "container")
    heads: list[DataFrame] = []
    stay: list[DataFrame] = []
    while True:
        depth = len(heads)
        load = F.sum(F.col("n") - depth)
        loads = written(held.groupBy(*KEY).agg(load.alias("load"), F.count("*").alias("members")), "loads")
        full = (F.col("load") > limit) & (F.col("members") > 1)
        known = attach(held, loads, KEY, "members", held.count())
        stay.append(known.filter(~full).select("c", *KEY, F.lit(depth).cast("long").alias("head"), "load", "members"))
        if not loads.filter(full).limit(1).count():
            return heads, stay
        above = known.filter(full).select("c", "n", "weight", F.col("k1").alias("up1"), F.col("k2").alias("up2"))
        steps = path.filter(F.col("depth") == depth + 1).select("c", "id1", "id2", "bytes")
        moved = above.join(steps, "c").withColumns({k: _hash(s, f"up{s}", "id1", "id2") for s, k in enumerate(KEY, 1)})
        moved = written(moved.drop("id1", "id2"), "moved")
        ends_here = F.col("n") == depth + 1
        heads.append(
            written(
                moved.groupBy(*KEY).agg(
                    F.any_value("up1").alias("up1"),
                    F.any_value("up2").alias("up2"),
                    F.min("c").alias("conv_id"),
                    F.sum("weight").alias("n_convs"),
                    F.any_value("bytes").alias("bytes"),
                    F.max(F.when(ends_here, F.col("c"))).alias("ending"),
                ),
                "heads",
            )
        )
        held = moved.filter(~ends_here).select("c", "n", "weight", *KEY)


def swept(suffixes: list[tuple], head: int) -> list[list]:
    """Nodes of one container from (ids, bytes, c, weight) of its suffixes:
    rows of NODE and the sequence that ends there. Sorted, neighbours share
    their longest prefixes, so a stack of open nodes is enough."""
    suffixes.sort()
    nodes: list[list] = []
    open_: list[int] = []

    def close(down_to: int) -> None:
        while len(open_) > down_to:
            node = nodes[open_.pop()]
            node[5] = node[5] or 1  # no child: a leaf
            node[6] += (node[3] - 1) * node[8]
            if open_:
                above = nodes[open_[-1]]
                above[0] = node[0] if above[0] is None else min(above[0], node[0])
                above[3] += node[3]
                above[4] += 1
                above[5] += node[5]
                above[6] += node[6]

    before: tuple = ()
    for ids, sizes, c, weight in suffixes:
        shared = 0
        for a, b in zip(ids, before):
            if a != b:
                break
            shared += 1
        close(shared)
        for depth in range(shared, len(ids)):
            above = open_[-1] if open_ else None
            open_.append(len(nodes))
            nodes.append([None, head + depth + 1, above, 0, 0, 0, 0, None, sizes[depth]])
        last = nodes[open_[-1]]
        last[0], last[3], last[7] = c, last[3] + weight, c
        before = ids
    close(0)
    for node in nodes:
        node[2] = None if node[2] is None else nodes[node[2]][0]
    return nodes


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by container, conversation and depth to the containers' nodes."""
    names = [f.split()[0] for f in SWEPT.split(", ")]
    out: list[tuple] = []
    suffixes: list[tuple] = []
    container: object = None
    conversation: object = None

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    for batch in batches:
        for key, c, weight, turn, size in zip(
            zip(*[batch.column(n).to_pylist() for n in (*KEY, "head")]),
            *[batch.column(n).to_pylist() for n in ("c", "weight")],
            zip(batch.column("id1").to_pylist(), batch.column("id2").to_pylist()),
            batch.column("bytes").to_pylist(),
        ):
            if key != container:
                if suffixes:
                    out += [(container[0], container[1], *n[:8]) for n in swept(suffixes, container[2])]
                suffixes, container, conversation = [], key, None
                if len(out) > 20_000:
                    yield batch_of(out)
                    out = []
            if c != conversation or not suffixes:
                conversation = c
                suffixes.append(([], [], c, weight))
            suffixes[-1][0].append(turn)
            suffixes[-1][1].append(size)
    if suffixes:
        out += [(container[0], container[1], *n[:8]) for n in swept(suffixes, container[2])]
    if out:
        yield batch_of(out)


def _chains(rows: DataFrame) -> DataFrame:
    """Nodes of suffixes that are alone in their container and longer than a
    task may hold: one per turn. Bytes below a turn are summed within blocks of
    turns, and over the blocks after."""
    block = F.floor(F.col("depth") / CHAIN_BLOCK).alias("block")
    rows = rows.withColumn("block", block)
    below = Window.partitionBy("c").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("c", "block").agg(F.sum("bytes").alias("words"), F.count("*").alias("in_block"))
    sums = sums.withColumn("after", F.coalesce(F.sum("words").over(below), F.lit(0))).drop("words", "in_block")
    inside = Window.partitionBy("c", "block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn("here", F.sum("bytes").over(inside)).join(sums, ["c", "block"])
    return summed.select(
        *KEY,
        F.col("c").alias("conv_id"),
        "depth",
        F.when(F.col("depth") > F.col("head") + 1, F.col("c")).alias("parent_conv_id"),
        F.col("weight").alias("n_convs"),
        F.when(F.col("depth") < F.col("n"), 1).otherwise(0).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("weight") - 1) * (F.col("here") + F.col("after"))).alias("saved_tokens"),
        F.when(F.col("depth") == F.col("n"), F.col("c")).alias("ending"),
    )


def _below(children: DataFrame, *key: str) -> DataFrame:
    sums = (F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"))
    return children.groupBy(*[F.col(k).alias(n) for k, n in zip(key, KEY)]).agg(*sums)


def trie(rows: DataFrame, convs: DataFrame, nameless: int | None = None, limit: int = LIMIT) -> DataFrame:
    """All nodes of the trie over turns (c, depth, id1, id2, bytes) of the
    conversations (c, n): NODE and ends_sha256."""
    spark = rows.sparkSession
    classes = _classes(rows, convs, nameless)
    total = rows.count()
    path = attach(rows, classes.select("c", "weight", "n"), ["c"], "n", total).filter(F.col("weight").isNotNull())
    path = written(path, "paths")
    heads, stay = _burst(path, classes, limit)

    containers = stay[0]
    for part in stay[1:]:
        containers = containers.unionByName(part)
    containers = written(containers, "containers")
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-total // TASK_TURNS))
    short = containers.filter(F.col("load") <= limit)
    suffixes = path.join(short.select("c", *KEY, "head"), "c").filter("depth > head")
    placed = suffixes.repartition(tasks, *KEY).sortWithinPartitions(*KEY, "c", "depth")
    columns = (*KEY, "head", "c", "weight", "id1", "id2", "bytes")
    nodes = written(placed.select(*columns).mapInArrow(_sweep, SWEPT), "swept")
    long = containers.filter(F.col("load") > limit).select("c", *KEY, "head", "load")
    if long.limit(1).count():
        apart = attach(path, long, ["c"], "load", total).filter(F.col("head").isNotNull()).filter("depth > head")
        nodes = nodes.unionByName(written(_chains(written(apart, "chains")), "chain-nodes"))

    top = nodes.filter(F.col("parent_conv_id").isNull())
    finished: list[DataFrame] = []
    children = _below(top, *KEY)
    for depth in range(len(heads), 0, -1):
        level = heads[depth - 1].join(children, KEY, "left")
        leaf = F.col("n_children").isNull()
        level = level.select(
            *KEY, "up1", "up2", "conv_id", F.lit(depth).cast("long").alias("depth"), "n_convs", "ending",
            F.when(leaf, 0).otherwise(F.col("n_children")).alias("n_children"),
            F.when(leaf, 1).otherwise(F.col("n_leaves")).alias("n_leaves"),
            (F.coalesce("below", F.lit(0)) + (F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
        )
        level = written(level, "level")
        finished.append(level)
        children = _below(top, *KEY).unionByName(_below(level, "up1", "up2"))
    zero = F.lit(0).cast("long")
    at_root = children.filter("k1 = 0 and k2 = 0")
    many, leaves, saved = at_root.agg(*[F.coalesce(F.sum(c), zero) for c in ("n_children", "n_leaves", "below")]).first()
    whole = classes.agg(F.min("c").alias("conv_id"), F.sum("weight").alias("n_convs"), F.max(F.when(F.col("n") == 0, F.col("c"))).alias("ending"))
    root = whole.filter(F.col("n_convs").isNotNull()).select(
        "conv_id", zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
        *[F.lit(v).cast("long").alias(c) for v, c in ((many, "n_children"), (max(leaves, 1), "n_leaves"), (saved, "saved_tokens"))],
        "ending",
    )
    root = written(root, "root")

    above = root.select(zero.alias("k1"), zero.alias("k2"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("many"))
    for level in finished:
        above = above.unionByName(level.select(*KEY, F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("many")))
    above = written(above, "parents")
    names = ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ending")
    loose = top.select(*KEY, *names)
    for level in finished:
        loose = loose.unionByName(level.select(F.col("up1").alias("k1"), F.col("up2").alias("k2"), *names))
    loose = written(loose, "loose")
    tied = attach(loose, above, KEY, "many", loose.count())
    every = nodes.filter(F.col("parent_conv_id").isNotNull()).select(*NODE, "ending")
    every = every.unionByName(tied.select(*NODE, "ending")).unionByName(root.select(*NODE, "ending"))

    ends = classes.select(F.col("c").alias("ending"), F.col("ends").alias("ends_sha256"))
    ended = every.filter(F.col("ending").isNotNull()).join(ends, "ending").select(*NODE, "ends_sha256")
    passed = every.filter(F.col("ending").isNull()).select(*NODE, F.lit(EMPTY_DIGEST).alias("ends_sha256"))
    out = ended.unionByName(passed)
    if nameless is None:
        return out
    shown = {c: F.when(F.col(c) != nameless, F.col(c)) for c in ("conv_id", "parent_conv_id")}
    return out.withColumns(shown)


def prefix_trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The trie of the rebuilt conversations of (conv_id, turn, role, text)."""
    return trie(*rebuilt(conversations), limit=limit)
