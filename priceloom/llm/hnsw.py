"""Approximate nearest neighbours: one HNSW graph per shard, results merged.

Equal vectors are collapsed first, each with its ``k + 1`` smallest ids, which
is all a top k can need; so thousands of copies are one node. Distinct vectors
are dealt to shards by hash, about SHARD_ROWS each. A shard's graph is stored as
flat arrays: vectors, and per layer the node numbers and a neighbour matrix. The
queries are searched in blocks against every shard (a stated query set against
all rows), each search returns its nearest candidates, and a top-k by score and
id merges the shards.

The measure is the inner product; scores are computed in double precision from
the stored float values, in the order of the components. Graph and search use
float32 and keep more candidates than asked for.

Every vector is indexed; nothing is sampled. Vectors that are null, zero or hold
a null or non-finite component take no part, nor do rows with a null id or a
length other than the table's most common one (ties: the shorter). Rows equal in
id and vector count once. A query's own id is no candidate. With fewer
candidates than k, all that are found are returned. Extra columns are not
read."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from priceloom.llm.common import written

SHARD_ROWS, NEIGHBOURS, BUILD_WIDTH, SEARCH_WIDTH, QUERY_BLOCK = 8192, 16, 64, 96, 512


class Graph:
    """Layers of (nodes, neighbours): nodes ascending, neighbours as a matrix of
    node numbers padded with -1."""

    def __init__(self, vectors: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]):
        self.vectors, self.layers = vectors, layers

    @staticmethod
    def build(vectors: np.ndarray, seed: int = 1) -> Graph:
        n = len(vectors)
        rng = np.random.default_rng(seed)
        levels = np.minimum((-np.log(rng.random(n) + 1e-12) / np.log(NEIGHBOURS)).astype(int), 8)
        top = int(levels.max(initial=0))
        widths = [2 * NEIGHBOURS] + [NEIGHBOURS] * top
        links = [np.full((n, w), -1, dtype=np.int32) for w in widths]
        degree = [np.zeros(n, dtype=np.int32) for _ in widths]
        entry, highest = -1, -1
        for i in range(n):
            level, q = int(levels[i]), vectors[i]
            near = [entry]
            for layer in range(highest, level, -1):
                near = [_search(vectors, links[layer], q, near, 1)[0][1]]
            for layer in range(min(level, highest), -1, -1):
                found = _search(vectors, links[layer], q, near, BUILD_WIDTH)
                chosen = _diverse(vectors, found, NEIGHBOURS)
                links[layer][i, : len(chosen)] = chosen
                degree[layer][i] = len(chosen)
                for c in chosen:
                    d = degree[layer][c]
                    if d < widths[layer]:
                        links[layer][c, d] = i
                        degree[layer][c] = d + 1
                    else:
                        all_ = np.append(links[layer][c], i)
                        scores = vectors[all_] @ vectors[c]
                        ranked = sorted(zip((-scores).tolist(), all_.tolist()))
                        kept = _diverse(vectors, [(-s, x) for s, x in ranked], widths[layer])
                        links[layer][c] = -1
                        links[layer][c, : len(kept)] = kept
                        degree[layer][c] = len(kept)
                near = [x for _, x in found]
            if level > highest:
                entry, highest = i, level
        layers = [(np.flatnonzero(levels >= layer).astype(np.int32), links[layer]) for layer in range(top + 1)]
        return Graph(vectors, [(nodes, matrix[nodes]) for nodes, matrix in layers])

    def ready(self) -> Graph:
        """Neighbour matrices by node number again, for searching."""
        self.full = []
        for nodes, matrix in self.layers:
            full = np.full((len(self.vectors), matrix.shape[1]), -1, dtype=np.int32)
            full[nodes] = matrix
            self.full.append(full)
        self.entry = int(self.layers[-1][0][0])
        return self

    def search(self, q: np.ndarray, width: int) -> list[int]:
        near = [self.entry]
        for full in self.full[:0:-1]:
            near = [_search(self.vectors, full, q, near, 1)[0][1]]
        return [x for _, x in _search(self.vectors, self.full[0], q, near, width)]


def _search(vectors: np.ndarray, links: np.ndarray, q: np.ndarray, start: list[int], width: int) -> list[tuple[float, int]]:
    """Best-first search in one layer: up to ``width`` (score, node), best first."""
    start = list(dict.fromkeys(start))
    scores = (vectors[start] @ q).tolist()
    seen = set(start)
    ahead = [(-s, x) for s, x in zip(scores, start)]
    best = [(s, x) for s, x in zip(scores, start)]
    heapq.heapify(ahead)
    heapq.heapify(best)
    while len(best) > width:
        heapq.heappop(best)
    while ahead:
        s, x = heapq.heappop(ahead)
        if len(best) >= width and -s < best[0][0]:
            break
        new = [y for y in links[x].tolist() if y >= 0 and y not in seen]
        if not new:
            continue
        seen.update(new)
        for score, y in zip((vectors[new] @ q).tolist(), new):
            if len(best) < width:
                heapq.heappush(best, (score, y))
                heapq.heappush(ahead, (-score, y))
            elif score > best[0][0]:
                heapq.heapreplace(best, (score, y))
                heapq.heappush(ahead, (-score, y))
    return sorted(best, reverse=True)


def _diverse(vectors: np.ndarray, found: list[tuple[float, int]], most: int) -> list[int]:
    """Neighbours, nearest first, that are nearer to the node than to a
    neighbour already taken; filled up with the nearest of the rest."""
    if len(found) <= most // 2:
        return [x for _, x in found]
    nodes = [x for _, x in found]
    own = vectors[nodes]
    between = own @ own.T
    taken: list[int] = []
    for i, (score, _) in enumerate(found):
        if len(taken) >= most:
            break
        if not taken or between[i, taken].max() < score:
            taken.append(i)
    left = [i for i in range(len(found)) if i not in set(taken)]
    taken += left[: most - len(taken)]
    return [nodes[i] for i in taken]


def _build(frame: pd.DataFrame) -> pd.DataFrame:
    vectors = np.frombuffer(b"".join(frame["packed"]), dtype=np.float32).reshape(len(frame), -1)
    order = np.lexsort(vectors.T[::-1])  # rows arrive in any order
    vectors = np.ascontiguousarray(vectors[order])
    graph = Graph.build(vectors)
    ids = [frame["ids"].iloc[i] for i in order]
    return pd.DataFrame(
        {
            "shard": [frame["shard"].iloc[0]],
            "vectors": [vectors.tobytes()],
            "nodes": [[nodes.tobytes() for nodes, _ in graph.layers]],
            "links": [[matrix.tobytes() for _, matrix in graph.layers]],
            "members": [np.concatenate(ids).astype(np.int64).tobytes()],
            "counts": [np.array([len(x) for x in ids], dtype=np.int32).tobytes()],
        }
    )


INDEX = "shard long, vectors binary, nodes array<binary>, links array<binary>, members binary, counts binary"


def _vectors(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector) of the rows that take part, vectors as arrays of float."""
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = table.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<float>").alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (common.n if common else 0))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = [np.asarray(v.values.to_numpy(zero_copy_only=False), dtype=np.float32) + 0 for v in batch.column("v")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array([p.tobytes() for p in packed], pa.binary())], ["id", "packed"]
        )


def build_index(table: DataFrame, k: int, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """One row per shard. Stored as a table, a shard's graph is read as a whole
    by the tasks that search it."""
    packed = _vectors(table, id_column, vector_column).mapInArrow(_pack, "id long, packed binary").distinct()
    ranked = packed.withColumn("r", F.row_number().over(Window.partitionBy("packed", F.pmod("id", F.lit(64))).orderBy("id")))
    small = ranked.filter(F.col("r") <= k + 1).groupBy("packed").agg(F.slice(F.sort_array(F.collect_list("id")), 1, k + 1).alias("ids"))
    small = written(small, "distinct-vectors")
    shards = max(1, -(-small.count() // SHARD_ROWS))
    dealt = small.withColumn("shard", F.pmod(F.xxhash64("packed", F.lit("shard")), F.lit(shards)))
    return written(dealt.groupBy("shard").applyInPandas(_build, INDEX), "hnsw-index")


def _look(k: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, graph, members, begins = None, None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if held != row["shard"]:
                    counts = np.frombuffer(row["counts"], dtype=np.int32)
                    vectors = np.frombuffer(row["vectors"], dtype=np.float32).reshape(len(counts), -1)
                    layers = []
                    for nodes, links in zip(row["nodes"], row["links"]):
                        nodes = np.frombuffer(nodes, dtype=np.int32)
                        layers.append((nodes, np.frombuffer(links, dtype=np.int32).reshape(len(nodes), -1)))
                    graph, held = Graph(vectors, layers).ready(), row["shard"]
                    members = np.frombuffer(row["members"], dtype=np.int64)
                    begins = np.concatenate([[0], np.cumsum(counts)])
                exact = graph.vectors.astype(np.float64)
                queries, hits, scores = [], [], []
                for query in row["queries"]:
                    q = np.frombuffer(query["packed"], dtype=np.float32)
                    found = np.array(graph.search(q, max(width, k + 1)))
                    score = exact[found] @ q.astype(np.float64)
                    order = np.argsort(-score, kind="stable")[: k + 1]
                    for j in order.tolist():
                        own = members[begins[found[j]] : begins[found[j] + 1]]
                        queries += [query["id"]] * len(own)
                        hits += own.tolist()
                        scores += [float(score[j])] * len(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(queries, pa.int64()), pa.array(hits, pa.int64()), pa.array(scores, pa.float64())],
                    ["query_id", "vec_id", "score"],
                )

    return run


def nearest(
    table: DataFrame, queries: DataFrame, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding",
    width: int = SEARCH_WIDTH,
) -> DataFrame:
    """query_id, rank, vec_id and score: for each row of queries its k nearest
    rows of the table other than itself."""
    index = build_index(table, k, id_column, vector_column)
    shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    packed = _vectors(queries, id_column, vector_column).mapInArrow(_pack, "id long, packed binary").distinct()
    many = packed.count()
    block = F.pmod(F.xxhash64("id"), F.lit(max(1, -(-many // QUERY_BLOCK))))
    blocks = packed.groupBy(block.alias("block")).agg(F.collect_list(F.struct("id", "packed")).alias("queries"))
    blocks = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<bigint>")))
    # Every block goes to every shard, which grows with the square: by shuffle only, as a broadcast passes through the driver.
    met = index.repartition(shards, "shard").hint("merge").join(blocks.repartition(shards, "shard"), "shard")
    found = met.drop("block").mapInArrow(_look(k, width), "query_id long, vec_id long, score double")
    found = found.filter("query_id <> vec_id").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    top = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return top.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
