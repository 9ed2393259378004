"""Approximate nearest neighbours: a hierarchical navigable small-world graph for each shard.

Vectors are dealt to shards of about ``SHARD`` by a hash of their id. A shard's graph has
layers: every vector is in layer 0, one in ``M`` of those in the next, and so on.
Vectors enter one by one; each links to near ones already there, chosen so that
none of them is nearer to another chosen one than to the new vector, and is linked back. As a
shard is small, the near ones are looked up exactly in blocks instead of by a search
of the graph so far. Neighbours are stored as flat arrays, ``M`` a vector (twice that in layer 0),
-1 where there is none.

A search descends greedily to layer 0 and there keeps the ``BEAM`` best
vectors found. Each block of queries visits every shard; the shards' results are
merged into the best of all.

Equal vectors enter the graph once; with it come the smallest ids that bear it, as many as
can be asked for, so a vector that very many rows share costs no search.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.llm.shared import saved

SHARD = 4096
M = 16
CANDIDATES = 64
BEAM = 96
BLOCK = 1024      # queries handed to a task at a time
EACH = 50         # every id divisible by this is a query
NEAREST = 5
INDEX = "shard long, size int, dims int, vectors binary, ids binary, counts binary, levels binary, links binary, layers array<int>"


# --- the graph ------------------------------------------------------------------------------------------------------------

class Graph:
    """Unit vectors, for each layer its members and their neighbours (rows of a flat array)."""

    def __init__(self, units: np.ndarray, members: list[np.ndarray], links: list[np.ndarray]):
        self.units, self.members, self.links = units, members, links
        self.rows = []
        for own in members:
            row = np.full(len(units), -1, dtype=np.int64)
            row[own] = np.arange(len(own))
            self.rows.append(row)

    def search(self, query: np.ndarray, beam: int = BEAM) -> list[tuple[float, int]]:
        """The ``beam`` best (cosine, vector) found, best first."""
        units = self.units
        if not len(units):
            return []
        at = int(self.members[-1][0])
        best = float(units[at] @ query)
        for layer in range(len(self.members) - 1, 0, -1):
            while True:
                near = self.links[layer][self.rows[layer][at]]
                near = near[near >= 0]
                if not len(near):
                    break
                close = units[near] @ query
                top = int(close.argmax())
                if close[top] <= best:
                    break
                at, best = int(near[top]), float(close[top])
        seen = np.zeros(len(units), dtype=bool)
        seen[at] = True
        waiting, kept = [(-best, at)], [(best, at)]
        while waiting:
            far, here = heapq.heappop(waiting)
            if len(kept) >= beam and -far < kept[0][0]:
                break
            near = self.links[0][here]
            near = near[near >= 0]
            near = near[~seen[near]]
            if not len(near):
                continue
            seen[near] = True
            for score, other in zip((units[near] @ query).tolist(), near.tolist()):
                if len(kept) < beam:
                    heapq.heappush(kept, (score, other))
                elif score > kept[0][0]:
                    heapq.heapreplace(kept, (score, other))
                else:
                    continue
                heapq.heappush(waiting, (-score, other))
        return sorted(kept, reverse=True)


def _choose(point: int, near: np.ndarray, close: np.ndarray, units: np.ndarray, most: int) -> list[int]:
    """Up to ``most`` of the candidates (nearest first): each nearer to the point than to any chosen before; then the nearest of the others."""
    among = units[near] @ units[near].T
    chosen: list[int] = []
    worst = np.full(len(near), -np.inf, dtype=np.float32)
    left_out = []
    for i in range(len(near)):
        if worst[i] < close[i]:
            chosen.append(i)
            worst = np.maximum(worst, among[i])
            if len(chosen) == most:
                break
        else:
            left_out.append(i)
    return near[chosen + left_out[:max(0, most // 2 - len(chosen))]].tolist()


def build(units: np.ndarray, heights: np.ndarray) -> Graph:
    """Graph over unit vectors that enter in the given order; ``heights`` is the top layer of each."""
    members, links = [], []
    for layer in range(int(heights.max(initial=0)) + 1):
        own = np.flatnonzero(heights >= layer)
        most = 2 * M if layer == 0 else M
        inside = units[own]
        table = np.full((len(own), most), -1, dtype=np.int32)
        fill = np.zeros(len(own), dtype=np.int64)
        for begin in range(0, len(own), 512):
            block = inside[begin:begin + 512] @ inside[:begin + 512].T
            for offset in range(len(block)):
                new = begin + offset
                if not new:
                    continue
                row = block[offset, :new]
                near = np.argpartition(-row, CANDIDATES)[:CANDIDATES] if new > CANDIDATES else np.arange(new)
                near = near[np.argsort(-row[near], kind="stable")]
                for other in _choose(new, near, row[near], inside, M):
                    table[new, fill[new]] = other
                    fill[new] += 1
                    if fill[other] < most:
                        table[other, fill[other]] = new
                        fill[other] += 1
                    else:
                        around = np.r_[table[other], new]
                        close = inside[around] @ inside[other]
                        order = np.argsort(-close, kind="stable")
                        kept = _choose(other, around[order], close[order], inside, most)
                        table[other] = -1
                        table[other, :len(kept)] = kept
                        fill[other] = len(kept)
        members.append(own)
        links.append(np.where(table >= 0, own[table], -1))
    return Graph(units, members, links)


def _heights(ids: np.ndarray) -> np.ndarray:
    """Top layers: geometric with 1 / M, from a hash of the id."""
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    u = ((mixed >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)
    return np.floor(-np.log(u) / np.log(M)).astype(int)


# --- tables ---------------------------------------------------------------------------------------------------------------

def usable(vec: str) -> Column:
    """Not null, not empty, all components finite, and not all zero."""
    v = F.col(vec)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    return v.isNotNull() & F.coalesce(good, F.lit(False))


def _indexed(batch: pd.DataFrame) -> pd.DataFrame:
    """One row with the graph of a shard's vectors."""
    batch = batch.assign(first=[min(ids) for ids in batch["ids"]]).sort_values("first", ignore_index=True)
    out = []
    for dims, rows in batch.groupby(batch["vec"].map(len)):
        vectors = np.stack(rows["vec"].to_numpy()).astype(np.float64)
        # The largest component first, so that neither tiny nor huge ones are lost in the square.
        scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        units = (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)
        graph = build(units, _heights(rows["first"].to_numpy()))
        out.append({"shard": batch["shard"].iloc[0], "size": len(rows), "dims": dims, "vectors": vectors.tobytes(),
                    "ids": np.concatenate([np.sort(np.asarray(i, dtype=np.int64)) for i in rows["ids"]]).tobytes(),
                    "counts": np.array([len(i) for i in rows["ids"]], dtype=np.int32).tobytes(),
                    "levels": np.concatenate(graph.members).astype(np.int32).tobytes(),
                    "links": np.concatenate([t.ravel() for t in graph.links]).astype(np.int32).tobytes(),
                    "layers": [len(m) for m in graph.members]})
    return pd.DataFrame(out)


def distinct_vectors(vectors: DataFrame, keep: int) -> DataFrame:
    """(vec, ids): each different vector once, with its ``keep`` smallest ids, cut in the map tasks.

    Rows whose vector cannot be compared take no part; nor do null ids.
    """
    rows = vectors.filter(usable("vec") & F.col("id").isNotNull()).select("id", F.col("vec").cast("array<double>").alias("vec"))
    # -0.0 and 0.0 are one number.
    rows = rows.withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0))).withColumn("key", F.xxhash64("vec"))
    order = Window.partitionBy("key", "vec").orderBy("id")
    ranked = rows.distinct().withColumn("n", F.row_number().over(order)).filter(F.col("n") <= keep)
    return ranked.groupBy("vec").agg(F.collect_list("id").alias("ids"))


def index(vectors: DataFrame, keep: int = NEAREST + 1, shard: int = SHARD) -> tuple[DataFrame, int]:
    """The graphs of all rows (id, vec), one row for each shard and length of vector, written out; the number of shards."""
    distinct = saved(distinct_vectors(vectors, keep), "vectors")
    shards = max(1, -(-distinct.count() // shard))
    dealt = distinct.withColumn("shard", F.pmod(F.xxhash64("vec", F.lit(1)), F.lit(shards)))
    tasks = min(shards, 10_000)
    return saved(dealt.repartition(tasks, "shard").groupBy("shard").applyInPandas(_indexed, INDEX), "graphs"), shards


def _loaded(row) -> tuple[Graph, np.ndarray, list[np.ndarray]]:
    vectors = np.frombuffer(row.vectors, dtype=np.float64).reshape(row.size, row.dims)
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    units = (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)
    levels, links = np.frombuffer(row.levels, dtype=np.int32), np.frombuffer(row.links, dtype=np.int32)
    members, tables, at, from_link = [], [], 0, 0
    for layer, n in enumerate(row.layers):
        most = 2 * M if layer == 0 else M
        members.append(levels[at:at + n].astype(np.int64))
        tables.append(links[from_link:from_link + n * most].reshape(n, most).astype(np.int64))
        at, from_link = at + n, from_link + n * most
    ids = np.split(np.frombuffer(row.ids, dtype=np.int64), np.cumsum(np.frombuffer(row.counts, dtype=np.int32))[:-1])
    return Graph(units, members, tables), vectors, ids


def _searched(k: int, beam: int):
    def run(key, graphs: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        loaded = {row.dims: _loaded(row) for row in graphs.itertuples(index=False)}
        out = []
        for name, vec in zip(queries["id"].tolist(), queries["vec"]):
            vec = np.asarray(vec, dtype=np.float64)
            if len(vec) not in loaded:
                continue
            graph, vectors, ids = loaded[len(vec)]
            unit = vec / np.abs(vec).max()
            unit /= np.linalg.norm(unit)
            found = graph.search(unit.astype(np.float32), beam)
            near = np.array([i for _, i in found], dtype=np.int64)
            scores = cosines(vectors[near], vec)
            rows = sorted((-s, int(i)) for s, place in zip(scores.tolist(), near.tolist()) for i in ids[place].tolist() if i != name)[:k]
            out += [(name, i, -s) for s, i in rows]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
    return run


def cosines(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosines of the rows of ``vectors`` with ``query``, in double precision, after division by the largest component."""
    scaled, own = vectors / np.abs(vectors).max(axis=1, keepdims=True), query / np.abs(query).max()
    return (scaled @ own) / (np.sqrt((scaled * scaled).sum(axis=1)) * np.sqrt(own @ own))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = NEAREST, beam: int = BEAM, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each query but itself, best first, ties by id.

    Both tables have columns (id, vec). Vectors that are null, empty, zero or hold null
    or non-finite components take no part, on either side; vectors are compared with those of their own
    length. Repeated rows count once. Empty tables give an empty result.
    """
    graphs, shards = index(vectors, k + 1, shard)
    asked = queries.filter(usable("vec") & F.col("id").isNotNull()).select("id", F.col("vec").cast("array<double>").alias("vec")).distinct()
    asked = saved(asked, "queries")
    blocks = max(1, -(-asked.count() // BLOCK))
    block = F.pmod(F.xxhash64("id", F.lit(9)), F.lit(blocks)).cast("int").alias("block")
    # A task is one shard's graphs with one block of queries: a stated query set against all rows, in blocks.
    sent = asked.select("id", "vec", block, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))
    held = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    tasks = max(1, min(shards * blocks, 10_000))
    sent, held = sent.repartition(tasks, "shard", "block"), held.repartition(tasks, "shard", "block")
    found = held.groupBy("shard", "block").cogroup(sent.groupBy("shard", "block")).applyInPandas(
        _searched(k, beam), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest_of_every(vectors: DataFrame, each: int = EACH) -> DataFrame:
    """:func:`nearest` for the rows whose id is divisible by ``each``."""
    return nearest(vectors, vectors.filter(F.col("id") % each == 0))
