"""Largest inner products by hierarchical navigable small-world graphs, one per shard.

Equal vectors are one node that carries the smallest ids of its copies (as many
as an answer can hold, one more for the query itself), so a vector that
fills a third of the table is one node. Nodes are dealt to shards by a hash of
the vector; the number of shards follows the number of nodes. Every shard
builds its graph in one task and stores it as a row of flat arrays: vectors, the sizes of the layers, and per
layer a padded matrix of neighbours. Queries, in blocks, meet every shard. A shard's blocks
are dealt to lanes of LANE_BLOCKS blocks; a lane is the shard's row followed by its blocks in one sorted
partition, so a task decodes a shard once for thousands of queries, holds one shard and one block at a
time, and no lane grows with the queries. A shard's answers are exact scores of the nodes that its
graph search found, and the best ``k`` of all shards remain.

The graph is searched in lockstep for many queries at a time, which turns the
search into numpy operations on (queries x neighbours) matrices. Inner
products are made a nearest-neighbour problem by one more coordinate,
sqrt(max norm**2 - norm**2), which gives all nodes the same length. Nodes are inserted layer by layer
from the top, in batches; neighbours are chosen by the usual diversity rule (a candidate stays if
it is closer to the node than to any neighbour kept before).

Defined results: vectors that are null, zero, or hold null, NaN or infinite
components take no part, neither as queries nor as candidates; rows without
vec_id neither; rows with equal vec_id and vector are one row. Vectors of different lengths never meet. Ties
go to the smaller vec_id. Fewer than k candidates give fewer rows; an empty
table gives none; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskbook.llm.common import stored
from riskbook.llm.text_arrays import U64, mix

SHARD_NODES = 8192
QUERY_BLOCK = 512
LANE_BLOCKS = 16
MOST_TASKS = 20_000  # of a search; a task then takes several lanes in turn
NEIGHBOURS = 16  # of a node on an upper layer; the lowest layer has twice as many
EF_BUILD, EF_SEARCH = 48, 160
BATCH = 512
SMALL = 96  # layers of at most so many nodes are searched whole
EXPAND = 4


def _diverse(own: np.ndarray, ids: np.ndarray, sims: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of each row's candidates (best first, -1 for none) by the diversity rule, filled up with the next best."""
    rows, width = ids.shape
    between = np.einsum("bid,bjd->bij", vectors[ids], vectors[ids])
    usable = (ids >= 0) & (ids != own[:, None])
    kept = np.zeros((rows, width), dtype=bool)
    closest = np.full((rows, width), -np.inf)  # to any kept neighbour
    for j in range(width):
        take = usable[:, j] & (sims[:, j] > closest[:, j]) & (kept.sum(axis=1) < most)
        kept[:, j] = take
        closest = np.where(take[:, None], np.maximum(closest, between[:, j, :]), closest)
    order = np.argsort(np.where(kept, 0, np.where(usable, 1, 2)), axis=1, kind="stable")[:, :most]
    out = np.where(np.take_along_axis(usable, order, axis=1), np.take_along_axis(ids, order, axis=1), -1)
    return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)


def _best_first(ids: np.ndarray, sims: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(-sims, axis=1, kind="stable")[:, :most]
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)


def beam_search(queries: np.ndarray, vectors: np.ndarray, neighbours: np.ndarray, entry: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and similarities (best first, -1 and -inf where fewer) of the ``ef`` nearest nodes found for each query."""
    n, rows = len(neighbours), len(queries)
    visited = np.zeros((rows, n + 1), dtype=bool)
    visited[:, n] = True  # place of the id -1
    at = np.arange(rows)[:, None]
    sims = np.where(entry >= 0, np.einsum("bd,bkd->bk", queries, vectors[entry]), -np.inf)
    visited[at, entry] = True
    ids, sims = _best_first(entry, sims, ef)
    done = ids < 0
    active = np.arange(rows)
    while len(active):
        open_sims = np.where(done[active], -np.inf, sims[active])
        step = min(EXPAND, ids.shape[1])
        pick = np.argpartition(-open_sims, step - 1, axis=1)[:, :step] if open_sims.shape[1] > step else np.tile(np.arange(step), (len(active), 1))
        fresh = np.take_along_axis(open_sims, pick, axis=1) > -np.inf
        go = fresh.any(axis=1)
        active, pick, fresh = active[go], pick[go], fresh[go]
        if not len(active):
            break
        row = active[:, None]
        done[row, pick] = True
        near = neighbours[np.where(fresh, ids[row, pick], 0)]
        near = np.where(fresh[:, :, None], near, -1).reshape(len(active), -1)
        near.sort(axis=1)
        again = np.zeros_like(near, dtype=bool)
        again[:, 1:] = near[:, 1:] == near[:, :-1]
        near[again | visited[row, near]] = -1
        visited[row, near] = True
        width = int((near >= 0).sum(axis=1).max())
        if width == 0:
            continue
        near = np.sort(near, axis=1)[:, ::-1][:, :width]
        close = np.where(near >= 0, np.einsum("bd,bkd->bk", queries[active], vectors[near]), -np.inf)
        all_ids, all_sims = np.concatenate((ids[active], near), axis=1), np.concatenate((sims[active], close), axis=1)
        all_done = np.concatenate((done[active], near < 0), axis=1)
        order = np.argsort(-all_sims, axis=1, kind="stable")[:, :ef]
        width = order.shape[1]
        if width > ids.shape[1]:
            grow = ((0, 0), (0, width - ids.shape[1]))
            ids, sims, done = np.pad(ids, grow, constant_values=-1), np.pad(sims, grow, constant_values=-np.inf), np.pad(done, grow, constant_values=True)
        ids[active, :width] = np.take_along_axis(all_ids, order, axis=1)
        sims[active, :width] = np.take_along_axis(all_sims, order, axis=1)
        done[active, :width] = np.take_along_axis(all_done, order, axis=1)
    return ids, sims


class Graph:
    """Layers from the lowest up; layer l holds the first ``sizes[l]`` nodes."""

    def __init__(self, vectors: np.ndarray, sizes: list[int], layers: list[np.ndarray]):
        self.vectors, self.sizes, self.layers = vectors, sizes, layers

    @classmethod
    def build(cls, points: np.ndarray, keys: np.ndarray, ef: int = EF_BUILD) -> tuple[Graph, np.ndarray]:
        """The graph of the points, and the order of the points in it. ``keys`` decide the nodes' layers."""
        norms = np.einsum("ij,ij->i", points, points)
        extra = np.sqrt(np.maximum(norms.max() - norms, 0))
        vectors = np.concatenate((points, extra[:, None]), axis=1) / np.sqrt(norms.max())
        uniform = ((mix(keys.astype(np.int64).view(U64) + U64(0x9E3779B97F4A7C15)) >> U64(11)).astype(np.float64) + 1) * 2.0**-53
        level = np.floor(-np.log(uniform) / np.log(NEIGHBOURS)).astype(int)
        order = np.lexsort((keys, -level))
        level, vectors = level[order], np.ascontiguousarray(vectors[order], dtype=np.float32)
        sizes = [int((level >= k).sum()) for k in range(level.max() + 1)]
        graph = cls(vectors, sizes, [np.full((s, 2 * NEIGHBOURS if k == 0 else NEIGHBOURS), -1, dtype=np.int32) for k, s in enumerate(sizes)])
        for k in range(len(sizes) - 1, -1, -1):
            graph._fill(k, ef)
        return graph, order

    def _fill(self, k: int, ef: int) -> None:
        layer, vectors = self.layers[k], self.vectors
        size, most = layer.shape
        first = min(size, SMALL)
        sims = vectors[:first] @ vectors[:first].T
        ids, close = _best_first(np.tile(np.arange(first), (first, 1)), sims, ef + 1)
        layer[:first] = _diverse(np.arange(first), ids, close, vectors, most)
        at = first
        while at < size:
            new = np.arange(at, min(size, at + min(BATCH, at)))
            queries = vectors[new]
            ids, close = beam_search(queries, vectors, layer[:at], self._entry(queries, k, at), ef)
            # Nodes of the same batch are candidates too.
            mates = np.tile(new, (len(new), 1))
            with_mates = queries @ queries.T
            np.fill_diagonal(with_mates, -np.inf)
            mates, with_mates = _best_first(mates, with_mates, NEIGHBOURS)
            ids, close = _best_first(np.concatenate((ids, np.where(with_mates > -np.inf, mates, -1)), axis=1), np.concatenate((close, with_mates), axis=1), ef)
            chosen = _diverse(new, ids, close, vectors, most)
            layer[new] = chosen
            self._link_back(layer, np.repeat(new, most), chosen.ravel())
            at = int(new[-1]) + 1

    def _link_back(self, layer: np.ndarray, source: np.ndarray, target: np.ndarray) -> None:
        source, target = source[target >= 0], target[target >= 0]
        sims = np.einsum("ij,ij->i", self.vectors[source], self.vectors[target])
        order = np.lexsort((-sims, target))
        source, target = source[order], target[order]
        nodes, begin, count = np.unique(target, return_index=True, return_counts=True)
        most = layer.shape[1]
        place = np.arange(len(target)) - np.repeat(begin, count)
        close = place < most  # more links back than that could not stay
        added = np.full((len(nodes), most), -1, dtype=np.int64)
        added[np.repeat(np.arange(len(nodes)), count)[close], place[close]] = source[close]
        for i in range(0, len(nodes), BATCH):
            own, ids = nodes[i : i + BATCH], np.concatenate((layer[nodes[i : i + BATCH]], added[i : i + BATCH]), axis=1)
            ids = np.sort(ids, axis=1)
            ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
            sims = np.where(ids >= 0, np.einsum("bd,bkd->bk", self.vectors[own], self.vectors[ids]), -np.inf)
            ids, sims = _best_first(ids, sims, 2 * most)
            layer[own] = _diverse(own, ids, sims, self.vectors, most)

    def _entry(self, queries: np.ndarray, k: int, filled: int) -> np.ndarray:
        """Entry nodes of layer k: the nearest nodes that the layers above lead to."""
        entry = None
        for upper in range(len(self.sizes) - 1, k, -1):
            layer = self.layers[upper]
            if len(layer) <= SMALL or entry is None:
                sims = queries @ self.vectors[: min(len(layer), SMALL)].T
                entry = _best_first(np.tile(np.arange(sims.shape[1]), (len(queries), 1)), sims, 8)[0]
            if len(layer) > SMALL:
                entry = beam_search(queries, self.vectors, layer, entry, 8)[0]
        if entry is None or filled < self.sizes[min(k + 1, len(self.sizes) - 1)]:
            first = min(filled, SMALL)
            entry = _best_first(np.tile(np.arange(first), (len(queries), 1)), queries @ self.vectors[:first].T, 8)[0]
        return entry

    def search(self, points: np.ndarray, ef: int) -> np.ndarray:
        queries = np.concatenate((points, np.zeros((len(points), 1))), axis=1).astype(np.float32)
        return beam_search(queries, self.vectors, self.layers[0], self._entry(queries, 0, self.sizes[0]), ef)[0]


def usable(vector: str) -> Column:
    """The vector is not null, has only finite components, and is not zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(odd, F.lit(True)) & F.exists(vector, lambda x: x != 0)


INDEX = "shard int, dim int, n int, sizes array<int>, layers array<binary>, vectors binary, points binary, first array<int>, ids array<long>"


def build_index(rows: DataFrame, copies: int, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """One row of flat arrays per shard for ``rows`` (vec_id, vector array<double>, all usable)."""
    keyed = rows.select("vec_id", "vector", F.xxhash64("vector").alias("v1"), F.xxhash64(F.lit(1), "vector").alias("v2"))
    # The smallest ids of each vector; the rank limit is applied by each task before the shuffle.
    few = keyed.select("v1", "v2", "vec_id").distinct().withColumn("place", F.row_number().over(Window.partitionBy("v1", "v2").orderBy("vec_id"))).where(F.col("place") <= copies)
    few = few.groupBy("v1", "v2").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = stored(keyed.groupBy("v1", "v2").agg(F.any_value("vector").alias("vector")).join(few, ["v1", "v2"]), "ann-nodes")
    dims = nodes.groupBy(F.size("vector").alias("dim")).agg(F.ceil(F.count("*") / shard_nodes).alias("shards"))
    # Shards of one length are numbered after those of the shorter ones; there is one row per length.
    dims = dims.withColumn("base", F.coalesce(F.sum("shards").over(Window.orderBy("dim").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    sharded = nodes.withColumn("dim", F.size("vector")).join(dims, "dim").withColumn("shard", (F.col("base") + F.pmod("v1", "shards")).cast("int"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        firsts = pdf["ids"].map(lambda x: x[0])
        pdf = pdf.iloc[np.argsort(firsts.to_numpy(), kind="stable")]
        points = np.array(pdf["vector"].tolist(), dtype=np.float64)
        keys = pdf["ids"].map(lambda x: x[0]).to_numpy()
        graph, order = Graph.build(points, keys)
        ids = [np.asarray(pdf["ids"].iloc[i], dtype=np.int64) for i in order]
        first = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
        row = [int(pdf["shard"].iloc[0]), points.shape[1], len(points), graph.sizes, [x.astype("<i4").tobytes() for x in graph.layers], graph.vectors.astype("<f4").tobytes(), points[order].astype("<f8").tobytes(), first.tolist(), np.concatenate(ids).tolist()]
        return pd.DataFrame([row], columns=[c.split()[0] for c in INDEX.split(", ")])

    return sharded.select("shard", "vector", "ids").groupBy("shard").applyInPandas(build, INDEX)


def load_shard(row: dict) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    """Graph, original vectors, and the ids of each node, from a row of the index."""
    n, dim = row["n"], row["dim"]
    vectors = np.frombuffer(row["vectors"], "<f4").reshape(n, dim + 1)
    layers = [np.frombuffer(x, "<i4").reshape(s, -1) for x, s in zip(row["layers"], row["sizes"], strict=True)]
    return Graph(vectors, list(row["sizes"]), layers), np.frombuffer(row["points"], "<f8").reshape(n, dim), np.asarray(row["first"]), np.asarray(row["ids"], dtype=np.int64)


def _answer(shard: tuple[Graph, np.ndarray, np.ndarray, np.ndarray], own: np.ndarray, vectors: np.ndarray, k: int, ef: int) -> pa.RecordBatch:
    """query_id, vec_id, score of the k nearest found in one shard for a block of queries."""
    graph, points, first, ids = shard
    found = graph.search(vectors, ef)
    out_q, out_v, out_s = [], [], []
    for q in range(len(own)):
        nodes = found[q][found[q] >= 0]
        score = points[nodes] @ vectors[q]
        counts = first[nodes + 1] - first[nodes]
        at = np.repeat(first[nodes] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        each, score = ids[at], np.repeat(score, counts)
        other = each != own[q]
        each, score = each[other], score[other]
        best = np.lexsort((each, -score))[:k]
        out_q.append(np.full(len(best), own[q]))
        out_v.append(each[best])
        out_s.append(score[best])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_q, out_v, out_s)], names=["query_id", "vec_id", "score"])


def search_index(index: DataFrame, queries: DataFrame, k: int, ef: int = EF_SEARCH, block: int = QUERY_BLOCK, lane: int = LANE_BLOCKS) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found for ``queries`` (vec_id, vector)."""
    lengths = index.groupBy("dim").agg(F.sort_array(F.collect_list("shard")).alias("shards"))
    n_blocks = max(1, -(-queries.count() // block))
    n_lanes = -(-n_blocks // lane)
    blocked = queries.select("vec_id", "vector", F.size("vector").alias("dim")).distinct().withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int"))
    blocks = blocked.groupBy("dim", "block").agg(F.collect_list(F.struct("vec_id", "vector")).alias("queries"))
    asked = blocks.join(lengths, "dim").select(F.explode("shards").alias("shard"), "block", "queries")
    asked = asked.select("shard", (F.col("block") % n_lanes).alias("lane"), "block", "queries", F.lit(None).cast(index.select(F.struct("*")).schema[0].dataType).alias("node"))
    # A shard goes once to each of its lanes, ahead of the lane's blocks.
    nodes = index.select("shard", F.explode(F.sequence(F.lit(0), F.lit(n_lanes - 1))).alias("lane"), F.lit(-1).alias("block"), F.lit(None).cast(blocks.schema["queries"].dataType).alias("queries"), F.struct(*index.columns).alias("node"))
    # The work is the search, not the bytes: partitions by the number of lanes, which are not joined by size.
    tasks = min(MOST_TASKS, max(int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * n_lanes * index.count()))
    work = nodes.unionByName(asked).repartition(tasks, "shard", "lane").sortWithinPartitions("shard", "lane", "block")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, loaded = None, None
        for batch in batches:
            numbers, blocks, asked, nodes = (batch.column(batch.schema.get_field_index(c)) for c in ("shard", "block", "queries", "node"))
            for i in range(batch.num_rows):
                if blocks[i].as_py() < 0:
                    if numbers[i].as_py() != loaded:
                        shard, loaded = load_shard(nodes[i].as_py()), numbers[i].as_py()
                    continue
                assert numbers[i].as_py() == loaded
                rows = asked[i].values
                own = rows.field("vec_id").to_numpy().astype(np.int64)
                yield _answer(shard, own, rows.field("vector").flatten().to_numpy().reshape(len(own), -1), k, ef)

    hits = work.mapInArrow(find, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.distinct().withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(embeddings: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """The k nearest other rows of every row where ``is_query`` holds (columns vec_id, embedding)."""
    rows = embeddings.where(usable("embedding") & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    index = stored(build_index(rows, copies=k + 1), "ann-index")
    return search_index(index, rows.where(is_query), k)
