"""Approximate nearest neighbours by robust-pruned directed graphs, one per shard.

Vectors are dealt to shards by a hash. A shard holds up to ``LARGEST`` distinct
vectors, some 100 MB with its graph; smaller tables have up to ``SPREAD``
shards of ``SMALLEST`` or more. Within a shard, the points are inserted in
rounds that grow: a beam search over the graph so far proposes neighbours for a
round's points, relaxed distance pruning keeps diverse ones (a candidate goes
when a kept neighbour is closer to it, by ``ALPHA``, than the point is), and
the edges are added both ways; a node is pruned again when it has half as many
edges more. Queries go to every shard in blocks, a beam search answers them
there, and the shards' answers are merged. A search computes a distance once:
a few per cent of a large shard's.

Equal vectors share a node, so copies cannot crowd the graph. No answer needs
more than the ``k + 1`` smallest ids of one vector (one may be the query's
own), so a vector's other copies are left out of the index, exactly.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SMALLEST, LARGEST, SPREAD = 1 << 14, 100_000, 64
DEGREE, BUILD_BEAM, QUERY_BEAM, ALPHA = 32, 64, 160, 1.2
#: Nodes that a search expands at once, and points of one round of insertions.
STEP, ROUND = 4, 512
#: Queries that meet a shard in one task, and that one numpy step searches for.
QUERY_BLOCK, STEP_BLOCK = 8192, 512


def beam_search(points: np.ndarray, edges: np.ndarray, entry: int, targets: np.ndarray, beam: int, counted: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For every target, the ``beam`` nearest nodes that a greedy search finds, nearest first, and their squared distances.

    ``edges`` is nodes x degree, -1 where there is none. All targets advance
    together; each expands its ``STEP`` nearest nodes not yet expanded, and a
    node's distance is computed once a target. ``counted`` gets the number of
    distances computed.
    """
    n, m = len(targets), len(points)
    ids = np.full((n, beam), -1, np.int64)
    near = np.full((n, beam), np.inf, np.float32)
    done = np.ones((n, beam), bool)
    seen = np.zeros((n, m + 1), bool)  # the last column takes the absent edges
    seen[:, m] = True
    seen[:, entry] = True
    ids[:, 0], done[:, 0] = entry, False
    near[:, 0] = ((points[entry] - targets) ** 2).sum(1)
    norms = np.einsum("nd,nd->n", points, points)
    own = np.einsum("nd,nd->n", targets, targets)
    active = np.arange(n)
    while len(active):
        unexpanded = np.where(done[active], np.inf, near[active])
        step = min(STEP, beam)
        pick = np.argpartition(unexpanded, step - 1, axis=1)[:, :step] if step < beam else np.broadcast_to(np.arange(beam), unexpanded.shape)
        live = np.isfinite(np.take_along_axis(unexpanded, pick, 1))
        going = live.any(1)
        active, pick, live = active[going], pick[going], live[going]
        if not len(active):
            break
        done[active[:, None], pick] = True
        found = np.where(live[:, :, None], edges[np.take_along_axis(ids[active], pick, 1)], -1).reshape(len(active), -1)
        found[found < 0] = m
        row, col = np.nonzero(~seen[active[:, None], found])
        node, whose = found[row, col], active[row]
        # two expanded nodes may share a neighbour: the first one counts
        _, first = np.unique(row * (m + 1) + node, return_index=True)
        row, node, whose = row[first], node[first], whose[first]
        seen[whose, node] = True
        if counted is not None:
            counted.append(len(node))
        far = norms[node] + own[whose] - 2 * np.einsum("fd,fd->f", points[node], targets[whose])
        # only what beats the beam's last matters
        better = far < near[whose].max(1)
        row, node, far = row[better], node[better], far[better]
        counts = np.bincount(row, minlength=len(active))
        place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        wide = int(counts.max(initial=0))
        if not wide:
            continue
        new_near = np.full((len(active), wide), np.inf, np.float32)
        new_ids = np.full((len(active), wide), -1, np.int64)
        new_near[row, place], new_ids[row, place] = far, node
        all_near = np.concatenate([near[active], new_near], 1)
        order = np.argpartition(all_near, beam - 1, axis=1)[:, :beam]
        near[active] = np.take_along_axis(all_near, order, 1)
        ids[active] = np.take_along_axis(np.concatenate([ids[active], new_ids], 1), order, 1)
        done[active] = np.take_along_axis(np.concatenate([done[active], new_ids < 0], 1), order, 1)
    order = near.argsort(1, kind="stable")
    near = np.take_along_axis(near, order, 1)
    return np.where(np.isfinite(near), np.take_along_axis(ids, order, 1), -1), near


def robust_prune(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """The kept neighbours of each point ``own[i]`` from ``candidates[i]`` (-1: none; repeats allowed), nearest first."""
    n, c = candidates.shape
    valid = (candidates >= 0) & (candidates != own[:, None])
    at = np.where(valid, candidates, 0)
    vectors = points[at] - points[own][:, None, :]  # as seen from the point
    far = np.where(valid, np.einsum("ncd,ncd->nc", vectors, vectors), np.inf)
    order = far.argsort(1, kind="stable")
    at, far = np.take_along_axis(at, order, 1), np.take_along_axis(far, order, 1)
    vectors = np.take_along_axis(vectors, order[:, :, None], 1)
    norms = np.einsum("ncd,ncd->nc", vectors, vectors)
    between = norms[:, :, None] + norms[:, None, :] - 2 * (vectors @ vectors.transpose(0, 2, 1))
    # candidate j, once kept, rules these out
    rules_out = (alpha**2 * between <= far[:, None, :]) | (at[:, :, None] == at[:, None, :])
    kept = np.full((n, degree), -1, np.int64)
    count = np.zeros(n, np.int64)
    alive = np.isfinite(far)
    for j in range(c):
        rows = np.flatnonzero(alive[:, j] & (count < degree))
        if len(rows):
            kept[rows, count[rows]] = at[rows, j]
            count[rows] += 1
            alive[rows] &= ~rules_out[rows, j]
    return kept


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """Edges (nodes x half as many again as ``degree``) and the entry node, the one nearest to the mean."""
    n = len(points)
    edges = np.full((n, degree + degree // 2), -1, np.int64)
    entry = int(((points - points.mean(0)) ** 2).sum(1).argmin())
    order = np.random.default_rng(0).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    done = 1
    while done < n:  # a round is at most half as large as the graph it searches
        batch = order[done : done + max(1, min(done // 2, ROUND))]
        found, _ = beam_search(points, edges, entry, points[batch], min(beam, n))
        edges[batch, :degree] = robust_prune(points, batch, found, degree, alpha)
        _add_back(points, edges, batch, degree, alpha)
        done += len(batch)
    return edges, entry


def _add_back(points: np.ndarray, edges: np.ndarray, batch: np.ndarray, degree: int, alpha: float) -> None:
    """Every new edge also leads back; a node without room for more is pruned to ``degree`` again."""
    source = np.repeat(batch, edges.shape[1])
    target = edges[batch].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = target.argsort(kind="stable")
    source, target = source[order], target[order]
    nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
    for begin in range(0, len(nodes), 512):
        part = slice(begin, begin + 512)
        new = np.full((len(nodes[part]), counts[part].max()), -1, np.int64)
        row = np.repeat(np.arange(len(nodes[part])), counts[part])
        lo, hi = first[part][0], first[part][-1] + counts[part][-1]
        new[row, np.arange(lo, hi) - np.repeat(first[part], counts[part])] = source[lo:hi]
        both = np.concatenate([edges[nodes[part]], new], 1)
        both = np.take_along_axis(both, (both < 0).argsort(1, kind="stable"), 1)
        both = both[:, : (both >= 0).sum(1).max()]
        room = (both >= 0).sum(1) <= edges.shape[1]
        width = min(both.shape[1], edges.shape[1])
        edges[nodes[part][room], :width] = both[room, :width]
        if (~room).any():
            pruned = nodes[part][~room]
            edges[pruned] = -1
            edges[pruned, :degree] = robust_prune(points, pruned, both[~room], degree, alpha)


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unpacked(blob: bytes, dimension: int) -> np.ndarray:
    return np.frombuffer(blob, np.float64).reshape(-1, dimension)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding",
    shard_size: int | None = None, degree: int = DEGREE, build_beam: int = BUILD_BEAM, query_beam: int = QUERY_BEAM,
) -> DataFrame:
    """Each query's ``k`` nearest found: query_id, ``rank`` from 1, the id, ``score`` (Euclidean distance, double).

    Nearest first, ties to the smaller id; the query's own id is no candidate.
    Fewer candidates than ``k`` are all returned if the shards hold at most
    ``query_beam`` vectors each. Vectors that are null, zero, or hold a null
    or non-finite component take no part, and a vector only meets those of its
    own dimension. Ids are unique; repeated rows count once. Null ids take no
    part. Empty tables give no rows; other columns are ignored.
    """
    tidy = lambda df: df.where(F.col(id_column).isNotNull() & usable(F.col(vector_column))).select(
        F.col(id_column).cast("long").alias("_id"), F.transform(vector_column, lambda x: x.cast("double")).alias("_vector"))
    # Spark groups -0.0 with 0.0, as distances do
    points = tidy(vectors).dropDuplicates(["_id"]).withColumn("_dim", F.size("_vector")).withColumn("_key", F.xxhash64("_vector"))
    smallest = Window.partitionBy("_key", "_vector").orderBy("_id")
    points = written(points.withColumn("_copy", F.row_number().over(smallest)).where(F.col("_copy") <= k + 1).select("_id", "_vector", "_dim", "_key"), "ann-points")
    size = F.lit(shard_size) if shard_size else F.least(F.lit(LARGEST), F.greatest(F.lit(SMALLEST), F.ceil(F.col("_n") / SPREAD)))
    shards = points.groupBy("_dim").agg(F.countDistinct("_key").alias("_n")).select(
        "_dim", F.greatest(F.lit(1), F.ceil(F.col("_n") / size)).cast("int").alias("_shards"))
    # building is work, not bytes, so the number of tasks follows the shards and not the data's size
    tasks = 2 * min(10_000, shards.agg(F.coalesce(F.sum("_shards"), F.lit(1))).first()[0])
    # salted, so that the shard is no function of the hash that dealt the rows
    dealt = points.join(shards, "_dim").withColumn("_shard", F.pmod(F.xxhash64("_key", F.lit(1)), F.col("_shards")).cast("int"))

    def build(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_id")
        matrix = np.stack(frame["_vector"].to_numpy()) + 0.0
        distinct, node = np.unique(matrix, axis=0, return_inverse=True)
        order = np.lexsort((frame["_id"].to_numpy(), node.ravel()))
        edges, entry = build_graph(distinct.astype(np.float32), min(degree, max(1, len(distinct) - 1)), build_beam)
        starts = np.searchsorted(node.ravel()[order], np.arange(len(distinct) + 1))
        return pd.DataFrame({
            "_dim": [int(key[0])], "_shard": [int(key[1])], "_points": [distinct.tobytes()], "_edges": [edges.tobytes()], "_entry": [entry],
            "_ids": [frame["_id"].to_numpy(np.int64)[order].tobytes()], "_starts": [starts.astype(np.int64).tobytes()]})

    graphs = written(dealt.repartition(tasks, "_dim", "_shard").groupBy("_dim", "_shard").applyInPandas(
        build, "_dim int, _shard int, _points binary, _edges binary, _entry int, _ids binary, _starts binary"), "ann-graphs")

    asked = written(tidy(queries).dropDuplicates(["_id"]).withColumn("_dim", F.size("_vector")), "ann-queries")
    blocks = max(1, math.ceil(asked.count() / QUERY_BLOCK))
    # every query goes to every shard of its dimension, as blocks of rows
    routed = (
        asked.withColumn("_block", F.pmod(F.xxhash64("_id"), F.lit(blocks)).cast("int")).join(shards, "_dim")
        .select("_dim", "_block", "_id", "_vector", F.explode(F.sequence(F.lit(0), F.col("_shards") - 1)).alias("_shard"))
    )
    copies = graphs.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(key: tuple, graph: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        dimension = int(key[0])
        if not len(graph) or not len(ask):
            return pd.DataFrame({"query_id": [], id_column: [], "score": []})
        g = graph.iloc[0]
        exact = _unpacked(g["_points"], dimension)
        rough = exact.astype(np.float32)
        edges = np.frombuffer(g["_edges"], np.int64).reshape(len(exact), -1)
        ids, starts = np.frombuffer(g["_ids"], np.int64), np.frombuffer(g["_starts"], np.int64)
        query_ids, targets = ask["_id"].to_numpy(np.int64), np.stack(ask["_vector"].to_numpy())
        rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for begin in range(0, len(targets), STEP_BLOCK):
            target, own = targets[begin : begin + STEP_BLOCK], query_ids[begin : begin + STEP_BLOCK]
            found, _ = beam_search(rough, edges, int(g["_entry"]), target.astype(np.float32), min(query_beam, len(exact)))
            for i in range(len(target)):
                nodes = found[i][found[i] >= 0]
                score = np.sqrt(((exact[nodes] - target[i]) ** 2).sum(1))
                members = [ids[starts[n] : starts[n + 1]] for n in nodes]
                member = np.concatenate(members)
                score = np.repeat(score, [len(m) for m in members])
                other = member != own[i]
                member, score = member[other], score[other]
                best = np.lexsort((member, score))[:k]
                rows.append((np.full(len(best), own[i]), member[best], score[best]))
        return pd.DataFrame({name: np.concatenate(c) for name, c in zip(("query_id", id_column, "score"), zip(*rows))})

    meet = ("_dim", "_shard", "_block")
    answers = routed.repartition(tasks, *meet).groupBy(*meet)
    found = copies.repartition(tasks, *meet).groupBy(*meet).cogroup(answers).applyInPandas(search, f"query_id long, `{id_column}` long, score double")
    best = Window.partitionBy("query_id").orderBy("score", id_column)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", id_column, "score")
