"""Graphs of nearest neighbours by neighbour descent: neighbours of neighbours are joined until hardly an edge changes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.store import dropped, written


def closest(x: np.ndarray, k: int, fresh: np.ndarray | None = None, far: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, other, squared distance) of the k nearest others of each row of x; only pairs with a fresh one, and nearer than the row's far, if these are given."""
    away = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(away, np.inf)
    if fresh is not None:
        away[~(fresh[:, None] | fresh[None, :])] = np.inf
    if far is not None:
        away[away >= far[:, None]] = np.inf
    size = min(k, len(x) - 1)
    if size < 1:
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    near = np.argpartition(away, size - 1, axis=1)[:, :size]
    rows = np.repeat(np.arange(len(x)), size)
    some = np.isfinite(away[rows, near.ravel()])
    return rows[some], near.ravel()[some], away[rows, near.ravel()][some]


def joined_lists(groups: DataFrame, k: int) -> DataFrame:
    """(batch, a, b, d) of groups (batch, members: id, pc, far, fresh): each member's k nearest others of its group."""

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            at, members = lists.offsets.to_numpy(), lists.values
            ids, far, fresh = (members.field(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3))
            x = members.field(1).flatten().to_numpy(zero_copy_only=False).reshape(len(members), -1) if len(members) else np.empty((0, 0))
            parts = []
            for i, (lo, hi) in enumerate(zip(at, at[1:])):
                order = lo + np.argsort(ids[lo:hi])
                a, b, d = closest(x[order], k, fresh[order].astype(bool), far[order])
                parts.append((np.full(len(a), i), ids[order][a], ids[order][b], d))
            row, a, b, d = (np.concatenate(column) for column in zip(*parts)) if parts else (np.empty(0, int),) * 4
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(d, pa.float64())], names=["batch", "a", "b", "d"])

    return groups.mapInArrow(run, f"batch {groups.schema['batch'].dataType.simpleString()}, a long, b long, d double")


def nearest_of_each(edges: DataFrame, k: int, by: str = "a") -> DataFrame:
    """The k nearest edges of each node (batch, `by`); equal distances are ordered by a hash of the pair, so that equal points don't all choose the same ones."""
    order = W.partitionBy("batch", by).orderBy("d", F.xxhash64("a", "b"), "a", "b")
    return edges.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def neighbour_graph(points: DataFrame, k: int = 15, group: int = 100, rounds: int = 20, least_change: float = 0.001, seed: int = 42) -> DataFrame:
    """(batch, id, rank, neighbour, distance) of points (batch, id, pc array): the k nearest points of the same batch, all batches in one plan.

    It begins with the nearest among the `group` points that a hash put together, and those of a second hash: lists within groups of one alone would never leave them. Each round lays out every point's neighbours, as many of those that have it as
    neighbour (the nearest ones) and itself, compares all of a list that weren't together before, and keeps the k nearest; it ends when no more than
    least_change of the edges are new, or after `rounds`. So a list is bounded by 2 k + 1, whatever the batch. The graph is approximate:
    tests ask for a recall of 0.9 against all pairs. Batches are strings or numbers, null is one of them;
    ids are longs, unique within their batch; all arrays are of one length. A batch of k points or fewer gets all pairs, one point alone no edge.
    """
    name = F.struct(F.col("batch").alias("name"))  # null is a batch like any other
    kept = written(points.select(name.alias("batch"), F.col("id").cast("long").alias("id"), "pc").where("id is not null and pc is not null"), "points")
    sizes = kept.groupBy("batch").agg(F.count("*").alias("n")).select("batch", F.greatest(F.lit(1), F.ceil(F.col("n") / group)).alias("groups"))
    member = F.struct("id", "pc", F.lit(float("inf")).alias("far"), F.lit(True).alias("fresh"))
    hashed = F.array(*[F.struct(F.lit(i).alias("start"), F.pmod(F.xxhash64("id", F.lit(seed + i)), "groups").alias("group")) for i in range(2)])
    placed = kept.join(sizes, "batch").withColumn("in", F.explode(hashed))
    first = joined_lists(placed.groupBy("batch", "in").agg(F.collect_list(member).alias("members")).drop("in"), k)
    first = first.groupBy("batch", "a", "b").agg(F.min("d").alias("d"), F.lit(True).alias("fresh"))
    edges = written(nearest_of_each(first, k).drop("rank"), "edges")
    for _ in range(rounds):
        far = edges.groupBy("batch", F.col("a").alias("id")).agg(F.when(F.count("*") >= k, F.max("d")).otherwise(float("inf")).alias("far"))
        nodes = kept.join(far, ["batch", "id"], "left").select("batch", "id", "pc", F.coalesce("far", F.lit(float("inf"))).alias("far"))
        forward = edges.select("batch", F.col("a").alias("node"), F.col("b").alias("id"), "fresh")
        back = nearest_of_each(edges, k, "b").select("batch", F.col("b").alias("node"), F.col("a").alias("id"), "fresh")
        own = kept.select("batch", F.col("id").alias("node"), "id", F.lit(True).alias("fresh"))
        lists = forward.unionByName(back).unionByName(own).groupBy("batch", "node", "id").agg(F.max("fresh").alias("fresh"))
        members = lists.join(nodes, ["batch", "id"]).groupBy("batch", "node").agg(F.collect_list(F.struct("id", "pc", "far", "fresh")).alias("members"))
        found = joined_lists(members.drop("node"), k).withColumn("fresh", F.lit(True))
        known = edges.select("batch", "a", "b", "d", F.lit(False).alias("fresh"))
        both = known.unionByName(found).groupBy("batch", "a", "b").agg(F.min("d").alias("d"), F.min("fresh").alias("fresh"))
        after = written(nearest_of_each(both, k).drop("rank"), "edges")
        dropped(edges)
        edges = after
        n = edges.agg(F.count("*").alias("all"), F.count_if("fresh").alias("new")).first()
        if n.new <= least_change * n.all:
            break
    dropped(kept)
    return nearest_of_each(edges, k).select("batch.name", "a", "rank", "b", F.round(F.sqrt("d"), 6).alias("distance")).toDF("batch", "id", "rank", "neighbour", "distance")
