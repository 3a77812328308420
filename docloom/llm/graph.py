"""Connected components of an edge table, by alternating large and small stars; nothing is collected to the driver."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import tidy
from docloom.sources.store import drop_stored, stored

#: Edges of one node that a task handles together at least; a node with more is split over salts.
SPLIT = 4096
MOST_HOT = 50_000
#: Edges that a task contracts by itself, in numpy.
ALONE = 1 << 18


def _edges(u, v, moved):
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(moved)], names=["u", "v", "moved"])


def _groups(batches):
    """Edges sorted by node, salt and other end, batch by batch without repeats: u, v, and the first v of each one's group.

    Only the last edge and the first of its group are carried from one batch to the next, whatever the partition holds.
    """
    last, least = None, 0
    for batch in batches:
        u, v, salt = (batch.column(n).to_numpy() for n in ("u", "v", "salt"))
        if not len(u):
            continue
        new = np.concatenate([[last is None or (u[0], salt[0]) != last[:2]], (u[1:] != u[:-1]) | (salt[1:] != salt[:-1])])
        fresh = np.concatenate([[last is None or (u[0], salt[0], v[0]) != last], new[1:] | (v[1:] != v[:-1])])
        first = np.maximum.accumulate(np.where(new, np.arange(len(u)), -1))
        start = np.where(first < 0, least, v[first])
        last, least = (u[-1], salt[-1], v[-1]), start[-1]
        yield u[fresh], v[fresh], start[fresh], new[fresh]


def _stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node that these edges lead to) for each node of the edges."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b, least = at[: len(u)], at[len(u) :], np.arange(len(ids))
    while True:
        x, y = least[a], least[b]
        apart = x != y
        if not apart.any():
            return ids, ids[least]
        a, b = a[apart], b[apart]
        np.minimum.at(least, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while not np.array_equal(least, further := least[least]):
            least = further


def _contract(alone: int):
    """A task's edges as stars, for each `alone` edges: the same connections with an edge for each node."""

    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            n += batch.num_rows
            if n >= alone:
                ids, least = _stars(*map(np.concatenate, zip(*held, strict=True)))
                yield _edges(ids, least, np.ones(len(ids), bool))
                held, n = [], 0
        if held:
            ids, least = _stars(*map(np.concatenate, zip(*held, strict=True)))
            yield _edges(ids, least, np.ones(len(ids), bool))

    return run


def _large_star(batches):
    """Each node gives its larger neighbours the smallest node near it."""
    for u, v, start, _ in _groups(batches):
        keep = v > u
        least = np.minimum(start, u)[keep]
        yield _edges(v[keep], least, least < u[keep])


def _small_star(batches):
    """Each node and its smaller neighbours get the smallest of these."""
    for u, v, start, new in _groups(batches):
        rest = ~new
        yield _edges(np.concatenate([v[rest], u[new]]), np.concatenate([start[rest], v[new]]), np.concatenate([np.ones(rest.sum(), bool), np.zeros(new.sum(), bool)]))


def _dealt(edges: DataFrame, f) -> DataFrame:
    """Edges (u, v) dealt out by u, a node with many edges over salts; its parts work like nodes of their own, which keeps
    all connections and costs at most further rounds. The nodes told to the executors are at most MOST_HOT."""
    most = max(SPLIT, -(-edges.count() // MOST_HOT))
    hot = edges.groupBy(F.col("u").alias("x")).agg(F.ceil(F.count("*") / most).alias("parts")).where("parts > 1")
    salted = edges.join(F.broadcast(hot), F.col("u") == F.col("x"), "left").select("u", "v", F.coalesce(F.pmod(F.xxhash64("v"), F.col("parts")), F.lit(0)).cast("long").alias("salt"))
    return salted.repartition("u", "salt").sortWithinPartitions("u", "salt", "v").mapInArrow(tidy(f), "u bigint, v bigint, moved boolean")


def components(edges: DataFrame, alone: int = ALONE) -> DataFrame:
    """(id, component) for each id in `edges` (columns u and v, a stored frame): the smallest id that links lead to.

    First each task contracts about `alone` edges to stars, which is all if there are no more. Then a round lets every node
    give its neighbours the smallest node near it, first the larger, then the smaller ones; the last is one that moves no edge. Rounds grow with the logarithm of the longest chain. Each round's table is stored in the
    shared folder, so a lost executor costs no more than the round. Loops and repeated edges count for nothing.
    """
    spark = edges.sparkSession
    edges = edges.where("u <> v").select("u", "v")
    n = edges.count()
    # One task that gets all edges contracts them together; several, in parts of whole batches.
    now, path = stored(edges.coalesce(max(1, -(-n // alone))).mapInArrow(tidy(_contract(alone if n > alone else n + 1)), "u bigint, v bigint, moved boolean"))
    if n <= alone:
        return now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    now = now.where("u <> v")
    moved = True
    while moved:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large, p1 = stored(_dealt(both, _large_star))
        small, p2 = stored(_dealt(large.select("u", "v"), _small_star))
        moved = not large.where("moved").isEmpty() or not small.where("moved").isEmpty()
        drop_stored(spark, path, p1)
        now, path = small, p2
    stars = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
