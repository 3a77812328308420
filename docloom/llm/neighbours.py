"""Approximate nearest neighbours by cosine: stable projections to few dimensions, kd-trees, and a chi-square stop.

Vectors are brought to length 1 (there the order by cosine is that by distance) and projected by a seeded Gaussian matrix
to DIMS dimensions. For a pair at distance d, the projected distance squared over d squared is chi-square distributed with
DIMS degrees of freedom. A search takes projected neighbours in growing distance and verifies each on the original
vectors; it may stop once the next projected distance squared exceeds d_k squared times the chi-square quantile at CERTAIN,
d_k being the distance of the worst neighbour kept: one that is nearer still would be missed with probability 1 - CERTAIN.

Distributed: the upper levels of a kd-tree (fitted on a bounded sample) cut space into cells, as many as the rows ask for;
every row lies in a cell, and large cells are split over parts. A query first searches its own cell, which bounds d_k, then
all cells whose boxes the stopping test can't exclude; inside a part a kd-tree with small leaves is searched in order of the
leaves' boxes. The queries of a part are cut into chunks, each with the part's members, so that no task handles more than
PART members and about ASKED queries together. Equal vectors are stored once, with the few smallest ids that can ever be
asked for, so groups of copies cost nothing.

Defined results: vectors that are null, empty or zero or hold nulls or non-finite values take no part, nor do rows without
an id; ids are integers; only vectors of one length are compared; ties go to the smaller id; other columns are not looked at; a query that has fewer than k candidates gets
all of them; rows that share id and vector count once as candidates, and each asks for itself.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docloom.llm.common import join_by_counted_key, tidy
from docloom.sources.store import drop_stored, stored

DIMS, CERTAIN, LEAF, PART, ASKED = 16, 0.96, 64, 4096, 4096
#: The upper tree's depth at most, the vectors of the sample for each of its cells, and the sample's numbers at most (32 MB).
DEPTH, EACH, SAMPLE = 13, 8, 1 << 22


def chi_square_quantile(p: float, k: int) -> float:
    """Where the chi-square distribution with k degrees of freedom reaches p, by bisection on the series of its integral."""
    from math import exp, lgamma, log

    def below(x: float) -> float:
        term = total = 1.0 / (k / 2)
        n = k / 2
        while term > total * 1e-14:
            n += 1
            term *= x / 2 / n
            total += term
        return total * exp(-x / 2 + k / 2 * log(x / 2) - lgamma(k / 2))

    low, high = 1e-9, 100.0 + 10 * k
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return low


def split(points: np.ndarray, leaf: int, depth: int) -> tuple[list[tuple[int, float, int, int]], list[np.ndarray]]:
    """A kd-tree: nodes (dimension, cut, low, high; a negative child -i - 1 is leaf i) and the rows of each leaf."""
    nodes: list[tuple[int, float, int, int]] = []
    leaves: list[np.ndarray] = []

    def grow(rows: np.ndarray, level: int) -> int:
        spread = np.ptp(points[rows], axis=0) if len(rows) else np.zeros(1)
        d = int(spread.argmax())
        if len(rows) <= leaf or level == depth or spread[d] == 0:
            leaves.append(rows)
            return -len(leaves)
        cut = float(np.median(points[rows, d]))
        low = points[rows, d] <= cut
        if low.all():
            low = points[rows, d] < cut
        here = len(nodes)
        nodes.append((d, cut, 0, 0))
        a, b = grow(rows[low], level + 1), grow(rows[~low], level + 1)
        nodes[here] = (d, cut, a, b)
        return here

    grow(np.arange(len(points)), 0)
    return nodes, leaves


@dataclass
class Upper:
    """Projection and cells for vectors of one length."""

    projection: np.ndarray
    nodes: list[tuple[int, float, int, int]]
    low: np.ndarray | None = None  # corners of the cells' boxes, once all rows lie in them
    high: np.ndarray | None = None
    parts: np.ndarray | None = None

    def project(self, v: np.ndarray) -> np.ndarray:
        # Sums row by row, so equal vectors get equal projections wherever they stand.
        u = v / np.sqrt((v * v).sum(1))[:, None]
        return np.stack([(u * p).sum(1) for p in self.projection], 1)

    def cell(self, y: np.ndarray) -> np.ndarray:
        out = np.zeros(len(y), np.int64)
        if not self.nodes:
            return out
        at = np.zeros(len(y), np.int64)
        live = np.arange(len(y))
        table = np.array(self.nodes)
        while len(live):
            node = table[at[live]]
            low = y[live, node[:, 0].astype(int)] <= node[:, 1]
            at[live] = np.where(low, node[:, 2], node[:, 3]).astype(int)
            done = at[live] < 0
            out[live[done]] = -at[live[done]] - 1
            live = live[~done]
        return out


def depth_for(rows: int) -> int:
    """Levels of the upper tree, so that a cell has about PART rows."""
    return min(DEPTH, max(0, int(np.ceil(np.log2(max(1, rows) / PART)))))


def sample_size(rows: int, length: int) -> int:
    """Vectors that the upper tree is fitted on: EACH a cell, but no more than SAMPLE numbers in all."""
    return max(1, min(EACH << depth_for(rows), SAMPLE // length))


def fit(vectors: np.ndarray, rows: int, seed: int = 11) -> Upper:
    """A projection for vectors of this length and cells for `rows` of them, from a sample."""
    dims = min(DIMS, vectors.shape[1])
    projection = np.random.default_rng([seed, vectors.shape[1]]).normal(size=(dims, vectors.shape[1]))
    upper = Upper(projection, [])
    upper.nodes, _ = split(upper.project(vectors), EACH // 2, depth_for(rows))
    return upper


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long arrays as rows of doubles."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.float64) if n else np.zeros((0, 1))


def _by_length(column: pa.Array):
    sizes = np.array([len(x) for x in column], np.int64)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield int(size), rows, _matrix(column.take(pa.array(rows)))


class Part:
    """The members of one part, with a kd-tree over their projections."""

    def __init__(self, ids: list[list[int]], vectors: np.ndarray, upper: Upper):
        y = upper.project(vectors)
        _, leaves = split(y, LEAF, 40)
        order = np.concatenate(leaves) if leaves else np.zeros(0, np.int64)
        self.ids = [ids[i] for i in order]
        self.vectors, self.y = vectors[order], y[order]
        self.norms = np.sqrt((self.vectors * self.vectors).sum(1))
        self.bounds = np.cumsum([0, *map(len, leaves)])
        self.low = np.array([y[r].min(0) for r in leaves])
        self.high = np.array([y[r].max(0) for r in leaves])

    def search(self, q: np.ndarray, y: np.ndarray, keep: int, floor: float, quantile: float) -> list[tuple[float, int]]:
        """The `keep` best (score, id) with a score of `floor` at least, as far as the stopping test goes."""
        gap = np.maximum(np.maximum(self.low - y, y - self.high), 0)
        near = (gap * gap).sum(1)
        order, norm = np.argsort(near, kind="stable"), float(np.sqrt((q * q).sum()))
        best: list[tuple[float, int]] = []
        for i in range(0, len(order), 8):
            limit = _radius(floor, quantile)
            some = [k for k in order[i : i + 8] if near[k] <= limit]
            if not some:
                break  # no leaf from here on can pass the test
            rows = np.concatenate([np.arange(self.bounds[k], self.bounds[k + 1]) for k in some])
            step = self.y[rows] - y
            rows = rows[(step * step).sum(1) <= limit]
            scores = (self.vectors[rows] * q).sum(1) / (self.norms[rows] * norm)
            good = np.flatnonzero(scores >= floor)
            if len(good) > 4 * keep:
                good = good[scores[good] >= np.partition(scores[good], -keep)[-keep]]
            best += [(-float(scores[g]), n) for g in good for n in self.ids[rows[g]]]
            best = sorted(set(best))[:keep]
            if len(best) == keep:
                floor = max(floor, -best[-1][0])
        return [(-s, n) for s, n in best]


def _radius(score: float, quantile: float) -> float:
    """Largest projected distance squared that is still verified when the worst neighbour kept has this cosine."""
    return (max(0.0, 2 - 2 * score) + 1e-9) * quantile if score > -1 else np.inf


def _place(shared):
    def run(batches):
        for batch in batches:
            cells = [""] * batch.num_rows
            ys = [None] * batch.num_rows
            for size, rows, v in _by_length(batch.column("vec")):
                upper = shared.value[size]
                y = upper.project(v)
                for r, c, p in zip(rows, upper.cell(y), y, strict=True):
                    cells[r], ys[r] = f"{size}/{c}", p
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.string()), pa.array(ys, pa.list_(pa.float64()))], names=[*batch.schema.names, "cell", "y"])

    return run


def _visit(shared, quantiles, keep):
    """Rows sorted by cell, part, chunk and role: members (ids, vec), then queries (qid, vec, floor)."""

    def run(batches):
        key, ids, vectors, part = None, [], [], None
        for batch in batches:
            columns = {n: batch.column(n) for n in ("role", "qid", "floor", "ids")}
            cells = batch.column("cell").to_pylist()
            chunks = batch.column("chunk").to_numpy()
            parts, roles, qids, floors = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("part", "role", "qid", "floor"))
            found = []
            for i in range(batch.num_rows):
                if key != (cells[i], parts[i], chunks[i]):
                    key, ids, vectors, part = (cells[i], parts[i], chunks[i]), [], [], None
                v = batch.column("vec")[i].values.to_numpy(zero_copy_only=False).astype(np.float64)
                if roles[i] == 0:
                    ids.append(columns["ids"][i].as_py())
                    vectors.append(v)
                    continue
                if not ids:
                    continue
                upper = shared.value[len(v)]
                if part is None:
                    part = Part(ids, np.array(vectors), upper)
                y = upper.project(v[None])[0]
                found += [(int(qids[i]), n, s) for s, n in part.search(v, y, keep, float(floors[i]), quantiles[len(y)])]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.float64())], names=["qid", "vec_id", "score"])

    return run


def _route(shared, quantiles):
    """For each query, the cells that the stopping test can't exclude, but for its own."""

    def run(batches):
        for batch in batches:
            out = []
            for vec, home, floor in zip(batch.column("vec"), batch.column("cell").to_pylist(), batch.column("floor").to_pylist(), strict=True):
                v = vec.values.to_numpy(zero_copy_only=False).astype(np.float64)
                upper = shared.value[len(v)]
                y = upper.project(v[None])[0]
                gap = np.maximum(np.maximum(upper.low - y, y - upper.high), 0)
                own = int(home.split("/")[1])
                out.append([f"{len(v)}/{c}" for c in np.flatnonzero((gap * gap).sum(1) <= _radius(floor, quantiles[len(y)])) if c != own])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.string()))], names=[*batch.schema.names, "to"])

    return run


def nearest(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row whose id `every` divides."""
    spark, keep = vectors.sparkSession, k + 1
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    fine = F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).where(fine)

    # Each vector once, with the ids that can be asked for; each query vector once, with its number of askers.
    small = rows.withColumn("place", F.dense_rank().over(Window.partitionBy("vec").orderBy("vec_id"))).where(F.col("place") <= keep)
    distinct, path = stored(small.groupBy("vec").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")))
    asked = rows.where(F.col("vec_id") % every == 0)
    queries, _ = stored(asked.groupBy("vec").agg(F.min("vec_id").alias("qid"), F.count("*").alias("asks")))

    # The upper trees, one for each length of vectors, from a bounded sample; the boxes from all rows.
    lengths = {r["n"]: r["c"] for r in distinct.groupBy(F.size("vec").alias("n")).agg(F.count("*").alias("c")).collect()}
    uppers = {}
    for n, c in sorted(lengths.items()):
        some = distinct.where(F.size("vec") == n).select("vec").orderBy(F.xxhash64(F.element_at("ids", 1)), "ids").limit(sample_size(c, n)).collect()
        uppers[n] = fit(np.array([r["vec"] for r in some], np.float64).reshape(len(some), n), c)
    quantiles = {d: chi_square_quantile(CERTAIN, d) for d in {len(u.projection) for u in uppers.values()}}
    first = spark.sparkContext.broadcast(uppers)
    placed, path2 = stored(distinct.select("ids", "vec").mapInArrow(_place(first), "ids array<bigint>, vec array<double>, cell string, y array<double>"))
    corner = lambda f, i: f(F.get("y", F.lit(i)))
    boxes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.array(*[corner(F.min, i) for i in range(DIMS)]).alias("low"), F.array(*[corner(F.max, i) for i in range(DIMS)]).alias("high")).collect()
    for n, u in uppers.items():
        cells, dims = 1 + sum(1 for node in u.nodes for c in node[2:] if c < 0) if u.nodes else 1, len(u.projection)
        u.low, u.high, u.parts = np.full((cells, dims), np.inf), np.full((cells, dims), -np.inf), np.ones(cells, int)
        for b in boxes:
            size, c = map(int, b["cell"].split("/"))
            if size == n:
                u.low[c], u.high[c], u.parts[c] = b["low"][:dims], b["high"][:dims], -(-b["n"] // PART)
    shared = spark.sparkContext.broadcast(uppers)
    parts = spark.createDataFrame([(b["cell"], -(-b["n"] // PART)) for b in boxes], "cell string, parts int")  # one row a cell
    members, _ = stored(placed.join(F.broadcast(parts), "cell").select("cell", F.pmod(F.xxhash64(F.element_at("ids", 1)), F.col("parts")).cast("int").alias("part"), "ids", "vec"))
    drop_stored(spark, path, path2)
    kinds = {"role": "int", "qid": "long", "floor": "double", "ids": "array<bigint>"}

    def rows_of(df: DataFrame, **given: Column) -> DataFrame:
        values = [given.get(n, F.lit(None)).cast(kind).alias(n) if n in given or n not in df.columns else F.col(n) for n, kind in kinds.items()]
        return df.select("cell", "part", "chunk", *values, "vec")

    def visit(asks: DataFrame) -> DataFrame:
        """`asks` (cell, qid, vec, floor) against the members of the cells asked. What is broadcast is a row a cell."""
        cuts = asks.groupBy("cell").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("chunks"))
        held = rows_of(members.join(F.broadcast(cuts), "cell").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))), role=F.lit(0))
        spread = asks.join(F.broadcast(cuts), "cell").withColumn("chunk", F.pmod(F.xxhash64("qid"), F.col("chunks")).cast("int"))
        spread = rows_of(spread.join(F.broadcast(parts), "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))), role=F.lit(1))
        both = held.unionByName(spread).repartition("cell", "part", "chunk").sortWithinPartitions("cell", "part", "chunk", "role", "qid")
        return both.mapInArrow(tidy(_visit(shared, quantiles, keep)), "qid bigint, vec_id bigint, score double")

    home, _ = stored(queries.mapInArrow(_place(shared), "vec array<double>, qid bigint, asks bigint, cell string, y array<double>").drop("y").withColumn("floor", F.lit(-2.0)))
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    near, _ = stored(visit(home).withColumn("place", F.row_number().over(best)).where(F.col("place") <= keep).drop("place"))
    floors = near.groupBy("qid").agg(F.when(F.count("*") >= keep, F.min("score")).otherwise(-2.0).alias("floor"))
    onward = home.drop("floor").join(floors, "qid").select("vec", "qid", "cell", "floor")
    onward = onward.mapInArrow(_route(shared, quantiles), "vec array<double>, qid bigint, cell string, floor double, to array<string>")
    onward, _ = stored(onward.select("qid", "vec", "floor", F.explode("to").alias("cell")))
    far = visit(onward)
    top = near.unionByName(far).withColumn("place", F.row_number().over(best)).where(F.col("place") <= keep)
    lists = top.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))
    lists, _ = stored(queries.join(lists, "qid").select("vec", "asks", "found"))

    out = join_by_counted_key(asked.select("vec_id", "vec"), lists, "vec", "asks").select(F.col("vec_id").alias("query_id"), "found")
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return out.select("query_id", F.posexplode(others).alias("i", "x")).select("query_id", (F.col("i") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def op6_nearest_neighbours(embeddings: DataFrame) -> DataFrame:
    """The contract's view."""
    return nearest(embeddings)
