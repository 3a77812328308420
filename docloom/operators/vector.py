"""Exact vector scoring (cosine, dot, L2) and deterministic top-k, all as native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision; null if either side is null or holds null."""
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Row-wise cosine; null for a zero vector."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def squared_l2(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0))))


#: Score by name, and whether a larger one is nearer.
METRICS = {"cosine": (cosine, True), "dot": (dot, True), "l2": (squared_l2, False)}


def top_k(vectors: DataFrame, query: DataFrame, k: int = 5, metric: str = "cosine", id_col: str = "vec_id", vec_col: str = "embedding", digits: int = 6) -> DataFrame:
    """The k rows nearest to the one vector in `query`; ties go to the smaller id, k beyond the rows gives all of them.

    The query frame is limited to one row before it is broadcast, so what is broadcast is one vector.
    """
    score, larger = METRICS[metric]
    q = query.select(F.col(vec_col).alias("_query")).limit(1)
    scored = vectors.crossJoin(F.broadcast(q)).select(id_col, F.round(score(F.col(vec_col), F.col("_query")), digits).alias("score")).where(F.col("score").isNotNull())
    return scored.orderBy(F.desc("score") if larger else F.asc("score"), F.asc(id_col)).limit(k)


def top_k_by(vectors: DataFrame, queries: DataFrame, group: str, k: int = 5, metric: str = "cosine", id_col: str = "vec_id", vec_col: str = "embedding", digits: int = 6) -> DataFrame:
    """For each group, the k rows of `vectors` nearest to the group's query vector (`queries` has one row per group).

    The join is on the group; ranks are limited before the shuffle (row_number <= k), so a large group costs k rows a task.
    """
    from pyspark.sql.window import Window

    score, larger = METRICS[metric]
    q = queries.select(group, F.col(vec_col).alias("_query"))
    scored = vectors.join(q, group).select(group, id_col, F.round(score(F.col(vec_col), F.col("_query")), digits).alias("score")).where(F.col("score").isNotNull())
    order = Window.partitionBy(group).orderBy(F.desc("score") if larger else F.asc("score"), F.asc(id_col))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked(top: DataFrame, larger: bool = True, id_col: str = "vec_id") -> DataFrame:
    """A bounded result with its display rank 1..k (the frame is at most k rows when it comes here)."""
    from pyspark.sql.window import Window

    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score") if larger else F.asc("score"), F.asc(id_col))))


def padded_search(found: DataFrame, k: int, last: DataFrame) -> DataFrame:
    """Compatibility: where fewer than k chunks exist, the missing places repeat the last chunk (`last`, one row)."""
    spark = found.sparkSession
    places = spark.range(1, k + 1).select(F.col("id").cast("int").alias("rank"))
    have = places.join(found, "rank", "left")
    fill = last.select(*[F.col(c).alias(f"_{c}") for c in last.columns]).limit(1)
    return have.crossJoin(F.broadcast(fill)).select("rank", *[F.coalesce(c, f"_{c}").alias(c) for c in last.columns])
