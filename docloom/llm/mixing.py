"""Mixing sources to target weights by capped water-filling, in DataFrame functions alone.

Each source's share of the budget follows its weight, but never exceeds `max_epochs` times its own size; what a clamped
source cannot take is shared out again by weight until no source is above its cap. That fixed point is
target = min(cap, level x weight), and the level follows from prefix sums over the sources in order of cap / weight, so
no loop is needed.

A source's rate (target / size) becomes copies of whole documents: floor(rate) of each, and one more of a seeded share
`rate - floor(rate)`. That share is drawn systematically: documents lie in strata of about `stratum` rows of one source
(the salt that splits a hot source), sorted by size, and every 1/share-th gets the extra copy, from a seeded start. The
words taken therefore stay within a few documents of the target. Same seed, same mix.

Defined results: a null or blank text has size 0; a source without words has target 0 and no copies; null is a source of
its own, the last in order; rows that are repeated count as often as they stand there; an empty table gives none; other
columns pass through. Columns whose names start with `_mix_` are the operator's own; those of the input are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docloom.llm.common import WORD, columns, fraction, own


def word_count(text: Column) -> Column:
    """Number of words; each word with the white space around it becomes one letter, and those are counted."""
    ws = r"[\x20\x09-\x0D]*+"
    marks = F.regexp_replace(text, f"{ws}{WORD}+{ws}", "x")
    return F.coalesce(F.length(F.btrim(marks, F.lit(" \t\n\x0b\x0c\r"))), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, size: str, weight: str, budget: float, max_epochs: float) -> DataFrame:
    """Add `_mix_target` to a frame with one row per source. The windows run over sources, not documents."""
    every = Window.partitionBy(F.lit(0))
    rising = Window.partitionBy(F.lit(0)).orderBy("_mix_full", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, 0)
    cap, w = F.col("_mix_cap"), F.col(weight)
    out = sources.withColumn("_mix_cap", F.col(size) * F.lit(max_epochs)).withColumn("_mix_full", cap / w)
    out = out.withColumn("_mix_total", F.sum(size).over(every) * F.lit(budget)).withColumn("_mix_w", F.sum(weight).over(every))
    held = F.sum("_mix_cap").over(rising) + F.col("_mix_full") * (F.col("_mix_w") - F.sum(weight).over(rising))
    out = out.withColumn("_mix_clamped", held <= F.col("_mix_total"))
    rest = F.col("_mix_total") - F.sum(F.when(F.col("_mix_clamped"), cap).otherwise(0.0)).over(every)
    free = F.sum(F.when(F.col("_mix_clamped"), 0.0).otherwise(w.cast("double"))).over(every)
    return out.withColumn("_mix_level", F.try_divide(rest, free)).withColumn("_mix_target", F.when(F.col("_mix_clamped"), cap).otherwise(F.col("_mix_level") * w))


def plan_mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), budget: float = 1.5, max_epochs: float = 2.0, seed: str = "mix", stratum: int = 1024) -> DataFrame:
    """The documents with `_mix_size`, `_mix_source_size`, `_mix_target` and `_mix_copies` (how often the mix takes each)."""
    docs = own(docs, "_mix_")
    sized = docs.withColumn("_mix_size", word_count(F.col("text")))
    per = sized.groupBy("source").agg(F.sum("_mix_size").alias("_mix_source_size"), F.count("*").alias("_mix_n"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("source").isNull(), "source")
    per = per.withColumn("_mix_weight", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    per = water_fill(per, "_mix_source_size", "_mix_weight", budget, max_epochs)
    per = per.select(F.col("source").alias("_mix_of"), "_mix_source_size", "_mix_target", F.coalesce(F.try_divide("_mix_target", "_mix_source_size"), F.lit(0.0)).alias("_mix_rate"), F.ceil(F.col("_mix_n") / stratum).alias("_mix_strata"))
    key = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    out = sized.join(per, F.col("source").eqNullSafe(F.col("_mix_of")))
    out = out.withColumn("_mix_salt", F.floor(fraction(key) * F.col("_mix_strata"))).withColumn("_mix_u", fraction(key, 1))
    rank = F.row_number().over(Window.partitionBy("source", "_mix_salt").orderBy("_mix_size", "_mix_u", "doc_id"))
    start = fraction(F.concat_ws("|", F.lit(seed), F.coalesce("source", F.lit("")), F.col("_mix_salt").cast("string")), 2)
    share = F.col("_mix_rate") - F.floor("_mix_rate")
    out = out.withColumn("_mix_rank", rank).withColumn("_mix_start", start)
    extra = F.floor(F.col("_mix_rank") * share + F.col("_mix_start")) - F.floor((F.col("_mix_rank") - 1) * share + F.col("_mix_start"))
    out = out.withColumn("_mix_copies", (F.floor("_mix_rate") + extra).cast("int"))
    return out.drop("_mix_of", "_mix_rate", "_mix_strata", "_mix_salt", "_mix_u", "_mix_rank", "_mix_start")


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as the plan takes it, with the columns it came with."""
    planned = plan_mix(docs, **options)
    return planned.withColumn("_mix_i", F.explode(F.array_repeat(F.lit(True), F.col("_mix_copies")))).select(*columns(own(docs, "_mix_")))


def op1_mixing(docs: DataFrame) -> DataFrame:
    """The contract's view of the plan."""
    return plan_mix(docs.select("doc_id", "text", "source")).select("doc_id", F.col("_mix_size").alias("size"), F.col("_mix_source_size").alias("source_size"), F.col("_mix_target").alias("target"), (F.col("_mix_size") * F.col("_mix_copies")).alias("taken"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size,
         md5('mix|' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS s, count(*) AS n FROM d GROUP BY source),
r AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w FROM p),
c AS (SELECT *, s * 2.0::DOUBLE AS cap, s * 2.0::DOUBLE / w AS ful, sum(s) OVER () * 1.5::DOUBLE AS total, sum(w) OVER () AS ws FROM r),
k AS (SELECT *, sum(cap) OVER win + ful * (ws - sum(w) OVER win) <= total AS clamped FROM c
      WINDOW win AS (ORDER BY ful, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
l AS (SELECT *, (total - sum(CASE WHEN clamped THEN cap ELSE 0 END) OVER ())
              / nullif(sum(CASE WHEN clamped THEN 0 ELSE w END) OVER (), 0) AS level FROM k),
t AS (SELECT source, s, n, CASE WHEN clamped THEN cap ELSE level * w END AS target FROM l),
j AS (SELECT d.*, t.s, t.target, coalesce(t.target / nullif(t.s, 0), 0) AS rate,
             floor(('0x' || substr(d.h, 1, 8))::BIGINT / 4294967296.0::DOUBLE * ceil(t.n / 1024))::BIGINT AS salt,
             ('0x' || substr(d.h, 9, 8))::BIGINT AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
x AS (SELECT *, row_number() OVER (PARTITION BY source, salt ORDER BY size, u, doc_id) AS k,
             ('0x' || substr(md5('mix|' || coalesce(source, '') || '|' || salt), 17, 8))::BIGINT / 4294967296.0::DOUBLE AS v, rate - floor(rate) AS f FROM j)
SELECT doc_id, size::BIGINT AS size, s AS source_size, target::DOUBLE AS target,
       (size * (floor(rate) + floor(k * f + v) - floor((k - 1) * f + v)))::BIGINT AS taken
FROM x
"""
