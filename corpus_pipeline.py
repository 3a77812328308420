"""A corpus pipeline of five stages; each takes (spark, docs, sf_dir) and works on all that the one before kept.

What a stage returns is written as Parquet in the shared folder and read again as the next one's documents, so a lost
executor never costs more than the stage at hand. All stages but the last return the columns of `documents`.

Defined results, of every stage: an empty table stays empty; repeated rows are handled alike; a null text counts as an
empty one and stays null until the last stage; a null source or language is a value of its own; columns beyond those of
`documents` pass through, but for names that begin as the operator's own do (`_toxic_`, `_line_`, `_mix_`, `_bpe_`).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import bpe, jaccard, lines, mixing, toxicity
from docloom.sources.store import shared_dir, swept


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labelled documents of the corpus (the folds of op8).

    Without labels of both classes nothing is rejected (or all, if every label is toxic). A null id is scored like any other.
    """
    model = toxicity.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score_toxicity(docs, model).where("_toxic_score < 0.5").drop("_toxic_score")


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents hold stay in one of them; n_chars follows the text. No document goes; a null id keeps its lines."""
    return lines.dedup_lines(docs).select(*docs.columns).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays, with all its repeated rows; documents without
    words and rows without an id stay."""
    return jaccard.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for; rows without words count for nothing and may go."""
    return mixing.mix_sources(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit) of each text, checked by decoding them: `decodes` says the text came back."""
    coded = bpe.encode_texts(docs.select("doc_id", "lang", "source", "text"))
    return coded.select("doc_id", "lang", "source", (F.octet_length("_bpe_ids") / 4).cast("long").alias("n_tokens"), F.sha2("_bpe_ids", 256).alias("ids_sha256"), F.sha2("_bpe_text", 256).alias("decoded_sha256"), (F.col("_bpe_text") == F.coalesce("text", F.lit(""))).alias("decodes"), F.col("_bpe_ids").alias("ids"))


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_common_lines), ("n-gram Jaccard join", drop_near_copies), ("mixing sources", mix), ("BPE", tokenize)]

#: SQL can express neither the classifier nor the tokens; the stages are tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        path = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}/{i}"
        with swept(spark):
            docs.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
