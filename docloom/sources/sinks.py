"""Sinks: report rows, standardised texts with their vectors, checkpoints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.text import report_cell

POINTER_SCHEMA = "doc_num string, last_comment_id string"


def report(df: DataFrame) -> DataFrame:
    """Every column as a report cell."""
    return df.select(*[report_cell(F.col(c)).alias(c) for c in df.columns])


def append_rows(df: DataFrame, path: str) -> None:
    """Rows as they are: what a notice table takes, where blank cells stay blank."""
    df.write.mode("append").parquet(path)


def append_report(df: DataFrame, path: str) -> None:
    report(df).write.mode("append").parquet(path)


def write_standardized(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A folder per document, so that a reader of one document prunes all others."""
    df.write.mode(mode).partitionBy("document_id").parquet(path)


def save_pointer(spark: SparkSession, path: str, doc_num: str, comment_id: str) -> None:
    spark.createDataFrame([(doc_num, comment_id)], POINTER_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{path}/{doc_num}")


def load_pointer(spark: SparkSession, path: str, doc_num: str) -> str | None:
    """The id saved last, or None if there is none."""
    from pyspark.errors import AnalysisException

    try:
        row = spark.read.schema(POINTER_SCHEMA).json(f"{path}/{doc_num}").first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return row["last_comment_id"] if row else None


def abstract_document(title: Column, date: Column, agency: Column, identity: Column, body: Column) -> Column:
    """The text of a rendered abstract: title, a line of particulars, body."""
    line = F.concat_ws("\n", F.concat(F.lit("Date: "), date), F.concat(F.lit("Agency: "), agency), F.concat(F.lit("ID: "), identity))
    return F.concat_ws("\n\n", title, line, body)
