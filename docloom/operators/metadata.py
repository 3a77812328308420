"""Stored comment metadata: reading, last write wins, pointers, and grouping files of one comment."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.text import attachment_base, file_base, initials

ENTRY = "struct<date:string,commenter:string,agency:string,comment_id:string,page:int>"
#: A reserved key among the entries: the pointer to the last comment, not a file.
POINTER = "lastComment"


def read_metadata(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(files, pointers) of all metadata.json files under `path`; an explicit schema, so empty objects and no files are fine."""
    try:
        rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("origin"), "value")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], "origin string, value string")
    entries = rows.select("origin", F.explode(F.from_json("value", f"map<string,{ENTRY}>")).alias("file_base", "entry")).select("origin", "file_base", "entry.*")
    return entries.where(F.col("file_base") != POINTER).drop("page"), entries.where(F.col("file_base") == POINTER).drop("file_base")


def latest(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Last write wins: per key the row that comes last in `order`. The maximum combines before the shuffle."""
    rest = [c for c in rows.columns if c != key]
    found = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
    return found.select(key, "_last.*")


def last_pointer(rows: DataFrame, order: list[str]) -> DataFrame:
    """The one row that comes last over all."""
    return rows.agg(F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("_last")).where("_last IS NOT NULL").select("_last.*")


def group_files(files: DataFrame, name: str, order: str, compat: bool = False) -> DataFrame:
    """Files of one comment as one row: base, and the names in order. Ordering is kept by sorting structs, not by arrival."""
    return files.groupBy(attachment_base(F.col(name), compat).alias("base")).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, name))), lambda x: x[name]).alias("files"))


def with_metadata(files: DataFrame, metadata: DataFrame, name: str) -> DataFrame:
    """Files with their metadata: the exact base counts first, then the one without attachment number; else nulls."""
    rest = [c for c in metadata.columns if c != "file_base"]
    exact = metadata.select(F.col("file_base").alias("_exact"), F.struct(*rest).alias("_m1"))
    shared = metadata.select(F.col("file_base").alias("_shared"), F.struct(*rest).alias("_m2"))
    joined = files.join(exact, file_base(F.col(name)) == F.col("_exact"), "left").join(shared, attachment_base(F.col(name)) == F.col("_shared"), "left")
    return joined.withColumn("_m", F.coalesce("_m1", "_m2")).select(*files.columns, "_m.*")


def abbreviate(rows: DataFrame, agency: str, dictionary: DataFrame) -> DataFrame:
    """`abbreviation` from the dictionary (agency, abbreviation), else the initials; the dictionary's size decides on a broadcast."""
    known = dictionary.select(F.col("agency").alias("_agency"), F.col("abbreviation").alias("_short"))
    joined = rows.join(known, F.lower(F.col(agency)) == F.col("_agency"), "left")
    return joined.withColumn("abbreviation", F.coalesce("_short", initials(F.lower(F.col(agency))))).drop("_agency", "_short")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object of agency to abbreviation as a two-column frame."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.explode(F.from_json("value", "map<string,string>")).alias("agency", "abbreviation"))


def running_text(rows: DataFrame, group: str, order: str, text: Column, separator: str = "") -> DataFrame:
    """Each row with the texts of the rows before it in its group, joined."""
    from pyspark.sql.window import Window

    before = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("context", F.array_join(F.collect_list(text).over(before), separator))
