"""Stored vectors as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos, embedding) of all JSON files below `path`: each holds one vector or a list of vectors.

    A file of another shape gives no rows.
    """
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(path, wholetext=True)
    many = F.from_json("value", "array<array<float>>")
    one = F.from_json("value", "array<float>")
    fits = lambda v: F.filter(v, lambda x: x.isNotNull() & (F.size(x) > 0))
    rows = F.when(F.size(fits(many)) > 0, fits(many)).otherwise(fits(F.array(one)))
    return raw.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), F.posexplode(rows).alias("pos", "embedding"))
