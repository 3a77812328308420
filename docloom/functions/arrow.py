"""Schemas of functions over Arrow batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType


def appended(df: DataFrame, more: str) -> StructType:
    """The frame's own fields, of whatever type and name, then those that `more` declares."""
    return StructType([*(StructField(f.name, f.dataType) for f in df.schema.fields), *StructType.fromDDL(more).fields])
