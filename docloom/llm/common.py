"""What the operators share: names, numbers drawn from texts, joins that survive hot keys, and memory given back."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space, as the contracts define it: space and U+0009 to U+000D.
SPACES = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def own(df: DataFrame, prefix: str) -> DataFrame:
    """Without columns of the operator's own names, which begin with `prefix`: its results replace them."""
    return df.drop(*[c for c in df.columns if c.lower().startswith(prefix)])


def columns(df: DataFrame) -> list[Column]:
    """The frame's columns, whatever characters their names have."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def fraction(text: Column, part: int = 0) -> Column:
    """A number in [0, 1) from eight hex digits of the text's MD5; DuckDB gives the same."""
    return F.conv(F.substring(F.md5(text), 1 + 8 * part, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def join_by_counted_key(left: DataFrame, counted: DataFrame, key: str, n: str, least: int = 512, most_hot: int = 50_000) -> DataFrame:
    """Inner join on `key`, where `counted` (a stored frame with one row per key) tells in `n` how many left rows the key has.

    Keys with many rows are broadcast, so no task receives a hot key; as each has at least max(least, rows / most_hot)
    rows, there are at most `most_hot` of them, whatever the input. All others go through a shuffle, where a key has few rows.
    """
    total = counted.agg(F.sum(n)).first()[0] or 0
    limit = max(least, -(-total // most_hot))
    hot = F.broadcast(counted.where(F.col(n) >= limit))
    return left.join(hot, key).unionByName(left.join(counted.where(F.col(n) < limit).hint("merge"), key))


def tidy(f):
    """The batch function, with memory that it has freed given back to the system at its end.

    Python workers serve one task after the other; without this each would hold the peak of all that it has run.
    """

    def run(batches):
        try:
            yield from f(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim:
                trim(0)

    return run
