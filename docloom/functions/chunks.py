"""Chunking of texts, natively: sequential semantics as one regular expression or one fold within the row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions.text import strip, token_count


def sentence_chunks(c: Column, size: int) -> Column:
    """At least `size` characters each, on to the next '.', '!' or '?'; the chunks joined are the text."""
    return F.regexp_extract_all(c, F.lit(f"(?s).{{{size}}}[^.!?]*[.!?]|.+"), F.lit(0))


def paragraph_chunks(c: Column, most: int = 2000, separator: str = "\n\n", drop_empty: bool = False) -> Column:
    """Paragraphs packed greedily while their words are at most `most`; a longer one is a chunk of its own.

    As the packing closes the open chunk first, a text whose first paragraph is too long begins with an empty chunk;
    `drop_empty` leaves that out.
    """
    parts = F.filter(F.transform(F.split(c, separator), strip), lambda p: p != "")
    # The fold gathers only where chunks end, as numbers; texts are cut and joined once, afterwards.
    start = F.struct(F.array().cast("array<int>").alias("ends"), F.lit(0).alias("at"), F.lit(0).alias("n"))

    def step(a: Column, p: Column) -> Column:
        n = token_count(p)
        full = F.struct(F.array_append(a["ends"], a["at"]).alias("ends"), (a["at"] + 1).alias("at"), n.alias("n"))
        more = F.struct(a["ends"].alias("ends"), (a["at"] + 1).alias("at"), (a["n"] + n).alias("n"))
        return F.when(a["n"] + n > most, full).otherwise(more)

    found = F.aggregate(parts, start, step, lambda a: F.struct(parts.alias("parts"), F.when(a["at"] > 0, F.array_append(a["ends"], a["at"])).otherwise(a["ends"]).alias("ends")))

    def cut(x: Column) -> Column:
        begins = F.concat(F.array(F.lit(0)), x["ends"])
        return F.transform(x["ends"], lambda end, i: F.array_join(F.slice(x["parts"], F.get(begins, i) + 1, end - F.get(begins, i)), separator))

    # An array of one element, so that its parts are computed once.
    chunks = F.flatten(F.transform(F.array(found), cut))
    return F.filter(chunks, lambda x: x != "") if drop_empty else chunks
