"""Line de-duplication: lines are normalised and hashed, the documents of each hash counted, and frequent lines dropped.

A key is the 16-byte BLAKE2b hash of a line without the white space around it, in lower case (A-Z alone); keys shorter
than `min_chars` code points never count. Each document sends a key once. Keys of at least `min_docs` documents lose
their lines everywhere but in the largest id that holds them; the lines that stay are joined again by position.

Very common lines are the skew here: counting combines before it shuffles, and keys with many documents are broadcast
(their number is bounded, see join_by_counted_key), so that no task receives a hot key.

Defined results: a null or empty text is one empty line; a null id neither counts nor loses lines; rows that share an id
are one document for the count, and each loses the same lines; an empty table gives none; other columns pass through,
but for names that start with `_line_`, which are the operator's own and replaced.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from docloom.functions.arrow import appended
from docloom.llm.common import SPACES, columns, join_by_counted_key, own, tidy
from docloom.sources.store import stored


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The key's hash, or None where the key is too short to count."""
    line = line.strip(SPACES)
    if len(line) < min_chars or (not line.isascii() and len(line.decode("utf-8", "replace")) < min_chars):
        return None
    return hashlib.blake2b(line.lower(), digest_size=16).digest()


def _keys(min_chars: int):
    def run(batches):
        for batch in batches:
            ids, keys = [], []
            for i, text in enumerate(batch.column(1)):
                found = {line_key(x, min_chars) for x in (text.as_py() or b"").split(b"\n")} - {None}
                ids += [i] * len(found)
                keys += found
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int64())), pa.array(keys, pa.binary())], names=["_line_id", "_line_key"])

    return run


def _rebuild(min_chars: int):
    def run(batches):
        for batch in batches:
            texts, dropped = [], []
            for text, drop in zip(batch.column("_line_text"), batch.column("_line_drop"), strict=True):
                drop = drop.as_py()
                if not drop:
                    texts.append(text.as_py())
                    dropped.append(0)
                    continue
                drop, lines = set(drop), (text.as_py() or b"").split(b"\n")
                kept = [x for x in lines if line_key(x, min_chars) not in drop]
                texts.append(b"\n".join(kept))
                dropped.append(len(lines) - len(kept))
            rest = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n not in ("_line_text", "_line_drop")]
            yield pa.RecordBatch.from_arrays([c for _, c in rest] + [pa.array(texts, pa.binary()), pa.array(dropped, pa.int64())], names=[n for n, _ in rest] + ["_line_text", "_line_dropped"])

    return run


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """The documents with shortened `text`, and `_line_n` (lines before) and `_line_dropped` beside the other columns."""
    docs = own(docs, "_line_")
    kind = StructType([StructField("_line_id", docs.schema["doc_id"].dataType), StructField("_line_key", BinaryType())])
    keys = docs.where("doc_id IS NOT NULL").select("doc_id", F.col("text").cast("binary")).mapInArrow(tidy(_keys(min_chars)), kind)
    counted = keys.groupBy("_line_key").agg(F.count_distinct("_line_id").alias("_line_docs"), F.max("_line_id").alias("_line_keeper"), F.count("*").alias("_line_rows"))
    counted, _ = stored(counted.where(F.col("_line_docs") >= min_docs))
    hits = join_by_counted_key(keys, counted, "_line_key", "_line_rows").where("_line_id < _line_keeper")
    drops = hits.groupBy(F.col("_line_id").alias("_line_doc")).agg(F.collect_set("_line_key").alias("_line_drop"))
    joined = docs.withColumn("_line_n", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long")).withColumn("_line_text", F.col("text").cast("binary")).drop("text")
    joined = joined.join(drops, joined["doc_id"] == drops["_line_doc"], "left").drop("_line_doc")
    out = joined.mapInArrow(tidy(_rebuild(min_chars)), appended(joined.drop("_line_text", "_line_drop"), "_line_text binary, _line_dropped bigint")).withColumn("text", F.decode("_line_text", "UTF-8"))
    return out.select(*columns(docs), "_line_n", "_line_dropped")


def op2_line_dedup(docs: DataFrame) -> DataFrame:
    """The contract's view: counts and the SHA-256 of what is left of each text (a null text counts as empty)."""
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", F.col("_line_n").alias("n_lines"), F.col("_line_dropped").alias("n_dropped"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH l AS (
  SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
c AS (SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT l.*, coalesce(c.keeper > l.doc_id, false) AS gone FROM l LEFT JOIN c USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, sum(gone::INT)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
