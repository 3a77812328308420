"""The operators as queries over the driver's tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docloom.llm.bpe import op7_bpe
from docloom.llm.html import op3_html_extraction
from docloom.llm.jaccard import op9_jaccard_join
from docloom.llm.lines import OP2_SQL, op2_line_dedup
from docloom.llm.media import op10_media_columns
from docloom.llm.mixing import OP1_SQL, op1_mixing
from docloom.llm.neighbours import op6_nearest_neighbours
from docloom.llm.quality import op4_quality
from docloom.llm.toxicity import op8_toxicity
from docloom.llm.urlfilter import OP5_SQL, op5_url_filters


def _over(table: str, f: Callable[..., DataFrame], *more: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: f(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in (table, *more)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": _over("documents", op1_mixing),
    "op2_line_dedup": _over("documents", op2_line_dedup),
    "op3_html_extraction": _over("pages", op3_html_extraction),
    "op4_quality": _over("documents", op4_quality, "labels"),
    "op5_url_filters": _over("pages", op5_url_filters),
    "op6_nearest_neighbours": _over("embeddings", op6_nearest_neighbours),
    "op7_bpe": _over("documents", op7_bpe),
    "op8_toxicity": _over("documents", op8_toxicity, "labels"),
    "op9_jaccard_join": _over("documents", op9_jaccard_join),
    "op10_media_columns": _over("documents", op10_media_columns),
}
ORACLES = {"op1_mixing": OP1_SQL, "op2_line_dedup": OP2_SQL, "op5_url_filters": OP5_SQL}
