"""Comments: cards to records, relevance before any model call, attachments, and resuming after a checkpoint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docloom.functions.text import absolute_url, strip, without_label

#: Abstracts shorter than this are never relevant, and no model is asked.
LEAST_ABSTRACT = 200


def label_map(items: Column) -> Column:
    """An array of (label, text) as a map: labels in lower case, the label taken out of its text."""
    entries = F.transform(items, lambda x: F.struct(F.lower(strip(x["label"])).alias("key"), strip(F.replace(x["text"], x["label"], F.lit(""))).alias("value")))
    return F.map_from_entries(F.filter(entries, lambda e: e["key"].isNotNull()))


def card_records(cards: DataFrame, base: str) -> DataFrame:
    """Five fields of each card (`title`, `href`, `meta` map); a label that is missing gives an empty text."""
    field = lambda k: F.coalesce(F.try_element_at("meta", F.lit(k)), F.lit(""))
    return cards.select(field("posted").alias("date"), without_label(strip(F.col("title"))).alias("name"), field("agency").alias("agency"), absolute_url(F.col("href"), base).alias("url"), field("id").alias("id"))


def abstract_of(text: Column) -> Column:
    return F.substring(text, 1, 1000)


def worth_asking(abstract: Column) -> Column:
    """The cheap gate before the model."""
    return F.length(abstract) >= LEAST_ABSTRACT


def says_yes(answer: Column) -> Column:
    """Exactly 'yes' counts, without outer white space and in any case."""
    return F.lower(strip(answer)) == "yes"


def pick_link(links: Column) -> Column:
    """The first link that contains 'pdf', else the first; null if there is none."""
    return F.coalesce(F.get(F.filter(links, lambda x: F.contains(x, F.lit("pdf"))), F.lit(0)), F.get(links, F.lit(0)))


def attachment_rows(comments: DataFrame) -> DataFrame:
    """A row for each file of a comment (`file_base`, `relevant`, `attachments` array of link arrays): its number and name.

    A relevant abstract is number 1; attachments without links take none; the name carries the number only where the
    comment has more than one file in all.
    """
    own = F.when(F.col("relevant"), 1).otherwise(0)
    total = own + F.size("attachments")
    links = F.filter(F.transform("attachments", pick_link), lambda x: x.isNotNull())
    files = F.concat(F.when(F.col("relevant"), F.array(F.lit(None).cast("string"))).otherwise(F.array().cast("array<string>")), links)
    rows = comments.withColumn("total", total).select("*", F.posexplode(files).alias("_i", "link")).withColumn("attachment", F.col("_i") + 1).drop("_i")
    return rows.withColumn("file_name", F.when(F.col("total") > 1, F.concat("file_base", F.lit("_attachment"), F.col("attachment").cast("string"))).otherwise(F.col("file_base")))


def resume_after(rows: DataFrame, order: str, key: str, checkpoint: str | None) -> DataFrame:
    """Rows after the checkpoint's first place; all without a checkpoint, none if it is never seen.

    The place is one number, found by a distributed minimum and compared through a one-row broadcast.
    """
    if checkpoint is None:
        return rows
    place = rows.where(F.col(key) == checkpoint).agg(F.min(order).alias("_place"))
    return rows.join(F.broadcast(place), F.col(order) > F.col("_place")).drop("_place")


def previous_ids(rows: DataFrame, group: str, order: str, key: str) -> DataFrame:
    """The key of the row before, within its group."""
    return rows.withColumn("previous", F.lag(key).over(Window.partitionBy(group).orderBy(order)))


#: Fixed value: what the service's error page says.
ERROR_PAGE = "we're sorry, an error has occurred"


def is_error_page(html: Column) -> Column:
    return F.contains(F.lower(html), F.lit(ERROR_PAGE))


def is_quota_error(error: Column) -> Column:
    return F.contains(F.lower(error), F.lit("quota"))


def with_relevance(rows: DataFrame, provider, text: str = "text") -> DataFrame:
    """The rows with `relevant`: false for short abstracts, which never reach the model; else whether its answer is yes."""
    from docloom.operators.providers import chat

    abstract = abstract_of(F.col(text))
    gate = F.coalesce(worth_asking(abstract), F.lit(False))
    prompt = F.concat(F.lit("Does this text answer a request for comments at length, rather than merely describe a comment? Yes or No alone.\n\n"), abstract)
    asked = chat(rows.where(gate).withColumn("_prompt", prompt), "_prompt", provider, "_answer")
    judged = asked.withColumn("relevant", F.coalesce(says_yes(F.col("_answer")), F.lit(False))).select(*rows.columns, "relevant")
    return judged.unionByName(rows.where(~gate).withColumn("relevant", F.lit(False)))
