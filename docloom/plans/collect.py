"""Collection: notices from search to report rows, comments from cards to named files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.text import file_name
from docloom.operators import comments, metadata, notices
from docloom.operators.providers import ChatProvider


def notice_rows(
    found: DataFrame, existing: DataFrame, details: DataFrame, model: ChatProvider, terms: list[str], order: list[Column], per_term: int, cap: int, since: str | None = None, types: list[str] | None = None,
) -> DataFrame:
    """The report's rows of new notices: searched by term in the abstract, published since a day, of some types, with a title
    that asks for comments, and not reported yet. Close dates and summaries are asked for only of these.

    `found` has document_number, title, abstract, publication_date, html_url and type; `existing` document_number; `details`
    agency, comments_close_on and body by document_number.
    """
    fresh = notices.published_since(found, since, types).where(notices.asks_for_comments(F.col("title")))
    hits = notices.search(notices.new_only(fresh, existing, "document_number"), terms, "document_number", "abstract", order, per_term, cap)
    rows = hits.drop("term", "term_idx", "term_rank").join(details, "document_number", "left")
    told = notices.with_summary(notices.fill_close_dates(rows, model), model)
    return notices.notice_rows(told.select(*found.columns), told.select("document_number", "agency", "comments_close_on", "summary"))


def comment_files(cards: DataFrame, pages: DataFrame, model: ChatProvider, dictionary: DataFrame, checkpoint: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(files, pointer): a row for each file of the comments after the checkpoint, and the card that the next run starts after.

    `cards` has seq, id, date, name and agency; `pages` text and attachments (link arrays) by id.
    """
    rows = comments.resume_after(cards, "seq", "id", checkpoint).join(pages, "id", "left").withColumn("attachments", F.coalesce("attachments", F.array().cast("array<array<string>>")))
    named = metadata.abbreviate(comments.with_relevance(rows, model), "agency", dictionary)
    named = named.withColumn("file_base", file_name(F.col("abbreviation"), F.col("name"), F.col("date"), F.col("id")))
    files = comments.attachment_rows(named).select("id", "seq", "relevant", "attachment", "link", "file_name")
    return files, metadata.last_pointer(comments.resume_after(cards, "seq", "id", checkpoint), ["seq"])
