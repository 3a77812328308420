"""Notices: vocabulary search over titles or texts, what is new, and the report's rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docloom.functions.text import answer_list, contains_any, reformat_date

#: The terms searched for by default, in their order.
DEFAULT_TERMS = [
    "artificial intelligence", "algorithm", "artificial general intelligence", "artificial narrow intelligence",
    "chat-based generative pre-trained transformer", "transformer models", "self-attention mechanism", "computer vision",
    "critical ai", "data", "training data", "hallucination", "human-centered perspective", "intelligence augmentation",
    "intelligent tutoring systems", "adaptive learning", "interpretable machine learning", "black boxes", "machine learning",
    "neural networks", "deep learning", "natural language processing", "robots", "explainable machine learning",
    "foundation models", "automated decision-making", "ai", "ai systems", "ai technologies", "ai tools", "ai applications",
    "ai software", "ai algorithms", "ai regulation", "ai policy",
]
#: A notice asks for comments if its title contains one of these.
TITLE_TERMS = [
    "request for ", "rfi", "rfc", "seeks comment", "seeking comment", "comments requested", "public comment", "nprm",
    "proposed rule", "notice of proposed rulemaking", "notice of", "extension of comment", "request for information",
]


def search_terms(spec: str | None) -> list[str]:
    """A comma-separated list as terms; the default vocabulary if it is blank."""
    found = [t.strip() for t in (spec or "").split(",") if t.strip()]
    return found or list(DEFAULT_TERMS)


def search_terms_column(c: Column) -> Column:
    return answer_list(c)


def asks_for_comments(title: Column) -> Column:
    return contains_any(title, TITLE_TERMS)


def new_only(found: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among the existing ones; a null key is never new."""
    return found.where(F.col(key).isNotNull()).join(existing.select(key).where(F.col(key).isNotNull()), key, "left_anti")


def published_since(notices: DataFrame, since: str | None = None, types: list[str] | None = None, published: str = "publication_date", kind: str = "type") -> DataFrame:
    """Notices published on `since` (yyyy-MM-dd) or later and of one of these types; plain comparisons, which reach the scan."""
    if since is not None:
        notices = notices.where(F.col(published) >= F.lit(since).cast(notices.schema[published].dataType))
    return notices.where(F.col(kind).isin(types)) if types else notices


def search(notices: DataFrame, terms: list[str], key: str, text: str, order: list[Column], per_term: int, cap: int, keep: Column | None = None) -> DataFrame:
    """Each term's first `per_term` hits by `order`, a notice with the first term that finds it, at most `cap` in all.
    Start date and types are filters on `notices` (published_since).

    The vocabulary is a literal, so no join is needed: a row is read once and exploded into the terms that it contains.
    Ranks are limited before they are shuffled; the cap is a top-k.
    """
    vocabulary = F.array(*[F.struct(F.lit(i).alias("term_idx"), F.lit(t).alias("term")) for i, t in enumerate(terms)])
    hits = notices.withColumn("_hit", F.explode(F.filter(vocabulary, lambda t: F.contains(F.lower(F.col(text)), t["term"]))))
    hits = hits.withColumn("term_idx", F.col("_hit.term_idx")).withColumn("term", F.col("_hit.term")).drop("_hit")
    hits = hits.withColumn("term_rank", F.row_number().over(Window.partitionBy("term_idx").orderBy(*order))).where(F.col("term_rank") <= per_term)
    if keep is not None:
        hits = hits.where(keep)
    first = hits.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy("term_idx", "term_rank"))).where("_n = 1").drop("_n")
    return first.orderBy("term_idx", "term_rank").limit(cap)


def search_order(kind: str, published: str, key: str, relevance: Column | None = None) -> list[Column]:
    """'newest', 'oldest' or 'relevance' (by default the order of the key) as sort columns; ties go to the smaller key."""
    if kind not in ("newest", "oldest", "relevance"):
        raise ValueError(f"unknown order: {kind}")
    if kind == "relevance":
        return [*([relevance.desc()] if relevance is not None else []), F.asc(key)]
    return [F.desc(published) if kind == "newest" else F.asc(published), F.asc(key)]


def matched_terms(text: Column, terms: list[str]) -> Column:
    """How many of the terms the text contains: a relevance that needs no server."""
    return F.size(F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(F.lower(text), t)))


def existing_ids(report: DataFrame) -> DataFrame:
    """The ids that a stored report already has."""
    return report.where(F.col("doc_id").isNotNull() & (F.trim("doc_id") != "")).select(F.trim("doc_id").alias("document_number")).distinct()


def fill_close_dates(rows: DataFrame, provider, body: str = "body") -> DataFrame:
    """`comments_close_on` (yyyy-MM-dd) where it is null: asked for from the body, kept only if it is a date after publication.

    Rows that have a date never reach the model.
    """
    from docloom.operators.providers import chat

    known, open_ = rows.where("comments_close_on IS NOT NULL"), rows.where("comments_close_on IS NULL")
    prompt = F.concat(F.lit("When do comments on this notice close? Answer with the date alone (MM/DD/YYYY), or NONE. It was published on "), F.coalesce("publication_date", F.lit("an unknown day")), F.lit(".\n"), F.coalesce(body, F.lit("")))
    asked = chat(open_.withColumn("_prompt", prompt), "_prompt", provider, "_answer")
    found = F.to_date(F.try_to_timestamp(F.trim("_answer"), F.lit("MM/dd/yyyy")))
    later = F.coalesce(found > F.to_date(F.try_to_timestamp("publication_date", F.lit("yyyy-M-d"))), found.isNotNull())
    return known.unionByName(asked.withColumn("comments_close_on", F.when(later, F.date_format(found, "yyyy-MM-dd"))).select(*rows.columns))


def comment_window(published: Column, closes: Column) -> Column:
    """'published - closes', or the first alone where no closing date is known."""
    return F.when(closes.isNotNull() & (closes != ""), F.concat(published, F.lit(" - "), closes)).otherwise(published)


def notice_rows(notices: DataFrame, details: DataFrame) -> DataFrame:
    """The report's nine columns. `details` has agency, comments_close_on and summary by document_number."""
    joined = notices.where(F.col("document_number").isNotNull() & (F.col("document_number") != "")).join(details, "document_number", "left")
    published, closes = reformat_date(F.col("publication_date")), reformat_date(F.col("comments_close_on"))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return joined.select(
        text("title").alias("title"), "agency", published.alias("pub_date"), comment_window(published, closes).alias("comment_window"),
        "summary", text("html_url").alias("url"), F.lit("").alias("notes"), text("type").alias("type"), F.col("document_number").alias("doc_id"),
    )


def summary_prompt(abstract: Column, body: Column) -> Column:
    """What the summarising model is asked: the abstract if there is one, else the body."""
    source = F.when(abstract.isNotNull() & (abstract != ""), abstract).otherwise(F.coalesce(body, F.lit("")))
    return F.concat(F.lit("Summarize this notice in one or two sentences: "), source)


def with_summary(rows: DataFrame, provider, abstract: str = "abstract", body: str = "body") -> DataFrame:
    """The rows with the model's `summary` of the abstract, or of the body where there is none."""
    from docloom.operators.providers import chat

    asked = chat(rows.drop("summary").withColumn("_prompt", summary_prompt(F.col(abstract), F.col(body))), "_prompt", provider, "_answer")
    return asked.withColumn("summary", clean_summary(F.col("_answer"))).drop("_prompt", "_answer", "_answer_error")


def bodies(found: DataFrame, fetcher, url: str = "json_url") -> DataFrame:
    """The notices with `comments_close_on`, `body` (HTML) and `agency`: the details are fetched, then the body that they name.

    What can't be fetched or read is null; nothing fails.
    """
    from docloom.operators.providers import fetch
    from docloom.sources.html import agencies

    details = fetch(found, url, fetcher).withColumn("_d", F.from_json(F.col("body").cast("string"), "comments_close_on string, body_html_url string"))
    named = details.select(*found.columns, F.col("_d.comments_close_on").alias("comments_close_on"), F.col("_d.body_html_url").alias("_url"))
    page = fetch(named, "_url", fetcher).withColumn("html", F.col("body").cast("string")).drop("_url", "status", "body", "suffix", "error")
    return agencies(page).drop("agency_text").withColumnRenamed("html", "body")


def clean_summary(c: Column) -> Column:
    """A model's answer without the line that announces it."""
    return F.trim(F.regexp_replace(c, r"(?i)^\s*here is a summary[^:\n]*:", ""))
