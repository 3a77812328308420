"""Standardisation and retrieval: chunks, context by vector search, rewritten queries, answers, and the structured report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.chunks import paragraph_chunks, sentence_chunks
from docloom.functions.text import sanitize, strip
from docloom.operators.providers import ChatProvider, EmbeddingProvider, chat, embed
from docloom.operators.vector import squared_l2
from docloom.sources.store import stored

_NA = "Where the documents don't say, answer N/A alone."
#: The questions of a report by column. Those of the second wave are asked only where an organization was named.
FIRST_WAVE = {
    "submitter_name": f"Name the person or body that wrote this comment, and nothing besides. {_NA} Known so far: ",
    "organization_name": f"Name the organization that the comment was sent by, and nothing besides. {_NA}",
    "contact_information": f"Give the writers' contact details, and nothing besides. {_NA}",
    "relevant_keywords": "List keywords of the comment, separated by commas.",
    "brief_summary": "Say in at most two short sentences what the comment is about.",
    "relevant_issues": "List the issues that the comment takes up, separated by commas.",
}
#: The roles that an answer may name.
ROLES = ["Citizen Engagement", "Individual Expression/Specialization", "Innovation", "Political Advocacy", "Service Provision", "Social Capital Creation", "Products", "Services", "Government Institution", "Citizen", "Infastructure"]
SECOND_WAVE = {
    "organization_type": f"What type of organization is it? The type alone. {_NA}",
    "status_501c": f"What is the organization's 501c status? The status alone. {_NA}",
    "ntee_type": f"What is the organization's NTEE type? The type alone. {_NA}",
    "organization_role": f"Which of these roles fits the organization: {', '.join(ROLES)}? The role alone. {_NA}",
}
REPORT = ["comment_id", "file", "date", "submitter_name", "organization_name", "organization_type", "status_501c", "ntee_type", "organization_role", "contact_information", "relevant_keywords", "brief_summary", "relevant_issues", "comment_text"]


def standardize(comments: DataFrame, provider: ChatProvider, most: int = 2000, separator: str = "\n\n") -> DataFrame:
    """(file, standardized): each comment's chunks through the model in order, the first with its metadata; joined and sanitised.

    `comments` has file, text and metadata (a struct). The answers are sorted by position within each file.
    """
    head = F.concat(
        F.lit("Bring this public comment into the markdown format below. Keep its words; drop page numbers and tables of contents.\n\nMetadata: "), F.coalesce(F.to_json("metadata"), F.lit("{}")),
        F.lit("\n\nFormat: Filename, Date Submitted, Submitter Name, Agency, Comment ID, Comment Text\n\n"), F.col("chunk"),
    )
    chunks = comments.select("file", "metadata", F.posexplode(paragraph_chunks(F.col("text"), most, separator)).alias("pos", "chunk"))
    asked = chunks.select("file", "pos", F.when(F.col("pos") == 0, head).otherwise(F.concat(F.lit("The comment goes on; treat this part alike:\n"), "chunk")).alias("prompt"))
    answers = chat(asked, "prompt", provider)
    joined = answers.groupBy("file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "answer"))), lambda x: F.coalesce(x["answer"], F.lit(""))), "\n").alias("joined"))
    return joined.select("file", sanitize(strip(F.col("joined"))).alias("standardized"))


def chunk_index(files: DataFrame, provider: EmbeddingProvider, size: int, text: str = "text") -> DataFrame:
    """(file, pos, chunk, embedding): the sentence-aligned chunks of each file with their vectors.

    The index is stored in the shared folder, so no reader of it embeds a chunk again.
    """
    chunks = files.select("file", F.posexplode(sentence_chunks(F.col(text), size)).alias("pos", "chunk"))
    return stored(embed(chunks, "chunk", provider).drop("embedding_error"))[0]


def contexts(index: DataFrame, asked: DataFrame, provider: EmbeddingProvider, k: int = 5, compat: bool = False) -> DataFrame:
    """`asked` (file, question, query) with `context`: the k chunks of the file nearest to the query, joined by line feeds.

    A file's chunks and its questions meet in one row, which holds about as much as the file's text did; the k nearest are
    taken there, so nothing is ranked across rows. compat repeats the last chunk where a file has fewer than k, as an index
    that pads its results would. Ties go to the earlier chunk; a file without chunks has an empty context.
    """
    vectors = embed(asked, "query", provider, "_q").drop("_q_error")
    questions = vectors.groupBy("file").agg(F.collect_list(F.struct(*vectors.columns)).alias("_asked"))
    packed = index.where("embedding IS NOT NULL").groupBy("file").agg(F.sort_array(F.collect_list(F.struct("pos", "chunk", "embedding"))).alias("_chunks"))

    def context(a: Column) -> Column:
        near = F.array_sort(F.transform("_chunks", lambda c: F.struct(squared_l2(c["embedding"], a["_q"]).alias("d"), c["pos"], c["chunk"].alias("chunk"))))
        parts = F.transform(F.slice(near, 1, k), lambda x: x["chunk"])
        if compat:
            parts = F.concat(parts, F.array_repeat(F.element_at("_chunks", -1)["chunk"], F.lit(k) - F.size(parts)))
        return F.coalesce(F.array_join(parts, "\n"), F.lit(""))

    joined = questions.join(packed, "file", "left")
    found = joined.select(F.explode(F.transform("_asked", lambda a: F.struct(a.alias("a"), context(a).alias("context")))).alias("x"))
    return found.select(*[F.col(f"x.a.{c}") for c in asked.columns], F.col("x.context").alias("context"))


def answer(index: DataFrame, asked: DataFrame, embedder: EmbeddingProvider, model: ChatProvider, k: int = 5) -> DataFrame:
    """(file, question, answer): a query is rewritten with its context, then answered with that same context."""
    found = contexts(index, asked, embedder, k)
    rewrite = F.concat(F.lit("Put this query in the terms of the passages given, asking for exactly the same.\n\nPassages:\n"), "context", F.lit("\n\nQuery: "), "query", F.lit("\nNew query:"))
    rewritten = chat(found.withColumn("_prompt", rewrite), "_prompt", model, "rewritten").drop("_prompt", "rewritten_error")
    ask = F.concat(F.lit("Answer from these passages, in short phrases.\n\nPassages:\n"), "context", F.lit("\n\nQuestion: "), F.coalesce("rewritten", F.lit("")), F.lit("\nAnswer:"))
    return chat(rewritten.withColumn("_prompt", ask), "_prompt", model).select("file", "question", "answer")


def has_organization(name: Column, compat: bool = False) -> Column:
    """Whether the answer names one. compat looks for 'n/a' in lower case alone."""
    return ~F.contains(name if compat else F.lower(name), F.lit("n/a"))


def structured_report(files: DataFrame, metadata: DataFrame, embedder: EmbeddingProvider, model: ChatProvider, size: int, k: int = 5, compat: bool = False) -> DataFrame:
    """A row of REPORT columns for each file. The questions are a literal, exploded per file; answers are pivoted by it.

    `metadata` has file, comment_id, date, commenter. The second wave is a filter before the model call, so files
    without an organization cost no call; the first wave's answers are stored, so the model is asked each question once.
    """
    index = chunk_index(files, embedder, size)
    people = files.select("file").join(metadata.select("file", "commenter"), "file", "left")

    def wave(rows: DataFrame, questions: dict[str, str]) -> DataFrame:
        asked = F.array(*[F.struct(F.lit(n).alias("question"), F.lit(q).alias("query")) for n, q in questions.items()])
        ask = rows.select("file", F.explode(asked).alias("x"), F.coalesce("commenter", F.lit("")).alias("_who"))
        ask = ask.select("file", "x.question", F.when(F.col("x.question") == "submitter_name", F.concat("x.query", "_who")).otherwise(F.col("x.query")).alias("query"))
        got = answer(index, ask, embedder, model, k)
        return got.groupBy("file").agg(*[F.max(F.when(F.col("question") == n, F.col("answer"))).alias(n) for n in questions])

    first, _ = stored(wave(people, FIRST_WAVE))
    named = people.join(first.where(has_organization(F.col("organization_name"), compat)).select("file"), "file", "left_semi")
    about = files.select("file", F.substring("text", 1, 49000).alias("comment_text")).join(metadata, "file", "left")
    both = about.join(first, "file", "left").join(wave(named, SECOND_WAVE), "file", "left")
    for c in SECOND_WAVE:
        both = both.withColumn(c, F.when(has_organization(F.col("organization_name"), compat), F.col(c)).otherwise("N/A"))
    return both.withColumn("comment_id", F.coalesce("comment_id", F.lit(""))).withColumn("date", F.coalesce("date", F.lit(""))).select(*REPORT)
