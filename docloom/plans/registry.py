"""Named queries over the driver's tables, each with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import chunks, text
from docloom.operators import comments, metadata, notices, providers, vector
from docloom.plans import collect, rag
from docloom.sources import files as file_source
from docloom.sources import html, sinks
from docloom.streaming import logs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a function as a query, with its SQL where there is one."""

    def put(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")




def _vector(name: str, metric: str, sql: str, order: str) -> None:
    oracle = f"""
    WITH q AS (SELECT embedding::DOUBLE[] AS qv FROM embeddings WHERE vec_id = 0),
    s AS (SELECT vec_id, round({sql}, 6) AS score FROM embeddings, q)
    SELECT vec_id, score FROM s ORDER BY score {order}, vec_id LIMIT 5
    """

    @query(name, oracle)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        emb = table(spark, sf_dir, "embeddings")
        return vector.top_k(emb, emb.where("vec_id = 0").select("embedding"), k=5, metric=metric)


_vector("vec_topk_cosine", "cosine", "list_cosine_similarity(embedding::DOUBLE[], qv)", "DESC")
_vector("vec_topk_dot", "dot", "list_dot_product(embedding::DOUBLE[], qv)", "DESC")
_vector("vec_topk_l2", "l2", "list_sum(list_transform(list_zip(embedding::DOUBLE[], qv), lambda z: (z[1] - z[2]) * (z[1] - z[2])))", "ASC")


@query(
    "vec_topk_per_label",
    """
    WITH q AS (SELECT label, embedding::DOUBLE[] AS qv FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS n FROM embeddings) WHERE n = 1),
    s AS (SELECT label, vec_id, round(list_cosine_similarity(embedding::DOUBLE[], qv), 6) AS score FROM embeddings JOIN q USING (label)),
    r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT label, vec_id, score, rank::INT AS rank FROM r WHERE rank <= 5
    """,
)
def vec_topk_per_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    first = emb.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("embedding"))
    return vector.top_k_by(emb, first, "label", k=5)


@query(
    "vec_rank_display",
    """
    WITH q AS (SELECT embedding::DOUBLE[] AS qv FROM embeddings WHERE vec_id = 7),
    s AS (SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], qv), 6) AS score FROM embeddings, q),
    t AS (SELECT * FROM s ORDER BY score DESC, vec_id LIMIT 10)
    SELECT vec_id, score, (row_number() OVER (ORDER BY score DESC, vec_id))::INT AS rank FROM t
    """,
)
def vec_rank_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    return vector.ranked(vector.top_k(emb, emb.where("vec_id = 7").select("embedding"), k=10))


@query(
    "chunk_sentences",
    """
    WITH c AS (SELECT doc_id, regexp_extract_all(text, '(?s).{500}[^.!?]*[.!?]|.+') AS cs FROM documents)
    SELECT doc_id, (pos - 1)::INT AS pos, cs[pos] AS chunk FROM (SELECT doc_id, cs, unnest(generate_series(1, len(cs))) AS pos FROM c)
    """,
)
def chunk_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunks.sentence_chunks(F.col("text"), 500)).alias("pos", "chunk"))


@query(
    "chunk_paragraphs",
    r"""
    WITH p AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, chr(32) || chr(9) || chr(13))), lambda x: x <> '') AS ps FROM documents),
    r AS (SELECT doc_id, CASE WHEN len(ps) = 0 THEN {'ch': []::VARCHAR[], 'cur': []::VARCHAR[], 'n': 0::BIGINT} ELSE list_reduce(
        list_transform(ps, lambda x: {'ch': []::VARCHAR[], 'cur': [x], 'n': len(list_filter(regexp_split_to_array(x, '\s+'), lambda w: w <> ''))}),
        lambda a, b: CASE WHEN a.n + b.n > 100 THEN {'ch': list_append(a.ch, array_to_string(a.cur, chr(10))), 'cur': b.cur, 'n': b.n}
                     ELSE {'ch': a.ch, 'cur': list_concat(a.cur, b.cur), 'n': a.n + b.n} END,
        {'ch': []::VARCHAR[], 'cur': []::VARCHAR[], 'n': 0::BIGINT}) END AS f FROM p),
    c AS (SELECT doc_id, CASE WHEN len(f.cur) > 0 THEN list_append(f.ch, array_to_string(f.cur, chr(10))) ELSE f.ch END AS cs FROM r)
    SELECT doc_id, (pos - 1)::INT AS pos, cs[pos] AS chunk FROM (SELECT doc_id, cs, unnest(generate_series(1, len(cs))) AS pos FROM c)
    """,
)
def chunk_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunks.paragraph_chunks(F.col("text"), 100, "\n")).alias("pos", "chunk"))


@query(
    "sanitize_text",
    r"SELECT doc_id, regexp_replace(translate(text, chr(61656) || chr(61623) || chr(61657) || chr(61658) || chr(61659), ' ' || chr(8226) || '   '), '[\x{80}-\x{9F}\x{FFFE}-\x{10FFFF}]', ' ', 'g') AS clean FROM documents",
)
def sanitize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.sanitize(F.col("text")).alias("clean"))


@query("token_counts", r"SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))::INT AS n_tokens FROM documents")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.token_count(F.col("text")).alias("n_tokens"))


#: Words that stand in for the notices' vocabulary on the driver's documents.
_TERMS = ["token", "license", "idiot", "clown", "that the", "nicht", "avec", "ing of"]


@query(
    "term_filter",
    "SELECT doc_id, source FROM documents WHERE contains(lower(text), 'token') OR contains(lower(text), 'license') OR contains(lower(text), 'idiot') OR contains(lower(text), 'clown')",
)
def term_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where(text.contains_any(F.col("text"), _TERMS[:4])).select("doc_id", "source")


_TITLE = "CASE page_id % 4 WHEN 0 THEN 'Request for Information ' WHEN 1 THEN 'PERFIDY ' WHEN 2 THEN 'Final Rule ' END || page_id"


@query("title_filter", f"SELECT page_id, title FROM (SELECT page_id, {_TITLE} AS title FROM pages) WHERE " + " OR ".join(f"contains(lower(title), '{t}')" for t in notices.TITLE_TERMS))
def title_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = table(spark, sf_dir, "pages").select("page_id", F.expr(_TITLE).alias("title"))
    return titles.where(notices.asks_for_comments(F.col("title")))


@query(
    "term_search_capped",
    """
    WITH t(term_idx, term) AS (VALUES (0, 'token'), (1, 'license'), (2, 'idiot'), (3, 'clown'), (4, 'that the'), (5, 'nicht'), (6, 'avec'), (7, 'ing of')),
    h AS (SELECT doc_id, source, term_idx, term, row_number() OVER (PARTITION BY term_idx ORDER BY n_chars DESC, doc_id) AS term_rank FROM documents JOIN t ON contains(lower(text), term)),
    f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY term_idx, term_rank) AS n FROM h WHERE term_rank <= 20)
    SELECT doc_id, source, term_idx::INT AS term_idx, term, term_rank::INT AS term_rank FROM f WHERE n = 1 ORDER BY term_idx, term_rank LIMIT 100
    """,
)
def term_search_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text", "n_chars")
    return notices.search(docs, _TERMS, "doc_id", "text", [F.desc("n_chars"), F.asc("doc_id")], 20, 100).select("doc_id", "source", "term_idx", "term", "term_rank")


@query("new_only_antijoin", "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def new_only_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notices.new_only(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


@query("relevance_gate", "SELECT doc_id, left(text, 1000) AS abstract, length(left(text, 1000)) >= 200 AS asked FROM documents")
def relevance_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    abstract = comments.abstract_of(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", abstract.alias("abstract"), comments.worth_asking(abstract).alias("asked"))


@query("relevance_verdict", "SELECT doc_id, quality FROM labels WHERE lower(trim(CASE WHEN quality = 1 THEN ' Yes ' ELSE 'Yes.' END)) = 'yes'")
def relevance_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = F.when(F.col("quality") == 1, " Yes ").otherwise("Yes.")
    return table(spark, sf_dir, "labels").where(comments.says_yes(answer)).select("doc_id", "quality")


@query(
    "submitter_normalise",
    r"""
    WITH s AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Comment Submitted by ' || c_name WHEN 1 THEN 'COMMENT FROM  ' || c_name || ' ' ELSE c_name END AS raw FROM customer)
    SELECT c_custkey, trim(regexp_replace(raw, '(?i)^(comment submitted by|comment from)\s*', '')) AS submitter,
           regexp_replace(trim(regexp_replace(raw, '(?i)^(comment submitted by|comment from)\s*', '')), '[^\p{L}\p{N}_]', '', 'g') AS letters,
           replace(raw, 'Comment Submitted by ', '') AS bare FROM s
    """,
)
def submitter_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, name = F.col("c_custkey"), F.col("c_name")
    raw = F.when(key % 3 == 0, F.concat(F.lit("Comment Submitted by "), name)).when(key % 3 == 1, F.concat(F.lit("COMMENT FROM  "), name, F.lit(" "))).otherwise(name)
    rows = table(spark, sf_dir, "customer").withColumn("raw", raw)
    return rows.select("c_custkey", text.submitter(F.col("raw")).alias("submitter"), text.word_characters(text.submitter(F.col("raw"))).alias("letters"), text.without_label(F.col("raw")).alias("bare"))


def _written_date() -> F.Column:
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    forms = [F.date_format(day, "MMM d, yyyy"), F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "yyyyMMdd"), F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T23:30:00-05:00")), F.lit("soon")]
    out = forms[-1]
    for i, f in enumerate(forms[:-1]):
        out = F.when(key % 5 == i, f).otherwise(out)
    return out


@query("date_key", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN 'unknownDate' ELSE strftime(o_orderdate, '%Y%m%d') END AS date_key FROM orders")
def date_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("written", _written_date()).select("o_orderkey", text.date_key(F.col("written")).alias("date_key"))


@query(
    "date_window",
    """
    SELECT event_id, strftime(ts, '%m/%d/%Y') || CASE WHEN event_id % 3 = 0 THEN '' ELSE ' - ' || strftime(ts + INTERVAL 30 DAY, '%m/%d/%Y') END AS comment_window FROM events
    """,
)
def date_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    published = text.reformat_date(F.date_format("ts", "yyyy-M-d"))
    closes = F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(text.reformat_date(F.date_format(F.expr("ts + INTERVAL 30 DAY"), "yyyy-M-d")))
    return rows.select("event_id", notices.comment_window(published, closes).alias("comment_window"))


_PAIRS = "('united states', 'USA'), ('united kingdom', 'UK'), ('saudi arabia', 'KSA'), ('china', 'PRC')"
_DICTIONARY = f"(VALUES {_PAIRS})"


def _dictionary(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {_PAIRS} AS d(agency, abbreviation)")


_INITIALS = r"array_to_string(list_transform(list_filter(regexp_split_to_array(lower(n_name), '\s+'), lambda w: w <> ''), lambda w: upper(left(w, 1))), '')"


@query("agency_abbrev", f"SELECT n_nationkey, coalesce(abbreviation, {_INITIALS}) AS abbreviation FROM nation LEFT JOIN {_DICTIONARY} d(agency, abbreviation) ON lower(n_name) = agency")
def agency_abbrev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.abbreviate(table(spark, sf_dir, "nation"), "n_name", _dictionary(spark)).select("n_nationkey", "abbreviation")


@query(
    "agency_title",
    r"""
    SELECT s_suppkey, array_to_string(list_transform(regexp_extract_all(x, '\p{L}+|\P{L}+'), lambda w: upper(left(w, 1)) || substr(w, 2)), '') AS agency
    FROM (SELECT s_suppkey, trim(regexp_replace(trim(replace(lower(trim(' Agency: ' || s_name || ' of the U.S. dept. ')), 'agency:', '')), '\.$', '')) AS x FROM supplier)
    """,
)
def agency_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit(" Agency: "), "s_name", F.lit(" of the U.S. dept. "))
    return table(spark, sf_dir, "supplier").select("s_suppkey", text.agency_name(raw).alias("agency"))


@query(
    "file_name",
    rf"""
    SELECT o_orderkey, concat_ws('__', coalesce(abbreviation, {_INITIALS}), regexp_replace(c_name, '[^\p{{L}}\p{{N}}_]', '', 'g'), strftime(o_orderdate, '%Y%m%d'), 'ID-' || o_orderkey) AS file_name
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey LEFT JOIN {_DICTIONARY} d(agency, abbreviation) ON lower(n_name) = agency
    """,
)
def file_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    agencies = metadata.abbreviate(table(spark, sf_dir, "nation"), "n_name", _dictionary(spark)).select("n_nationkey", "abbreviation")
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey").join(agencies, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate").join(people, F.col("o_custkey") == F.col("c_custkey"))
    posted, identity = F.date_format("o_orderdate", "MMM d, yyyy"), F.concat(F.lit("ID-"), F.col("o_orderkey").cast("string"))
    return rows.select("o_orderkey", text.file_name(F.col("abbreviation"), F.col("c_name"), posted, identity).alias("file_name"))


@query(
    "attachment_ordinal",
    """
    SELECT l_orderkey, l_linenumber, (row_number() OVER w)::INT AS attachment,
           CASE WHEN count(*) OVER (PARTITION BY l_orderkey) > 1 THEN 'C' || l_orderkey || '_attachment' || row_number() OVER w ELSE 'C' || l_orderkey END AS file_name
    FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber)
    """,
)
def attachment_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("numbers"))
    rows = lines.select("l_orderkey", "numbers", F.concat(F.lit("C"), F.col("l_orderkey").cast("string")).alias("file_base"), F.lit(False).alias("relevant"), F.transform("numbers", lambda n: F.array(n.cast("string"))).alias("attachments"))
    return comments.attachment_rows(rows).select("l_orderkey", F.element_at("numbers", F.col("attachment")).alias("l_linenumber"), "attachment", "file_name")


@query(
    "metadata_upsert_latest",
    "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1",
)
def metadata_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.latest(table(spark, sf_dir, "events").drop("props"), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@query("last_pointer", "SELECT event_id, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def last_pointer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.last_pointer(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts"), ["ts", "event_id"]).select("event_id", "user_id", "event_type")


@query("resume_after", "SELECT event_id, event_type FROM events WHERE event_id > (SELECT min(event_id) FROM events WHERE event_type = 'purchase')")
def resume_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comments.resume_after(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_id", "event_type", "purchase")


@query("previous_id", "SELECT user_id, event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS previous FROM events")
def previous_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comments.previous_ids(table(spark, sf_dir, "events").select("user_id", "event_id"), "user_id", "event_id", "event_id")


@query("group_duplicates", "SELECT 'order' || l_orderkey AS base, string_agg('order' || l_orderkey || '_attachment' || l_linenumber || '.pdf', ';' ORDER BY l_linenumber) AS files FROM lineitem GROUP BY l_orderkey")
def group_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("order"), F.col("l_orderkey").cast("string"), F.lit("_attachment"), F.col("l_linenumber").cast("string"), F.lit(".pdf"))
    files = table(spark, sf_dir, "lineitem").select(name.alias("file"), F.col("l_linenumber").alias("seq"))
    return metadata.group_files(files, "file", "seq").select("base", F.array_join("files", ";").alias("files"))


@query("file_parts", r"SELECT page_id, regexp_replace(f, '^(.*[^./][^/]*?)\.[^./]*$', '\1') AS base, lower(split_part(f, '.', -1)) AS suffix, regexp_extract(f, '\.[^.]*$') AS extension FROM (SELECT page_id, 'p' || page_id || CASE page_id % 3 WHEN 0 THEN '.PDF' WHEN 1 THEN '.tar.gz' ELSE '.docx' END AS f FROM pages)")
def file_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("page_id")
    f = F.concat(F.lit("p"), key.cast("string"), F.when(key % 3 == 0, ".PDF").when(key % 3 == 1, ".tar.gz").otherwise(".docx"))
    return table(spark, sf_dir, "pages").select("page_id", text.file_base(f).alias("base"), text.url_suffix(f).alias("suffix"), text.file_extension(f).alias("extension"))


@query(
    "report_row_na",
    """
    SELECT CASE WHEN d.doc_id = 0 THEN 'N/A' ELSE d.doc_id::VARCHAR END AS doc_id, coalesce(nullif(d.source, ''), 'N/A') AS source,
           CASE WHEN l.quality IS NULL OR l.quality = 0 THEN 'N/A' ELSE l.quality::VARCHAR END AS quality,
           CASE WHEN coalesce(d.text, '') = '' THEN 'N/A' ELSE trim(left(d.text, 49000), chr(32) || chr(9) || chr(10) || chr(13)) END AS comment_text
    FROM documents d LEFT JOIN labels l USING (doc_id)
    """,
)
def report_row_na(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return sinks.report(docs.select("doc_id", "source", "quality", F.substring("text", 1, 49000).alias("comment_text")))


@query("notice_report", """
    SELECT 'Notice ' || p_partkey AS title, p_brand AS agency, '06/05/2023' AS pub_date,
           CASE WHEN p_size > 25 THEN '06/05/2023 - 07/09/2023' ELSE '06/05/2023' END AS comment_window, p_name AS summary, '' AS url, '' AS notes, p_type AS type, p_partkey::VARCHAR AS doc_id
    FROM part""")
def notice_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").withColumn("document_number", F.col("p_partkey").cast("string"))
    found = part.select("document_number", F.concat(F.lit("Notice "), "document_number").alias("title"), F.lit("2023-6-5").alias("publication_date"), F.lit(None).cast("string").alias("html_url"), F.col("p_type").alias("type"))
    details = part.select("document_number", F.col("p_brand").alias("agency"), F.when(F.col("p_size") > 25, "2023-07-09").alias("comments_close_on"), F.col("p_name").alias("summary"))
    return notices.notice_rows(found, details)


@query("nonblank_count", "SELECT count(*) FILTER (trim(event_type) <> '') - 1 AS n_rows FROM events")
def nonblank_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").agg((F.count_if(F.trim("event_type") != "") - 1).alias("n_rows"))


@query("union_distinct_ids", "SELECT DISTINCT id FROM (SELECT doc_id AS id FROM documents UNION ALL SELECT page_id FROM pages UNION ALL SELECT conv_id FROM conversations)")
def union_distinct_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = [table(spark, sf_dir, t).select(F.col(c).alias("id")) for t, c in (("documents", "doc_id"), ("pages", "page_id"), ("conversations", "conv_id"))]
    return ids[0].unionByName(ids[1]).unionByName(ids[2]).dropDuplicates()


@query("chat_transcript", "SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS transcript FROM conversations GROUP BY conv_id")
def chat_transcript(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.concat("role", F.lit(": "), "text").alias("line")))).alias("turns"))
    return turns.select("conv_id", F.array_join(F.transform("turns", lambda x: x["line"]), "\n").alias("transcript"))


@query("running_context", "SELECT conv_id, turn, coalesce(string_agg(role, ',') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS context FROM conversations")
def running_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.running_text(table(spark, sf_dir, "conversations"), "conv_id", "turn", F.col("role"), ",").select("conv_id", "turn", "context")


@query("answer_lists", "SELECT event_id, list_filter(list_transform(string_split(event_type || ', ' || props, ','), lambda x: trim(x)), lambda x: x <> '')[1] AS first_answer, CASE WHEN event_type IN ('click', 'view') THEN event_type END AS role FROM events")
def answer_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = text.answer_list(F.concat("event_type", F.lit(", "), "props"))
    return table(spark, sf_dir, "events").select("event_id", F.get(answers, F.lit(0)).alias("first_answer"), text.validated(F.col("event_type"), ["click", "view"]).alias("role"))


@query("log_levels", "SELECT time_bucket(INTERVAL 10 MINUTE, date_trunc('second', ts)) AS start, CASE event_type WHEN 'error' THEN 'ERROR' ELSE 'INFO' END AS level, count(*) AS n FROM events GROUP BY ALL")
def log_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    lines = table(spark, sf_dir, "events").select(logs.log_line(F.col("ts"), level, F.col("props")).alias("value"))
    return logs.level_counts(logs.parse_logs(lines)).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query(
    "html_title",
    """
    SELECT page_id, regexp_replace(regexp_replace(regexp_replace(t, '&quot;?', '"', 'g'), '&middot;?', chr(183), 'g'), '&amp;?', '&', 'g') AS title
    FROM (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS t FROM pages)
    """,
)
def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.parsed_pages(table(spark, sf_dir, "pages").select("page_id", "html"), "title").select("page_id", "title")


@query("html_links_pick", '''SELECT page_id, len(ls) AS n_links, coalesce(list_filter(ls, lambda x: contains(x, 'pdf'))[1], ls[1]) AS link FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS ls FROM pages)''')
def html_links_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.parsed_pages(table(spark, sf_dir, "pages").select("page_id", "html"), "links").select("page_id", F.size("links").cast("long").alias("n_links"), comments.pick_link(F.col("links")).alias("link"))


@query(
    "html_text",
    r"""
    SELECT page_id, regexp_replace(regexp_replace(replace(replace(replace(replace(replace(t, '&middot;', chr(183)), '&copy;', chr(169)), '&nbsp;', chr(160)), '&lt;', '<'), '&gt;', '>'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g') AS page_text
    FROM (SELECT page_id, regexp_replace(html, '(?s)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->|<[^>]*>', '', 'g') AS t FROM pages)
    """,
)
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.parsed_pages(table(spark, sf_dir, "pages").select("page_id", "html"), "page_text").select("page_id", "page_text")


@query("url_absolute", "SELECT page_id, CASE WHEN starts_with(u, 'http') THEN u ELSE 'https://host.example' || u END AS url FROM (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url ELSE '/p/' || page_id END AS u FROM pages)")
def url_absolute(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(F.concat(F.lit("/p/"), F.col("page_id").cast("string")))
    return table(spark, sf_dir, "pages").select("page_id", text.absolute_url(u, "https://host.example").alias("url"))


@query("error_pages", "SELECT page_id, contains(lower(html), 'we''re sorry, an error has occurred') AS failed, contains(lower(coalesce(url, '') || CASE WHEN page_id % 7 = 0 THEN ' Quota exceeded' ELSE '' END), 'quota') AS quota FROM pages")
def error_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", comments.is_error_page(F.col("html")).alias("failed"), comments.is_quota_error(F.concat(F.coalesce("url", F.lit("")), F.when(F.col("page_id") % 7 == 0, " Quota exceeded").otherwise(""))).alias("quota"))


@query("pdf_magic", "SELECT doc_id, starts_with(CASE WHEN doc_id % 2 = 0 THEN '%PDF-1.7 ' ELSE '' END || coalesce(text, ''), '%PDF') AS is_pdf FROM documents")
def pdf_magic(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.concat(F.when(F.col("doc_id") % 2 == 0, "%PDF-1.7 ").otherwise(""), F.coalesce("text", F.lit(""))).cast("binary")
    return table(spark, sf_dir, "documents").select("doc_id", file_source.is_pdf(content).alias("is_pdf"))


#: SQL: the paragraph chunks of `documents`, of at most 500 words; and the sentence chunks with their letters counted.
_PARAGRAPHS = r"""
    p AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, chr(32) || chr(9) || chr(13))), lambda x: x <> '') AS ps FROM documents),
    r AS (SELECT doc_id, list_reduce(
        list_transform(ps, lambda x: {'ch': []::VARCHAR[], 'cur': [x], 'n': len(list_filter(regexp_split_to_array(x, '\s+'), lambda w: w <> ''))}),
        lambda a, b: CASE WHEN a.n + b.n > 500 THEN {'ch': list_append(a.ch, array_to_string(a.cur, chr(10))), 'cur': b.cur, 'n': b.n}
                     ELSE {'ch': a.ch, 'cur': list_concat(a.cur, b.cur), 'n': a.n + b.n} END,
        {'ch': []::VARCHAR[], 'cur': []::VARCHAR[], 'n': 0::BIGINT}) AS f FROM p WHERE len(ps) > 0),
    c AS (SELECT doc_id, list_append(f.ch, array_to_string(f.cur, chr(10))) AS cs FROM r)"""
_LETTERS = "list_transform(string_split('abcdefghijklmnopqrstuvwxyz', ''), lambda c: length(lower({0})) - length(replace(lower({0}), c, '')))"


def _near(size: int) -> str:
    """SQL: `ctx` (doc_id, question, query, context) for questions in `asked`: the five chunks with the nearest letter counts."""
    return f"""
    ch AS (SELECT doc_id, pos, cs[pos] AS chunk FROM (SELECT doc_id, cs, unnest(generate_series(1, len(cs))) AS pos FROM (SELECT doc_id, regexp_extract_all(text, '(?s).{{{size}}}[^.!?]*[.!?]|.+') AS cs FROM documents))),
    cv AS (SELECT *, {_LETTERS.format("chunk")} AS v FROM ch),
    qv AS (SELECT *, {_LETTERS.format("query")} AS q FROM asked),
    sc AS (SELECT qv.doc_id, question, pos, chunk, row_number() OVER (PARTITION BY qv.doc_id, question ORDER BY list_sum(list_transform(list_zip(v, q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), pos) AS n FROM qv JOIN cv USING (doc_id)),
    ctx AS (SELECT asked.doc_id, question, any_value(query) AS query, coalesce(string_agg(chunk, chr(10) ORDER BY n) FILTER (n <= 5), '') AS context FROM asked LEFT JOIN sc USING (doc_id, question) GROUP BY asked.doc_id, question)"""


@query(
    "standardize_comments",
    f"""
    WITH {_PARAGRAPHS},
    l AS (SELECT doc_id, pos, list_filter(list_transform(string_split(cs[pos], chr(10)), lambda x: trim(x)), lambda x: x <> '')[-1] AS line FROM (SELECT doc_id, cs, unnest(generate_series(1, len(cs))) AS pos FROM c)),
    j AS (SELECT doc_id, trim(string_agg(CASE WHEN line IS NULL AND pos = 1 THEN 'Format: Filename, Date Submitted, Submitter Name, Agency, Comment ID, Comment Text' ELSE line END, chr(10) ORDER BY pos)) AS j FROM l GROUP BY doc_id)
    SELECT doc_id::VARCHAR AS file, regexp_replace(j, '[\\x{{80}}-\\x{{9F}}\\x{{FFFE}}-\\x{{10FFFF}}]', ' ', 'g') AS standardized FROM j
    """,
)
def standardize_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("file"), "text", F.struct("source", "lang").alias("metadata"))
    return rag.standardize(docs, providers.EchoChat(), most=500, separator="\n")


@query(
    "rag_context",
    f"""
    WITH asked AS (SELECT doc_id, 'who' AS question, 'who submitted the comment' AS query FROM documents), {_near(500)}
    SELECT doc_id::VARCHAR AS file, context FROM ctx
    """,
)
def rag_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("file"), "text")
    asked = files.select("file", F.lit("who").alias("question"), F.lit("who submitted the comment").alias("query"))
    embedder = providers.LetterEmbedding()
    return rag.contexts(rag.chunk_index(files, embedder, 500), asked, embedder).select("file", "context")


_QUESTIONS = ", ".join("('{}', '{}')".format(n, q.replace("'", "''")) for n, q in {**rag.FIRST_WAVE, **rag.SECOND_WAVE}.items())
_ANSWER = "coalesce(nullif(left(trim(regexp_extract(context, '[^\\n]*[^\\s][^\\n]*')), 80), ''), 'N/A')"
_PICK = ", ".join([f"max(answer) FILTER (question = '{n}') AS {n}" for n in rag.FIRST_WAVE] + [f"CASE WHEN max(answer) FILTER (question = 'organization_name') <> 'N/A' THEN max(answer) FILTER (question = '{n}') ELSE 'N/A' END AS {n}" for n in rag.SECOND_WAVE])


@query(
    "structured_report",
    f"""
    WITH asked AS (SELECT doc_id, question, CASE WHEN question = 'submitter_name' THEN query || coalesce(source, '') ELSE query END AS query FROM documents, (VALUES {_QUESTIONS}) AS t(question, query)), {_near(1000)},
    a AS (SELECT doc_id, question, CASE WHEN question <> 'organization_name' THEN {_ANSWER} WHEN length(context) % 2 = 1 THEN 'Organization ' || length(context) ELSE 'N/A' END AS answer FROM ctx),
    w AS (SELECT doc_id, {_PICK} FROM a GROUP BY doc_id)
    SELECT doc_id::VARCHAR AS comment_id, doc_id::VARCHAR AS file, '2023-06-15' AS date, w.* EXCLUDE (doc_id), left(text, 49000) AS comment_text FROM documents JOIN w USING (doc_id)
    """,
)
def structured_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = docs.select(F.col("doc_id").cast("string").alias("file"), "text")
    about = docs.select(F.col("doc_id").cast("string").alias("file"), F.col("doc_id").cast("string").alias("comment_id"), F.lit("2023-06-15").alias("date"), F.col("source").alias("commenter"))
    return rag.structured_report(files, about, providers.LetterEmbedding(), providers.PassageChat(), 1000)


#: SQL and columns of notices made from `documents`: the first words as abstract, a title and type by number, days of one month.
_NOTICE_TITLE = "CASE doc_id % 4 WHEN 0 THEN 'Request for Information ' WHEN 1 THEN 'PERFIDY ' WHEN 2 THEN 'Final ' ELSE 'Notice of ' END || doc_id"
_NOTICE_TYPE = "CASE WHEN doc_id % 5 = 0 THEN 'RULE' ELSE 'NOTICE' END"
_NOTICE_DAY = "'2023-06-' || lpad(({0})::VARCHAR, 2, '0')"


def _notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.concat(F.lit("2023-06-"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("document_number"), F.expr(_NOTICE_TITLE).alias("title"), F.substring("text", 1, 300).alias("abstract"), day.alias("publication_date"), F.lit(None).cast("string").alias("html_url"), F.expr(_NOTICE_TYPE).alias("type"), "doc_id",
    )


@query(
    "notices_since",
    """
    SELECT event_id, event_type FROM (SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-20' AND event_type IN ('click', 'view') AND contains(lower(props), '7') ORDER BY ts DESC, event_id LIMIT 500)
    """,
)
def notices_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search by term, start date and type; both filters reach the scan. Newest first."""
    found = notices.published_since(table(spark, sf_dir, "events"), "2024-01-20", ["click", "view"], "ts", "event_type")
    return notices.search(found, ["7"], "event_id", "props", notices.search_order("newest", "ts", "event_id"), 500, 1000).select("event_id", "event_type")


_NOTICES_SQL = f"""
    n AS (SELECT doc_id, {_NOTICE_TITLE} AS title, left(text, 300) AS abstract, {_NOTICE_DAY.format("doc_id % 28 + 1")} AS day, {_NOTICE_TYPE} AS type, source FROM documents),
    k AS (SELECT * FROM n WHERE day >= '2023-06-05' AND type = 'NOTICE' AND doc_id % 4 <> 2 AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = n.doc_id)),
    t(i, term) AS (VALUES (0, 'token'), (1, 'license'), (2, 'that the'), (3, 'nicht'), (4, 'avec')),
    h AS (SELECT k.*, i, row_number() OVER (PARTITION BY i ORDER BY day, doc_id::VARCHAR) AS r FROM k JOIN t ON contains(lower(abstract), term)),
    f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i, r) AS first FROM h WHERE r <= 200),
    g AS (SELECT * FROM f WHERE first = 1 ORDER BY i, r LIMIT 500)"""


@query(
    "notice_collection",
    f"""
    WITH {_NOTICES_SQL}
    SELECT title, source AS agency, strftime(day::DATE, '%m/%d/%Y') AS pub_date,
           strftime(day::DATE, '%m/%d/%Y') || CASE doc_id % 3 WHEN 0 THEN ' - 08/01/2023' WHEN 1 THEN ' - 07/09/2023' ELSE '' END AS comment_window,
           CASE WHEN len(list_filter(string_split(abstract, chr(10)), lambda x: trim(x) <> '')) < 2 THEN 'Summarize this notice in one or two sentences: ' ELSE '' END || trim(list_filter(string_split(abstract, chr(10)), lambda x: trim(x) <> '')[-1]) AS summary,
           '' AS url, '' AS notes, type, doc_id::VARCHAR AS doc_id FROM g
    """,
)
def notice_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole collection: a third of the notices has a close date, a third tells it in the body, a third nowhere."""
    found = _notices(spark, sf_dir)
    key = F.col("doc_id")
    details = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("document_number"), F.col("source").alias("agency"), F.when(key % 3 == 0, "2023-08-01").alias("comments_close_on"), F.concat("text", F.when(key % 3 == 1, "\n07/09/2023").otherwise("\nNONE")).alias("body"))
    known = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("document_number"))
    return collect.notice_rows(found.drop("doc_id"), known, details, providers.EchoChat(), ["token", "license", "that the", "nicht", "avec"], notices.search_order("oldest", "publication_date", "document_number"), 200, 500, "2023-06-05", ["NOTICE"])


@query(
    "close_dates",
    """
    SELECT doc_id::VARCHAR AS document_number, CASE WHEN doc_id % 3 = 0 THEN '2023-08-01' WHEN doc_id % 3 = 1 AND '2023-07-09' > '2023-0' || (6 + doc_id % 4) || '-01' THEN '2023-07-09' END AS comments_close_on FROM documents
    """,
)
def close_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select(
        key.cast("string").alias("document_number"), F.concat(F.lit("2023-0"), (6 + key % 4).cast("string"), F.lit("-01")).alias("publication_date"),
        F.when(key % 3 == 0, "2023-08-01").alias("comments_close_on"), F.concat("text", F.when(key % 3 == 1, "\n07/09/2023").otherwise("\nNONE")).alias("body"),
    )
    return notices.fill_close_dates(rows, providers.EchoChat()).select("document_number", "comments_close_on")


@query(
    "comment_collection",
    r"""
    WITH c AS (SELECT doc_id, source, length(left(text, 1000)) >= 200 AND contains(left(text, 1000), 'the ') AS relevant FROM documents WHERE doc_id > 20),
    f AS (SELECT *, unnest(CASE WHEN relevant THEN [NULL] ELSE []::VARCHAR[] END || CASE WHEN doc_id % 2 = 0 THEN ['/f/' || doc_id || '.pdf'] ELSE []::VARCHAR[] END) AS link,
                 generate_subscripts(CASE WHEN relevant THEN [NULL] ELSE []::VARCHAR[] END || CASE WHEN doc_id % 2 = 0 THEN ['/f/' || doc_id || '.pdf'] ELSE []::VARCHAR[] END, 1) AS attachment,
                 relevant::INT + (doc_id % 2 = 0)::INT AS total FROM c)
    SELECT 'C' || doc_id AS id, doc_id AS seq, relevant, attachment::INT AS attachment, link,
           CASE source WHEN 'web' THEN 'WWW' ELSE upper(left(source, 1)) END || '__' || regexp_replace('Ann ' || doc_id, '[^\p{L}\p{N}_]', '', 'g') || '__20230605__C' || doc_id || CASE WHEN total > 1 THEN '_attachment' || attachment ELSE '' END AS file_name FROM f
    """,
)
def comment_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards after a checkpoint, relevance by a model that says yes to a phrase, attachments with names."""
    docs, key = table(spark, sf_dir, "documents"), F.col("doc_id").cast("string")
    cards = docs.select(F.col("doc_id").alias("seq"), F.concat(F.lit("C"), key).alias("id"), F.lit("Jun 5, 2023").alias("date"), F.concat(F.lit("Comment from Ann "), key).alias("name"), F.col("source").alias("agency"))
    links = F.when(F.col("doc_id") % 2 == 0, F.array(F.array(F.concat(F.lit("/f/"), key, F.lit(".doc")), F.concat(F.lit("/f/"), key, F.lit(".pdf"))))).otherwise(F.array().cast("array<array<string>>"))
    pages = docs.select(F.concat(F.lit("C"), key).alias("id"), "text", links.alias("attachments"))
    known = spark.sql("SELECT * FROM VALUES ('web', 'WWW') AS d(agency, abbreviation)")
    return collect.comment_files(cards, pages, providers.EchoChat({"the ": "Yes"}), known, "C20")[0]


@query("relevance_model", "SELECT doc_id, length(left(text, 1000)) >= 200 AND contains(left(text, 1000), 'und') AS relevant FROM documents")
def relevance_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comments.with_relevance(table(spark, sf_dir, "documents").select("doc_id", "text"), providers.EchoChat({"und": " YES "})).select("doc_id", "relevant")


@query(
    "metadata_join",
    """
    SELECT 'order' || l_orderkey || CASE WHEN l_linenumber = 1 THEN '' ELSE '_attachment' || l_linenumber END || '.pdf' AS file, strftime(o_orderdate, '%Y-%m-%d') AS date, c_name AS commenter
    FROM lineitem LEFT JOIN (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 2 = 0) ON l_orderkey = o_orderkey
    """,
)
def metadata_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with the metadata of their own base, or of the comment that they are attached to."""
    number = F.when(F.col("l_linenumber") == 1, "").otherwise(F.concat(F.lit("_attachment"), F.col("l_linenumber").cast("string")))
    files = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("order"), F.col("l_orderkey").cast("string"), number, F.lit(".pdf")).alias("file"))
    people = table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    entries = people.select(F.concat(F.lit("order"), F.col("o_orderkey").cast("string")).alias("file_base"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("c_name").alias("commenter"))
    return metadata.with_metadata(files, entries, "file")


@query("known_ids", "SELECT DISTINCT trim(x) AS document_number FROM (SELECT CASE doc_id % 3 WHEN 0 THEN ' ' || (doc_id // 6) || ' ' WHEN 1 THEN (doc_id // 6)::VARCHAR ELSE ' ' END AS x FROM documents) WHERE trim(x) <> ''")
def known_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.floor(F.col("doc_id") / 6).cast("string")
    raw = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(" "), key, F.lit(" "))).when(F.col("doc_id") % 3 == 1, key).otherwise(" ")
    return notices.existing_ids(table(spark, sf_dir, "documents").select(raw.alias("doc_id")))


@query("search_terms", "SELECT conv_id, turn, list_filter(list_transform(string_split(text, ','), lambda x: trim(x, chr(32) || chr(10) || chr(9) || chr(13))), lambda x: x <> '') AS terms FROM conversations")
def search_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", notices.search_terms_column(F.col("text")).alias("terms"))


@query("matched_order", "SELECT doc_id, (contains(lower(text), 'token')::INT + contains(lower(text), 'license')::INT + contains(lower(text), 'that the')::INT) AS matched FROM documents ORDER BY 2 DESC, 1 LIMIT 50")
def matched_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched = notices.matched_terms(F.col("text"), ["token", "license", "that the"])
    docs = table(spark, sf_dir, "documents").select("doc_id", matched.alias("matched"))
    return docs.orderBy(*notices.search_order("relevance", "", "doc_id", F.col("matched"))).limit(50)


@query("card_records", "SELECT 'Jun 5, 2023' AS date, 'Ann ' || c_custkey AS name, c_mktsegment AS agency, 'https://host.example/c/' || c_custkey AS url, CASE WHEN c_custkey % 2 = 0 THEN '' ELSE 'N-' || c_custkey END AS id FROM customer")
def card_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards with labelled items: the label goes from its text, a missing label gives an empty field."""
    key = F.col("c_custkey").cast("string")
    item = lambda label, value: F.struct(F.lit(label).alias("label"), F.concat(F.lit(label), F.lit(" "), value).alias("text"))
    items = F.array(item(" Posted", F.lit("Jun 5, 2023")), item("Agency", F.col("c_mktsegment")), F.when(F.col("c_custkey") % 2 == 1, item("ID", F.concat(F.lit("N-"), key))).otherwise(item("Other", key)))
    cards = table(spark, sf_dir, "customer").select(F.concat(F.lit("Comment Submitted by Ann "), key, F.lit(" ")).alias("title"), F.concat(F.lit("/c/"), key).alias("href"), comments.label_map(items).alias("meta"))
    return comments.card_records(cards, "https://host.example")


#: A page with an agency, attachment cards and a notice card, by page number.
_DETAIL = [
    "<html><body><div id='agency'>Agency: Office of ", "label", ".</div><div class='x card card-attachment'><a href='/a", "page", ".doc'>d</a><a href='/a", "page", ".pdf'>p</a></div><div class='card-attachment card'></div>"
    "<div class='card card-type-notice'><h3 class='card-title'><a href='/n/", "page", "'>N</a></h3><ul><li><strong>ID</strong> D-", "page", "</li></ul></div></body></html>",
]


def _details(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = {"label": F.concat(F.lit("unit "), (F.col("page_id") % 9).cast("string")), "page": F.col("page_id").cast("string")}
    return table(spark, sf_dir, "pages").select("page_id", F.concat(*[parts.get(x, F.lit(x)) for x in _DETAIL]).alias("html"))


@query("detail_pages", "SELECT page_id, 'Office Of Unit ' || page_id % 9 AS agency, '/a' || page_id || '.pdf' AS link, 2 AS cards FROM pages")
def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html.parsed_pages(html.agencies(_details(spark, sf_dir)), "attachments")
    return pages.select("page_id", "agency", comments.pick_link(F.get("attachments", F.lit(0))).alias("link"), F.size("attachments").alias("cards"))


@query("document_ids", "SELECT page_id, 0 AS pos, 'D-' || page_id AS id FROM pages")
def document_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.document_ids(_details(spark, sf_dir))


@query("metadata_entries", "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'lastComment' ELSE 'F__' || user_id END AS file_base, event_type AS agency, CASE WHEN event_id % 4 = 0 THEN (user_id % 9)::INT END AS page FROM events")
def metadata_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored metadata objects parsed with their explicit schema; the pointer is a key like any other here."""
    entry = F.when(F.col("event_id") % 4 == 0, F.struct(F.col("event_type").alias("agency"), (F.col("user_id") % 9).alias("page"))).otherwise(F.struct(F.col("event_type").alias("agency"), F.lit(None).cast("long").alias("page")))
    name = F.when(F.col("event_id") % 4 == 0, metadata.POINTER).otherwise(F.concat(F.lit("F__"), F.col("user_id").cast("string")))
    raw = table(spark, sf_dir, "events").select("event_id", F.to_json(F.create_map(name, entry)).alias("value"))
    return raw.select("event_id", F.explode(F.from_json("value", f"map<string,{metadata.ENTRY}>")).alias("file_base", "entry")).select("event_id", "file_base", "entry.agency", "entry.page")


@query("log_lines", "SELECT event_id, strftime(ts, '%m/%d/%Y - %H:%M:%S') || ' - [INFO] - ' || event_type AS line FROM events")
def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", logs.log_line(F.col("ts"), F.lit("INFO"), F.col("event_type")).alias("line"))


@query("new_event_keys", "SELECT DISTINCT user_id FROM events")
def new_event_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.new_events(table(spark, sf_dir, "events").select("user_id", "ts"), "user_id", "ts").select("user_id")


@query("clean_summaries", "SELECT conv_id, turn, trim(text) AS summary FROM conversations")
def clean_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.when(F.col("turn") % 2 == 0, F.concat(F.lit(" Here is a summary of the notice: "), "text")).otherwise(F.col("text"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", notices.clean_summary(said).alias("summary"))


@query(
    "file_texts",
    r"""
    SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN trim(text, chr(32) || chr(9) || chr(10) || chr(13)) WHEN 1 THEN trim(trim(text, chr(32) || chr(9) || chr(10) || chr(13)) || chr(10) || 'seen', chr(32) || chr(10)) END AS text, doc_id % 3 = 2 AS failed FROM documents
    """,
)
def file_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dispatch by suffix: texts, PDF pages by an extractor (the second page has no text of its own), and an unknown suffix."""
    key = F.col("doc_id")
    name = F.concat(F.lit("f"), key.cast("string"), F.when(key % 3 == 0, ".TXT").when(key % 3 == 1, ".pdf").otherwise(".xyz"))
    files = table(spark, sf_dir, "documents").select("doc_id", name.alias("file"), F.col("text").cast("binary").alias("content"))
    read = file_source.extract_texts(files, lambda data: [(data.decode().strip(), ""), (" ", "seen")])
    return read.select("doc_id", "text", F.col("error").isNotNull().alias("failed"))


@query("abstract_documents", "SELECT doc_id, source || chr(10) || chr(10) || 'Date: 2023-06-05' || chr(10) || 'Agency: ' || lang || chr(10) || 'ID: ' || doc_id || chr(10) || chr(10) || left(text, 1000) AS document FROM documents")
def abstract_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = comments.abstract_of(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", sinks.abstract_document(F.col("source"), F.lit("2023-06-05"), F.col("lang"), F.col("doc_id").cast("string"), body).alias("document"))


@query(
    "padded_topk",
    """
    WITH q AS (SELECT embedding::DOUBLE[] AS qv FROM embeddings WHERE vec_id = 3),
    s AS (SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], qv), 6) AS score FROM embeddings, q WHERE vec_id < 4),
    r AS (SELECT vec_id, (row_number() OVER (ORDER BY score DESC, vec_id))::INT AS rank FROM s)
    SELECT rank, vec_id FROM r UNION ALL SELECT unnest([5, 6])::INT, (SELECT max(vec_id) FROM embeddings)
    """,
)
def padded_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search over an index of four vectors that asks for six: the last vector of all fills the places."""
    emb = table(spark, sf_dir, "embeddings")
    found = vector.ranked(vector.top_k(emb.where("vec_id < 4"), emb.where("vec_id = 3").select("embedding"), k=6)).select("rank", "vec_id")
    return vector.padded_search(found, 6, emb.agg(F.max("vec_id").alias("vec_id")))


@query("total_count", "SELECT count(*) AS n_rows, min(length(text))::INT AS shortest FROM documents")
def total_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").agg(F.count("*").alias("n_rows"), F.min(F.length("text")).alias("shortest"))
