import datetime
import io
import json
import zipfile
from html import unescape
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from docloom.operators import comments, notices, providers
from docloom.plans import collect, rag
from docloom.plans.registry import QUERIES
from docloom.sources import files, html, sinks, store, vectors
from docloom.sources import paged
from docloom.sources.paged import PagedComments
from docloom.streaming import logs


def docx(*paragraphs):
    ns = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    body = "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {ns}><w:body>{body}</w:body></w:document>")
    return out.getvalue()


def test_files(spark, tmp_path):
    for name, data in {"a.txt": b" hi \n", "b.DOCX": docx("one", "two"), "c.pdf": b"%PDF-x", "d.PDF": b"bad", "e.xyz": b"x"}.items():
        (tmp_path / name).write_bytes(data)
    assert sorted(r.file for r in files.list_files(spark, str(tmp_path)).collect()) == ["c.pdf", "d.PDF"]
    assert [r.file for r in files.list_files(spark, str(tmp_path), any_case=False).collect()] == ["c.pdf"]

    def pages(data):
        if not data.startswith(b"%PDF"):
            raise ValueError("no pdf")
        return [("own text", "seen"), ("  ", "read by eye")]

    found = spark.read.format("binaryFile").load(str(tmp_path)).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    got = {r.file: (r.text, r.error) for r in files.extract_texts(found, pages).collect()}
    assert got["a.txt"] == ("hi", None) and got["b.DOCX"] == ("one\ntwo", None) and got["c.pdf"] == ("own text\nread by eye", None)
    assert got["d.PDF"] == ("", "ValueError: no pdf") and got["e.xyz"][0] is None and "unsupported" in got["e.xyz"][1]
    assert files.extract_texts(found.where("file = 'c.pdf'")).first().error

    def torn(data):
        yield "page one", ""
        raise ValueError("torn")

    assert files.extract_texts(found.where("file = 'c.pdf'"), torn).select("text", "error").first() == ("page one", "ValueError: torn")
    portfolio = spark.createDataFrame([([b"PK", b"%PDF-1", b"%PDF-2"], b"own"), ([], b"own")], "e array<binary>, own binary")
    assert [bytes(r[0]) for r in portfolio.select(files.first_pdf(F.col("e"), F.col("own"))).collect()] == [b"%PDF-1", b"own"]


PAGE = """<html><head><title>A &amp; B</title><script>var x;</script></head><body><div id="agency">Agency: Office of the U.S. Trade.</div>
<div id="mainContent">Hello <b>there</b></div><div class="card card-attachment"><a href="/x.doc">d</a><a href="/y.pdf">p</a></div>
<div class="card card-type-notice"><h3 class="card-title"><a href="/n/1">First</a></h3><ul><li><strong>ID</strong> D-1</li><li><strong>Posted</strong> Jun 5, 2023</li></ul></div></body></html>"""


def test_html(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, "<p>open <b>tags")], "page_id int, html string")
    got = {r.page_id: r for r in html.parsed_pages(pages, card_class="card-type-notice").collect()}
    assert got[1].title == "A & B" and got[1].main_text == "Hello there" and "var x" not in got[1].page_text
    assert got[1].attachments == [["/x.doc", "/y.pdf"]] and got[1].cards[0].title == "First"
    assert got[2].page_text == "" and got[2].cards == [] and got[3].page_text == "open tags"
    assert [(r.page_id, r.id) for r in html.document_ids(pages).collect()] == [(1, "D-1")]
    assert html.agencies(pages).where("page_id = 1").first().agency == "Office Of The U.S. Trade"


def test_every_page_has_its_title(spark, tmp_path):
    titles = ["AT&T", "Q&A", "a & b", "R&D &amp; more", "&copy 2023", "&ampx", "end &", "&bogus; &bogus", "&middot;&quot;x&quot;", "plain", ""]
    rows = [(i, f"<html><head><title>{t}</title></head><body>{t}</body></html>") for i, t in enumerate(titles)]
    spark.createDataFrame(rows, "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: r.title for r in QUERIES["html_title"](spark, str(tmp_path)).collect()}
    assert got == {i: unescape(t) for i, t in enumerate(titles)}


def test_paged_source(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    for n, ids in ((1, "ab"), (2, "c"), (4, "z")):
        (pages / f"page_{n}.json").write_text(json.dumps([{"id": i, "name": i.upper()} for i in ids]))
    spark.dataSource.register(PagedComments)
    got = spark.read.format("paged_comments").option("folder", str(pages)).load()
    want = [(1, "a", ""), (1, "b", ""), (2, "c", "")]
    assert sorted((r.page, r.id, r.agency) for r in got.collect()) == want
    assert sorted((r.page, r.id, r.agency) for r in paged.read_pages(spark, str(pages)).collect()) == want
    assert paged.read_pages(spark, str(pages), 3).count() == 0 and paged.read_pages(spark, str(pages), 4).count() == 1
    (pages / "page_3.json").write_text(" [ ]\n")
    assert paged.page_run(str(pages), 1) == range(1, 3) and paged.read_pages(spark, str(pages)).count() == 3
    (pages / "page_3.json").unlink()
    q = spark.readStream.format("paged_comments").option("folder", str(pages)).load().writeStream.format("memory").queryName("paged").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        for _ in range(60):
            q.awaitTermination(1)
            if spark.table("paged").count() == 3:
                break
        assert sorted(r.id for r in spark.table("paged").collect()) == ["a", "b", "c"]
    finally:
        q.stop()


def test_log_stream(spark, tmp_path):
    lines = ["06/05/2023 - 10:01:00 - [INFO] - one", "06/05/2023 - 10:09:59 - [ERROR] - two - [x]", "06/05/2023 - 10:10:00 - [INFO] - three", "no line"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text("\n".join(lines))
    table = logs.read_logs(spark, str(tmp_path / "in"))
    assert table.where("level = 'ERROR'").first().message == "two - [x]" and table.where("ts IS NULL").first().message == "no line"
    q = logs.level_counts(logs.stream_logs(spark, str(tmp_path / "in"))).writeStream.outputMode("complete").format("memory").queryName("levels").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    want = {(datetime.datetime(2023, 6, 5, 10, 0), "INFO", 1), (datetime.datetime(2023, 6, 5, 10, 0), "ERROR", 1), (datetime.datetime(2023, 6, 5, 10, 10), "INFO", 1)}
    assert {tuple(r) for r in spark.table("levels").collect()} == want == {tuple(r) for r in logs.level_counts(table).collect()}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, " a ", None), (0, "", "x")], "n int, s string, t string")
    sinks.append_report(df, str(tmp_path / "r"))
    sinks.append_report(df, str(tmp_path / "r"))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "r")).collect())) == [("1", "a", "N/A")] * 2 + [("N/A", "N/A", "x")] * 2
    assert sinks.load_pointer(spark, str(tmp_path / "p"), "d") is None
    sinks.save_pointer(spark, str(tmp_path / "p"), "d", "c1")
    sinks.save_pointer(spark, str(tmp_path / "p"), "d", "c2")
    assert sinks.load_pointer(spark, str(tmp_path / "p"), "d") == "c2"
    sinks.write_standardized(spark.createDataFrame([("d1", "f", "t")], "document_id string, file string, text string"), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).where("document_id = 'd1'").count() == 1


def test_document_zero_is_reported(spark, tmp_path):
    spark.createDataFrame([(0, "a", " x "), (1, "b", "y")], "doc_id long, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    got = sorted(tuple(r) for r in QUERIES["report_row_na"](spark, str(tmp_path)).select("doc_id", "source", "quality", "comment_text").collect())
    assert got == [("1", "b", "1", "y"), ("N/A", "a", "N/A", "x")]


def test_providers(spark):
    class Counting:
        def complete(self, prompts):
            assert len(prompts) == len(set(prompts))
            return [p.upper() for p in prompts]

    class Failing:
        def complete(self, prompts):
            raise RuntimeError("Quota exceeded")

    df = spark.createDataFrame([("a",), ("a",), (None,)], "p string").coalesce(1)
    assert [tuple(r) for r in providers.chat(df, "p", Counting()).collect()] == [("a", "A", None)] * 2 + [(None, None, None)]
    assert "Quota" in providers.chat(df, "p", providers.Retrying(Failing(), 2)).first().answer_error
    class Picky:
        def complete(self, prompts):
            if "b" in prompts:
                raise ValueError("b")
            return [p.upper() for p in prompts]

    many = spark.createDataFrame([(x,) for x in "abcde"], "p string").coalesce(1)
    assert [(r.answer, r.answer_error) for r in providers.chat(many, "p", Picky()).collect()] == [("A", None), (None, "ValueError: b"), ("C", None), ("D", None), ("E", None)]
    assert providers.LetterEmbedding().embed(["Abba z", ""]) == [[2.0, 2.0] + [0.0] * 23 + [1.0], [0.0] * 26]
    e = providers.HashEmbedding(8).embed(["x y", "y x", "z"])
    assert e[0] == e[1] != e[2]


def test_fetch_and_vectors(spark, tmp_path):
    class Web:
        def fetch(self, urls):
            return [(200, u.encode()) if "ok" in u else (404, b"") for u in urls]

    df = spark.createDataFrame([("http://h/ok.PDF",), ("http://h/gone.pdf",), (None,)], "url string")
    got = {r.url: (r.status, r.body and bytes(r.body), r.suffix) for r in providers.fetch(df, "url", Web()).collect()}
    class Shaky:
        tries = 0

        def fetch(self, urls):
            Shaky.tries += 1
            if Shaky.tries == 1:
                raise OSError("down")
            return [(200, b"x") for _ in urls]

    assert providers.Retrying(Shaky()).fetch(["u"]) == [(200, b"x")] and Shaky.tries == 2
    assert got == {"http://h/ok.PDF": (200, b"http://h/ok.PDF", "pdf"), "http://h/gone.pdf": (404, None, "pdf"), None: (None, None, None)}
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.json").write_text("[[1.0, 2.0], [3.0, 4.5]]")
    (tmp_path / "flat.json").write_text("[0.5, 1.5]")
    (tmp_path / "odd.json").write_text('{"x": 1}')
    assert sorted((r.file, r.pos, r.embedding) for r in vectors.read_vectors(spark, str(tmp_path)).collect()) == [("flat.json", 0, [0.5, 1.5]), ("one.json", 0, [1.0, 2.0]), ("one.json", 1, [3.0, 4.5])]


def test_models_are_asked_only_where_needed(spark):
    class Strict:
        def complete(self, prompts):
            assert all("short" not in p and "known" not in p for p in prompts)
            return ["Yes" if "good" in p else "07/09/2023" if "closes" in p else "NONE" for p in prompts]

    rows = spark.createDataFrame([("short",), ("good " * 60,), ("bad " * 60,), (None,)], "text string")
    got = {r.text: r.relevant for r in comments.with_relevance(rows, Strict()).collect()}
    assert got == {"short": False, "good " * 60: True, "bad " * 60: False, None: False}
    n = spark.createDataFrame([("2023-01-02", "2023-06-01", "known"), (None, "2023-06-01", "closes"), (None, "2023-08-01", "closes"), (None, "2023-06-01", "x")], "comments_close_on string, publication_date string, body string")
    assert sorted((r.comments_close_on or "") for r in notices.fill_close_dates(n, Strict()).collect()) == ["", "", "2023-01-02", "2023-07-09"]


def test_orders_and_known_ids(spark):
    n = spark.createDataFrame([("a", "2023-01-01", "data and ai"), ("b", "2023-02-01", "data"), ("c", None, "x")], "id string, day string, title string")
    first = lambda kind: n.orderBy(*notices.search_order(kind, "day", "id", notices.matched_terms(F.col("title"), ["data", "ai"]))).first().id
    assert [first(k) for k in ("newest", "oldest", "relevance")] == ["b", "c", "a"]
    report = spark.createDataFrame([(" d1 ",), (None,), ("",), ("d1",)], "doc_id string")
    assert [r[0] for r in notices.existing_ids(report).collect()] == ["d1"]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame([("f1", "Cats purr. Dogs bark loudly. Birds sing."), ("f2", "Rain falls.")], "file string, text string")


def test_retrieval(spark, corpus):
    index = rag.chunk_index(corpus, providers.HashEmbedding(), 5)
    asked = spark.createDataFrame([("f1", "q", "dogs bark"), ("f2", "q", "rain")], "file string, question string, query string")
    got = {r.file: r.context for r in rag.contexts(index, asked, providers.HashEmbedding(), 2).collect()}
    assert "Dogs bark" in got["f1"].split("\n")[0] and got["f2"] == "Rain falls."
    padded = {r.file: r.context for r in rag.contexts(index, asked, providers.HashEmbedding(), 3, compat=True).collect()}
    assert padded["f2"] == "\n".join(["Rain falls."] * 3)


def test_report_asks_in_two_waves(spark, corpus):
    about = spark.createDataFrame([("f1", "c1", "d", "Ann")], "file string, comment_id string, date string, commenter string")
    got = {r.file: r for r in rag.structured_report(corpus, about, providers.HashEmbedding(), providers.EchoChat({"organization": "N/A", "Question: N/A": "N/A"}), 5).collect()}
    assert list(got["f1"].asDict()) == rag.REPORT and len(rag.REPORT) == 14
    assert got["f1"].organization_type == "N/A" and got["f1"].comment_id == "c1" and got["f2"].comment_id == ""
    named = rag.structured_report(corpus, about, providers.HashEmbedding(), providers.EchoChat(), 5).where("file = 'f1'").first()
    assert named.organization_type != "N/A" and named.comment_text.startswith("Cats")


def test_each_prompt_is_sent_once(spark, tmp_path):
    (tmp_path / "seen").mkdir()

    class Counting(providers.PassageChat):
        def __init__(self, folder):
            self.folder = folder

        def complete(self, prompts):
            import uuid

            (self.folder / uuid.uuid4().hex).write_text(json.dumps(prompts))
            return super().complete(prompts)

    files_ = spark.createDataFrame([(f"f{i}", f"Comment {'x' * i} here.") for i in range(4)], "file string, text string")
    about = files_.select("file", F.col("file").alias("comment_id"), F.lit("d").alias("date"), F.col("file").alias("commenter"))
    report = rag.structured_report(files_, about, providers.LetterEmbedding(), Counting(tmp_path / "seen"), 50).collect()
    named = sum(r.organization_name != "N/A" for r in report)
    sent = [p for f in (tmp_path / "seen").iterdir() for p in json.loads(f.read_text())]
    assert len(report) == 4 and named == 2 and len(sent) == len(set(sent)) == 2 * (4 * len(rag.FIRST_WAVE) + named * len(rag.SECOND_WAVE))


def test_notices_are_collected(spark):
    class Web:
        def fetch(self, urls):
            pages = {"j1": (200, b'{"comments_close_on": "2023-07-09", "body_html_url": "b1"}'), "b1": (200, b'<div id="agency">Agency: Trade office.</div><p>Body</p>'), "j2": (200, b"no json"), "j3": (404, b"")}
            return [pages.get(u, (500, b"")) for u in urls]

    rows = [("1", "j1"), ("2", "j2"), ("3", "j3"), ("4", None)]
    got = {r.document_number: (r.comments_close_on, r.agency, bool(r.body)) for r in notices.bodies(spark.createDataFrame(rows, "document_number string, json_url string"), Web()).collect()}
    assert got == {"1": ("2023-07-09", "Trade Office", True), "2": (None, None, False), "3": (None, None, False), "4": (None, None, False)}
    found = spark.createDataFrame([(str(i), t, f"data {i}", d, "u", k) for i, (t, d, k) in enumerate([("RFI on x", "2023-06-01", "NOTICE"), ("A perfidy", "2023-06-02", "NOTICE"), ("Final", "2023-06-02", "NOTICE"), ("RFI", "2023-01-01", "NOTICE"), ("RFI", "2023-06-03", "RULE"), ("RFI", "2023-06-04", "NOTICE")])], "document_number string, title string, abstract string, publication_date string, html_url string, type string")
    details = spark.createDataFrame([("0", "X", None, "closes\n07/09/2023"), ("1", "Y", "2023-08-01", "b")], "document_number string, agency string, comments_close_on string, body string")
    out = collect.notice_rows(found, spark.createDataFrame([("5",)], "document_number string"), details, providers.EchoChat(), ["data"], [F.asc("document_number")], 10, 10, "2023-05-01", ["NOTICE"])
    assert [(r.doc_id, r.agency, r.comment_window, r.summary) for r in out.orderBy("doc_id").collect()] == [("0", "X", "06/01/2023 - 07/09/2023", "Summarize this notice in one or two sentences: data 0"), ("1", "Y", "06/02/2023 - 08/01/2023", "Summarize this notice in one or two sentences: data 1")]


def test_comments_are_collected(spark):
    cards = spark.createDataFrame([(i, f"c{i}", "Jun 5, 2023", f"Comment from P{i}", "Some Agency") for i in range(4)], "seq int, id string, date string, name string, agency string")
    pages = spark.createDataFrame([("c1", "short", [["/a.doc", "/b.pdf"]]), ("c2", "good " * 60, [["/c.pdf"], []])], "id string, text string, attachments array<array<string>>")
    known = spark.createDataFrame([("some agency", "SOME")], "agency string, abbreviation string")
    files_, pointer = collect.comment_files(cards, pages, providers.EchoChat({"good": "Yes"}), known, "c0")
    got = {(r.id, r.attachment): (r.link, r.file_name) for r in files_.collect()}
    assert got == {("c1", 1): ("/b.pdf", "SOME__P1__20230605__c1"), ("c2", 1): (None, "SOME__P2__20230605__c2_attachment1"), ("c2", 2): ("/c.pdf", "SOME__P2__20230605__c2_attachment2")}
    assert pointer.first().id == "c3"


def test_registered_report_asks_both_waves(spark, tmp_path):
    rows = [(i, f"Comment number {i} on the rule.", f"s{i}") for i in range(20)] + [(20, None, "s")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["structured_report"](spark, str(tmp_path)).collect()
    named = {r.file for r in got if r.organization_name.startswith("Organization ")}
    assert len(got) == 21 and 0 < len(named) < 20 and "20" not in named
    for r in got:
        second = {r[c] for c in rag.SECOND_WAVE}
        assert second == ({f"Comment number {r.file} on the rule."} if r.file in named else {"N/A"})


def test_standardize_keeps_order(spark):
    text = "\n\n".join(f"part{i} words here" for i in range(12))
    df = spark.createDataFrame([("f", text)], "file string, text string").withColumn("metadata", F.struct(F.lit(1).alias("a")))
    assert rag.standardize(df, providers.EchoChat(), most=3).first().standardized.split("\n") == [f"part{i} words here" for i in range(12)]


def test_stored_tables_leave_no_shuffle_files(spark):
    dirs = [str(d) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {p.name for d in dirs for p in Path(d).rglob("shuffle_*")}
    before, setting = files(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    kept, path = store.stored(df)
    assert files() <= before and kept.count() == 7
    df.write.parquet(f"{path}-plain")
    assert files() > before and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
    store.drop_stored(spark, path, f"{path}-plain")
