import json

from pyspark.sql import functions as F

from docloom.operators import comments, metadata, notices, vector


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_vectors(spark):
    v = spark.createDataFrame([(1, [3.0, 0.0]), (2, [0.5, 0.1]), (3, [0.0, 1.0]), (4, [0.0, 0.0]), (5, [6.0, 0.0])], "vec_id long, embedding array<float>")
    q = spark.createDataFrame([([1.0, 0.0],)], "embedding array<float>")
    assert [r.vec_id for r in vector.top_k(v, q, 9).collect()] == [1, 5, 2, 3]
    assert [r.vec_id for r in vector.top_k(v, q, 2, "dot").collect()] == [5, 1]
    assert [r.vec_id for r in vector.top_k(v, q, 2, "l2").collect()] == [2, 4]
    assert vector.top_k(v.limit(0), q, 3).collect() == []
    top = vector.ranked(vector.top_k(v, q, 2)).select("rank", "vec_id")
    padded = vector.padded_search(top, 4, spark.createDataFrame([(9,)], "vec_id long"))
    assert rows(padded, "rank") == [(1, 1), (2, 5), (3, 9), (4, 9)]


def test_search_takes_the_first_term_and_caps(spark):
    n = spark.createDataFrame([(i, t) for i, t in enumerate(["data and AI", "ai only", None, "data", "neither", "Data data"])], "id int, title string")
    got = notices.search(n, ["data", "ai"], "id", "title", [F.asc("id")], 2, 10)
    assert rows(got.select("id", "term", "term_rank"), "id") == [(0, "data", 1), (1, "ai", 2), (3, "data", 2)]
    assert notices.search(n, ["data", "ai"], "id", "title", [F.asc("id")], 2, 1).count() == 1
    assert notices.search_terms(" a ,, b") == ["a", "b"] and len(notices.search_terms("")) == 35
    assert rows(notices.new_only(n, spark.createDataFrame([(0,), (None,)], "id int"), "id").select("id"), "id") == [(1,), (2,), (3,), (4,), (5,)]


def test_notice_rows(spark):
    n = spark.createDataFrame([("1", "T", "2023-06-05", None, "NOTICE"), ("", "x", "", "", ""), (None, "x", "", "", "")], "document_number string, title string, publication_date string, html_url string, type string")
    d = spark.createDataFrame([("1", "Agency", None, "s")], "document_number string, agency string, comments_close_on string, summary string")
    assert rows(notices.notice_rows(n, d)) == [("T", "Agency", "06/05/2023", "06/05/2023", "s", "", "", "NOTICE", "1")]
    asked = spark.createDataFrame([("", "body"), ("abs", None)], "a string, b string").select(notices.summary_prompt(F.col("a"), F.col("b")).alias("p")).collect()
    assert asked[0].p.endswith("body") and asked[1].p.endswith("abs")
    assert spark.sql("SELECT 'Here is a summary of the notice: Short.' AS s").select(notices.clean_summary(F.col("s"))).first()[0] == "Short."


def test_cards_and_attachments(spark):
    cards = spark.createDataFrame([("Comment Submitted by Ann ", "/c/1", {"agency": "X", "id": "7"})], "title string, href string, meta map<string,string>")
    assert rows(comments.card_records(cards, "https://h")) == [("", "Ann", "X", "https://h/c/1", "7")]
    c = spark.createDataFrame([("a", True, [["x.doc", "y.pdf"], []]), ("b", False, [["z.doc"]]), ("c", False, [])], "file_base string, relevant boolean, attachments array<array<string>>")
    got = comments.attachment_rows(c).select("file_base", "attachment", "link", "file_name")
    assert rows(got, "file_base", "attachment") == [("a", 1, None, "a_attachment1"), ("a", 2, "y.pdf", "a_attachment2"), ("b", 1, "z.doc", "b")]


def test_relevance_and_resume(spark):
    a = spark.createDataFrame([("x" * 199,), ("x" * 200,), (None,)], "t string").select(comments.worth_asking(F.col("t"))).collect()
    assert [r[0] for r in a] == [False, True, None]
    yes = spark.createDataFrame([(" YES ",), ("yes.",), ("no",)], "t string").select(comments.says_yes(F.col("t"))).collect()
    assert [r[0] for r in yes] == [True, False, False]
    s = spark.createDataFrame([(i, k) for i, k in enumerate("abcb")], "seq int, id string")
    assert comments.resume_after(s, "seq", "id", None).count() == 4
    assert rows(comments.resume_after(s, "seq", "id", "b").select("id"), "id") == [("b",), ("c",)]
    assert comments.resume_after(s, "seq", "id", "zz").count() == 0
    assert rows(comments.previous_ids(s.withColumn("g", F.lit(1)), "g", "seq", "id").select("seq", "previous"), "seq") == [(0, None), (1, "a"), (2, "b"), (3, "c")]


def test_metadata_files(spark, tmp_path):
    (tmp_path / "d1").mkdir()
    (tmp_path / "d2").mkdir()
    entry = {"date": "Jun 5, 2023", "commenter": "Ann", "agency": "X", "comment_id": "1"}
    (tmp_path / "d1" / "metadata.json").write_text(json.dumps({"X__Ann": entry, "lastComment": entry | {"page": 3}}))
    (tmp_path / "d2" / "metadata.json").write_text("{}")
    files, pointers = metadata.read_metadata(spark, str(tmp_path / "*" / "metadata.json"))
    assert [r.file_base for r in files.collect()] == ["X__Ann"] and [r.page for r in pointers.collect()] == [3]
    none, _ = metadata.read_metadata(spark, str(tmp_path / "absent.json"))
    assert none.count() == 0
    listed = spark.createDataFrame([("X__Ann_attachment2.pdf", 2), ("X__Ann_attachment1.pdf", 1), ("Y.pdf", 3)], "file string, seq int")
    assert rows(metadata.group_files(listed, "file", "seq"), "base") == [("X__Ann", ["X__Ann_attachment1.pdf", "X__Ann_attachment2.pdf"]), ("Y", ["Y.pdf"])]
    joined = metadata.with_metadata(listed, files.drop("origin"), "file")
    assert rows(joined.select("file", "commenter"), "file") == [("X__Ann_attachment1.pdf", "Ann"), ("X__Ann_attachment2.pdf", "Ann"), ("Y.pdf", None)]


def test_upserts_and_dictionary(spark):
    w = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new"), ("j", 1, "x")], "file_base string, seq int, v string")
    assert rows(metadata.latest(w, "file_base", ["seq"]).select("file_base", "v"), "file_base") == [("j", "x"), ("k", "new")]
    assert metadata.last_pointer(w, ["seq"]).first().v == "new" and metadata.last_pointer(w.limit(0), ["seq"]).count() == 0
    known = spark.createDataFrame([("office of x", "OX")], "agency string, abbreviation string")
    named = spark.createDataFrame([("Office of X",), ("Some other one",)], "agency string")
    assert rows(metadata.abbreviate(named, "agency", known), "agency") == [("Office of X", "OX"), ("Some other one", "SOO")]
