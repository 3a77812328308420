import random
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from docloom.functions import chunks, text


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select(f(F.col("v")).alias("o"), "i").orderBy("i").select("o").collect()]


WHITE = [" ", "　", "\x1c", "\x85", " ", "\n", " "]


def test_strip_and_tokens(spark):
    values = ["", "a", *[f"{w}a b{w}{w}" for w in WHITE], "".join(WHITE), None, "x\n", "\nx\n\n"]
    assert column(spark, values, text.strip) == [None if v is None else v.strip() for v in values]
    assert column(spark, values, text.token_count) == [None if v is None else len(v.split()) for v in values]


def test_submitter(spark):
    values = ["Comment Submitted by Ann", "comment from  Bob ", "A comment from C", "COMMENT FROMX", "", None]
    assert column(spark, values, text.submitter) == ["Ann", "Bob", "A comment from C", "X", "", None]
    assert column(spark, ["x Comment Submitted by y", "comment submitted by z"], text.without_label) == ["x y", "comment submitted by z"]
    assert column(spark, ["Ünï-code 12_a!", "a b"], text.word_characters) == ["Ünïcode12_a", "ab"]


DATES = {
    "Jun 5, 2023": "20230605", "jun 15, 2023": "20230615", "Jun  5,  2023": "20230605", "2023-06-15": "20230615", "20230615": "20230615", "2023-W24-4": "20230615",
    "2023-06-15T23:59:00-08:00": "20230615", "Feb 30, 2023": "unknownDate", "": "unknownDate", "garbage": "unknownDate", "2023-13-01": "unknownDate", None: "unknownDate",
}


def test_dates(spark):
    assert column(spark, list(DATES), text.date_key) == list(DATES.values())
    assert date.fromisocalendar(2023, 24, 4) == date(2023, 6, 15)
    assert column(spark, ["2023-06-15", "2023-6-5", "June", None, "2023-02-30"], text.reformat_date) == ["06/15/2023", "06/05/2023", "", "", ""]


def test_agencies(spark):
    assert column(spark, ["national telecom and info", "NTIA", "", None], text.initials) == ["NTAI", "N", "", None]
    got = column(spark, [" Agency: Office of the U.S. Trade. ", "AGENCY:", None, "x"], text.agency_name)
    assert got == ["Office Of The U.S. Trade", None, None, "X"]


def test_file_names(spark):
    names = ["a.pdf", "a.b.pdf", ".hidden", "noext", "x/y.pdf", "A__B_attachment2.pdf", "A___attachment1.pdf", "q.PDF"]
    assert column(spark, names, text.file_base) == ["a", "a.b", ".hidden", "noext", "x/y", "A__B_attachment2", "A___attachment1", "q"]
    assert column(spark, names, text.attachment_base)[5:7] == ["A__B", "A"]
    assert column(spark, names, lambda c: text.attachment_base(c, True))[5:7] == ["A__B_attachment2", "A_"]
    assert column(spark, names, text.file_extension)[:3] == [".pdf", ".pdf", ""]
    parts = spark.createDataFrame([("NTIA", "Comment from Ann Lee", "Jun 5, 2023", "ID-1")], "a string, b string, c string, d string")
    assert parts.select(text.file_name(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).first()[0] == "NTIA__AnnLee__20230605__ID-1"


def test_sanitize(spark):
    def model(t):
        t = t.translate({0xF0D8: " ", 0xF0B7: "•", 0xF0D9: " ", 0xF0DA: " ", 0xF0DB: " "})
        return "".join(c if ord(c) < 128 or 160 <= ord(c) < 0xD800 or 0xE000 <= ord(c) < 0xFFFE else " " for c in t)

    values = ["xy", "a\x85b\x9f\xa0", "😀z￾", "", "\x00\x1f"]
    assert column(spark, values, text.sanitize) == [model(v) for v in values]


def test_cells_and_answers(spark):
    assert column(spark, [None, "", "  ", " a ", "0", "false"], text.report_cell) == ["N/A", "N/A", "", "a", "0", "false"]
    typed = "0, 1, 0L, 0.0D, -0.0D, 0.00BD, 2.50BD, false, true, array(), array(0), map(), cast('x' AS string)".split(", ")
    got = spark.sql("SELECT " + ", ".join(f"{v} AS c{i}" for i, v in enumerate(typed)).replace("array(0)", "array(0)"))
    assert list(got.select(*[text.report_cell(F.col(c)) for c in got.columns]).first()) == ["N/A", "1", "N/A", "N/A", "N/A", "N/A", "2.50", "N/A", "true", "N/A", "[0]", "N/A", "x"]
    assert column(spark, ["a, b ,, c", "", None], text.answer_list) == [["a", "b", "c"], [], None]
    assert column(spark, ["Perfidy", "none", None, "NOTICE OF x"], lambda c: text.contains_any(c, ["rfi", "notice of"])) == [True, False, None, True]
    assert column(spark, ["/p", "http://x"], lambda c: text.absolute_url(c, "https://h")) == ["https://h/p", "http://x"]


def sentences(t, size):
    out, start = [], 0
    while start < len(t):
        m = re.compile(r"[.!?]").search(t, min(start + size, len(t)))
        end = m.end() if m else len(t)
        out.append(t[start:end])
        start = end
    return out


def paragraphs(t, most, sep):
    done, held, n = [], [], 0
    for p in (p.strip() for p in t.split(sep)):
        if not p:
            continue
        k = len(p.split())
        if n + k > most:
            done.append(sep.join(held))
            held, n = [], 0
        held.append(p)
        n += k
    return done + ([sep.join(held)] if held else [])


@pytest.mark.parametrize("size", [1, 7, 50])
def test_chunks_equal_models(spark, size):
    rnd = random.Random(size)
    values = ["", "x", "a.b!c?", "no end", "😀" * 60] + ["".join(rnd.choice("ab .!?\n😀") for _ in range(rnd.randrange(200))) for _ in range(300)]
    got = column(spark, values, lambda c: chunks.sentence_chunks(c, size))
    assert got == [sentences(v, size) for v in values] and all("".join(g) == v for g, v in zip(got, values, strict=True))
    assert column(spark, values, lambda c: chunks.paragraph_chunks(c, size, "\n")) == [paragraphs(v, size, "\n") for v in values]


def test_first_long_paragraph(spark):
    assert column(spark, ["a b c\n\nd"], lambda c: chunks.paragraph_chunks(c, 2)) == [["", "a b c", "d"]]
    assert column(spark, ["a b c\n\nd"], lambda c: chunks.paragraph_chunks(c, 2, drop_empty=True)) == [["a b c", "d"]]
