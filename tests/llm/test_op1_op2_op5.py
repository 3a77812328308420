"""Mixing, line de-duplication and URL filters against brute force, with nulls, ties, repeats and clashing columns."""

import hashlib
import math
import re
import time

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docloom.llm.lines import OP2_SQL, dedup_lines, op2_line_dedup
from docloom.llm.mixing import OP1_SQL, mix_sources, op1_mixing, plan_mix
from docloom.llm.urlfilter import OP5_SQL, RULES, filter_urls, op5_url_filters

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def check_sql(df, sql, **tables):
    con = duckdb.connect()
    for name, (rows, schema) in tables.items():
        con.register(name, pa.Table.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema))
    rel = con.sql(sql)
    order = sorted(rel.columns)
    assert sorted(df.columns) == order
    want = sorted((tuple(r[rel.columns.index(c)] for c in order) for r in rel.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in order) for r in df.collect()), key=repr) == want


DOCS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("source", pa.string())])
TEXTS = [None, "", " \t\n", "a b c", "é  x y", "w " * 5000, "one", "one", "\x0bz\x0c", "a\x85b c"]


def docs(n=400):
    return [(i, TEXTS[i % len(TEXTS)] if i % 3 else f"w{i} " * (i % 50), [None, "a", "b", "é", "hot", "hot", "hot"][i % 7]) for i in range(n)]


def fill(sizes, weights, total):
    """Water-filling by the loop that the contract describes."""
    clamped = set()
    while True:
        free = [s for s in sizes if s not in clamped]
        rest = total - sum(2 * sizes[s] for s in clamped)
        share = {s: rest * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return share | {s: 2.0 * sizes[s] for s in clamped}
        clamped |= over


def test_mixing(spark):
    rows = docs()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = op1_mixing(df).collect()
    sizes, count = {}, {}
    for i, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
        count[i] = len(WORD.findall(t or ""))
    names = sorted((s for s in sizes if s is not None)) + [None]
    target = fill(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}, 1.5 * sum(sizes.values()))
    source = {i: s for i, _, s in rows}
    taken = {}
    for r in got:
        assert r["size"] == count[r.doc_id] and r.source_size == sizes[source[r.doc_id]] and math.isclose(r.target, target[source[r.doc_id]])
        assert r.taken in (0, r["size"], 2 * r["size"])
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
    assert all(abs(taken[s] - target[s]) <= 5000 for s in names)  # the largest document
    assert sorted(got) == sorted(op1_mixing(df.repartition(7)).collect())
    check_sql(op1_mixing(df), OP1_SQL, documents=(rows, DOCS))


def test_mix_repeats_rows_and_keeps_columns(spark):
    df = spark.createDataFrame([(1, "a b", "s", 9, 1.0), (1, "a b", "s", 9, 1.0), (None, "c", None, 8, 2.0), (4, "d " * 30, "t", 7, 3.0)], "doc_id long, text string, source string, size int, target double")
    out = mix_sources(df)
    assert out.columns == df.columns
    assert {r._mix_copies for r in plan_mix(df).where("source = 's'").collect()} == {2}
    assert out.count() == sum(r._mix_copies for r in plan_mix(df).collect())
    assert op1_mixing(df.limit(0)).count() == 0
    blank = op1_mixing(spark.createDataFrame([(1, None, "s")], "doc_id long, text string, source string")).first()
    assert (blank["size"], blank.target, blank.taken) == (0, 0.0, 0)


LINES = ["A common line of the corpus  ", "\ta COMMON line of the corpus", "short", "", "ÉÉÉÉÉÉÉÉÉÉ ÉÉÉÉÉÉÉÉÉ", "éééééééééé ééééééééé", "exactly twenty chars", "x" * 300]


def line_docs():
    rows = [(i, "\n".join(LINES[(i + k) % len(LINES)] for k in range(i % 5 + 1)) + f"\nown line number {i:09d}") for i in range(40)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "a common LINE of the corpus\na common line of the corpus"), (104, "tail\n"), (105, "\r\nexactly twenty chars\r")]
    return rows


def test_line_dedup(spark):
    rows = line_docs()
    held = {}
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    for i, t in rows:
        for x in (t or "").split("\n"):
            held.setdefault(key(x), set()).add(i)
    want = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 20 and len(held[key(x)]) >= 3 and max(held[key(x)]) != i)]
        want[i] = (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in op2_line_dedup(df).collect()} == want
    check_sql(op2_line_dedup(df), OP2_SQL, documents=(rows, pa.schema([("doc_id", pa.int64()), ("text", pa.string())])))


def test_lines_and_mixes_of_long_texts_and_odd_columns(spark):
    x = "a line that is long enough"
    df = spark.sql("SELECT 's' AS source, named_struct('a b', 1) AS `x y`, 'old' AS _line_text, 'old' AS _mix_size, * FROM VALUES (1, 'q'), (2, 'r'), (3, 'r') AS t(doc_id, text)")
    df = df.withColumn("text", F.concat(F.repeat(F.lit(x + "\n"), 100_000), "text"))
    got = dedup_lines(df).orderBy("doc_id").collect()
    assert [(r.text, r._line_n, r._line_dropped) for r in got[:2]] == [("q", 100_001, 100_000), ("r", 100_001, 100_000)]
    assert got[2].text == x + "\n" + (x + "\n") * 99_999 + "r" and got[0]["x y"]["a b"] == 1 and "_line_text" not in got[0]
    mixed = mix_sources(df)
    assert mixed.columns == ["source", "x y", "_line_text", "doc_id", "text"] and mixed.count() >= 3
    assert {r._mix_size for r in plan_mix(df).collect()} == {600_001}


def test_line_dedup_other_rows(spark):
    x = "a line that is long enough"
    df = spark.createDataFrame([(1, x, "k"), (1, x, "k"), (2, x + "\ny", "k"), (None, x, "k"), (3, x, "k")], "doc_id long, text string, key string")
    got = sorted(((r.doc_id, r.text, r._line_dropped, r.key) for r in dedup_lines(df).collect()), key=repr)
    assert got == sorted([(1, "", 1, "k"), (1, "", 1, "k"), (2, "y", 1, "k"), (None, x, 0, "k"), (3, x, 0, "k")], key=repr)
    assert dedup_lines(df.limit(0)).count() == 0
    assert dedup_lines(df.where("doc_id < 3")).where("_line_dropped > 0").count() == 0  # two documents are too few


URLS = [
    "http://Example.ORG/es/x", "http://example.org/en/1", "http://example.org/en/2", "http://a.example.org/en/19?q", "http://example.org", "https://notexample.org/es/", "http://x.com/fr/", "http://x.com/FR/",
    "http://x.com/de/y#z", "http://com/de/", "ftp://a.b/c://org/", "no scheme", "", None, "://", "://org/", "http://org?x/", "http://ÉX.com/de/", "http://example.org:80/es/", "HTTP://a.b.c.ORG/", "http://comx/fr/", "http://xcom/fr/", "http://x.com/fr/", "http://.com/fr/",
]


def test_url_filters(spark):
    def verdict(url):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host) :])[0]
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [(len(h + p), h + p, a) for a, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, *(max(fits)[1:] if fits else (None, "allow")))

    rows = list(enumerate(URLS))
    df = spark.createDataFrame(rows, "page_id long, url string")
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in op5_url_filters(df).collect()} == {i: verdict(u) for i, u in rows}
    check_sql(op5_url_filters(df), OP5_SQL, pages=(rows, pa.schema([("page_id", pa.int64()), ("url", pa.string())])))
    assert op5_url_filters(df.limit(0)).count() == 0


def test_cascade_is_exact_for_many_rules(spark):
    rules = [("block" if i % 2 else "allow", f"h{i}.net", "/p" * (i % 3 + 1)) for i in range(300)]
    urls = [(i, f"http://{'s.' * (i % 2)}h{i % 600}.net{'/p' * (i % 5)}/") for i in range(3000)]
    df = spark.createDataFrame(urls, "page_id long, url string").withColumnRenamed("page_id", "key")
    listed = {(h, p): a for a, h, p in rules}
    for r in filter_urls(df, rules).collect():
        fits = [(len(p), h + p, a) for (h, p), a in listed.items() if (r._url_host == h or r._url_host.endswith("." + h)) and r._url_path.startswith(p)]
        assert (r._url_rule, r._url_verdict) == (max(fits)[1:] if fits else (None, "allow"))


def test_long_hosts_and_clashing_columns(spark):
    host = "a." * 100_000 + "org"
    df = spark.createDataFrame([(1, f"http://{host}/x", "old"), (2, "http://" + "b" * 3_000_000 + ".com/fr/", "old"), (3, "http://example.org/" + "es/" * 500_000, "old")], "page_id long, url string, _url_rule string")
    began = time.monotonic()
    got = {r.page_id: (r._url_rule, r._url_verdict) for r in filter_urls(df).collect()}
    assert got == {1: ("org/", "allow"), 2: ("com/fr/", "allow"), 3: ("example.org/es/", "block")} and time.monotonic() - began < 30
    odd = spark.sql("SELECT 'http://x.org/' AS url, named_struct('a b', 1) AS `x.y`, 1 AS _url_host")
    assert filter_urls(odd).first()["x.y"]["a b"] == 1
    empty = spark.createDataFrame([(1, "http://.org/"), (2, "http://org./"), (3, "http://./"), (4, "http://..com/fr/")], "page_id long, url string")
    assert [r.rule for r in op5_url_filters(empty).orderBy("page_id").collect()] == ["org/", None, None, "com/fr/"]


def test_plan_has_no_join_and_no_python(spark):
    df = spark.createDataFrame([(1, "http://x.org/")], "page_id long, url string")
    plan = op5_url_filters(df)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("rules", [[], [("block", "org", "/")]])
def test_short_lists(spark, rules):
    df = spark.createDataFrame([("http://x.org/",), ("http://x.net/",)], "url string")
    assert [r._url_verdict for r in filter_urls(df, rules).collect()] == (["block", "allow"] if rules else ["allow", "allow"])
