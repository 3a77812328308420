"""The pipeline's stages, each on its own input."""

import hashlib

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark):
    x, y = "a line that stands in several documents", "another passage of this text goes on with many more words than five in it"
    rows = [(i, f"{x}\nown words of number {i} are these here and w{i} v{i} u{i}", "en", f"s{i % 3}", 1) for i in range(12)]
    rows += [(50, y, "en", "s0", 1), (51, y, "en", "s0", 1), (60, None, None, None, None), (61, "", "en", "s1", 0)]
    return spark.createDataFrame(rows, COLUMNS)


def test_stages(spark, tmp_path):
    df = docs(spark)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    toxic = [(100 + i, "you vilepig and scumbag of words " * 3, "en", "s0", 9) for i in range(30)]
    clean = [(200 + i, f"quiet words of number {i} and then some", "en", "s0", 9) for i in range(60)]
    every = df.unionByName(spark.createDataFrame(toxic + clean, COLUMNS))
    every.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(r[0], 1, int(r[0] < 200)) for r in toxic + clean], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "mixing sources", "BPE"]

    kept = corpus_pipeline.drop_toxic(spark, every, str(tmp_path))
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == every.columns and ids == {r.doc_id for r in every.collect()} - {r[0] for r in toxic}

    short = corpus_pipeline.drop_common_lines(spark, df, str(tmp_path))
    assert short.columns == df.columns and short.count() == df.count()
    texts = {r.doc_id: r for r in short.collect()}
    assert texts[0].text.startswith("own words") and texts[11].text.startswith("a line") and texts[0].n_chars == len(texts[0].text) and texts[60].text is None

    one = corpus_pipeline.drop_near_copies(spark, df, str(tmp_path))
    assert one.columns == df.columns and {r.doc_id for r in df.collect()} - {r.doc_id for r in one.collect()} == {51}

    mixed = corpus_pipeline.mix(spark, df, str(tmp_path))
    assert mixed.columns == df.columns

    coded = {r.doc_id: r for r in corpus_pipeline.tokenize(spark, df, str(tmp_path)).collect()}
    assert all(r.decodes and r.n_tokens * 4 == len(r.ids) for r in coded.values())
    assert coded[50].decoded_sha256 == hashlib.sha256(texts[50].text.encode()).hexdigest()

    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {"doc_id", "n_tokens", "ids"} <= set(out.columns) and not {r.doc_id for r in out.collect()} & {r[0] for r in toxic}


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Repeated rows, nulls, ties, a very long text and columns with the operators' own names; and the folder of the corpus."""
    d = tmp_path_factory.mktemp("odd")
    df = docs(spark).where("doc_id < 52")
    rows = [(70, None, "en", None, None), (71, None, None, "s0", None), (None, "words of a row without an id", "en", "s1", 9), (72, "long words " * 200_000, "en", "s2", 9)]
    df = df.unionByName(df.where("doc_id IN (3, 50)")).unionByName(spark.createDataFrame(rows, COLUMNS))
    df = df.selectExpr("*", "named_struct('a b', 1) AS `x y`", "1 AS size", "'k' AS key", "2 AS id", "3 AS component", "4 AS y", "'old' AS _line_n", "'old' AS _toxic_score", "'old' AS _mix_copies", "'old' AS _bpe_ids")
    df.write.parquet(str(d / "documents.parquet"))
    spark.sql("SELECT id AS doc_id, 1 AS quality, cast(id % 2 AS int) AS toxic FROM range(12)").write.parquet(str(d / "labels.parquet"))
    return spark.read.parquet(str(d / "documents.parquet")), str(d)


EXTRA = ["x y", "size", "key", "id", "component", "y"]


@pytest.mark.parametrize("at", range(5))
def test_each_stage_on_odd_rows_and_on_none(spark, odd, at):
    df, d = odd
    name, stage = corpus_pipeline.STAGES[at]
    out = stage(spark, df, d)
    got = out.collect()
    assert stage(spark, df.limit(0), d).collect() == []
    if at == 4:
        assert len(got) == df.count() and all(r.decodes for r in got) and sum(r.doc_id == 3 for r in got) == 2
        assert {r.n_tokens for r in got if r.doc_id in (70, 71)} == {0}
        return
    assert set(EXTRA) <= set(out.columns) and {r["x y"]["a b"] for r in got} == {1}
    ids = [r.doc_id for r in got]
    if at == 1:
        assert len(got) == df.count() and {r.text for r in got if r.doc_id in (70, 71)} == {None} and len({r.text for r in got if r.doc_id == 3}) == 1
        assert next(r.n_chars for r in got if r.doc_id == 72) == 2_200_000
    if at == 2:
        assert ids.count(3) == ids.count(50) == 2 and 51 not in ids and ids.count(None) == 1 and {70, 71, 72} <= set(ids)
    if at == 3:
        assert ids.count(3) % 2 == 0 or ids.count(3) <= 4


def test_a_corpus_without_labels_or_rows(spark, odd, tmp_path):
    df, _ = odd
    plain = df.select("doc_id", "text", "lang", "source", "n_chars")
    plain.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    assert corpus_pipeline.drop_toxic(spark, plain, str(tmp_path)).count() == plain.count()
