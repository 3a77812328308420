"""Nearest neighbours, BPE and the Jaccard join against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from docloom.llm import bpe, graph, jaccard, neighbours
from docloom.llm.bpe import BytePairs, encode_texts, op7_bpe
from docloom.llm.graph import components
from docloom.llm.neighbours import chi_square_quantile, nearest
from docloom.llm.textvec import Texts


def brute(rows, every=50, k=5):
    rows = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, a in rows:
        if q % every == 0:
            scored = [(-float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))), i) for i, b in rows if i != q and len(a) == len(b)]
            out[q] = [(i, -s) for s, i in sorted(set(scored))[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), rng.normal(size=16).tolist()) for i in rng.permutation(3000)]
    rows += [(10_000 + i, rows[0][1]) for i in range(200)] + [(10_500, [2 * x for x in rows[0][1]])]
    got, want = found(nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))), brute(rows)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    near = {q: dict(x) for q, x in want.items()}
    assert all(abs(s - near[q][i]) < 1e-12 for q in got for i, s in got[q] if i in near[q])
    hot = got[10_000]
    assert [i for i, _ in hot] == [i for i, _ in want[10_000]] and hot[0][0] == rows[0][0]


def test_many_cells_and_chunks(spark, monkeypatch):
    for name, value in (("PART", 128), ("ASKED", 16)):
        monkeypatch.setattr(neighbours, name, value)
    monkeypatch.setattr(neighbours, "_visit", lambda *a, f=neighbours._visit: _counted(f(*a)))
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 24))
    rows = [(int(i), (centres[i % 40] + 0.5 * rng.normal(size=24)).tolist()) for i in range(4000)] + [(5000 + i, centres[0].tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert neighbours.depth_for(4001) == 5
    got, want = found(nearest(df, every=10)), brute(rows, every=10)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def _counted(run):
    """The same function, which fails where one key holds too many members or queries."""

    def checked(batches):
        def watched():
            held = {}
            for batch in batches:
                for key in zip(*(batch.column(n).to_pylist() for n in ("cell", "part", "chunk", "role")), strict=True):
                    held[key] = held.get(key, 0) + 1
                yield batch
            assert all(n <= (300 if key[-1] == 0 else 60) for key, n in held.items()), max(held.values())

        yield from run(watched())

    return checked


def test_the_upper_tree_grows_with_the_rows():
    assert [neighbours.depth_for(n) for n in (1, 4096, 4097, 10**6, 10**9, 10**12)] == [0, 0, 1, 8, 13, 13]
    assert neighbours.sample_size(10**9, 64) == 65536 and neighbours.sample_size(10**9, 4096) == 1024 and neighbours.sample_size(5, 3) == 8


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (50, [0.0, 0.0]), (100, None), (150, [nan, 1.0]), (200, [inf, 1.0]), (250, [None, 1.0]), (300, []), (350, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (400, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert found(nearest(df)) == {0: [(1, 1.0), (400, 1.0), (2, 0.0)], 400: [(0, 1.0), (1, 1.0), (2, 0.0)]}
    assert nearest(df.limit(0)).count() == 0
    assert nearest(df.where("vec_id = 0")).count() == 0
    assert abs(chi_square_quantile(0.95, 10) - 18.307) < 1e-3


@pytest.fixture(scope="module")
def spec():
    P = pytest.importorskip("public_tokenizers")
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read(), P.path("byte_bpe_50k.json")


ODD = ["", " ", "a", "\n\n  x", "don't we'll", "x<|endoftext|>y <|endoftext|>", "é" * 900, "ab" * 3000, " " * 3000, "1234 " * 50, "😀 naïve ǅ \x1c\x85\xa0\u3000z", "<|endoftext", "a" * 130]


def test_bpe_equals_the_library(spec):
    Tokenizer = pytest.importorskip("tokenizers").Tokenizer
    library, own, rnd = Tokenizer.from_file(spec[1]), BytePairs(spec[0], table=50), random.Random(2)
    texts = ODD + ["".join(rnd.choice([chr(rnd.randrange(32, 127)), chr(rnd.randrange(0xA0, 0x3000)), " ", "\n", "the", "ing"]) for _ in range(rnd.randrange(60))) for _ in range(400)]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False) == text


def test_long_words_merge_alike(spec):
    own, rnd = BytePairs(spec[0]), random.Random(5)
    for n in (2, 17, 128):
        word = "".join(rnd.choice("thearonsi") for _ in range(n)).encode()
        heap = b"".join(own.id[p].to_bytes(4, "little") for p in own._long(word))
        assert heap == own._short([word])[0]


def test_bpe_query(spark):
    pytest.importorskip("public_tokenizers")
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate([None, *ODD, "a", "a"])], "doc_id long, text string, n_tokens string")
    got = {r.doc_id: r for r in op7_bpe(df).collect()}
    coded = {r.doc_id: r for r in encode_texts(df).collect()}
    for i, r in got.items():
        text, ids = coded[i].text or "", bytes(coded[i]._bpe_ids)
        assert coded[i]._bpe_text == text and r.n_tokens * 4 == len(ids) and r.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert op7_bpe(df.limit(0)).count() == 0
    odd = spark.sql("SELECT 1 AS doc_id, 'a b' AS text, named_struct('a b', 1) AS `x y`, 'old' AS _bpe_ids, 'old' AS _bpe_text")
    assert encode_texts(odd).columns == ["doc_id", "text", "x y", "_bpe_ids", "_bpe_text"] and encode_texts(odd).first()["_bpe_text"] == "a b"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = words_of(t)
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: (len(sets[i]), top(i)) for i in ids}


def family(seed, n):
    """Near copies in chains, exact copies, a passage that many share, odd rows."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(30)]
    rows, base = [], None
    for i in range(n):
        if base is None or rnd.random() < 0.3:
            base = [word() for _ in range(rnd.randrange(6, 120))]
        text = list(base)
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
            text[rnd.randrange(len(text))] = word()
        if rnd.random() < 0.3:
            base = text  # chains: near its neighbour, far from the first
        if rnd.random() < 0.3:
            text = text + passage
        rows.append((i * 3 + 1, " ".join(w.upper() if rnd.random() < 0.1 else w for w in text)))
    return rows + [(5000, None), (5001, ""), (5002, "  \n"), (5003, "one two"), (5004, "One\ttwo"), (5005, "two one"), (5006, "x y z u v"), (5007, "é é é é é é"), (5008, "É é é é é é")]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "PART", 3)  # small parts: groups are cut
    rows = family(seed, 220)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.op9_jaccard_join(df).collect()} == brute_components(rows)


def test_small_sets_are_linked(spark):
    four, five = "a b c d e f g h", "a b c d e f g h i"
    long = "p q r s t u v w x"
    turns = " ".join(["k l m n"] * 6)  # 4 distinct shingles in 24 words
    texts = [four, five, four, "b c d e f g h", five.upper(), "z " + five, long, long[:-2], turns, turns + " o", "a b c d e f g i"]
    rows = [(i + 1, t) for i, t in enumerate(texts)] + [(100 + i, t) for i, t in enumerate([four, five, turns] * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.op9_jaccard_join(df).collect()}
    assert got == brute_components(rows)
    assert got[1][1] == got[2][1] == got[6][1] == 1 and got[8][1] == 7 and got[10] == (5, 9)
    assert {r.doc_id for r in jaccard.keep_one(df).collect()} == {1, 4, 7, 9, 11}


def test_salted_tokens_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SALT", 4)
    rows = [(i, " ".join(["common words in every text here", *[f"w{j}" for j in range(20)], f"own{i}"])) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in jaccard.op9_jaccard_join(df).collect()} == {0}


def test_ids_of_any_type(spark):
    rows = family(3, 60)
    want = brute_components([(f"d{i:05d}", t) for i, t in rows])
    df = spark.createDataFrame([(f"d{i:05d}", t) for i, t in rows] + [(None, "a b c d e f")], "doc_id string, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.op9_jaccard_join(df).collect()}
    assert got.pop(None) == (2, None) and got == want
    kept = {r.doc_id for r in jaccard.keep_one(df).collect()}
    assert kept == {c for _, c in want.values()} | {None}


def test_busy_texts_are_spread(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BUSY", 2)
    monkeypatch.setattr(jaccard, "PART", 2)
    rows = family(4, 120)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.op9_jaccard_join(df).collect()} == brute_components(rows)


def _batches(columns, names, size):
    return [pa.RecordBatch.from_arrays([pa.array(c[i : i + size]) for c in columns], names=names) for i in range(0, len(columns[0]), size)]


def _rows(batches):
    return sorted(tuple(r.values()) for b in batches for r in b.to_pylist())


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_streams_do_not_depend_on_batches(size):
    rnd = random.Random(size)
    for _ in range(30):
        rows = sorted((t, 1 + (t % 5 == 0), rnd.randrange(8), 9) for t in (rnd.randrange(15) for _ in range(rnd.randrange(1, 40))))
        classes = {t: sorted({r[2] for r in rows if r[0] == t}) for t, *_ in rows}
        want = {(t, s > 1, c, n, 2, classes[t][0]) for t, s, c, n in rows if len(classes[t]) > 1 or s > 1}
        columns = [np.array([r[k] for r in rows], kind) for k, kind in enumerate((np.int64, np.int32, np.int64, np.int64))] + [np.full(len(rows), 2, np.int32)]
        assert set(_rows(jaccard._share(_batches(columns, ["token", "salts", "cls", "n", "place"], size)))) == want
        edges = sorted({(rnd.randrange(10), 0, rnd.randrange(10)) for _ in range(rnd.randrange(1, 40))})
        edges = [e for e in edges for _ in range(1 + (e[0] == 3))]
        columns = [np.array([e[k] for e in edges], np.int64) for k in (0, 2, 1)]
        near = {u: sorted({v for x, _, v in edges if x == u}) for u in {e[0] for e in edges}}
        large = sorted((v, min(u, near[u][0]), min(u, near[u][0]) < u) for u in near for v in near[u] if v > u)
        assert _rows(graph._large_star(_batches(columns, ["u", "v", "salt"], size))) == large
        small = sorted([(v, near[u][0], True) for u in near for v in near[u][1:]] + [(u, near[u][0], False) for u in near])
        assert _rows(graph._small_star(_batches(columns, ["u", "v", "salt"], size))) == small


@pytest.mark.parametrize("own", [2, 3, 6])
def test_a_passage_with_own_words(spark, own):
    """Texts of one passage and a few words: linked or not by the number of their words, with chains between."""
    rnd = random.Random(own)
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [(i, f"{' '.join(f'o{i}x{j}' for j in range(own if i % 4 else rnd.randrange(own + 2)))} {passage}" + (" tail end" if i % 5 == 0 else "")) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.op9_jaccard_join(df).collect()} == brute_components(rows)


def test_parities_never_exclude_linked_sets():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(4, 900))
        both = rng.integers(0, 1 << 63, n).astype(np.uint64)
        a, b = (np.unique(np.concatenate([both, rng.integers(0, 1 << 63, int(rng.integers(0, n // 5 + 2))).astype(np.uint64)])) for _ in range(2))
        apart = sum(int(x).bit_count() for x in (jaccard.parities(a) ^ jaccard.parities(b)).view(np.uint64))
        assert apart <= len(a) + len(b) - 2 * jaccard.overlap(a, b)
        if jaccard.linked(a, b):
            assert 9 * apart <= len(a) + len(b)


def test_sketches_never_exclude_linked_sets():
    rng = np.random.default_rng(3)
    refused = 0
    for _ in range(300):
        n = int(rng.integers(4, 3000))
        both = rng.integers(0, 1 << 63, n).astype(np.uint64)
        a, *others = (np.unique(np.concatenate([both, rng.integers(0, 1 << 63, int(rng.integers(0, n // 3 + 2))).astype(np.uint64)])) for _ in range(4))
        for b in others:
            may = bool(jaccard.may_link(len(a), jaccard.sketch(a), np.array([len(b)]), jaccard.sketch(b)[None])[0])
            assert may or not jaccard.linked(a, b)
            refused += not may
    assert refused > 200


def _shuffled(spark):
    """Bytes of shuffles that the session has written so far."""
    sc, jvm = spark.sparkContext, spark.sparkContext._jvm
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(jvm.double, 0), None)
    return sum(s.shuffleWriteBytes() for s in jvm.scala.jdk.javaapi.CollectionConverters.asJava(stages))


def test_texts_of_unlinked_pairs_are_not_sent(spark):
    """Long texts in families of six, too few for frequent tokens: all pairs of a family are candidates, none is linked but the last two."""
    rnd = random.Random(11)
    word = lambda: f"{rnd.getrandbits(40):010x}"
    rows = []
    for _ in range(4):
        common = [word() for _ in range(1300)]
        rows += [(len(rows) + i, " ".join(common + [word() for _ in range(300)])) for i in range(6)]
    rows.append((len(rows), rows[-1][1] + " end"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows)
    before = _shuffled(spark)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.op9_jaccard_join(df).collect()} == want
    assert _shuffled(spark) - before < 2 * sum(len(t) for _, t in rows)


def test_jaccard_other_rows(spark):
    df = spark.createDataFrame([(3, "a b c d e f", 1), (3, "a b c d e f", 1), (None, "a b c d e f", 2), (7, "A b c d e f", 3)], "doc_id long, text string, id int")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.op9_jaccard_join(df).collect()), key=repr)
    assert got == sorted([(3, 2, 3), (3, 2, 3), (None, 2, None), (7, 2, 3)], key=repr)
    assert sorted(((r.doc_id, r.id) for r in jaccard.keep_one(df).collect()), key=repr) == sorted([(3, 1), (3, 1), (None, 2)], key=repr)
    assert jaccard.op9_jaccard_join(df.limit(0)).count() == 0


def test_very_long_text(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    df = spark.createDataFrame([(1, long), (2, long + " tail"), (3, "other text altogether with some words")], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.op9_jaccard_join(df).collect()}
    assert got == {1: (199_996, 1), 2: (199_997, 1), 3: (2, 3)}


def test_shingles_of_batches_do_not_mix():
    raw = [b"a b c d e", b"f g", b"a b c d e"]
    sets = jaccard.shingle_sets(Texts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])))
    assert [len(s) for s in sets] == [1, 1, 1] and sets[0] == sets[2] != sets[1]


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 700)] + [(2000, 2001), (2001, 2000), (5, 5)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(31)) and all(got[i] == 100 for i in range(100, 800)) and got[2001] == 2000


def test_components_alone_and_in_rounds(spark):
    """One task with all edges, and many that contract a few each, find the same."""
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 900, (700, 2))] + [(i + 1, i) for i in range(1000, 1300)] + [(7, 7)]
    least = {i: i for e in edges if e[0] != e[1] for i in e}
    while True:
        now = dict(least)
        for a, b in edges:
            if a != b:
                now[a] = now[b] = min(now[a], now[b])
        if now == least:
            break
        least = now
    df = spark.createDataFrame(edges, "u long, v long").repartition(6)
    for alone in (1 << 18, 50):
        got = [(r.id, r.component) for r in components(df, alone).collect()]
        assert len(got) == len(least) and dict(got) == least
    assert components(df.where("u = v")).count() == 0 and components(df.where("u = v"), 1).count() == 0


def test_lean_table_gives_the_same_ids(spark):
    """More words than the table of the pipeline's form keeps, in texts of more than one step."""
    rows = [(i, " ".join(f"w{(i * 331 + k) % 70_000}x" for k in range(200))) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (hashlib.sha256(bytes(r._bpe_ids)).hexdigest(), r._bpe_text) for r in bpe.encode_texts(df).collect()}
    want = {r.doc_id: r.ids_sha256 for r in bpe.op7_bpe(df).collect()}
    assert {i: d for i, (d, _) in got.items()} == want and all(got[i][1] == t for i, t in rows) and bpe.LEAN_TABLE < 200_000
