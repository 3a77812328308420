"""N-gram Jaccard join by a token-group matrix: exact components of documents whose word shingles overlap enough.

1. Every text becomes its set of hashed shingles. Texts of equal sets are one class, represented by the smallest id.
2. A class can only be linked to one with which it shares a token of its prefix: the |x| - ceil(0.8 |x|) + 1 first tokens
   in one global order. The order puts frequent tokens last (they are counted over all documents: each batch counts its own,
   those that come up several times are summed), so common passages open no candidates.
3. Classes that share prefix tokens with a token's smallest class (its pivot) are verified against one pivot each, the one
   they share most with: a number of checks linear in the classes. The links found put similar classes into groups (connected components).
4. Token-group matrix: for tokens that occur in several groups, (token, group) rows tell which groups a class of another
   group may overlap with. The first token that two linked sets share stands so early in both that the overlap still fits
   behind it: with n and m tokens and places i and j, 5n - 9i >= 4m and 5m - 9j >= 4n. So passages that many texts share
   open no candidates among those whose own words come first. Where the group is a single class, parities bound the overlap
   as well: each set has PARITY bits, the parities of how many of its tokens fall into each; two sets differ in at least as
   many tokens as in bits, and linked ones in no more than (n + m) / 9; sets of more than WIDE tokens fill so few bits and
   have none. What passes is sent to the group, first with a sketch alone: parities again, but as many as the set has
   tokens, so that of all sets only those remain that are nearly linked. The texts of these follow. In the group the union
   of the members' tokens bounds the overlap; only a group whose bound reaches 0.8 |x| is opened and its members compared,
   until one is linked. (Step 3 compares with the pivots in the same way.)
5. Components of all links, given back to all documents of the class.

No link is lost: two linked classes share a prefix token, so they are either in one group or meet in step 4. Nothing grows
with the square of a group of copies. Hot tokens are split over salts, hot groups over parts of at most PART rows; workers
read sorted partitions as streams, so that their memory does not grow with a partition.

Defined results: words are cut at ASCII white space after lower-casing A-Z; a text of fewer than five words is one
shingle; without words (null, empty, blank) the set is empty and the document its own component; a null id gets a null
component; rows that share an id count as linked. Repeated rows are given back as often as they came.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from docloom.llm.common import join_by_counted_key, tidy
from docloom.llm.graph import components
from docloom.llm.textvec import Texts, hashed, mix, pieces
from docloom.sources.store import drop_stored, stored

SIZE = 5
#: The least size of a set that can be linked to an unequal one: 4 shingles to 5. Smaller sets have only their copies.
LEAST = 4
#: Rows of one group that a task handles together.
PART = 128
#: Postings of one token that a task handles together.
SALT = 4096
#: A text that at least so many rows of a verification ask for (and a 64th of them) is sent to SPREAD places.
BUSY, SPREAD = 100_000, 64
#: At most so many frequent tokens are told to the executors: 16 bytes each.
FREQUENT = 200_000
#: Columns of 64 parities each, and the size from which sets have none: at 2 * WIDE / 9 unlike tokens half of all parities differ.
PARITY = ["b0", "b1", "b2", "b3"]
WIDE = 720
_STEPS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]


def shingle_sets(texts: Texts) -> list[np.ndarray]:
    """The sorted distinct shingle hashes (unsigned 64 bits) of each text."""
    starts, ends, at = texts.words()
    h = hashed(texts.sums(), starts, ends) if len(starts) else np.zeros(0, np.uint64)
    n = max(0, len(h) - SIZE + 1)
    joined = np.zeros(n, np.uint64)
    for j in range(SIZE):
        joined += h[j : j + n] * np.uint64(_STEPS[j])
    joined = mix(joined)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= SIZE:
            s = np.sort(joined[a : b - SIZE + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif b > a:
            short = (h[a:b] * np.array(_STEPS[: b - a], np.uint64)).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def need(n):
    """The least overlap of a set of n tokens with any set that it is linked to: ceil(0.8 n)."""
    return (4 * n + 4) // 5


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets have a Jaccard similarity of 0.8 or more."""
    if 5 * min(len(a), len(b)) < 4 * max(len(a), len(b)) or not len(a) or not len(b):
        return False
    return _reaches(len(a), len(b), overlap(a, b))


def _reaches(n: int, m: int, both: int) -> bool:
    return 100 * both >= 80 * (n + m - both)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    for i, _, texts in pieces(column):
        yield from enumerate(shingle_sets(texts), i)


def _describe(batches):
    """Per text: its class key and parities (nulls above WIDE tokens); per batch: how often tokens came that came up at least three times."""
    for batch in batches:
        n, d1, d2, bits, tokens = [], [], [], [], []
        for _, s in _sets(batch.column(1)):
            n.append(len(s))
            bits.append(parities(s) if len(s) <= WIDE else None)
            d1.append(int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)))
            d2.append(int(mix(s + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64).astype(np.int64)))
            tokens.append(s)
        every = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
        tokens.clear()
        every.sort()
        found, count = np.unique(every[2:][every[2:] == every[:-2]], return_counts=True)  # the third and later ones
        found, count = found.view(np.int64), count + 2
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.nulls(len(n), pa.int64()), *_columns(bits)], names=_DESCRIBED)
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.nulls(len(found), batch.column(0).type), pa.array(count), pa.nulls(len(found), pa.int64()), pa.nulls(len(found), pa.int64()), pa.array(found), *[pa.nulls(len(found), pa.int64())] * len(PARITY)], names=_DESCRIBED)


_DESCRIBED = ["id", "n", "d1", "d2", "token", *PARITY]


def parities(s: np.ndarray) -> np.ndarray:
    """The parities of a set's tokens in 256 buckets, as four numbers."""
    odd = np.bincount((s >> np.uint64(11)).astype(np.int64) & 255, minlength=256).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def _columns(bits: list[np.ndarray | None]) -> list[pa.Array]:
    return [pa.array([None if b is None else b[k] for b in bits], pa.int64()) for k in range(len(PARITY))]


def sketch(s: np.ndarray) -> np.ndarray:
    """The parities of a set's tokens in at least as many buckets as it has tokens (a power of two, 64 at least), eight to a byte."""
    width = max(64, 1 << (len(s) - 1).bit_length())
    odd = np.bincount((s >> np.uint64(11)).astype(np.int64) & (width - 1), minlength=width).astype(np.uint8) & 1
    return np.packbits(odd)


def fold(bits: np.ndarray) -> np.ndarray:
    """Sketches (one each row) as they would be with half as many buckets."""
    half = bits.shape[-1] // 2
    return bits[..., :half] ^ bits[..., half:]


def may_link(n: int, bits: np.ndarray, sizes: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which of the sets with these sizes and sketches (of one width) a set of n tokens may be linked to. Those that are linked always."""
    if bits.shape[-1] > 2 * others.shape[-1] or others.shape[-1] > 2 * bits.shape[-1]:
        return np.zeros(len(sizes), bool)  # sizes too far apart
    if bits.shape[-1] > others.shape[-1]:
        bits = fold(bits)
    elif others.shape[-1] > bits.shape[-1]:
        others = fold(others)
    near = (5 * np.minimum(sizes, n) >= 4 * np.maximum(sizes, n)) & (sizes > 0)
    near[near] = 9 * np.bitwise_count(others[near] ^ bits).sum(1, dtype=np.int64) <= sizes[near] + n
    return near


def _prefixes(frequent):
    """The prefix of each text's set in the global order, with the salts that each token is split over."""

    def run(batches):
        tokens, counts = frequent.value
        for batch in batches:
            rows, prefix, salts, n, d1 = [], [], [], [], []
            for i, s in _sets(batch.column(1)):
                if len(s) < LEAST:
                    continue  # linked only to equal sets
                keep = len(s) - need(len(s)) + 1
                weight = np.zeros(len(s), np.int64)
                if len(tokens):
                    at = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
                    weight = np.where(tokens[at] == s, counts[at], 0)
                first = np.argsort(weight, kind="stable")[:keep] if weight.any() else np.arange(keep)
                rows.append(i)
                prefix.append(s[first].view(np.int64))
                salts.append((-(-weight[first] // SALT)).astype(np.int32))
                n.append(len(s))
                d1.append(int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)))
            at = np.cumsum([0, *map(len, prefix)]).astype(np.int32)
            flat = lambda x, kind: pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(x) if x else np.zeros(0, kind)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), flat(prefix, np.int64), flat(salts, np.int32)], names=["id", "n", "d1", "tokens", "salts"])

    return run


def _share(batches):
    """Rows sorted by token and class: postings of the tokens that several classes have, each with the token's smallest class.

    Of one batch only the last token's first posting is carried on, until another class shows that it is shared.
    """
    held, told = None, False  # first posting of the token at hand, and whether it was given out
    for batch in batches:
        token, salts, cls, *rest = (c.to_numpy() for c in batch.columns)
        if not len(token):
            continue
        joins = held is not None and token[0] == held[0]
        first = np.concatenate([[not joins], token[1:] != token[:-1]])
        at = np.maximum.accumulate(np.where(first, np.arange(len(token)), -1))
        pivots = np.where(at < 0, held[2] if joins else 0, cls[at])
        other = cls != pivots
        # A first posting goes out with the second class of its token, or at once if the token is salted.
        group = np.cumsum(first)
        shared = np.bincount(group, other) > 0
        keep = other | (salts > 1) | (first & shared[group])
        if joins and not told and shared[0]:
            yield _postings(batch.schema.names, *(np.array([x]) for x in held), np.array([held[2]]))
            told = True
        if first.any():
            i = int(np.flatnonzero(first)[-1])
            held, told = [c[i] for c in (token, salts, cls, *rest)], bool(keep[i])
        yield _postings(batch.schema.names, *(c[keep] for c in (token, salts, cls, *rest)), pivots[keep])


def _postings(names, token, salts, *rest):
    return pa.RecordBatch.from_arrays([*map(pa.array, (token, salts > 1, *rest))], names=["token", "salted", *names[2:], "pivot"])


def _open_groups(batches):
    """Rows sorted by group, part and role: the members of a part, then the classes that may be linked to it."""
    key, members, union = None, [], None
    for batch in batches:
        g, s, role, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        us, vs = [], []
        for i, tokens in _sets(batch.column(4)):
            if key != (g[i], s[i]):
                key, members, union = (g[i], s[i]), [], None
            if role[i] == 0:
                members.append((int(ids[i]), tokens))
                continue
            if not members:
                continue
            if union is None:
                union = members[0][1] if len(members) == 1 else np.unique(np.concatenate([m for _, m in members]))
            if overlap(tokens, union) < need(len(tokens)):
                continue  # no member can be linked: the group stays closed
            hit = next((m for m, have in members if linked(tokens, have)), None)
            if hit is not None:
                us.append(int(ids[i]))
                vs.append(hit)
        yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])


def _sketch(batches):
    """Size and sketch of each text."""
    for batch in batches:
        n, bits = [], []
        for _, s in _sets(batch.column(1)):
            n.append(len(s))
            bits.append(sketch(s).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(bits, pa.binary())], names=["id", "n", "bits"])


def _sift(batches):
    """Rows sorted by group, part, role and id, with sketches: the members and the classes of a part that may be linked to another of it."""
    key, members, told, last = None, {}, set(), None  # of each width: ids, sizes and sketches of the members
    for batch in batches:
        g, s, role, ids, sizes = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        out = []
        for i, raw in enumerate(batch.column(5).to_pylist()):
            if key != (g[i], s[i]):
                key, members, told, last = (g[i], s[i]), {}, set(), None
            bits = np.frombuffer(raw, np.uint8)
            if role[i] == 0:
                members.setdefault(len(bits), []).append((ids[i], sizes[i], bits))
                continue
            hits = set()
            for width, of in members.items():
                if isinstance(of, list):  # the first query: all members have come
                    of = members[width] = (np.array([m[0] for m in of]), np.array([m[1] for m in of]), np.stack([m[2] for m in of]))
                hits.update(of[0][may_link(int(sizes[i]), bits, of[1], of[2])].tolist())
            if hits and last != ids[i]:  # texts of one id are one row
                out.append((g[i], s[i], 1, ids[i]))
                last = ids[i]
            out.extend((g[i], s[i], 0, m) for m in hits - told)
            told |= hits
        columns = zip(*out, strict=True) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["g", "s", "role", "id"])


def _only(texts: DataFrame, ids: DataFrame, drawn: bool) -> DataFrame:
    """The texts whose id may be among `ids`, or what _sketch makes of them, so that no other is shuffled: a bit for each id
    in a map of fixed size (4 MB). Both in one Python worker: one that waits behind another would hold its memory, too."""
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 25))
    maps = ids.select(place.alias("p")).groupBy(F.floor(F.col("p") / 32768).alias("k")).agg(F.bitmap_construct_agg((F.col("p") % 32768).cast("long")).alias("bits")).collect()
    bits = np.zeros(1 << 22, np.uint8)
    for r in maps:
        bits[r["k"] * 4096 : (r["k"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def kept(batches):
        for batch in batches:
            at = batch.column(2).to_numpy()
            keep = shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1
            yield batch.select([0, 1]).filter(pa.array(keep.astype(bool)))

    run, columns = (lambda batches: _sketch(kept(batches)), "n bigint, bits binary") if drawn else (kept, "text string")
    return texts.select("id", "text", place.alias("place")).mapInArrow(tidy(run), f"id bigint, {columns}")


def _verify(members: DataFrame, queries: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (u, v) between queries (g, id) and members (g, id), a link for each query and part of a group at most.

    `texts` (id, text) has the texts of both. Groups are cut into parts of PART members; the queries of a part are cut
    again, and its members sent to each cut. Sketches go first, then the texts of those that they do not tell apart.
    """
    rows = members.select("g", "id", F.lit(0).alias("role")).unionByName(queries.select("g", "id", F.lit(1).alias("role")))
    counts = rows.groupBy("g").agg(F.sum(1 - F.col("role")).alias("members"), F.sum("role").alias("queries"), F.count("*").alias("rows")).where("members > 0 AND queries > 0")
    groups, path = stored(counts.select("g", F.ceil(F.col("members") / PART).alias("parts"), F.ceil(F.col("queries") / PART).alias("cuts"), "rows"))
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    rows = join_by_counted_key(rows, groups, "g", "rows")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("role") == 0, F.col("cuts")).otherwise(F.col("parts")).cast("int") - 1)))
    s = F.when(F.col("role") == 0, own("parts") * F.col("cuts") + F.col("other")).otherwise(F.col("other") * F.col("cuts") + own("cuts"))
    rows, path2 = stored(rows.select("g", s.cast("int").alias("s"), "role", "id"))
    drawn, path3 = _sent(rows, _only(texts, rows, True), ["n", "bits"])
    rows, path4 = stored(drawn.mapInArrow(tidy(_sift), "g bigint, s int, role int, id bigint"))
    drop_stored(texts.sparkSession, path, path2, *path3)
    found, path5 = _sent(rows, _only(texts, rows, False), ["text"])
    links, _ = stored(found.mapInArrow(tidy(_open_groups), "u bigint, v bigint"))
    drop_stored(texts.sparkSession, path4, *path5)
    return links


def _sent(rows: DataFrame, what: DataFrame, names: list[str]) -> tuple[DataFrame, list[str]]:
    """The rows (g, s, role, id) with what their ids have, dealt out by group and part, in order; and the stored tables to drop after use."""
    n, paths = rows.count(), []
    if n >= BUSY:  # else no id can be asked for so often
        uses = rows.groupBy("id").agg(F.count("*").alias("uses"))
        hot, path = stored(uses.where(F.col("uses") >= max(BUSY, -(-n // 64))).select("id"))
        paths = [path]
    if not paths or hot.isEmpty():
        rows = rows.join(what, "id")
    else:  # at most 64 ids; what each of them has goes to SPREAD places, so that no task gets all rows of one
        few = what.join(F.broadcast(hot), "id").withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
        busy = rows.join(F.broadcast(hot), "id").withColumn("place", F.pmod(F.xxhash64("g", "s"), F.lit(SPREAD)).cast("int"))
        rows = busy.join(few, ["id", "place"]).drop("place").unionByName(rows.join(F.broadcast(hot), "id", "left_anti").join(what, "id"))
    return rows.select("g", "s", "role", "id", *names).repartition("g", "s").sortWithinPartitions("g", "s", "role", "id"), paths


def _room(least: str) -> Column:
    """Whether a linked set of `least` tokens or more fits behind the place of the row's token, and this one behind the other's
    (`slack`): 5n - 9i >= 4m and 5m - 9j >= 4n, m being at least 0.8n."""
    low = F.greatest(F.col(least), F.floor((4 * F.col("n") + 4) / 5))
    return (5 * F.col("n") - 9 * F.col("place") >= 4 * low) & (F.col("slack") >= 4 * F.col("n"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(id, n_shingles, component) of each document row, from columns doc_id and text.

    Ids that are no integers are numbered in their order first (a sort, stored), and given back at the end.
    """
    kind = docs.schema["doc_id"].dataType
    if isinstance(kind, IntegralType):
        return _near_duplicates(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy("doc_id").select("doc_id", F.monotonically_increasing_id().alias("n"))
    ids, _ = stored(ids)
    found, _ = stored(_near_duplicates(docs.select("doc_id", "text").join(ids, "doc_id", "left").select(F.col("n").alias("doc_id"), "text")))
    sizes = found.where("id IS NOT NULL").groupBy("component").agg(F.count("*").alias("rows"))
    names, _ = stored(sizes.join(ids, F.col("component") == F.col("n")).select("component", F.col("doc_id").alias("first"), "rows"))
    real = join_by_counted_key(found.where("id IS NOT NULL"), names, "component", "rows").join(ids, F.col("id") == F.col("n"))
    none = F.lit(None).cast(kind)
    rest = found.where("id IS NULL").select(none.alias("id"), "n_shingles", none.alias("component"))
    return real.select(F.col("doc_id").alias("id"), "n_shingles", F.col("first").alias("component")).unionByName(rest)


def _near_duplicates(texts: DataFrame) -> DataFrame:
    spark = texts.sparkSession
    described, _ = stored(texts.mapInArrow(tidy(_describe), "id bigint, n bigint, d1 bigint, d2 bigint, token bigint, " + ", ".join(f"{b} bigint" for b in PARITY)))
    rows = described.where("d1 IS NOT NULL")
    classes = rows.where("id IS NOT NULL AND n > 0").groupBy("n", "d1", "d2").agg(F.min("id").alias("cls"), F.count("*").alias("copies"), *(F.any_value(b).alias(b) for b in PARITY))  # equal sets, equal parities
    classes, _ = stored(classes)

    counts = described.where("token IS NOT NULL").groupBy("token").agg(F.sum("n").alias("n"))
    counts, path = stored(counts.where("n >= 8"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    frequent = counts.where(F.col("n") >= -(-total // FREQUENT)).toPandas()
    drop_stored(spark, path)
    tokens = frequent["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    shared = spark.sparkContext.broadcast((tokens[order], frequent["n"].to_numpy(np.int64)[order]))

    # Prefixes of one text of each class.
    ids = classes.where(F.col("n") >= LEAST).select(F.col("cls"), F.col("d1").alias("of"), F.lit(1).alias("one"))
    prefix = texts.where("doc_id IS NOT NULL").mapInArrow(tidy(_prefixes(shared)), "id bigint, n bigint, d1 bigint, tokens array<bigint>, salts array<int>")
    prefix = prefix.join(ids, (prefix["id"] == ids["cls"]) & (prefix["d1"] == ids["of"])).select("cls", "n", F.arrays_zip("tokens", "salts").alias("z"))
    postings = prefix.select("cls", "n", F.posexplode("z").alias("place", "z")).select(F.col("z.tokens").alias("token"), F.col("z.salts").alias("salts"), "cls", "n", "place")
    salt = F.when(F.col("salts") > 1, F.pmod(F.xxhash64("cls"), F.col("salts").cast("long"))).otherwise(0)
    postings = postings.withColumn("salt", salt).repartition("token", "salt").select("token", "salts", "cls", "n", "place").sortWithinPartitions("token", "cls")
    postings, _ = stored(postings.mapInArrow(tidy(_share), "token bigint, salted boolean, cls bigint, n bigint, place int, pivot bigint"))

    # Step 3: each class against the pivot that it shares most tokens with, if it shares an eighth of its prefix, and the
    # pivots of a salted token against its smallest. What is not linked here is looked for in step 4.
    pool = texts.where("doc_id IS NOT NULL").withColumnRenamed("doc_id", "id")
    sizes = postings.where("cls <> pivot").groupBy("cls", "pivot").agg(F.count("*").alias("both"), F.first("n").alias("n"))
    prefix_size = F.col("n") - F.floor((4 * F.col("n") + 4) / 5) + 1
    sizes = sizes.where(8 * F.col("both") >= prefix_size).groupBy("cls").agg(F.max_by("pivot", F.struct("both", -F.col("pivot"))).alias("pivot"))
    salted = postings.where("salted").groupBy("token").agg(F.min("pivot").alias("least"), F.count("*").alias("rows"))
    salted, _ = stored(salted)
    above = join_by_counted_key(postings.where("salted AND cls = pivot").select("token", "pivot", "n"), salted, "token", "rows").where("pivot <> least").groupBy(F.col("pivot").alias("cls"), F.col("least").alias("pivot")).agg(F.count("*").alias("both")).select("cls", "pivot")
    near, path = stored(sizes.unionByName(above).distinct())
    stars = _verify(near.select(F.col("pivot").alias("g"), F.col("pivot").alias("id")).distinct(), near.select(F.col("pivot").alias("g"), F.col("cls").alias("id")), pool)
    drop_stored(spark, path)

    # Step 4: the token-group matrix, for tokens that lie in several groups.
    groups, _ = stored(components(stars))
    of = groups.select(F.col("id").alias("cls"), F.col("component").alias("g"))
    placed, path = stored(postings.select("token", "cls", "n", "place").join(of, "cls", "left").withColumn("g", F.coalesce("g", "cls")))
    slack = F.max(5 * F.col("n") - 9 * F.col("place")).alias("slack")
    across = placed.groupBy("token").agg(F.min("g").alias("low"), F.max("g").alias("high"), F.count("*").alias("rows"), F.min("n").alias("smallest"), slack).where("low <> high")
    across, path2 = stored(across.select("token", "rows", "smallest", "slack"))
    placed, path3 = stored(join_by_counted_key(placed, across, "token", "rows").where(_room("smallest")).select("token", "cls", "n", "place", "g").join(classes.select("cls", *PARITY), "cls"))
    matrix = placed.groupBy("token", F.col("g").alias("to")).agg(F.min("n").alias("least"), F.max("n").alias("most"), slack, (F.min("cls") == F.max("cls")).alias("single"), F.any_value(F.struct(*PARITY)).alias("odd"))
    apart = reduce(lambda a, b: a + b, [F.bit_count(F.col(b).bitwiseXOR(F.col(f"odd.{b}"))) for b in PARITY])
    pairs = placed.join(matrix, "token").where((F.col("to") < F.col("g")) & F.expr("5 * n >= 4 * least AND 4 * n <= 5 * most") & _room("least") & (~F.col("single") | (9 * F.coalesce(apart, F.lit(0)) <= F.col("n") + F.col("least"))))
    pairs = pairs.select(F.col("to").alias("g"), F.col("cls").alias("id")).distinct()
    pairs, path5 = stored(pairs)
    members = placed.select("g", F.col("cls").alias("id")).distinct()
    bridges = _verify(members.join(pairs.select("g").distinct(), "g", "left_semi"), pairs, pool)
    drop_stored(spark, path, path2, path3, path5)

    joined, _ = stored(components(stars.unionByName(bridges)))
    whole = classes.join(joined, classes["cls"] == joined["id"], "left").select("n", "d1", "d2", F.coalesce("component", "cls").alias("component"), "copies")
    whole, _ = stored(whole)
    key = ["n", "d1", "d2"]
    real = rows.where("id IS NOT NULL AND n > 0").withColumn("key", F.struct(*key))
    placed = join_by_counted_key(real.select("id", "key", F.col("n").alias("n_shingles")), whole.select(F.struct(*key).alias("key"), "component", "copies"), "key", "copies")
    rest = rows.where("id IS NULL OR n = 0").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component"))
    return placed.select("id", "n_shingles", "component").unionByName(rest)


def keep_one(docs: DataFrame) -> DataFrame:
    """Of each component the document with the smallest id; rows without an id stay. Columns as they came."""
    found = near_duplicates(docs).where("id IS NOT NULL AND id <> component").select(F.col("id").alias("_near_id")).distinct()
    return docs.join(found, docs["doc_id"] == found["_near_id"], "left_anti")


def op9_jaccard_join(docs: DataFrame) -> DataFrame:
    """The contract's view."""
    return near_duplicates(docs).select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))
