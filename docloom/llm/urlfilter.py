"""URL filters by a cascade of Bloom filters, in DataFrame functions alone.

A list of keys (a rule's host and path as one string) becomes bit arrays. Level 1 encodes the listed keys; level 2 those
keys of the corpus that are not listed but pass level 1; level 3 the listed ones that pass level 2; and so on until no
false positive is left. A key of the corpus is then listed exactly if the first level that lacks it is an even one.
The universe is complete: every key that any url of the corpus can be looked up by (each suffix of its host of at most as
many labels as some rule's host has, with each prefix of its path that is as long as some rule's path). Longer suffixes
can't be listed, so a url has a bounded number of keys, however long its host is.

Bits: level 1 has so low an error rate, listed / universe (the universe counted by HyperLogLog), that about as many false
positives as listed keys are expected; later levels have an error rate of 1 in 64, about nine bits for each key that they hold. What reaches the
executors is therefore bounded by the rule list times the logarithm of the corpus' size: one binary value for each level,
sent with the tasks. No join is needed to look up.

Defined results: a null url or one without `://` has an empty host and path and fits no rule; a rule's host fits itself and
its subdomains, its path any path that it begins; the longest rule that fits wins, a block before an allow of the same
text; where none fits the cascades themselves say "not listed", which allows. Repeated urls get the same verdict; an empty
table gives none. Columns whose names start with `_url_` are the operator's own; those of the input are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil, log, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import lower_ascii, own
from docloom.sources.store import drop_stored, stored

#: The contract's rules: action, host, path.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host in lower case, and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url)))
    host = F.coalesce(lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def url_keys(host: Column, path: Column, lengths: Sequence[int], most_labels: int) -> Column:
    """All keys that a rule with such path lengths and at most so many labels in its host can have for this url."""
    suffixes = F.array_distinct(F.array(*[F.substring_index(host, ".", -k) for k in range(1, most_labels + 1)]))
    starts = F.transform(F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(starts, lambda p: F.concat(s, p))))


class BloomLevel:
    """One bit array: how to find a key's bits, and the test for all of them."""

    def __init__(self, n: int, error: float, seed: str):
        self.hashes = max(1, ceil(log2(1 / error)))
        self.bits = 64 * max(1, ceil(n * self.hashes / log(2) / 64))
        self.seed, self.bytes = seed, bytearray(self.bits // 8)

    def places(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(f"{self.seed}.{i}"), key), F.lit(self.bits)) for i in range(self.hashes)]

    def fill(self, keys: DataFrame) -> BloomLevel:
        """Set the bits of the keys: they are combined on the executors, and at most bits / 64 words come to the driver."""
        at = keys.select(F.explode(F.array(*self.places(F.col("key")))).alias("p"))
        for r in at.groupBy(F.floor(F.col("p") / 64).cast("int").alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int"))).alias("b")).collect():
            self.bytes[8 * r["w"] : 8 * r["w"] + 8] = r["b"].to_bytes(8, "little", signed=True)
        return self

    def holds(self, key: Column) -> Column:
        """All bits set? A byte of the binary value, read as a Latin-1 letter, is that letter's code."""
        byte = lambda p: F.ascii(F.decode(F.substring(F.lit(bytes(self.bytes)), (F.floor(p / 8) + 1).cast("int"), F.lit(1)), "ISO-8859-1"))
        return reduce(lambda a, b: a & b, [F.getbit(byte(p).cast("long"), (p % 8).cast("int")) == 1 for p in self.places(key)])


class Cascade:
    """Levels of Bloom filters that are exact for every key of the universe they were built over."""

    def __init__(self, levels: Sequence[BloomLevel]):
        self.levels = list(levels)

    def holds(self, key: Column) -> Column:
        """Whether the key is listed: level 1 has it, and not (level 2 has it, and not (level 3 ...))."""
        answer = self.levels[-1].holds(key)
        for level in reversed(self.levels[:-1]):
            answer = level.holds(key) & ~answer
        return answer


def build_cascade(listed: DataFrame, passed: DataFrame, first: BloomLevel, seed: str, error: float = 1 / 64) -> Cascade:
    """Further levels until none has a false positive. `passed`: the unlisted keys of the corpus that pass level 1."""
    levels, inside, outside = [first], passed, listed
    while n := inside.count():
        levels.append(BloomLevel(n, error, f"{seed}.{len(levels)}").fill(inside))
        inside, outside = outside.where(levels[-1].holds(F.col("key"))), inside
    return Cascade(levels)


def _hit(action: str):
    return lambda key: F.struct(F.length(key).alias("n"), F.lit(action).alias("verdict"), key.alias("rule"))


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, default: str = "allow") -> DataFrame:
    """The pages with `_url_host`, `_url_path`, `_url_rule` and `_url_verdict`; other columns pass through."""
    spark, pages = pages.sparkSession, own(pages, "_url_")
    host, path = split_url(F.col("url"))
    urls = pages.withColumn("_url_host", host).withColumn("_url_path", path)
    lists = {action: sorted({h + p for a, h, p in rules if a == action}) for action in ("allow", "block")}
    lists = {action: keys for action, keys in lists.items() if keys}
    if not lists:
        return urls.withColumn("_url_rule", F.lit(None).cast("string")).withColumn("_url_verdict", F.lit(default))
    lengths = sorted({len(p) for _, _, p in rules})
    keys = url_keys(F.col("_url_host"), F.col("_url_path"), lengths, max(h.count(".") + 1 for _, h, _ in rules))
    universe = urls.select(F.explode(keys).alias("key"))
    size = max(1, universe.agg(F.approx_count_distinct("key")).first()[0])
    frames = {a: spark.createDataFrame([(k,) for k in ks], "key string") for a, ks in lists.items()}
    first = {a: BloomLevel(len(ks), min(0.5, len(ks) / size), a).fill(frames[a]) for a, ks in lists.items()}
    # The keys that pass a first level are few; each is told apart from the listed ones while the filters are built.
    passed = universe.select("key", *[first[a].holds(F.col("key")).alias(a) for a in lists]).where(" OR ".join(lists)).groupBy("key").agg(*[F.bool_or(a).alias(a) for a in lists])
    passed, path_of = stored(passed)
    cascades = {a: build_cascade(frames[a], passed.where(a).select("key").join(F.broadcast(frames[a]), "key", "left_anti"), first[a], a) for a in lists}
    drop_stored(spark, path_of)
    hits = F.flatten(F.array(*[F.transform(F.filter(keys, c.holds), _hit(a)) for a, c in cascades.items()]))
    best = F.array_max(hits)
    return urls.withColumn("_url_best", best).withColumn("_url_rule", F.col("_url_best.rule")).withColumn("_url_verdict", F.coalesce("_url_best.verdict", F.lit(default))).drop("_url_best")


def op5_url_filters(pages: DataFrame) -> DataFrame:
    """The contract's view."""
    out = filter_urls(pages.select("page_id", "url"))
    return out.select("page_id", F.col("_url_host").alias("host"), F.col("_url_path").alias("path"), F.col("_url_rule").alias("rule"), F.col("_url_verdict").alias("verdict"))


OP5_SQL = r"""
WITH r(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS (SELECT s.*, r.verdict, r.h || r.p AS rule, row_number() OVER (PARTITION BY page_id ORDER BY length(r.h || r.p) DESC NULLS LAST, r.verdict DESC) AS k
      FROM s LEFT JOIN r ON (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.p))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1
"""
