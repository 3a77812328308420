"""Text normalisation as native column expressions: no Python runs for any of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space, as a Java character class.
WS = r"[\s\x1c-\x1f\x85\p{Z}]"


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends (Spark's trim knows the space alone)."""
    return F.regexp_replace(c, rf"^{WS}+|{WS}+\z", "")


def words(c: Column) -> Column:
    """Pieces between Unicode white space; an empty array for a blank text."""
    return F.filter(F.split(c, f"{WS}+"), lambda w: w != "")


def token_count(c: Column) -> Column:
    return F.size(words(c))


def submitter(c: Column) -> Column:
    """Without a leading 'comment submitted by' or 'comment from', in any case."""
    return strip(F.regexp_replace(c, rf"(?i)^(comment submitted by|comment from){WS}*", ""))


def without_label(c: Column) -> Column:
    """Without the literal label that page titles carry, wherever it stands."""
    return F.replace(c, F.lit("Comment Submitted by "), F.lit(""))


def word_characters(c: Column) -> Column:
    """Letters, digits and underscores of any script alone."""
    return F.regexp_replace(c, r"[^\p{L}\p{N}_]", "")


def _parsed(c: Column) -> Column:
    """A date from 'Jun 5, 2023' or ISO 8601 (extended, compact or week form); the written day counts, whatever the zone."""
    plain = F.regexp_replace(F.trim(c), r"\s+", " ")
    named = F.to_date(F.try_to_timestamp(F.initcap(F.lower(plain)), F.lit("MMM d, yyyy")))
    day = r"(?:[T ].*)?$"
    dashed = F.to_date(F.try_to_timestamp(F.regexp_extract(plain, rf"^(\d{{4}}-\d{{2}}-\d{{2}}){day}", 1), F.lit("yyyy-MM-dd")))
    compact = F.to_date(F.try_to_timestamp(F.regexp_extract(plain, rf"^(\d{{8}}){day}", 1), F.lit("yyyyMMdd")))
    week = r"^(\d{4})-?W(\d{2})(?:-?([1-7]))?$"
    part = lambda i: F.regexp_extract(plain, week, i)
    fourth = F.to_date(F.try_to_timestamp(F.concat(part(1), F.lit("-01-04")), F.lit("yyyy-MM-dd")))
    weeks = F.when(part(2).cast("string") != "", F.try_to_number(part(2), F.lit("99")).cast("int")).cast("int")
    weekday = F.when(part(3) != "", F.try_to_number(part(3), F.lit("9")).cast("int")).otherwise(1)
    from_week = F.date_add(F.date_sub(fourth, F.weekday(fourth)), (weeks - 1) * 7 + weekday - 1)
    return F.coalesce(named, dashed, compact, F.when(weeks.between(1, 53), from_week))


def date_key(c: Column) -> Column:
    """yyyyMMdd, or 'unknownDate' where no date can be read."""
    return F.coalesce(F.date_format(_parsed(c), "yyyyMMdd"), F.lit("unknownDate"))


def reformat_date(c: Column, into: str = "MM/dd/yyyy") -> Column:
    """yyyy-M-d in another form; the empty string where that can't be read."""
    return F.coalesce(F.date_format(F.try_to_timestamp(c, F.lit("yyyy-M-d")), into), F.lit(""))


def initials(c: Column) -> Column:
    """The upper-cased first letter of each word."""
    return F.array_join(F.transform(words(c), lambda w: F.upper(F.left(w, F.lit(1)))), "")


def agency_name(c: Column) -> Column:
    """Lower-cased without 'agency:' and a trailing period, then with a capital at each run of letters; null if nothing is left."""
    bare = strip(F.replace(F.lower(strip(c)), F.lit("agency:"), F.lit("")))
    bare = strip(F.regexp_replace(bare, r"\.\z", ""))
    runs = F.regexp_extract_all(bare, F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    title = F.array_join(F.transform(runs, lambda x: F.concat(F.upper(F.left(x, F.lit(1))), F.substring(x, F.lit(2), F.length(x)))), "")
    return F.when(bare != "", title)


def file_name(abbreviation: Column, who: Column, posted: Column, identity: Column) -> Column:
    """abbreviation__submitter__date__id."""
    return F.concat_ws("__", *[F.coalesce(x, F.lit("")) for x in (abbreviation, word_characters(submitter(who)), date_key(posted), identity)])


def file_base(c: Column) -> Column:
    """The name without its last extension; a leading dot begins a name, not an extension."""
    return F.regexp_replace(c, r"^(.*[^./][^/]*?)\.[^./]*$", "$1")


def file_extension(c: Column) -> Column:
    return F.when(file_base(c) != c, F.substring(c, F.length(file_base(c)) + 1, F.length(c))).otherwise("")


def attachment_base(c: Column, compat: bool = False) -> Column:
    """The base that a comment's attachments share: '_attachmentN' goes. compat cuts at the last '__attachment' instead."""
    base = file_base(c)
    return F.regexp_replace(base, r"(?s)^(.*)__attachment.*$", "$1") if compat else F.regexp_replace(base, r"_+attachment\d+$", "")


def sanitize(c: Column) -> Column:
    """Private-use bullets become bullets or spaces, and C1 controls and everything beyond the basic plane a space."""
    return F.regexp_replace(F.translate(c, "", " •   "), r"[\x{80}-\x{9F}\x{FFFE}-\x{10FFFF}]", " ")


def url_suffix(c: Column) -> Column:
    return F.lower(F.substring_index(c, ".", -1))


def absolute_url(c: Column, base: str) -> Column:
    return F.when(F.startswith(c, F.lit("http")), c).otherwise(F.concat(F.lit(base), c))


def report_cell(c: Column) -> Column:
    """A cell of a report: 'N/A' for null, the empty text, a number that is zero, false, and empty arrays and maps; else the
    text without outer white space. The type counts, not what the text looks like: '0' and 'false' as texts stay."""
    text, kind = c.cast("string"), F.typeof(c)
    number = kind.isin("tinyint", "smallint", "int", "bigint", "float", "double") | F.startswith(kind, F.lit("decimal"))
    zero = number & F.coalesce(text.try_cast("double") == 0, F.lit(False))
    none = ((kind == "boolean") & (text == "false")) | ((F.startswith(kind, F.lit("array")) | F.startswith(kind, F.lit("map"))) & text.isin("[]", "{}"))
    falsy = c.isNull() | (text == "") | zero | none
    return F.when(falsy, "N/A").otherwise(strip(text))


def validated(c: Column, allowed: list[str]) -> Column:
    """The answer if it is one of those allowed, else null."""
    return F.when(strip(c).isin(allowed), strip(c))


def answer_list(c: Column) -> Column:
    """'a, b, c' as an array, without empty pieces."""
    return F.filter(F.transform(F.split(c, ","), strip), lambda x: x != "")


def contains_any(c: Column, terms: list[str]) -> Column:
    """Whether the lower-cased text contains one of the terms as a substring; null for null."""
    return F.exists(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(F.lower(c), t))
