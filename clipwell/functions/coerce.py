"""Type coercion of loosely typed crawl fields (all built-in expressions)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blanks that are trimmed from texts.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c: str | Column) -> Column:
    """Trimmed text; null becomes ''. Also drops Unicode blanks, unlike ``trim``."""
    return F.coalesce(F.btrim(col(c).cast("string"), F.lit(BLANKS)), F.lit(""))


def filled(c: str | Column) -> Column:
    """Text or null when blank."""
    return F.nullif(text(c), F.lit(""))


def first_filled(cols: Iterable[str | Column]) -> Column:
    """First non-blank text among the columns, '' when all are blank."""
    return F.coalesce(*[filled(c) for c in cols], F.lit(""))


def whole_number(c: str | Column) -> Column:
    """Integer from digit text (optional minus); anything else is null."""
    t = text(c)
    return F.when(t.rlike(r"^-?[0-9]+$"), t.try_cast("bigint"))


def number_from_float_text(c: str | Column) -> Column:
    """Integer from float text, truncated; junk is null."""
    return text(c).try_cast("double").try_cast("bigint")


def grouped_number(c: str | Column) -> Column:
    """Integer from text with thousands commas; junk is 0."""
    return F.coalesce(F.replace(text(c), F.lit(","), F.lit("")).try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def real(c: str | Column, default: float = 0.0) -> Column:
    return F.coalesce(col(c).try_cast("double"), F.lit(float(default)))


# Words read as true / false.
TRUE_WORDS = ("1", "true", "yes", "y", "on")
FALSE_WORDS = ("0", "false", "no", "n", "off")


def flag(c: str | Column) -> Column:
    """Tri-state boolean: known words, otherwise null."""
    t = F.lower(text(c))
    return F.when(t.isin(*TRUE_WORDS), F.lit(True)).when(t.isin(*FALSE_WORDS), F.lit(False))


def truthy(c: Column) -> Column:
    """Any value but null, blank, false, 0, none and null counts as true."""
    t = F.lower(c.cast("string"))
    return F.coalesce((t != "") & ~t.isin("false", "0", "0.0", "none", "null"), F.lit(False))


def timestamp_of(c: str | Column) -> Column:
    """Timestamp from epoch seconds, ISO text or a date; naive text means the session zone (UTC)."""
    t = text(c)
    epoch = F.when(t.rlike(r"^[0-9]+(\.[0-9]+)?$"), t.try_cast("double"))
    return F.coalesce(F.timestamp_micros((epoch * 1000000).try_cast("bigint")), F.try_to_timestamp(t))


def iso_text(ts: Column) -> Column:
    """ISO rendering in UTC, whatever the session zone, micros only when present, '' for null (identity hashes)."""
    micros = F.unix_micros(ts.cast("timestamp"))
    second = F.make_dt_interval(secs=F.floor(micros / 1000000).cast("decimal(18,6)"))
    wall = (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + second).cast("string")
    rest = F.pmod(micros, F.lit(1000000))
    part = F.when(rest == 0, F.lit("")).otherwise(F.concat(F.lit("."), F.lpad(rest.cast("string"), 6, "0")))
    return F.coalesce(F.concat(F.replace(wall, F.lit(" "), F.lit("T")), part, F.lit("+00:00")), F.lit(""))


def tag_list(c: str | Column, default: Column | None = None) -> Column:
    """Tags from a JSON array (also with single quotes), comma text or one word.

    Blank input gives ``default`` (an array column), or an empty list.
    """
    t = text(c)
    parsed = F.filter(F.from_json(t, "array<string>"), lambda x: F.btrim(x) != "")
    bare = F.regexp_replace(t, r"^[\[\]]+|[\[\]]+$", "")
    parts = F.filter(
        F.transform(F.split(bare, ","), lambda x: F.btrim(F.btrim(x), F.lit("\"'"))), lambda x: x != ""
    )
    tags = F.when(t.contains(","), parts).otherwise(F.array(t))
    empty = F.array().cast("array<string>") if default is None else default
    return F.when(t == "", empty).when(t.startswith("["), F.coalesce(parsed, tags)).otherwise(tags)


def default_tags(pairs: dict[str, str | Column]) -> Column:
    """``key:value`` tags for the filled values, in the given order."""
    return F.array_compact(
        F.array(*[F.when(text(v) != "", F.concat(F.lit(f"{k}:"), text(v))) for k, v in pairs.items()])
    )
