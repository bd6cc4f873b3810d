"""Text expressions: ids in text, URLs, cleaning, tokens, topics, hashes."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from clipwell.functions import lexicons as lx
from clipwell.functions.coerce import col, filled, text
from clipwell.functions.rows import exploded


def has_any(c: Column, words: Sequence[str]) -> Column:
    """True when any word occurs in the text."""
    out = F.lit(False)
    for i, w in enumerate(words):
        out = c.contains(w) if i == 0 else out | c.contains(w)
    return out


def hits(c: Column, words: Sequence[str]) -> Column:
    """Number of distinct words that occur."""
    total = F.lit(0)
    for w in words:
        total = total + c.contains(w).cast("int")
    return total


def occurrences(c: Column, words: Sequence[str]) -> Column:
    """Non-overlapping occurrences of all words together."""
    total = F.lit(0)
    for w in words:
        total = total + F.floor((F.length(c) - F.length(F.replace(c, F.lit(w), F.lit("")))) / len(w)).cast("int")
    return total


# -- ids inside texts ---------------------------------------------------------

def longest_digit_run(c: str | Column, at_least: int = 10) -> Column:
    """Longest run of at least ``at_least`` digits, the first on ties, '' when none."""
    runs = F.regexp_extract_all(text(c), F.lit(rf"([0-9]{{{at_least},}})"), 1)
    ranked = F.transform(runs, lambda x, i: F.struct(F.length(x).alias("n"), (-i).alias("at"), x.alias("run")))
    return F.coalesce(F.array_max(ranked)["run"], F.lit(""))


def first_digit_run(c: str | Column, at_least: int = 10) -> Column:
    return F.regexp_extract(text(c), rf"([0-9]{{{at_least},}})", 1)


def path_segment_id(c: str | Column) -> Column:
    return F.regexp_extract(text(c), r"/video/([^/?#]+)", 1)


def path_digits_id(c: str | Column) -> Column:
    return F.regexp_extract(text(c), r"/video/([0-9]+)", 1)


def suffix_id(c: str | Column) -> Column:
    """Part after the last underscore of a file stem."""
    return F.regexp_extract(text(c), r"_([^_]+)$", 1)


def strict_id(c: str | Column, at_least: int = 10) -> Column:
    return text(c).rlike(rf"^[0-9]{{{at_least},}}$")


def loose_id(c: str | Column) -> Column:
    t = text(c)
    return t.rlike(r"^[A-Za-z0-9_-]{6,128}$") & ~F.lower(t).isin(*lx.NULL_WORDS)


# -- names and URLs -----------------------------------------------------------

def account_key(c: str | Column) -> Column:
    """Stable account id: URL path (or host), blanks to underscores, 'unknown' when blank."""
    t = F.coalesce(filled(c), F.lit("unknown"))
    path = F.btrim(F.regexp_extract(t, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)", 1), F.lit("/"))
    host = F.regexp_extract(t, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1)
    return F.replace(F.when(host != "", F.coalesce(F.nullif(path, F.lit("")), host)).otherwise(t), F.lit(" "), F.lit("_"))


def bare_name(c: str | Column) -> Column:
    """Account name without question marks (lost emoji)."""
    return text(F.translate(text(c), "?？", ""))


def host_and_path(c: str | Column) -> Column:
    """Response URL without scheme, query and fragment."""
    return F.regexp_replace(F.regexp_replace(text(c), r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"[?#].*$", "")


def origin(c: str | Column) -> Column:
    return F.regexp_extract(text(c), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)


def canonical_url(base: str | Column, video_id: Column) -> Column:
    """Origin of the page plus /video/<id>."""
    return F.concat(origin(base), F.lit("/video/"), video_id)


def slug(c: str | Column, size: int = 80) -> Column:
    """File-name safe text of at most ``size`` characters, 'unknown' when nothing is left.

    A longer one ends with a short hash of the whole, so that equal beginnings stay apart.
    """
    safe = F.btrim(F.regexp_replace(text(c), r'[\\/:*?"<>|\s_]+', "_"), F.lit("._ "))
    cut = F.concat(F.left(safe, F.lit(size - 9)), F.lit("_"), F.left(F.sha1(safe.cast("binary")), F.lit(8)))
    return F.when(safe == "", F.lit("unknown")).when(F.length(safe) > size, cut).otherwise(safe)


# -- cleaning -----------------------------------------------------------------

ENTITY = r"&(?:#[0-9]{1,7};?|#[xX][0-9a-fA-F]{1,6};?|[A-Za-z][A-Za-z0-9]{1,31};?)"
TERMINATED_ENTITY = ENTITY.replace(";?", ";")


def _constant_map(pairs: Mapping[str, str]) -> Column:
    return F.from_json(F.lit(json.dumps(dict(pairs))), "map<string,string>")


def _decoded(mark: Column) -> Column:
    """Text of one entity, the mark itself if there is none."""
    digits = F.regexp_extract(mark, r"^&#[xX]?([0-9a-fA-F]+)", 1)
    number = F.when(mark.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10)).cast("int")
    point = F.when((number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF), 0xFFFD).otherwise(number)
    odd = F.element_at(_constant_map({str(k): v for k, v in lx.WINDOWS_1252.items() if v}), number.cast("string"))
    char = F.coalesce(odd, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32"))
    name = F.element_at(_constant_map(lx.ENTITIES), F.substring(mark, F.lit(2), F.length(mark)))
    return F.when(mark.startswith("&#"), char).otherwise(F.coalesce(name, mark))


def unescaped(c: Column, terminated: bool = False) -> Column:
    """All numeric and named HTML entities decoded; texts without an ampersand are left alone.

    The standard also reads old names and numbers without their semicolon (``&amp``, as a cut text ends);
    with ``terminated`` these stay as they are.
    """
    entity = TERMINATED_ENTITY if terminated else ENTITY
    pieces, marks = F.split(c, entity), F.regexp_extract_all(c, F.lit(entity), F.lit(0))
    joined = F.zip_with(pieces, marks, lambda p, m: F.concat(p, F.coalesce(_decoded(m), F.lit(""))))
    return F.when(c.contains("&"), F.array_join(joined, "")).otherwise(c)


def single_spaced(c: Column) -> Column:
    """Blanks collapsed to one space. Lone plain spaces are left alone, so most of a text is only scanned."""
    return F.btrim(F.regexp_replace(c, r"[\s\x{a0}\x{3000}]{2,}|[\t\n\x0B\f\r\x{a0}\x{3000}]", " "))


def clean_comment(c: str | Column, terminated: bool = False) -> Column:
    """Entities decoded, zero-width marks and blanks collapsed."""
    return single_spaced(F.translate(unescaped(F.coalesce(col(c).cast("string"), F.lit("")), terminated), "​﻿", "  "))


def visible_text(c: str | Column, terminated: bool = False) -> Column:
    """HTML without scripts, styles and tags."""
    bare = F.regexp_replace(col(c), r"(?is)<(script|style)[^>]*>.*?</\1>", " ")
    return single_spaced(unescaped(F.regexp_replace(bare, r"(?is)<[^>]+>", " "), terminated))


def plausible_comment(c: Column) -> Column:
    return (
        F.length(c).between(2, 500)
        & ~F.lower(c).isin(*lx.COMMENT_KEYWORDS)
        & ~c.rlike(r"^[^\p{L}\p{N}]+$")
        & ~c.rlike(r"^[0-9]+(\.[0-9]+)?$")
    )


# -- tokens, titles, topics, sentiment ----------------------------------------

def raw_tokens(c: str | Column) -> Column:
    return F.regexp_extract_all(F.lower(col(c)), F.lit(lx.TOKEN_PATTERN), 1)


def tokens(c: str | Column, stopwords: Sequence[str] = lx.STOPWORDS) -> Column:
    return F.filter(raw_tokens(c), lambda t: ~t.isin(*stopwords))


def token_rows(
    df: DataFrame, keys: Sequence[str], c: str | Column, stopwords: Sequence[str] = lx.STOPWORDS, name: str = "token"
) -> DataFrame:
    """One row per token occurrence; the stop words are dropped after the explode, inside codegen."""
    out = exploded(df, keys, raw_tokens(c), name)
    return out.where(~F.col(name).isin(*stopwords)) if stopwords else out


def title_features(
    c: str | Column,
    words: Mapping[str, Sequence[str]] = lx.TITLE_WORDS,
    grade_pattern: str = lx.GRADE_PATTERN,
    suffix: str = lx.TITLE_SUFFIX,
) -> dict[str, Column]:
    """Binary title flags, length and hashtag count."""
    t = text(F.replace(text(c), F.lit(suffix), F.lit("")))
    out = {
        "title_clean": t,
        "title_len": F.length(t).cast("bigint"),
        "has_question": has_any(t, ("?", "？")).cast("int"),
        "has_exclaim": has_any(t, ("!", "！")).cast("int"),
        "has_grade": t.rlike(grade_pattern).cast("int"),
    }
    out.update({name: has_any(t, group).cast("int") for name, group in words.items()})
    out["hashtag_count"] = F.regexp_count(t, F.lit("#")).cast("bigint")
    return out


TITLE_FLAGS = (
    "has_question", "has_exclaim", "has_grade", "has_method", "has_material",
    "has_parent_child", "has_interaction", "has_subject", "has_persona",
)


def topics(
    c: Column, lexicon: Mapping[str, Sequence[str]] = lx.COMMENT_TOPICS, default: str | None = lx.OTHER_TOPIC
) -> Column:
    low = F.lower(c)
    found = F.array_compact(
        F.array(*[F.when(has_any(low, [w.lower() for w in words]), F.lit(name)) for name, words in lexicon.items()])
    )
    if default is None:
        return found
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(default)))


def sentiment(c: Column, lexicon: Mapping[str, Sequence[str]] = lx.SENTIMENTS, neutral: str = lx.NEUTRAL) -> Column:
    expr = None
    for label, words in lexicon.items():
        cond = has_any(c, words)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(neutral) if expr is None else expr.otherwise(F.lit(neutral))


def is_noise(c: str | Column, markers: Sequence[str] = lx.COMMENT_NOISE) -> Column:
    return has_any(text(c), markers)


def same_author(nick: str | Column, name: str | Column) -> Column:
    """Nickname equals, contains or is contained in the account name (both filled)."""
    a, b = text(nick), text(name)
    return (a != "") & (b != "") & ((a == b) | a.contains(b) | b.contains(a))


def contains_in(c: Column, words: Sequence[str], head: int = 0, tail: int = 0) -> Column:
    scope = F.left(c, F.lit(head)) if head else F.right(c, F.lit(tail)) if tail else c
    return has_any(scope, words)


def compact(c: Column) -> Column:
    return F.regexp_replace(c, r"[\s\p{Z}]+", "")


def readability(c: Column) -> Column:
    """0.7 * readable share + 0.3 * min(1, length / 80), 4 digits."""
    t = compact(c)
    size = F.length(t)
    readable = F.length(F.regexp_replace(t, r"[^\x{4e00}-\x{9fff}\p{L}\p{N}]", ""))
    score = readable / size * 0.7 + F.least(F.lit(1.0), size / 80.0) * 0.3
    return F.when(size > 0, F.bround(score, 4)).otherwise(0.0)


def keyword_density(c: Column, pattern: str) -> Column:
    t = compact(c)
    found = F.regexp_count(t, F.lit(pattern))
    return F.when(F.length(t) > 0, F.bround(F.least(F.lit(1.0), found * 6.0 / F.length(t)), 4)).otherwise(0.0)


def char_overlap(left: Column, right: Column) -> Column:
    """Jaccard similarity of the two character sets."""
    a, b = F.array_distinct(F.split(left, "")), F.array_distinct(F.split(right, ""))
    both = F.size(F.array_intersect(a, b))
    either = F.size(F.array_union(a, b))
    return F.when((F.length(left) > 0) & (F.length(right) > 0), both / either).otherwise(0.0)


# -- identity -----------------------------------------------------------------

def content_hash(c: str | Column, terminated: bool = False) -> Column:
    return F.sha1(clean_comment(c, terminated).cast("binary"))


def identity_hash(kind: str, *parts: Column) -> Column:
    """SHA-256 over the kind and the parts joined by a bar, blanks for nulls."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("|", F.lit(kind), *texts), 256)


def short_hash(c: Column, size: int = 16) -> Column:
    return F.left(F.sha1(c.cast("binary")), F.lit(size))


@F.pandas_udf(StringType())
def repaired_text(values: pd.Series) -> pd.Series:
    """Latin-1 text that is really GBK, decoded when that raises the CJK share.

    The only Python function in the hot path: the charset is not available to
    ``decode``. Rows without a suspicious letter pass through untouched.
    """

    def cjk_share(t: str) -> float:
        chars = [ch for ch in t if not ch.isspace()]
        return sum("一" <= ch <= "鿿" for ch in chars) / len(chars) if chars else 0.0

    def repair(t: str) -> str:
        try:
            candidate = t.encode("latin1").decode("gbk")
        except UnicodeError:
            return t
        return candidate if cjk_share(candidate) > cjk_share(t) else t

    suspicious = values.str.contains("[À-ÿ]", regex=True, na=False)
    return values.where(~suspicious, values[suspicious].map(repair))
