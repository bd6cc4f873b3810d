"""Column expressions and small helpers that the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwell.operators.ordering import checkpoint_folder, durable

__all__ = ["checkpoint_folder", "durable", "digest", "read", "row_key", "small", "text_of", "utf8_crc32", "words_of", "BLANKS", "GAP", "WORD"]

#: The six characters between words, as a set, and a word and a gap as patterns.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def text_of(column: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words_of(text: Column) -> Column:
    """Words of a text as an array; empty for a text without words."""
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(inner) == 0, F.array().cast("array<string>")).otherwise(F.split(inner, GAP))


def utf8_crc32(text: Column) -> Column:
    return F.crc32(text.cast("binary"))


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it was counted and has at most ``rows`` rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def digest(text: Column) -> Column:
    """16 bytes that name a text."""
    return F.unhex(F.md5(text_of(text).cast("binary")))


def row_key(key: Column, text: Column) -> Column:
    """16 bytes that name an id with a text."""
    return F.unhex(F.md5(F.concat(digest(text), F.coalesce(key.cast("string"), F.lit("null")).cast("binary"))))
