"""Quality rules by cross-document line frequency. DataFrame functions only.

Lines are normalised (lower case, single blanks, digit runs as 0) and hashed;
for every host the distinct documents that hold a line are counted, where
documents with the same text are one. A line above its host's limit is
boilerplate: it goes from every document but the first one that holds it
(smallest id), so that a large group of copies never loses its last holder. A
document whose remaining words fall below a share of all its words is depleted
and rejected.

Null or empty texts have no words and fail the base rule. A null host is a host
of its own. Repeated rows get equal verdicts; ties of the smallest id break by
the text's hash. An empty table gives an empty result, and columns besides the
three named ones are ignored.

The exploded lines are one row per line of a *distinct* text, the only joins
are on (host, line) and (host, text), and both sides meet after partial
aggregation; a hot host, line or text is split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwell.llm.common import BLANKS, GAP, WORD, durable, text_of, words_of

#: Symbol characters and the base limits.
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def normal_line(line: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.btrim(line, F.lit(BLANKS))), GAP, " "), "[0-9]+", "0")


def _repeat_words(df: DataFrame, words: str, name: str, spare: int = 0) -> DataFrame:
    """Words inside three-word windows that occur at least twice in the array.

    Each window is one long: high bits of its hash, low bits its place (``spare`` more of them are left out of
    the hash). Sorting longs puts equal windows side by side, so no window leaves its row. The words of windows
    with equal hashes are compared, up to two places apart: a repeat is missed only if three different windows
    of one text have one hash of at least 32 bits and stand between each other.
    """
    n = F.size(words) - 2
    bits = F.length(F.bin(F.greatest(n, F.lit(1)).cast("long"))) + spare
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    at = lambda i: F.get(F.col(words), i)
    step = df.withColumns({"__bits": bits, "__starts": starts})
    window = lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2))
    high = F.expr("-shiftleft(1L, __bits)")
    step = step.withColumn("__high", high).withColumn(
        "__packed", F.sort_array(F.transform("__starts", lambda i: window(i).bitwiseAND(F.col("__high")).bitwiseOR(i.cast("long"))))
    )
    place = lambda x: x.bitwiseAND(F.bitwise_not(F.col("__high"))).cast("int")

    def twin(x: Column, i: Column) -> Column:
        other = F.get("__packed", i)
        equal = x.bitwiseXOR(other).bitwiseAND(F.col("__high")) == 0
        for k in range(3):
            equal = equal & (at(place(x) + k) == at(place(other) + k))
        return F.coalesce(equal, F.lit(False))

    near = lambda x, i: twin(x, i - 1) | twin(x, i + 1) | twin(x, i - 2) | twin(x, i + 2)
    step = step.withColumn("__twins", F.filter("__packed", near))
    step = step.withColumn("__places", F.sort_array(F.transform("__twins", lambda x: x.bitwiseAND(F.bitwise_not(F.col("__high"))))))
    reach = F.transform("__places", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("__places", i + 1) - p, F.lit(3))))
    total = F.aggregate(reach, F.lit(0).cast("long"), lambda a, b: a + b)
    return step.withColumn(name, total).drop("__bits", "__starts", "__high", "__packed", "__twins", "__places")


def measured(docs: DataFrame, host: str = "source", text: str = "text", key: str = "doc_id") -> DataFrame:
    """One narrow row per document: base measures, the text's hash, and hash and words of each line that has a word."""
    t = F.col("__t")
    df = docs.select(F.col(key).alias("doc_id"), F.col(host).alias("__host"), text_of(text).alias("__t"))
    df = df.withColumn("__words", words_of(t)).withColumn(
        "__lines", F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0)
    )
    df = _repeat_words(df, "__words", "n_repeat_words")
    return df.select(
        "doc_id",
        "__host",
        F.struct(F.xxhash64(t).alias("h"), F.octet_length(t).alias("n")).alias("__text"),
        F.size("__words").cast("long").alias("n_words"),
        (F.length(t) - F.regexp_count(t, F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.transform(
            "__lines",
            lambda x: F.struct(F.xxhash64(normal_line(x)).alias("h"), F.regexp_count(x, F.lit(WORD)).alias("w")),
        ).alias("__line"),
    )


def frequent_lines(texts: DataFrame, min_docs: int, share: float) -> tuple[DataFrame, DataFrame]:
    """(all lines of the distinct texts, the lines above their host's limit with their first holder)."""
    keys = ["__host", "__text"]
    lines = (
        texts.select(*keys, "__id", F.explode("__line").alias("__l"))
        .groupBy(*keys, F.col("__l.h").alias("__h"))
        .agg(F.sum("__l.w").alias("__w"), F.min("__id").alias("__id"))
    )
    hosts = texts.groupBy("__host").agg(F.count(F.lit(1)).alias("__docs"))
    held = lines.groupBy("__host", "__h").agg(
        F.count(F.lit(1)).alias("__n"), F.min(F.struct("__id", "__text")).alias("__first")
    )
    held = held.where(F.col("__n") > min_docs).alias("a").join(hosts.alias("b"), F.expr("a.__host <=> b.__host"))
    often = held.where(F.col("__n") > F.greatest(F.lit(min_docs), F.col("__docs") * share))
    return lines, often.select("a.__host", "__h", F.col("__first.__text").alias("__keeper"), "__n")


def line_verdicts(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    key: str = "doc_id",
    min_docs: int = 10,
    share: float = 0.005,
    min_left: float = 0.2,
) -> DataFrame:
    """Measures and verdict per row of ``docs``.

    A line is boilerplate on a host if more distinct documents hold it than
    ``min_docs`` and than ``share`` of the host's; a document is depleted if
    less than ``min_left`` of its words remain.
    """
    rows = durable(measured(docs, host, text, key))
    texts = rows.groupBy("__host", "__text").agg(F.min("doc_id").alias("__id"), F.first("__line").alias("__line"))
    lines, often = frequent_lines(texts, min_docs, share)
    gone = (
        lines.alias("a")
        .join(often.alias("b"), F.expr("a.__host <=> b.__host and a.__h = b.__h and a.__text <> b.__keeper"))
        .groupBy(F.col("a.__host").alias("__host"), F.col("a.__text").alias("__text"))
        .agg(F.sum("__w").alias("__gone"), F.collect_set("a.__h").alias("removed_lines"))
    )
    out = rows.alias("a").join(gone.alias("b"), F.expr("a.__host <=> b.__host and a.__text = b.__text"), "left")
    n, removed = F.col("n_words"), F.coalesce("__gone", F.lit(0)).cast("long")
    failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)
    return out.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        removed.alias("boilerplate_words"),
        failed.alias("base_failed"),
        (~failed & (n - removed >= min_left * n)).alias("kept"),
        F.coalesce("removed_lines", F.array().cast("array<bigint>")).alias("removed_lines"),
        F.col("a.__host").alias("host"),
        F.col("a.__text").alias("text_key"),
    )


def accepted(docs: DataFrame, host: str = "source", text: str = "text", key: str = "doc_id", strip: bool = False, **limits) -> DataFrame:
    """The rows of ``docs`` that pass, all columns as they are; ``strip`` also cuts boilerplate lines from the texts."""
    verdicts = line_verdicts(docs, host, text, key, **limits).where("kept")
    keep = verdicts.groupBy("host", "text_key").agg(F.first("removed_lines").alias("__gone"))
    t = text_of(f"`{text}`")
    wide = docs.withColumns({"__text": F.struct(F.xxhash64(t).alias("h"), F.octet_length(t).alias("n")), "__host": F.col(host)})
    out = wide.join(
        keep.select(F.col("host").alias("__h2"), F.col("text_key").alias("__t2"), "__gone"),
        F.expr("__host <=> __h2 and __text = __t2"),
    )
    if strip:
        left = F.filter(F.split(t, "\n"), lambda x: ~F.array_contains("__gone", F.xxhash64(normal_line(x))))
        out = out.withColumn(text, F.array_join(left, "\n"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
