"""Line dedup by content-defined chunks. DataFrame functions only.

A passage is a run of two or more lines with ``min_words`` words, or one line of
``long_words``. A rolling hash (cyclic shift and xor of line hashes) runs over
each line and the next. In the shortest window of two or more lines and
``min_words`` words from every line the pair of the smallest rolling hash is
chosen: such boundaries depend only on the lines of their window, so they stand in
every copy of a passage wherever it is shifted. Also chosen are the pair before a
line of ``min_words`` words, which no window from an earlier blank line holds, and
single long lines.

Boundaries are counted over all documents by their hash. Only documents with
repeated ones are read again: a repeated boundary grows over its neighbours to
every shortest window, forward and backward, that holds it. A passage is the union
of such windows, so none is missed. The windows are counted by the SHA-256 of
their line digests; the bytes of the lines under every digest of a repeated window
are compared (distinct lines, aggregated before the shuffle, so that a line in a
third of all documents is one row per task), and a window with a line whose digest
stands for two texts stays. Of equal windows the first one stays
(smallest id, then place), as does one that overlaps its own first occurrence. The
others go; windows that touch are one run. Lines without words at the ends of a
passage stay, and so do passages that begin or end inside a line.

``repeated_runs`` is the exact check of this: it counts all windows of all
documents and chooses no boundaries. ``without_repeats`` cuts the chunks' runs.

Null or empty texts have one empty line and no chunk. Null ids come first. Rows
that agree in id and text share one fate. An empty table gives no rows. Other
columns play no part and stay as they are in the texts form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipwell.llm.common import WORD, durable, row_key, text_of

MIN_WORDS = 20
LONG_WORDS = 50


def _joined(lines: Column, start: Column, end: Column) -> Column:
    return F.array_join(F.slice(lines, start + 1, end - start + 1), "\n")


def _rolled(lines: Column, i: Column) -> Column:
    """Rolling hash of line ``i`` and the next one."""
    h = F.xxhash64(F.get(lines, i))
    turned = F.shiftleft(h, 1).bitwiseOR(F.shiftrightunsigned(h, 63))
    return turned.bitwiseXOR(F.xxhash64(F.get(lines, i + 1)))


def _line_digest(line: Column) -> Column:
    return F.md5(line.cast("binary"))


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, also where ``use`` reads it for every element of an array."""
    return F.get(F.transform(F.array(value), use), 0)


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, row_key, lines, at, w, back, m): lines, and places and words of those that have words."""
    return _measured(docs.select(
        F.col(f"`{key}`").alias("doc_id"), row_key(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("row_key"),
        F.split(text_of(f"`{text}`"), "\n").alias("lines"),
    ))


def _measured(df: DataFrame) -> DataFrame:
    counted = F.transform("lines", lambda x, i: F.struct(i.alias("i"), F.regexp_count(x, F.lit(WORD)).alias("w")))
    df = df.withColumn("full", F.filter(counted, lambda x: x["w"] > 0))
    kept = [F.col(c) for c in df.columns if c != "full"]
    df = df.select(*kept, F.col("full.i").alias("at"), F.col("full.w").alias("w"))
    return df.withColumns({"back": F.reverse("w"), "m": F.size("w")})


def _taken(w: str, k: Column, min_words: int) -> Column:
    """Lines with words from the ``k``-th on that hold ``min_words`` words; null if all that follow hold fewer."""
    start = F.struct(F.lit(0).alias("s"), F.lit(0).alias("n"))
    more = lambda a, x: F.when(a["s"] >= min_words, a).otherwise(F.struct((a["s"] + x).alias("s"), (a["n"] + 1).alias("n")))
    # every line taken has a word, so min_words lines are enough
    return F.aggregate(F.slice(w, k + 1, min_words), start, more, lambda a: F.when(a["s"] >= min_words, a["n"]))


def _ranges(min_words: int, long_words: int) -> Column:
    """Shortest windows from and to every line that has a word, and long lines, as structs of start and end."""
    span = lambda a, b: F.struct(a.cast("int").alias("start"), b.cast("int").alias("end"))
    end = lambda k, n: F.when(n == 1, F.get("at", k) + 1).when(n > 1, F.get("at", k + n - 1))
    begin = lambda k, n: F.when(n == 1, F.get("at", k) - 1).when(n > 1, F.get("at", k - n + 1))
    forward = F.transform("w", lambda w, k: span(F.get("at", k), end(k, _taken("w", k, min_words))))
    backward = F.transform("w", lambda w, k: span(begin(k, _taken("back", F.col("m") - 1 - k, min_words)), F.get("at", k)))
    alone = F.transform("w", lambda w, k: F.when(w >= long_words, span(F.get("at", k), F.get("at", k))))
    inside = lambda r: (r["start"] >= 0) & (r["end"] < F.size("lines"))
    return F.array_distinct(F.filter(F.concat(forward, backward, alone), inside))


def boundaries(docs: DataFrame, key: str, text: str, min_words: int = MIN_WORDS, long_words: int = LONG_WORDS) -> DataFrame:
    """(row_key, h, p): hash and line of every chosen pair of lines; long lines alone have the place -1 - p."""
    df = _lines(docs, key, text)
    point = lambda h, p: F.struct(h.alias("h"), p.cast("int").alias("p"))
    pairs = F.transform("at", lambda a: point(_rolled(F.col("lines"), a), a))
    taken = F.transform("w", lambda w, k: _taken("w", k, min_words))

    def least(v: Column) -> Column:
        pick = lambda n, k: F.when(n.isNotNull(), F.array_min(F.slice(v["pairs"], k + 1, F.greatest(n, F.lit(2)) - 1)))
        return F.transform(v["taken"], pick)

    chosen = _bound(F.struct(pairs.alias("pairs"), taken.alias("taken")), least)
    before = F.transform("w", lambda w, k: F.when(w >= min_words, point(_rolled(F.col("lines"), F.get("at", k) - 1), F.get("at", k) - 1)))
    inside = F.filter(F.concat(chosen, before), lambda x: (x["p"] >= 0) & (x["p"] + 1 < F.size("lines")))
    alone = F.transform("w", lambda w, k: F.when(w >= long_words, point(F.xxhash64(F.get("lines", F.get("at", k))), -1 - F.get("at", k))))
    all_of = F.array_distinct(F.concat(inside, F.filter(alone, lambda x: x.isNotNull())))
    return df.select("row_key", F.explode_outer(all_of).alias("b")).where("b is not null").select("row_key", "b.h", "b.p")


def _holders(docs: DataFrame, own: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, row_key, text, marks) of the documents whose ``places`` ``own`` lists by row_key; stored, as most have none."""
    zeros = lambda v: F.transform(v, lambda p, i: F.concat(F.repeat(F.lit("0"), p - F.coalesce(F.get(v, i - 1), F.lit(-1)) - 1), F.lit("1")))
    # one byte a line, 1 where a repeated boundary stands
    marks = F.array_join(_bound(F.array_sort(F.filter("places", lambda p: p >= 0)), zeros), "").cast("binary")
    rows = docs.select(
        F.col(f"`{key}`").alias("doc_id"), row_key(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("row_key"), text_of(f"`{text}`").alias("text")
    )
    return durable(rows.join(own.select("row_key", marks.alias("marks")), "row_key"))


def _grown(holders: DataFrame, min_words: int, long_words: int) -> DataFrame:
    """(doc_id, row_key, start, end, digest): windows that hold a marked boundary, and long lines."""
    df = _measured(holders.select("doc_id", "row_key", F.split("text", "\n").alias("lines"), "marks"))
    cut = lambda r: F.substring(F.col("marks"), r["start"] + 1, r["end"] - r["start"])
    held = F.filter(_ranges(min_words, long_words), lambda r: (r["start"] == r["end"]) | F.contains(cut(r), F.lit(b"1")))

    def named(v: Column) -> Column:
        joined = lambda r: F.array_join(F.slice(v["ids"], r["start"] + 1, r["end"] - r["start"] + 1), "")
        return F.transform(v["held"], lambda r: r.withField("digest", F.unhex(F.sha2(joined(r).cast("binary"), 256))))

    ranges = _bound(F.struct(F.transform("lines", _line_digest).alias("ids"), held.alias("held")), named)
    df = df.select("doc_id", "row_key", F.explode_outer(ranges).alias("r")).where("r is not null")
    return df.select("doc_id", "row_key", "r.*")


def _runs(ranges: DataFrame, *more: Column) -> DataFrame:
    """(doc_id, row_key, start_line, end_line, more): ranges that touch, merged per document."""
    before = Window.partitionBy("row_key").orderBy("start", "end")
    reach = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    df = ranges.withColumn("new", F.coalesce((F.col("start") > reach + 1).cast("int"), F.lit(1)))
    df = df.withColumn("run", F.sum("new").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    merged = df.groupBy("doc_id", "row_key", "run")
    return merged.agg(F.min("start").cast("long").alias("start_line"), F.max("end").cast("long").alias("end_line"), *more).drop("run")


def _same_bytes(holders: DataFrame, again: DataFrame) -> DataFrame:
    """``again`` without windows that hold a line whose digest stands for two different texts."""
    own = _runs(again).groupBy("row_key").agg(F.collect_set(F.struct("start_line", "end_line")).alias("runs"))
    runs = holders.join(own, "row_key").select("row_key", F.split("text", "\n").alias("lines"), F.explode("runs").alias("r"))
    cut = F.slice("lines", F.col("r.start_line").cast("int") + 1, (F.col("r.end_line") - F.col("r.start_line") + 1).cast("int"))
    lines = runs.select("row_key", "r.start_line", F.posexplode(cut).alias("i", "line"))
    lines = lines.select("row_key", (F.col("start_line") + F.col("i")).alias("at"), "line", F.unhex(_line_digest(F.col("line"))).alias("id"))
    # equal lines meet as bytes, once per task; a digest with two of them is mixed
    mixed = durable(lines.select("id", "line").distinct().groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"))
    if mixed.isEmpty():
        return again
    bad = lines.join(mixed, "id").select(F.col("row_key").alias("__bad"), "at").distinct()
    return again.join(bad, (F.col("row_key") == F.col("__bad")) & F.col("at").between(F.col("start"), F.col("end")), "left_anti")


def repeated_chunks(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, long_words: int = LONG_WORDS
) -> DataFrame:
    """One row per run of lines that goes: doc_id, row_key, start_line, end_line, first_doc_id, occurrences.

    Lines count from 0, ends are inclusive; ``first_doc_id`` is the smallest id that keeps a window of the run, and
    ``occurrences`` counts the most frequent of its windows.
    """
    chosen = durable(boundaries(docs, key, text, min_words, long_words))
    often = chosen.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    own = chosen.join(often.select("h"), "h").groupBy("row_key").agg(F.collect_set("p").alias("places"))
    holders = _holders(docs, own, key, text)
    found = durable(_grown(holders, min_words, long_words))
    often = found.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = durable(found.join(often.select("digest"), "digest"))
    gone = _later(_same_bytes(holders, again))
    return _runs(gone, F.min("first")["doc_id"].alias("first_doc_id"), F.max("occurrences").alias("occurrences"))


def _later(again: DataFrame) -> DataFrame:
    """The windows that stand in an earlier place too and do not overlap it: doc_id, row_key, start, end, first, occurrences."""
    first = again.groupBy("digest").agg(F.min(F.struct("doc_id", "row_key", "start")).alias("first"), F.count(F.lit(1)).alias("occurrences"))
    own = F.col("row_key") == F.col("first.row_key")
    apart = F.col("start") > F.col("first.start") + F.col("end") - F.col("start")
    return again.join(first, "digest").where(~own | apart).drop("digest")


def windows(docs: DataFrame, key: str, text: str, min_words: int = MIN_WORDS, long_words: int = LONG_WORDS) -> DataFrame:
    """(doc_id, row_key, start, end, digest): shortest windows from and to every line that has a word, and long lines."""
    df = _lines(docs, key, text).withColumn("r", _ranges(min_words, long_words))
    named = F.transform("r", lambda r: r.withField("digest", F.unhex(F.sha2(_joined(F.col("lines"), r["start"], r["end"]).cast("binary"), 256))))
    df = df.select("doc_id", "row_key", F.explode_outer(named).alias("r")).where("r is not null")
    return df.select("doc_id", "row_key", "r.start", "r.end", "r.digest")


def repeated_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, long_words: int = LONG_WORDS
) -> DataFrame:
    """One row per run of lines that goes: doc_id, row_key, start_line, end_line; every line of it stands in an earlier passage."""
    found = durable(windows(docs, key, text, min_words, long_words))
    often = found.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = durable(found.join(often.select("digest"), "digest"))
    return _runs(_later(again).select("doc_id", "row_key", "start", "end").distinct())


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """``docs`` with the lines of repeated chunks cut from the texts; all other columns and rows stay."""
    gone = repeated_chunks(docs, key, text, **limits)
    own = gone.groupBy(F.col("row_key").alias("__own")).agg(F.collect_set(F.struct("start_line", "end_line")).alias("__gone"))
    wide = docs.withColumn("__key", row_key(F.col(f"`{key}`"), F.col(f"`{text}`")))
    out = wide.join(own, F.col("__key") == F.col("__own"), "left")
    cut = lambda i: F.exists("__gone", lambda g: i.between(g["start_line"], g["end_line"]))
    left = F.array_join(F.filter(F.split(F.col(f"`{text}`"), "\n"), lambda x, i: ~cut(i)), "\n")
    out = out.withColumn(text, F.when(F.col("__gone").isNull(), F.col(f"`{text}`")).otherwise(left))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
