"""Phrase collocations by vertical partitioning of truncated suffixes.

Texts are lower-cased (A-Z), split into pieces and words; everything is counted
per language. A phrase of up to ``longest`` words is a prefix of a suffix that
begins at one of its occurrences, cut after ``longest`` words or at the piece's end.

Vertical partitioning. Word prefixes that occur less than ``least`` times are in
no candidate: words are counted, then pairs of frequent words, then triples of frequent
pairs, and suffixes also end where one that is too rare begins. The remaining pairs are the prefixes; one with more than ``budget``
occurrences is extended by the next word, one scan per length, until each fits or
is a whole phrase. Prefixes in the order of their hashes are cut into groups of
about ``budget`` occurrences, which bounds what a group's leaves take in memory, and
the suffixes of a group go to one task. There the group's depth-truncated subtrees
are built by themselves: sorted suffixes are the leaves, the words shared with the
next leaf the rightmost path, and a node's count is the total of its leaves. Nodes
above an extended prefix get their totals from several groups, which are added.

Texts are taken in chunks of bounded size, cut between words, whose words are
numbered by array operations; words of equal hash are compared byte by byte, so
that counts are exact. Copies of a suffix are added up in the chunk, so a passage
that fills a third of the table is one leaf per chunk. Hashes of prefixes decide only
what is pruned and where a suffix goes: equal ones prune less. Four things are
broadcast: three bitmaps of fixed size that tell which words, pairs and triples may be frequent
(a wrong yes only adds leaves, which the count drops), the first hash of each group
(one per ``budget`` words), and the prefixes over the budget, of which there are fewer.
Counts of parts meet their candidates by joins.

Scores are exact decimals. Null texts are empty; a null language is ``und``. Repeated
rows count each. Ties are in the order of the contract: score and count descending,
then UTF-8 bytes. Texts without words count nothing, an empty table gives no rows,
other columns play no part.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from clipwell.llm.common import durable, small
from clipwell.llm.spans import K1, Spans, mixed
from clipwell.operators.ordering import with_running_total

#: Kinds of bytes, 0 in words, 1 blanks, 2 between pieces; and letters that are lowered.
_KIND, _LOWER = np.zeros(256, np.uint8), np.arange(256, dtype=np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_LOWER[65:91] += 32
_BREAK = re.compile(rb"[\x20\x09.,;:!?\x0A-\x0D]")
_WORD_AFTER = rb"(?:[\x20\x09]+[^\x20\x09.,;:!?\x0A-\x0D]+){0,%d}"
UNKNOWN = "und"
#: Ends every word of a stored phrase. Words with it, or with the escape, are escaped, so that phrases with a common
#: beginning are neighbours in the order of bytes.
END, _ESCAPE = "\x00", "\x01"
WORD_BITS, PREFIX_BITS = 26, 27
#: Bits of a prefix's hash, and lengths of prefixes whose rare ones are pruned before suffixes are built.
_HASH = 40
PRUNED = (2, 3)
_CHUNK = 1 << 20
_MAX_LANGS = 10_000


class Chunk(Spans):
    """Words of one language's bytes in order: exact numbers, hashes and pieces; words from ``limit`` on only follow others."""

    def __init__(self, lang: str, data: bytes, limit: int):
        raw = np.frombuffer(data, np.uint8)
        kind = _KIND[raw]
        edge = np.diff((kind == 0).view(np.int8), prepend=np.int8(0), append=np.int8(0))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.own = int(np.searchsorted(self.start, limit))
        self.piece = np.searchsorted(np.flatnonzero(kind == 2), self.start)
        super().__init__(_LOWER[raw], self.start, self.end)
        self.hash = mixed(self.hash ^ np.uint64(xxh64_intdigest(lang.encode())))
        self.names: dict[int, str] = {}

    def name(self, code: int) -> str:
        """The stored form of a word."""
        found = self.names.get(code)
        if found is None:
            word = self.bytes_of(self.first[code]).decode("utf-8", "replace")
            if END in word or _ESCAPE in word:
                word = word.replace(_ESCAPE, "\x01\x03").replace(END, "\x01\x02")
            found = self.names[code] = word + END
        return found

    def after(self, k: int, x: np.ndarray) -> np.ndarray:
        """``x`` of the k-th next word, zero at the end."""
        return np.concatenate([x[k:], np.zeros(min(k, len(x)), x.dtype)])

    def prefix(self, h: np.ndarray, k: int) -> np.ndarray:
        """Hash of prefixes of k + 1 words from that of k words."""
        return mixed(h * K1 + self.after(k, self.hash)) >> np.uint64(64 - _HASH)

    def frequent(self, bitmaps: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
        """(hash, whether it may be frequent, length k) of the prefix of k words at each place; the bitmaps are of 1 to k words."""
        h, may = self.hash, _among(bitmaps[0], WORD_BITS, self.hash >> np.uint64(64 - WORD_BITS))
        for k, found in enumerate(bitmaps[1:], 1):
            h, may = self.longer(h, may, k)
            may &= _among(found, PREFIX_BITS, h >> np.uint64(_HASH - PREFIX_BITS))
        return h, may, len(bitmaps)

    def longer(self, h: np.ndarray, may: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, whether both shorter parts may be frequent) of the prefixes of k + 1 words."""
        both = may & self.after(1, may)
        if k == 1:
            both &= (self.piece == self.after(1, self.piece)) & (np.arange(len(may)) + 1 < len(may))
        return self.prefix(h, k), both

    def reach(self, bitmaps: list[bytes], longest: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash of each pair, number of further words of each suffix, below ``longest``)."""
        n = np.zeros(len(self.hash), np.int64)
        for k in range(2, len(bitmaps) + 1):
            h, may, _ = self.frequent(bitmaps[:k])
            n += may
        for k in range(len(bitmaps), longest):
            may = may & self.after(1, may)
            n += may
        n[self.own :] = 0
        return self.prefix(self.hash, 1), n


def _among(bitmap: bytes, bits: int, at: np.ndarray) -> np.ndarray:
    return (np.frombuffer(bitmap, np.uint8)[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def _cut(data: bytes, ahead: int) -> Iterator[tuple[bytes, int]]:
    """Chunks that end between words, with the next words of the piece behind them, and the length without these."""
    at, more = 0, re.compile(_WORD_AFTER % ahead)
    while at < len(data):
        cut = _BREAK.search(data, at + _CHUNK)
        if cut is None:
            yield data[at:], len(data) - at
            return
        yield data[at : more.match(data, cut.start()).end()], cut.start() - at
        at = cut.start()


def _counted(count: Callable[[str, Chunk], dict], fields: dict[str, pa.DataType], ahead: int):
    """Arrow batches (lang, text as bytes) to the counts of their chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = defaultdict(list)
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                texts[lang].append(text)
            for lang, found in texts.items():
                for data, limit in _cut(b"\n".join(found), ahead):
                    chunk = Chunk(lang, data, limit)
                    if chunk.own:
                        out = count(lang, chunk)
                        arrays = [x if isinstance(x := out[k], pa.Array) else pa.array(x, t) for k, t in fields.items()]
                        yield pa.RecordBatch.from_arrays(arrays, names=list(fields))

    return run


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    kept = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    return docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"), kept.alias("text"))


def vocabulary(texts: DataFrame) -> DataFrame:
    """(lang, phrase, n): every word as a stored phrase with its count."""

    def count(lang: str, c: Chunk) -> dict:
        n = np.bincount(c.code[: c.own], minlength=len(c.first))
        used = np.flatnonzero(n)
        return {"lang": [lang] * len(used), "phrase": [c.name(i) for i in used.tolist()], "n": n[used]}

    fields = {"lang": pa.string(), "phrase": pa.string(), "n": pa.int64()}
    found = texts.mapInArrow(_counted(count, fields, 0), "lang string, phrase string, n bigint")
    return found.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def word_hashes(words: DataFrame) -> DataFrame:
    """(h) of stored words (lang, phrase), as the chunks of texts have them."""

    def count(lang: str, c: Chunk) -> dict:
        return {"h": c.hash.view(np.int64)}

    spelled = F.replace(F.replace(F.rtrim("phrase", F.lit(END)), F.lit("\x01\x02"), F.lit(END)), F.lit("\x01\x03"), F.lit(_ESCAPE))
    return words.select("lang", spelled.cast("binary").alias("text")).mapInArrow(_counted(count, {"h": pa.int64()}, 0), "h bigint")


def bitmap(hashes: DataFrame, shift: int, bits: int) -> bytes:
    """A bit for every hash of (h) without its last ``shift`` bits: 2^bits bits, whatever their number."""
    # Spark counts the places of a bitmap from 1
    at = hashes.select((F.shiftrightunsigned("h", shift) + 1).alias("bit"))
    parts = at.groupBy(F.bitmap_bucket_number("bit").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("m"))
    out = bytearray((1 << bits) // 8)
    for r in parts.collect():  # at most 2^bits / 32768 rows of 4 KB
        out[(r.k - 1) * 4096 : (r.k - 1) * 4096 + len(r.m)] = r.m
    return bytes(out)


def _hashed(texts: DataFrame, count: Callable[[str, Chunk], dict], ahead: int) -> DataFrame:
    found = texts.mapInArrow(_counted(count, {"h": pa.int64(), "n": pa.int64()}, ahead), "h bigint, n bigint")
    return found.groupBy("h").agg(F.sum("n").alias("n"))


def _sums(h: np.ndarray) -> dict:
    found, n = np.unique(h, return_counts=True)
    return {"h": found.view(np.int64), "n": n}


def prefix_counts(texts: DataFrame, bitmaps) -> DataFrame:
    """(h, n) of the prefixes one word longer than those of the last bitmap, both of whose shorter parts may be frequent."""

    def count(lang: str, c: Chunk) -> dict:
        h, may = c.longer(*c.frequent(bitmaps.value))
        return _sums(h[: c.own][may[: c.own]])

    return _hashed(texts, count, len(PRUNED))


def _is_in(h: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    at = np.searchsorted(sorted_, h)
    return (at < len(sorted_)) & (sorted_[np.minimum(at, len(sorted_) - 1)] == h) if len(sorted_) else np.zeros(len(h), bool)


def _extended(c: Chunk, h: np.ndarray, reach: np.ndarray, hot: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the prefix that places each suffix, words of its longest prefix over the budget, whether all lengths of ``hot`` were extended)."""
    words, more = np.zeros(len(h), np.int64), reach >= 1
    for k, over in enumerate(hot, 2):
        more = more & _is_in(h, over)
        words[more] = k  # also of a suffix that ends here, whose node is shared by several groups
        more &= reach >= k
        h = np.where(more, c.prefix(h, k), h)
    return h, words, more


def fitting_prefixes(texts: DataFrame, sizes: DataFrame, bitmaps, budget: int, longest: int) -> tuple[DataFrame, list[np.ndarray]]:
    """((h, n) of prefixes that fit the budget or are whole phrases, the hashes over it by length from 2 on)."""
    hot: list[np.ndarray] = []
    done = sizes
    for _ in range(2, longest):
        # each has over ``budget`` occurrences of its own, so there are fewer of them than groups
        over = np.array(sorted(r.h for r in sizes.where(F.col("n") > budget).select("h").collect()), np.int64).view(np.uint64)
        if not len(over):
            break
        hot.append(np.sort(over))
        known = texts.sparkSession.sparkContext.broadcast(list(hot))

        def count(lang: str, c: Chunk, known=known) -> dict:
            h, reach = c.reach(bitmaps.value, longest)
            h, _, longer = _extended(c, h, reach, known.value)
            return _sums(h[longer])

        sizes = durable(_hashed(texts, count, longest - 1))
        done = done.where(F.col("n") <= budget).unionByName(sizes)
    return done, hot


def subtree(leaves: dict[tuple[str, str], tuple[int, int]], least: int) -> Iterator[tuple[str, str, int, int]]:
    """Leaves (lang, phrase) to (hot, n) of whole subtrees, to their nodes (lang, phrase, words, n) of two or more words.

    A node is whole, and given if it counts ``least`` or more, unless it lies above an extended prefix of ``hot`` words.
    """
    path: list[str] = []  # words of the rightmost path, with the leaves counted below each and whether it is shared
    totals: list[int] = []
    shared: list[bool] = []

    def close(depth: int, lang: str) -> Iterator[tuple[str, str, int, int]]:
        while len(path) > depth:
            n, parts = totals.pop(), shared.pop()
            if (n >= least or parts) and len(path) > 1:
                yield lang, END.join(path) + END, len(path), n
            path.pop()
            if totals:
                totals[-1] += n

    before = ""
    for lang, phrase in sorted(leaves):
        hot, n = leaves[lang, phrase]
        words, depth = phrase.split(END)[:-1], 0
        if lang == before:
            for a, w in zip(path, words):
                if a != w:
                    break
                depth += 1
        yield from close(depth, before)
        before = lang
        path += words[depth:]
        totals += [0] * (len(words) - depth)
        shared += [False] * (len(words) - depth)
        totals[-1] += n
        for i in range(min(hot, len(words))):
            shared[i] = True
    yield from close(0, before)


def _nodes(least: int):
    """Fragments (lang, part, leaves) in order of the group, to the nodes of each group's subtrees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[int, int]] = {}  # of one group: at most about two budgets
        part = None

        def flush() -> pa.RecordBatch:
            found = [*zip(*subtree(held, least))] or [()] * 4
            held.clear()
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, kinds)], names=["lang", "phrase", "words", "n"])

        for b in batches:
            columns = b.column("lang").to_pylist(), b.column("part").to_pylist(), b.column("phrases"), b.column("hot"), b.column("n")
            for lang, own, phrases, hot, n in zip(*columns):
                if own != part:
                    yield flush()
                    part = own
                for phrase, longer, count in zip(phrases.as_py(), hot.as_py(), n.as_py()):
                    known = held.get((lang, phrase))
                    held[lang, phrase] = (longer, count + known[1] if known else count)
        yield flush()

    return run


def counted_phrases(docs: DataFrame, least: int, longest: int, budget: int, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, n) of all phrases that occur ``least`` times or more, (lang, n) of all word occurrences)."""
    texts, context = _texts(docs, text, lang), docs.sparkSession.sparkContext
    vocabulary_ = durable(vocabulary(texts))
    often = vocabulary_.where(F.col("n") >= least)
    maps, pairs = [bitmap(word_hashes(often), 64 - WORD_BITS, WORD_BITS)], None
    for _ in PRUNED:
        sizes = durable(prefix_counts(texts, context.broadcast(maps)).where(F.col("n") >= least))
        maps = [*maps, bitmap(sizes, _HASH - PREFIX_BITS, PREFIX_BITS)]
        pairs = sizes if pairs is None else pairs
    bitmaps = context.broadcast(maps)
    prefixes, hot = fitting_prefixes(texts, pairs, bitmaps, budget, longest)
    placed = with_running_total(prefixes, ["h"], "n", "upto")
    group = F.floor((F.col("upto") - F.col("n")) / budget)
    firsts = placed.groupBy(group.alias("g")).agg(F.min("h").alias("first")).collect()  # one row per ``budget`` occurrences
    known = context.broadcast((np.array(sorted(r["first"] for r in firsts), np.int64), hot))

    def count(lang: str, c: Chunk) -> dict:
        firsts, hot = known.value
        h, reach = c.reach(bitmaps.value, longest)
        at = np.flatnonzero(reach)
        # equal suffixes in one leaf: by hash and length, and compared word by word
        key = h.copy()
        for k in range(2, longest):
            key = np.where(reach >= k, c.prefix(key, k), key)
        order = at[np.lexsort((reach[at], key[at]))]
        same = np.zeros(len(order), bool)
        same[1:] = (key[order[1:]] == key[order[:-1]]) & (reach[order[1:]] == reach[order[:-1]])
        for k in range(longest):
            code = c.after(k, c.code)[order]
            same[1:] &= (code[1:] == code[:-1]) | (reach[order[1:]] < k)
        first = np.flatnonzero(~same)
        leaf = order[first]
        n = np.diff(np.append(first, len(order)))
        place, longer, _ = _extended(c, h, reach, hot)
        codes = [c.after(k, c.code)[leaf].tolist() for k in range(longest)]
        name = c.name
        phrase = ["".join([name(x) for x in row[: m + 1]]) for m, row in zip(reach[leaf].tolist(), zip(*codes))]
        part = np.searchsorted(firsts, place[leaf].view(np.int64), side="right")
        # one row per group: the chunk's part of the group's leaves
        order = np.argsort(part, kind="stable")
        groups, begin = np.unique(part[order], return_index=True)
        cuts = pa.array(np.append(begin, len(order)).astype(np.int32))
        listed = lambda x, kind: pa.ListArray.from_arrays(cuts, pa.array(x, kind))
        return {
            "lang": [lang] * len(groups), "part": groups.astype(np.int32), "phrases": listed([phrase[i] for i in order.tolist()], pa.string()),
            "hot": listed(longer[leaf][order].astype(np.int32), pa.int32()), "n": listed(n[order], pa.int64()),
        }

    fields = {"lang": pa.string(), "part": pa.int32(), "phrases": pa.list_(pa.string()), "hot": pa.list_(pa.int32()), "n": pa.list_(pa.int64())}
    kinds = "lang string, part int, phrases array<string>, hot array<int>, n array<bigint>"
    fragments = texts.mapInArrow(_counted(count, fields, longest - 1), kinds)
    dealt = fragments.repartition("part").sortWithinPartitions("part")
    nodes = dealt.mapInArrow(_nodes(least), "lang string, phrase string, words int, n bigint")
    whole = nodes.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    single = often.select("lang", "phrase", F.lit(1).alias("words"), "n")
    return whole.unionByName(single), vocabulary_.groupBy("lang").agg(F.sum("n").alias("n"))


def readable(phrase: Column) -> Column:
    """A stored phrase, space-joined."""
    spaced = F.replace(F.rtrim(phrase, F.lit(END)), F.lit(END), F.lit(" "))
    return F.replace(F.replace(spaced, F.lit("\x01\x02"), F.lit(END)), F.lit("\x01\x03"), F.lit(_ESCAPE))


def _words(phrase: Column, start: Column, n: Column) -> Column:
    """A stored phrase of ``n`` words of another, from a 0-based word on."""
    return F.concat(F.array_join(F.slice(F.split(phrase, END), start + 1, n), END), F.lit(END))


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, longest: int = 5, cover: int = 100, top: int = 2000,
    budget: int = 250_000,
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Candidates have 2 to ``longest`` words and ``least`` or more occurrences; the
    lowest score of all cuts counts. A candidate inside a longer one that has
    ``cover`` percent of its count is dropped.
    """
    counts, totals = counted_phrases(docs, least, longest, budget, text, lang)
    counts = durable(counts)
    known = counts.select("lang", "phrase", "n")
    found = counts.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    # contiguous shorter phrases of every candidate, with the count of the longest holder
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(F.sequence(F.lit(0), F.col("words") - n), lambda s: F.struct(s.alias("s"), n.alias("n")))))
    inner = found.where("words > 2").select("lang", "a", "phrase", F.explode(spans).alias("x"))
    inner = inner.groupBy("lang", _words(F.col("phrase"), F.col("x.s"), F.col("x.n")).alias("phrase")).agg(F.max("a").alias("holder"))
    open_ = found.join(inner, ["lang", "phrase"], "left").where(F.col("holder").isNull() | (100 * F.col("holder") < cover * F.col("a"))).drop("holder")
    cuts = open_.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumns({"__left": _words(F.col("phrase"), F.lit(0), F.col("k")), "__right": _words(F.col("phrase"), F.col("k"), F.col("words") - F.col("k"))})
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("__left"), F.col("n").alias("l")), ["lang", "__left"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("__right"), F.col("n").alias("r")), ["lang", "__right"])
    cuts = cuts.join(small(totals, _MAX_LANGS), "lang")
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    over = F.lit(1000).cast("decimal(4,0)") * exact("a")
    cuts = cuts.withColumns({"__over": over.cast("decimal(19,0)") * exact("n"), "__under": exact("l") * exact("r")})
    cuts = cuts.withColumn("score", F.expr("__over div __under"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("b")).select("lang", readable(F.col("phrase")).alias("phrase"), "b.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
