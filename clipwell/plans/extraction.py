"""Extraction of counters, links and comments from raw pages, body texts and API payloads.

Everything that concerns one page stays in that page's row (array functions on
its own text), so nothing is shuffled to read a page. Only payload objects,
whose depth is open, are exploded; their duplicates are cut per task first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwell.functions import lexicons as lx
from clipwell.functions import nodes
from clipwell.functions.coerce import filled, text
from clipwell.functions.numbers import comment_count_text, page_count
from clipwell.functions.rows import exploded
from clipwell.functions.text import canonical_url, clean_comment, content_hash, has_any, loose_id, plausible_comment, visible_text
from clipwell.operators.ordering import durable
from clipwell.operators.picking import one_per_key, top_per_key

NO_TEXTS = "array<string>"

# A count in a page, a count token, scripts, fragments that hint at comments.
COUNT_VALUE = r"-?[0-9]+(?:\.[0-9]+)?(?:[,_][0-9]{3})*(?:\.[0-9]+)?(?:\s*[万亿])?"
COUNT_TOKEN = r"^[0-9]+(\.[0-9]+)?(万|亿)?$"
SCRIPT = r"(?is)<script\b[^>]*>(.*?)</script>"
FRAGMENT = r"(?is)<(div|span|p|li|a|article|section)([^>]*)>(.*?)</\1>"
COMMENT_HINT = "(?i)comment|reply"
LIKE_LINE = r"^[0-9]+(\.[0-9]+)?(w|万)?$"


def scripts(html: Column) -> Column:
    found = F.transform(F.regexp_extract_all(html, F.lit(SCRIPT), 1), lambda s: F.btrim(s))
    return F.filter(found, lambda s: s != "")


# -- page counters ------------------------------------------------------------------

def _values(source: Column, keys: Sequence[str]) -> Column:
    names = "|".join(keys)
    found = F.regexp_extract_all(source, F.lit(rf"(?is)[\"']?(?:{names})[\"']?\s*[:=]\s*[\"']?({COUNT_VALUE})[\"']?"), 1)
    return F.array_compact(F.transform(found, lambda v: page_count(v)))


def _values_of(keys: Sequence[str]):
    return lambda source: _values(source, keys)


def page_metrics(
    pages: DataFrame, html: str, body: str | None = None, keys: Mapping[str, Sequence[str]] = lx.PAGE_METRIC_KEYS,
) -> DataFrame:
    """Counters from key/value pairs: scripts first, then the page, then the body; the largest value wins."""
    out = pages.withColumn("__scripts", scripts(F.col(html)))
    cols = {}
    for name, aliases in keys.items():
        in_scripts = F.flatten(F.transform(F.col("__scripts"), _values_of(aliases)))
        sources = [in_scripts, _values(F.col(html), aliases)]
        if body:
            sources.append(_values(F.coalesce(F.col(body), F.lit("")), aliases))
        cols[f"__{name}"] = F.array(*sources)
    out = out.withColumns(cols)
    final = {}
    for name in keys:
        found = F.filter(F.col(f"__{name}"), lambda a: F.size(a) > 0)
        final[name] = F.coalesce(F.array_max(F.try_element_at(found, F.lit(1))), F.lit(0).cast("bigint"))
        final[f"{name}_candidates"] = F.size(F.flatten(F.col(f"__{name}"))).cast("bigint")
    return out.withColumns(final).drop("__scripts", *cols)


@dataclass(frozen=True)
class TextMarkers:
    """Markers around the counters of a body text. Fixed default values."""

    published: str = "发布时间："
    published_word: str = "发布时间"
    report: str = "举报"
    first_comment: str = "抢首评"
    noisy: tuple[str, ...] = ("获赞", "关注", "推荐视频", "下载客户端")
    before: int = 260
    after: int = 40
    tail_lines: int = 12
    too_large: int = 100_000_000


def text_metrics(rows: DataFrame, body: str, m: TextMarkers = TextMarkers()) -> DataFrame:
    """Like, comment and share counts from the last count tokens near a marker; ``matched`` tells if they hold."""
    raw = F.coalesce(F.col(body), F.lit(""))
    flat = F.btrim(F.regexp_replace(raw, r"\s+", " "))

    def around(marker: str) -> Column:
        at = F.locate(marker, raw) - 1
        start = F.greatest(F.lit(0), at - m.before)
        return F.substring(raw, start + 1, at + m.after - start)

    section = (
        F.when(raw.contains(m.published), around(m.published)).when(raw.contains(m.report), around(m.report))
        .otherwise(F.right(flat, F.lit(m.before)))
    )
    out = rows.withColumn("__lines", F.filter(F.split(section, r"\s+"), lambda x: x != ""))
    lines = F.col("__lines")
    numbers = F.filter(lines, lambda x: x.rlike(COUNT_TOKEN))
    last4 = F.slice(numbers, F.greatest(F.lit(1), F.size(numbers) - 3), F.lit(4))
    counts = F.filter(F.transform(last4, lambda x: page_count(x)), lambda v: v < m.too_large)
    tail = F.array_join(F.slice(lines, F.greatest(F.lit(1), F.size(lines) - m.tail_lines + 1), F.lit(m.tail_lines)), " ")
    block = ~has_any(tail, m.noisy) & has_any(tail, (m.published_word, m.report, m.first_comment))
    out = out.withColumns({"__counts": counts, "__first": F.exists(lines, lambda x: x.contains(m.first_comment)), "matched": block})
    c, n = F.col("__counts"), F.size("__counts")
    ok = F.col("matched") & (n > 0)
    pick = lambda i, cond: F.when(ok & cond, F.try_element_at(c, F.lit(i))).otherwise(F.lit(0).cast("bigint"))
    return out.withColumns({
        "matched": ok,
        "like_count": pick(1, F.lit(True)),
        "comment_count": pick(2, ~F.col("__first") & (n >= 2)),
        "share_count": F.when(F.col("__first"), pick(-1, n >= 2)).otherwise(pick(-1, n >= 3)),
    }).drop("__lines", "__counts", "__first")


# -- homepage links -------------------------------------------------------------------

# Links and id keys of posts in a homepage.
URL_PATTERN = r"(?:(?:https?:)?//[^\"'\s<>]+)?/video/([A-Za-z0-9_-]+)"
KEYED = r"[\"']?(?:{keys})[\"']?\s*[:=]\s*[\"']?([A-Za-z0-9_-]{{6,128}})"
ID_KEYS = ("aweme_id", "modal_id", "item_id", "group_id")


def homepage_candidates(
    pages: DataFrame, html: str, url: str, cap: int, patterns: Sequence[str] | None = None,
) -> DataFrame:
    """Post ids of a page in three passes (links, first id key, all id keys), up to ``cap``, with diagnostics."""
    pats = patterns or (URL_PATTERN, KEYED.format(keys=ID_KEYS[0]), KEYED.format(keys="|".join(ID_KEYS)))
    space = F.replace(F.coalesce(F.col(html), F.lit("")), F.lit("\\/"), F.lit("/"))
    out = pages.withColumns({f"__p{i}": F.regexp_extract_all(space, F.lit(p), 1) for i, p in enumerate(pats)})
    out = out.withColumn("__all", F.concat(*[F.col(f"__p{i}") for i in range(len(pats))]))
    out = out.withColumn("__kept", F.slice(F.array_distinct(F.filter("__all", lambda x: loose_id(x))), 1, cap))
    stop = F.array_position("__all", F.element_at("__kept", -1))
    out = out.withColumn("__cut", F.when(F.size("__kept") >= cap, stop).otherwise(F.size("__all")))
    out = out.withColumn("__seen", F.slice("__all", F.lit(1), F.col("__cut").cast("int")))
    sizes, before = {}, F.lit(0)
    for i in range(len(pats)):
        size = F.size(f"__p{i}")
        sizes[f"pass{i + 1}_matches"] = F.greatest(F.lit(0), F.least(size, F.col("__cut") - before)).cast("bigint")
        before = before + size
    good = F.size(F.filter("__seen", lambda x: loose_id(x)))
    return out.withColumns({
        **sizes,
        "unique_ids": F.size("__kept").cast("bigint"),
        "invalid_candidates": (F.size("__seen") - good).cast("bigint"),
        "duplicate_candidates": (good - F.size("__kept")).cast("bigint"),
        "videos": F.transform("__kept", lambda v: F.struct(v.alias("video_id"), canonical_url(url, v).alias("video_url"))),
    }).drop("__all", "__kept", "__cut", "__seen", *[f"__p{i}" for i in range(len(pats))])


# -- comments in body texts -------------------------------------------------------------

@dataclass(frozen=True)
class CommentMarkers:
    """Words of the comment section of a body text. Fixed default values."""

    start: str = "全部评论"
    ends: tuple[str, ...] = ("加载中", "下载客户端，桌面快捷访问", "推荐视频", "广告投放", "暂时没有更多评论", "大家都在搜", "相关推荐")
    empty: tuple[str, ...] = ("暂无评论", "抢首评", "还没有评论")
    share: str = "分享"
    reply: str = "回复"
    waiting: tuple[str, ...] = ("加载中", "暂时没有更多评论")
    not_authors: tuple[str, ...] = ("...", "留下你的精彩评论吧", "大家都在搜：", "加载中", "暂时没有更多评论")
    badges: tuple[str, ...] = ("...", "作者", "置顶")
    badge_end: str = "赞过"
    stub: str = "[评论正文未渲染] "
    open_section: int | None = None  # characters of a section without an end, None for all


REPLIES_LINE = "^展开([0-9]+)条回复$"
META_LINE = (
    r"(?:刚刚|昨天|前天|\d{1,2}[/-]\d{1,2}|\d{4}[/-]\d{1,2}[/-]\d{1,2}|\d+\s*(?:分钟|小时|天|周|月|年)前)"
    r"(?:\s+\d{1,2}:\d{2})?(?:·[^\n]{1,40})?$"
)
BLOCK = (
    r"(?m)((?!\.\.\.$)[^\n]{1,80})\n(?:\.\.\.\n)?([^\n]{2,200})\n(\d+[^\n]{0,40})\n(\d+(?:\.\d+)?(?:w|万)?)\n分享\n回复(?:\n展开(\d+)条回复)?"
)


def comment_section(body: Column, m: CommentMarkers = CommentMarkers()) -> Column:
    """Part of the text that holds the comments; '' without the start marker."""
    after = F.substring(body, F.locate(m.start, body) + len(m.start), F.length(body))
    first = lambda words: F.least(*[F.nullif(F.locate(w, after), F.lit(0)) for w in words])
    end, empty = first(m.ends), first(m.empty)
    size = F.lit(0)
    for w in reversed(m.empty):
        size = F.when(F.locate(w, after) == empty, len(w)).otherwise(size)
    cut = (
        F.when(end.isNotNull() & empty.isNotNull() & (end < empty), F.substring(after, F.lit(1), empty - 1 + size))
        .when(end.isNotNull(), F.substring(after, F.lit(1), end - 1))
        .otherwise(after if m.open_section is None else F.left(after, F.lit(m.open_section)))
    )
    return F.when(F.locate(m.start, body) > 0, F.btrim(cut, F.lit(" \t\r\n"))).otherwise(F.lit(""))


def _is_control(x: Column, m: CommentMarkers) -> Column:
    return x.isin(m.share, m.reply, *m.waiting) | (x.startswith("展开") & x.endswith("条回复"))


def _tagged(line: Column, m: CommentMarkers) -> Column:
    """A line with the roles it can play; each line is judged once."""
    meta, like, control = line.rlike(META_LINE), line.rlike(LIKE_LINE), _is_control(line, m)
    author = (line != "") & ~line.isin(*m.not_authors) & (F.length(line) <= 80) & ~meta & ~control & ~like
    body = plausible_comment(line) & ~meta & ~control
    return F.struct(
        line.alias("line"), author.alias("author"), body.alias("body"), meta.alias("meta"), like.alias("like"), control.alias("control"),
        F.regexp_extract(line, REPLIES_LINE, 1).alias("replies"),
    )


def _item(author: Column, content: Column, seed: Column, meta: Column, like: Column, reply: Column, source: str) -> Column:
    hashed = content_hash(seed)
    return F.struct(
        F.concat(F.lit("cmt_"), F.left(hashed, F.lit(16))).alias("comment_id"), author.alias("author_name"), content.alias("content"),
        comment_count_text(like).alias("like_count"), comment_count_text(reply).alias("reply_count"), meta.alias("meta_line"),
        hashed.alias("content_hash"), F.lit(source).alias("source"),
    )


def _first_by_hash(df: DataFrame, items: str, cap: int | None) -> DataFrame:
    """First item per hash in an array column; equal hashes meet by sorting, so long pages take no quadratic time."""
    out = df.withColumn("__ranked", F.sort_array(F.transform(items, lambda x, i: F.struct(x["content_hash"].alias("h"), i.alias("i")))))
    new = lambda r, i: F.coalesce(F.get("__ranked", i - 1)["h"] != r["h"], F.lit(True))
    out = out.withColumn("__firsts", F.sort_array(F.transform(F.filter("__ranked", new), lambda r: r["i"])))
    kept = F.col("__firsts") if cap is None else F.slice("__firsts", 1, cap)
    return out.withColumn(items, F.transform(kept, lambda i: F.get(items, i))).drop("__ranked", "__firsts")


def body_comments(rows: DataFrame, body: str, m: CommentMarkers = CommentMarkers(), cap: int | None = None) -> DataFrame:
    """Comments of a body text: whole blocks, else line patterns, else stubs of unrendered ones.

    Adds ``comments`` (array of structs) and the hit counters of the three ways.
    A later way runs only on pages where the earlier ones found nothing.
    """
    out = rows.withColumn("__section", comment_section(F.coalesce(F.col(body), F.lit("")), m))
    out = out.withColumn("__blocks", F.regexp_extract_all("__section", F.lit(BLOCK), 0))
    part = lambda b, g: clean_comment(F.regexp_extract(b, BLOCK, g))
    parts = F.transform("__blocks", lambda b: F.struct(*[part(b, g).alias(f"p{g}") for g in range(1, 6)]))
    kept = F.filter(parts, lambda p: plausible_comment(p["p2"]) & ~p["p1"].isin(*m.not_authors[:3]))
    out = out.withColumn("__kept", kept)
    out = out.withColumn("__a", F.transform("__kept", lambda p: _item(p["p1"], p["p2"], p["p2"], p["p3"], p["p4"], p["p5"], "body_text_block")))

    badge = lambda x: x.isin(*m.badges) | x.endswith(m.badge_end)
    split = F.filter(F.transform(F.split("__section", r"\r?\n"), lambda x: F.btrim(x)), lambda x: (x != "") & ~badge(x))
    none = F.array().cast(NO_TEXTS)
    out = out.withColumn("__clean", F.when(F.size("__a") == 0, F.transform(split, lambda x: clean_comment(x))).otherwise(none))
    out = out.withColumn("__lines", F.transform("__clean", lambda x: _tagged(x, m)))
    lines, size = F.col("__lines"), F.size("__lines")
    at = lambda i: F.try_element_at(lines, i + 1)
    yes = lambda i, role: F.coalesce(at(i)[role], F.lit(False))
    say = lambda i: F.coalesce(at(i)["line"], F.lit(""))

    # Other lines than controls, and for each of them where a run of controls that begins three or four lines later stops:
    # at one of the next four others.
    placed = F.transform(lines, lambda x, i: F.struct(i.alias("i"), x["control"].alias("control")))
    out = out.withColumn("__others", F.transform(F.filter(placed, lambda s: ~s["control"]), lambda s: s["i"]))

    def stop(r: Column, start: Column) -> Column:
        after = [F.get("__others", r + k) for k in range(1, 5)]
        return F.coalesce(*[F.when(x >= start, x) for x in after], size)

    spot = lambda i, r: F.struct(i.alias("i"), stop(r, i + 3).alias("stop3"), stop(r, i + 4).alias("stop4"))

    def controls(start: Column, end: Column) -> Column:
        """Run of control lines from ``start`` to before ``end``."""
        return F.slice(lines, start + 1, F.greatest(end - start, F.lit(0)))

    def replies(run: Column) -> Column:
        counts = F.filter(F.transform(run, lambda x: x["replies"]), lambda x: x != "")
        return F.coalesce(F.try_element_at(counts, F.lit(-1)), F.lit(""))

    def shows(run: Column, word: str) -> Column:
        return F.exists(run, lambda x: x["line"] == word)

    out = out.withColumn("__spots", F.filter(F.transform("__others", spot), lambda s: yes(s["i"], "author")))
    full = F.filter("__spots", lambda s: yes(s["i"] + 1, "body") & yes(s["i"] + 2, "meta") & yes(s["i"] + 3, "like"))
    after3 = lambda s: controls(s["i"] + 3, s["stop3"])
    bare = F.filter("__spots", lambda s: (
        yes(s["i"] + 1, "meta") & yes(s["i"] + 2, "like") & shows(after3(s), m.share) & shows(after3(s), m.reply)
    ))
    out = out.withColumns({"__full": full, "__bare": bare})

    def whole(s: Column) -> Column:
        i = s["i"]
        return _item(say(i), say(i + 1), say(i + 1), say(i + 2), say(i + 3), replies(controls(i + 4, s["stop4"])), "body_text_lines")

    def stub(s: Column) -> Column:
        i = s["i"]
        return _item(
            say(i), F.concat(F.lit(m.stub), say(i), F.lit(" "), say(i + 1)), F.concat_ws("|", say(i), say(i + 1), say(i + 2)),
            say(i + 1), say(i + 2), replies(after3(s)), "body_text_stub",
        )

    out = out.withColumn("__b", F.transform("__full", whole))
    stubs = F.transform("__bare", stub)
    out = out.withColumn("__c", F.when(F.size("__full") == 0, stubs).otherwise(F.slice("__b", 1, 0)))
    for items in ("__a", "__b", "__c"):
        out = _first_by_hash(out, items, cap)
    return out.withColumns({
        "comments": F.concat("__a", "__b", "__c"),
        "body_text_blocks": (F.size("__a") + F.size("__b")).cast("bigint"), "body_text_stub_blocks": F.size("__c").cast("bigint"),
    }).drop(*[c for c in out.columns if c.startswith("__")])


def body_comment_rows(rows: DataFrame, keys: Sequence[str], body: str, m: CommentMarkers = CommentMarkers(), cap: int | None = None) -> DataFrame:
    """One row per comment of ``body_comments``."""
    return exploded(body_comments(rows, body, m, cap), keys, "comments", "c").select(*keys, "c.*")


# -- comments in API payloads -----------------------------------------------------------

def _children(node: Column) -> Column:
    none = F.array().cast("array<variant>")
    inner = (
        F.when(nodes.is_object(node), F.map_values(F.try_variant_get(node, "$", "map<string,variant>")))
        .when(nodes.is_array(node), F.try_variant_get(node, "$", "array<variant>"))
    )
    kept = F.filter(F.coalesce(inner, none), lambda v: nodes.kind(v).isin("OBJECT", "ARRAY"))
    return kept


STEP = 8


def payload_comments(
    payloads: DataFrame, key: str, body: str, response_url: Column | None = None, depth: int | None = None, cap: int | None = None,
) -> DataFrame:
    """Comment objects at any depth, one row per distinct text and payload.

    ``STEP`` levels are walked inside the payload's row and exploded; what lies
    deeper is stored and walked again, until nothing is left. ``depth`` stops at
    so many levels; ``cap`` keeps the first rows per payload in walking order.
    """
    rows = payloads if response_url is None else payloads.where(has_any(F.lower(text(response_url)), lx.COMMENT_RESPONSES))
    raw = F.col(body)
    hinted = F.lit(False)
    for k in (*nodes.TEXT_KEYS, *nodes.CONTAINER_KEYS):
        hinted = hinted | raw.contains(f'"{k}"')
    level = rows.where(hinted).select(key, F.array(F.try_parse_json(body)).alias("__l0"))
    found, done = None, 0
    while True:
        step = STEP if depth is None else min(STEP, depth - done)
        for d in range(1, step + 1):
            level = level.withColumn(f"__l{d}", F.flatten(F.transform(f"__l{d - 1}", _children)))
        top = step + 1 if depth is not None and done + step >= depth else step  # the last level opens the next walk
        walked = F.concat(*[F.col(f"__l{d}") for d in range(top)])
        part = exploded(level, [key], walked, "node", "position").withColumn("position", F.col("position") + F.lit(done << 32))
        found = part if found is None else found.unionByName(part)
        done += step
        if top > step:
            break
        # variants are stored as text, which every format keeps
        deeper = level.where(F.size(f"__l{step}") > 0).select(key, F.transform(f"__l{step}", lambda v: F.to_json(v)).alias("__texts"))
        deeper = durable(deeper)
        if deeper.isEmpty():
            break
        level = deeper.select(key, F.transform("__texts", F.try_parse_json).alias("__l0"))
    node = F.col("node")
    found = found.where(nodes.is_object(node)).withColumn("content", nodes.comment_text(node))
    found = found.where(plausible_comment(F.col("content"))).withColumn("content_hash", content_hash("content"))
    first = one_per_key(found, [key, "content_hash"], [F.col("position").asc()])
    if cap is not None:
        first = top_per_key(first, [key], [F.col("position").asc()], cap, "__pos").drop("__pos")
    return first.select(
        key, "position", F.coalesce(filled(nodes.scalar(node, nodes.ID_KEYS)), F.concat(F.lit("cmt_"), F.left("content_hash", F.lit(16)))).alias("comment_id"),
        nodes.author_id(node).alias("author_id"), nodes.author_name(node).alias("author_name"), "content",
        comment_count_text(nodes.scalar(node, nodes.LIKE_KEYS)).alias("like_count"),
        comment_count_text(nodes.scalar(node, nodes.REPLY_KEYS)).alias("reply_count"),
        nodes.scalar(node, nodes.TIME_KEYS).alias("created_at"), "content_hash",
    )


# -- comments inside HTML ---------------------------------------------------------------

def _unescaped_json(c: Column) -> Column:
    return F.coalesce(F.try_variant_get(F.try_parse_json(F.concat(F.lit('"'), c, F.lit('"'))), "$", "string"), c)


def html_comments(pages: DataFrame, key: str, html: str, hint: str = COMMENT_HINT, words: Sequence[str] = ("text", "content", "comment"),
                  script_hint: str = "(?i)comment|application/json|ld\\+json|__next_data__", cap: int | None = None, terminated: bool = False) -> DataFrame:
    """Texts of comment-like fragments and of comment strings in scripts, one row per distinct text and page.

    ``terminated`` leaves entities without their semicolon as they are.
    """
    names = "|".join(words)
    fragments = F.regexp_extract_all(html, F.lit(FRAGMENT), 0)
    hinted = F.filter(fragments, lambda f: F.regexp_extract(f, r"(?is)^<\w+([^>]*)>", 1).rlike(hint))
    texts = F.transform(hinted, lambda f: visible_text(F.regexp_extract(f, FRAGMENT, 3), terminated))
    blocks = F.filter(F.regexp_extract_all(html, F.lit(r"(?is)<script\b[^>]*>.*?</script>"), 0), lambda s: s.rlike(script_hint))
    quoted = [rf"(?is)\"(?:{names})\"\s*:\s*\"((?:\\.|[^\"\\]){{2,500}}?)\"", rf"(?is)'(?:{names})'\s*:\s*'((?:\\.|[^'\\]){{2,500}}?)'"]
    strings = F.flatten(F.transform(blocks, lambda s: F.concat(*[F.regexp_extract_all(s, F.lit(q), 1) for q in quoted])))
    pairs = F.concat(
        F.transform(texts, lambda x: F.struct(F.lit("dom_regex").alias("source"), x.alias("raw"))),
        F.transform(strings, lambda x: F.struct(F.lit("dom_json").alias("source"), _unescaped_json(x).alias("raw"))),
    )
    found = exploded(pages, [key], pairs, "hit", "position").select(
        key, "position", "hit.source", clean_comment("hit.raw", terminated).alias("content")
    )
    found = found.where(plausible_comment(F.col("content"))).withColumn("content_hash", content_hash("content", terminated))
    first = one_per_key(found, [key, "content_hash"], [F.col("position").asc()])
    kept = first if cap is None else top_per_key(first, [key], [F.col("position").asc()], cap, "__pos").drop("__pos")
    return kept.withColumns(comment_signals(F.col("content"), terminated))


def hit_counters(found: DataFrame, source: str = "source") -> DataFrame:
    return found.groupBy(source).agg(F.count(F.lit(1)).alias("n"))


def comment_signals(c: Column, terminated: bool = False) -> dict[str, Column]:
    """Author, like and reply counts mentioned inside a comment text."""
    t = clean_comment(c, terminated)
    reply = F.coalesce(
        F.nullif(F.regexp_extract(t, r"(?i)回复\s*([0-9]+(?:\.[0-9]+)?(?:w|万)?)", 1), F.lit("")),
        F.nullif(F.regexp_extract(t, r"(?i)([0-9]+(?:\.[0-9]+)?(?:w|万)?)\s*条?回复", 1), F.lit("")), F.lit(""),
    )
    return {
        "author_name": F.regexp_extract(t, r"(?i)(?:作者|author)\s*[:：]\s*([^\s，,。:：]{1,32})", 1),
        "like_count": comment_count_text(F.regexp_extract(t, r"(?i)([0-9]+(?:\.[0-9]+)?(?:w|万)?)\s*赞", 1)),
        "reply_count": comment_count_text(reply),
    }


# -- media URLs -------------------------------------------------------------------------

@dataclass(frozen=True)
class MediaWords:
    """Tokens of media addresses. Fixed default values."""

    media: tuple[str, ...] = (".mp4", ".m3u8", "video_mp4", "playwm", "playaddr", "aweme/v1/play", "/play/", "/video/tos/", "douyinvod.com")
    excluded: tuple[str, ...] = ("douyin_pc_client.mp4", "bytednsdoc.com", "/download/", "client/download")
    explicit: tuple[str, ...] = ("video_mp4", ".mp4", ".m3u8", "aweme/v1/play", "douyinvod.com")
    host: tuple[str, ...] = ("douyinvod.com",)
    sources: tuple[str, ...] = ("dom_media_element", "network_response")
    notes: tuple[str, ...] = ("video", "media")


def media_candidates(rows: DataFrame, keys: Sequence[str], expected: Column, w: MediaWords = MediaWords(), best: int = 1) -> DataFrame:
    """Media addresses ranked by eight criteria per post; the best ones kept."""
    url = F.lower(text("url"))
    rank = [
        has_any(url, w.excluded).cast("int"),
        (~((text(expected) != "") & url.contains(F.lower(text(expected))))).cast("int"),
        (~F.lower(text("mime_type")).contains("video/")).cast("int"),
        (~has_any(url, w.host)).cast("int"), (~has_any(url, w.explicit)).cast("int"),
        (~F.lower(text("source")).isin(*w.sources)).cast("int"), (~has_any(F.lower(text("note")), w.notes)).cast("int"), url,
    ]
    usable = rows.where((url.startswith("http://") | url.startswith("https://")) & has_any(url, w.media))
    return top_per_key(usable.withColumn("excluded", has_any(url, w.excluded)), keys, [r.asc() for r in rank], best)
