"""Field lookup in schemaless JSON objects (VARIANT columns)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipwell.functions.text import clean_comment

# Field names of comment objects, in priority order.
TEXT_KEYS = ("text", "content", "comment", "comment_text", "commenttext", "comment_content", "commentcontent")
INNER_TEXT_KEYS = ("text", "content", "value")
ID_KEYS = ("comment_id", "cid", "id")
LIKE_KEYS = ("like_count", "digg_count", "likes", "like", "upvote_count", "vote_count")
REPLY_KEYS = ("reply_count", "reply_cnt", "reply_num", "replynum", "sub_comment_count", "children_count")
TIME_KEYS = ("create_time", "created_at", "update_time", "updated_at", "publish_time")
AUTHOR_ID_KEYS = ("author_id", "uid", "user_id", "sec_uid", "sec_user_id")
AUTHOR_NAME_KEYS = ("author_name", "nickname", "nick_name", "user_name", "screen_name", "name")
AUTHOR_ID_BOXES = ("user", "user_info", "author", "author_info", "owner")
AUTHOR_NAME_BOXES = ("author", "user", "user_info", "author_info", "owner")
CONTAINER_KEYS = (
    "comment", "comments", "comment_list", "commentlist", "list", "data", "items",
    "replies", "reply_comment", "reply_comments",
)


def child(node: Column, key: str) -> Column:
    return F.try_variant_get(node, f"$.{key}", "variant")


def kind(node: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.schema_of_variant(node), r"^([A-Z]+)", 1), F.lit(""))


def is_object(node: Column) -> Column:
    return kind(node) == "OBJECT"


def is_array(node: Column) -> Column:
    return kind(node) == "ARRAY"


def _string(node: Column, key: str) -> Column:
    value = child(node, key)
    return F.when(kind(value) == "STRING", F.try_variant_get(node, f"$.{key}", "string"))


def _scalar(node: Column, key: str) -> Column:
    value = child(node, key)
    plain = kind(value).isin("STRING", "BIGINT", "DOUBLE", "FLOAT", "DECIMAL")
    return F.when(plain, F.try_variant_get(node, f"$.{key}", "string"))


def first_clean(found: Sequence[Column]) -> Column:
    """First text that is not blank after cleaning, '' when none."""
    cleaned = F.filter(F.transform(F.array_compact(F.array(*found)), lambda x: clean_comment(x)), lambda x: x != "")
    return F.coalesce(F.try_element_at(cleaned, F.lit(1)), F.lit(""))


def scalar(node: Column, keys: Sequence[str]) -> Column:
    """First filled text or number among the keys, '' when none."""
    return first_clean([_scalar(node, k) for k in keys])


def author_id(node: Column) -> Column:
    nested = [_scalar(child(node, box), k) for box in AUTHOR_ID_BOXES for k in AUTHOR_ID_KEYS]
    return first_clean([*[_scalar(node, k) for k in AUTHOR_ID_KEYS], *nested])


def author_name(node: Column) -> Column:
    """Direct name, then the author text, then the same inside author-like objects, at any depth, the first box first.

    Objects are walked level by level inside the row. The place of a name is the
    list of boxes that lead to it; lists compare like the walk that goes into a box before it looks at the next one.
    """
    own = lambda n: first_clean([_string(n, k) for k in (*AUTHOR_NAME_KEYS, "author")])
    boxes = "|".join(AUTHOR_NAME_BOXES)
    # no object lies deeper than there are such boxes in the text
    turns = F.regexp_count(F.to_json(node), F.lit(f'"({boxes})":[{{]'))
    start = F.struct(
        F.array(F.struct(F.array().cast("array<int>").alias("place"), node.alias("node"))).alias("open"),
        F.array().cast("array<struct<place: array<int>, name: string>>").alias("found"),
    )

    def inner(x: Column) -> Column:
        down = [F.struct(F.concat(x["place"], F.array(F.lit(i))).alias("place"), child(x["node"], b).alias("node")) for i, b in enumerate(AUTHOR_NAME_BOXES)]
        return F.filter(F.array(*down), lambda y: is_object(y["node"]))

    def step(state: Column, _: Column) -> Column:
        named = F.transform(state["open"], lambda x: F.struct(x["place"].alias("place"), own(x["node"]).alias("name")))
        found = F.concat(state["found"], F.filter(named, lambda x: x["name"] != ""))
        return F.struct(F.flatten(F.transform(state["open"], inner)).alias("open"), found.alias("found"))

    deep = F.aggregate(F.sequence(F.lit(0), turns), start, step, lambda s: F.array_min(s["found"])["name"])
    direct = own(node)
    return F.when(direct != "", direct).when(turns > 0, F.coalesce(deep, F.lit(""))).otherwise("")


def comment_text(node: Column) -> Column:
    found = []
    for key in TEXT_KEYS:
        found.append(_string(node, key))
        found += [_scalar(child(node, key), k) for k in INNER_TEXT_KEYS]
    return first_clean(found)
